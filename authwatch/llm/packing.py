"""Hierarchical multi-length packing of token sequences.

Documents become ids plus an end id. Whole windows of the longest tier are cut
off first; what is left of a document goes to the shortest tier that holds it.
From the longest tier down, each document opens a window of its tier, and the
gap is filled from shorter tiers: whole documents that fit, longest first, then
a cut one. Windows that are not full wait for the next documents, so only the
last of a partition is padded. Sequences are dealt to step groups, always to the
group with the fewest tokens, so that groups weigh the same.

Each partition packs its own documents in one pass with a bounded buffer; there
is no shuffle. A null text is empty and packs its end id alone. Repeated rows
are packed again, null ids stay null, and other columns are ignored. Texts of any
length are taken whole; an empty table gives no pieces.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator
from heapq import heapreplace
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from authwatch.llm.batches import split_by_size, texts, type_of
from authwatch.llm.bpe_files import BYTE_LEVEL_PATTERN, Vocabulary, lookup

TIERS = (2048, 1024, 512, 256)
#: Tokens that wait before a partition packs them.
BUFFER_TOKENS = 1 << 20
#: Tokens of a step group.
STEP_TOKENS = 1 << 16


class Piece(NamedTuple):
    """``length`` ids of document ``row`` from ``start`` on; sorts by length."""

    length: int
    row: int
    start: int


class Packer:
    """Pieces in, full windows out: (tier, pieces)."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers = tuple(sorted(tiers, reverse=True))
        self.pools: dict[int, list[Piece]] = {tier: [] for tier in self.tiers}
        self.waiting = 0

    def add(self, row: int, length: int) -> Iterator[tuple[int, list[Piece]]]:
        """Takes a document; gives the windows that it fills alone."""
        longest = self.tiers[0]
        for start in range(0, length - longest + 1, longest):
            yield longest, [Piece(longest, row, start)]
        if rest := length % longest:
            self._put(Piece(rest, row, length - rest))
            self.waiting += rest

    def _put(self, piece: Piece) -> None:
        tier = min(tier for tier in self.tiers if tier >= piece.length)
        insort(self.pools[tier], piece)

    def _fill(self, gap: int, tiers: tuple[int, ...]) -> Iterator[Piece]:
        """Pieces that fill the gap: whole ones, longest first, then a cut one."""
        for tier in tiers:
            pool = self.pools[tier]
            while gap and (at := bisect_right(pool, (gap, float("inf"), 0))):
                piece = pool.pop(at - 1)
                gap -= piece.length
                yield piece
        for tier in reversed(tiers):
            if gap and self.pools[tier]:
                piece = self.pools[tier].pop()
                yield Piece(gap, piece.row, piece.start)
                self._put(Piece(piece.length - gap, piece.row, piece.start + gap))
                return

    def pack(self) -> Iterator[tuple[int, list[Piece]]]:
        """Full windows; pieces of one that stays open return to their tiers."""
        for place, tier in enumerate(self.tiers):
            while self.pools[tier]:
                first = self.pools[tier].pop()
                window = [first, *self._fill(tier - first.length, self.tiers[place + 1:])]
                gap = tier - sum(piece.length for piece in window)
                window += self._fill(gap, self.tiers[place:place + 1])
                filled = sum(piece.length for piece in window)
                if filled < tier:
                    # Nothing shorter is left: an open window of this tier stays.
                    for piece in window:
                        self._put(piece)
                    break
                self.waiting -= tier
                yield tier, window

    def rest(self) -> list[Piece]:
        """What is left at the end, all of it shorter than the longest window."""
        left = [piece for pool in self.pools.values() for piece in pool]
        self.pools = {tier: [] for tier in self.tiers}
        self.waiting = 0
        return left


class TextIds:
    """Ids of a text, as the tokenizers library gives them, as little-endian unsigned 32-bit
    integers.

    Stretches of ordinary characters go through the faster library with the
    vocabulary of the file (its ids are the ranks of its merges, so both give the
    same); others through the model of the tokenizers library, word by word.
    """

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        ranks = {bytes(vocab.byte_of[letter] for letter in name): number
                 for name, number in vocab.ids.items() if name not in vocab.special}
        self.fast = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})

    def ids(self, text: str) -> Iterator[list[int]]:
        for special, piece in self.vocab.pieces(text):
            if special:
                yield [self.vocab.special[piece]]
            elif self.vocab.is_ordinary(piece):
                yield self.fast.encode_ordinary(piece)
            else:
                for word in self.vocab.library_words(piece):
                    letters = "".join(self.vocab.letters[b]
                                      for b in word.encode("utf-8", "surrogateescape"))
                    yield [token.id for token in self.vocab.tokenizer.model.tokenize(letters)]

    def __call__(self, text: str) -> bytes:
        return b"".join(np.array(part, "<u4").tobytes() for part in self.ids(text))


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                   end_id: int = 1, tiers: tuple[int, ...] = TIERS,
                   step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    tier and step_group.

    Sequence and group ids are unique: the partition's number stands above the
    running number.
    """
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 33
        encoded = lookup("ids", path, TextIds)
        end = np.array([end_id], "<u4").tobytes()
        packer, ids, keys = Packer(tiers), {}, {}
        sequences = groups = row = 0
        done: list[tuple[int, list[Piece]]] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal sequences, groups, done
            done += packer.pack()
            if last and (left := packer.rest()):
                # Less than a window of each tier: one or two padded sequences.
                window, size = [], 0
                for piece in left:
                    if size + piece.length > tiers[0]:
                        done.append((tiers[0], window))
                        window, size = [], 0
                    window.append(piece)
                    size += piece.length
                done.append((tiers[0], window))
            if not done:
                return
            total = sum(piece.length for _, window in done for piece in window)
            loads = [(0, groups + n) for n in range(max(1, round(total / step_tokens)))]
            groups += len(loads)
            out = []
            for tier, window in sorted(done, key=lambda x: -x[0]):
                load, group = loads[0]
                heapreplace(loads, (load + sum(p.length for p in window), group))
                offset = 0
                for length, number, start in window:
                    out.append((keys[number], start, length,
                                crc32(ids[number][4 * start:4 * (start + length)]),
                                len(ids[number]) // 4, base + sequences, offset, tier,
                                base + group))
                    offset += length
                sequences += 1
            done = []
            open_rows = {piece.row for pool in packer.pools.values() for piece in pool}
            for number in list(ids):
                if number not in open_rows:
                    del ids[number], keys[number]
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:])],
                ["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                 "tier", "step_group"])

        id_type, held = None, 0
        for whole in batches:
            id_type = whole.schema.field(0).type
            for batch in split_by_size(whole):
                for key, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)),
                                     strict=True):
                    ids[row] = encoded(text) + end
                    keys[row] = key
                    done += packer.add(row, len(ids[row]) // 4)
                    held += len(ids[row]) // 4
                    row += 1
                    if held >= BUFFER_TOKENS:
                        yield from flush(False)
                        held = packer.waiting
        if id_type is not None:
            yield from flush(True)

    return docs.select(id_col, text_col).mapInArrow(
        over, f"doc {type_of(docs, id_col)}, start long, length long, ids_crc32 long, "
        "doc_tokens long, sequence_id long, offset long, tier long, step_group long"
    ).withColumnRenamed("doc", id_col)

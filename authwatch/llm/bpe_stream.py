"""BPE encoding and decoding as streaming transducers with bounded lookahead.

Encoding: the merge list itself bounds how far to the left an unknown symbol
can reach (``lookahead``). Tokens that end further left than that from the last
symbol read are stable; they are emitted, and the rest is kept as symbols, since
a stretch of a tokenization is the tokenization of that stretch. Memory is the
lookahead plus a fixed chunk, however long the word.

Decoding: a state machine takes one token at a time and gives text as soon as
it is decided. Byte-level files turn letters to bytes and bytes to text, with at
most one unfinished character as state; files without a decoder join the token
names by blanks, as the library does.

Beside the text itself, a window of it and a run of its tokens are in memory; ids
and decoded text go to their digests run by run. The dealt file has no decoder, so
its state is whether a token came before; the byte-to-text machine serves
byte-level files.

A null text counts as empty, an empty one has no tokens, and texts of any length
are taken whole. One output row per input row, repeated rows too, no shuffle; an
empty table gives no rows, and other columns are ignored.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from authwatch.llm.batches import map_batches, texts, type_of
from authwatch.llm.bpe_files import PACK, Vocabulary, lookup
from authwatch.llm.token_counts import merge_linked

#: Symbols read beyond the lookahead before merging again.
CHUNK = 1024
#: Characters of a text that are split at once (or up to the next blank), chunks of a run.
WINDOW, RUN = 1 << 16, 4096
_BLANK = re.compile(r"[\t\n\r ]")
#: Ranks after all others.
NO_PAIR = 1 << 62


def lookahead(vocab: Vocabulary) -> int:
    """Symbols that must follow a token for it to be stable.

    What is unknown on the right can change a merge only through a chain of
    merges of rising rank: each takes the last decided token as its left part,
    and its right part begins with the left part of the merge before. The sum
    of the left parts' lengths, greatest over all chains, bounds the reach.
    One pass in order of rank finds it.
    """
    width = {number: 1 for number in vocab.ids.values()}
    first_part: dict[int, int] = {}
    reach: dict[int, int] = {}
    longest = 0
    for (left, right), (_, merged) in sorted(vocab.pairs.items(), key=lambda item: item[1][0]):
        before, start = 0, right
        while True:
            before = max(before, reach.get(start, 0))
            if start not in first_part:
                break
            start = first_part[start]
        total = width[left] + before
        reach[left] = max(reach.get(left, 0), total)
        longest = max(longest, total)
        width[merged] = width[left] + width[right]
        first_part[merged] = left
    return longest


def merge_all(symbols: list[int], packed: dict[int, int]) -> list[int]:
    """Byte-pair merging of a list: lowest rank first, leftmost of equals."""
    if len(symbols) > 24:
        return merge_linked(symbols, packed)[1]
    pair_of = packed.get
    tokens = list(symbols)
    ranks = [pair_of(a << PACK | b, NO_PAIR) for a, b in zip(tokens, tokens[1:])]
    while ranks and (best := min(ranks)) != NO_PAIR:
        at = ranks.index(best)
        tokens[at:at + 2] = [best & (1 << PACK) - 1]
        del ranks[at]
        if at:
            ranks[at - 1] = pair_of(tokens[at - 1] << PACK | tokens[at], NO_PAIR)
        if at < len(ranks):
            ranks[at] = pair_of(tokens[at] << PACK | tokens[at + 1], NO_PAIR)
    return tokens


class Encoder:
    """Symbols of one word in, stable tokens out."""

    def __init__(self, vocab: Vocabulary, reach: int | None = None):
        self.packed = vocab.packed
        self.reach = lookahead(vocab) if reach is None else reach
        self.width: dict[int, int] = {}
        for (left, right), (_, merged) in vocab.pairs.items():
            self.width[merged] = self.width.get(left, 1) + self.width.get(right, 1)
        self.held: list[int] = []

    def feed(self, symbols: Iterable[int]) -> Iterator[int]:
        for symbol in symbols:
            self.held.append(symbol)
            if len(self.held) >= self.reach + CHUNK:
                yield from self._settle()

    def _settle(self) -> Iterator[int]:
        stable = len(self.held) - self.reach
        done = 0
        for token in merge_all(self.held, self.packed):
            end = done + self.width.get(token, 1)
            if end > stable:
                break
            yield token
            done = end
        del self.held[:done]

    def finish(self) -> Iterator[int]:
        """Tokens of what is held; the word ends here."""
        yield from merge_all(self.held, self.packed)
        self.held.clear()

    def encode(self, symbols: list[int]) -> list[int]:
        """Tokens of a whole word; a short one is never split."""
        if len(symbols) < self.reach + CHUNK:
            return merge_all(symbols, self.packed)
        return [*self.feed(symbols), *self.finish()]


class Decoder:
    """Tokens in, text out."""

    def __init__(self, vocab: Vocabulary):
        self.names, self.special = vocab.names, vocab.special
        self.plain = not vocab.byte_level_decoder
        self.bytes_of = {} if self.plain else {x: n for n, x in enumerate(vocab.letters)}
        self.text = codecs.getincrementaldecoder("utf-8")("replace")
        self.begun = False

    def feed(self, token: int) -> str:
        name = self.names[token]
        if self.plain:
            if self.begun:
                return " " + name
            self.begun = True
            return name
        if name in self.special:
            return self.text.decode(name.encode())
        return self.text.decode(bytes(self.bytes_of[letter] for letter in name))

    def run(self, tokens: list[int]) -> str:
        """Text of the next tokens, as :func:`feed` gives it one by one."""
        if not (self.plain and tokens):
            return "".join(map(self.feed, tokens))
        begun, self.begun = self.begun, True
        return " " * begun + " ".join(map(self.names.__getitem__, tokens))

    def finish(self) -> str:
        return self.text.decode(b"", True)

    def decode(self, tokens: Iterable[int]) -> str:
        return self.run([*tokens]) + self.finish()


class Aged(dict):
    """Packed ids by string. Bounded: a full generation becomes the old one, whose
    entries move to the young one when they are met again; long keys are not kept."""

    def __init__(self, make, most: int = 250_000, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest, self.old = make, most, longest, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class Ids:
    """Ids of texts, in runs of bounded length."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.encoder = vocab, Encoder(vocab)
        self.by_word = Aged(lambda word: self._packed(self.encoder.encode(vocab.symbols(word))))
        self.by_chunk = Aged(lambda chunk: b"".join(
            map(self.by_word.__getitem__, vocab.split_chunk(chunk))))

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return array("I", ids).tobytes()

    def _packed_parts(self, stretch: str) -> Iterator[bytes]:
        chunks = self.vocab.chunks(stretch)
        if chunks is None:
            return map(self.by_word.__getitem__, self.vocab.library_words(stretch))
        return map(self.by_chunk.__getitem__, chunks)

    def runs(self, text: str) -> Iterator[list[int]]:
        """Ids of a text in order, some thousands at a time."""
        for special, piece in self.vocab.pieces(text):
            if special:
                yield [self.vocab.special[piece]]
                continue
            for window in self._windows(piece):
                parts = self._packed_parts(window)
                while some := [*islice(parts, RUN)]:
                    yield np.frombuffer(b"".join(some), "I").tolist()

    def _windows(self, stretch: str) -> Iterator[str]:
        """Parts that split into words alone as they do together.

        Where blanks are dropped, any blank parts two words. One stretch without
        a blank is a window however long it is.
        """
        if self.vocab._keeps_blanks or len(stretch) <= WINDOW:
            yield stretch
            return
        start = 0
        while start < len(stretch):
            blank = _BLANK.search(stretch, min(len(stretch), start + WINDOW))
            stop = blank.start() if blank else len(stretch)
            yield stretch[start:stop]
            start = stop


def encoder(vocab: Vocabulary) -> Ids:
    return Ids(vocab)


def encode_text(text: str, encoded: Ids) -> tuple[int, str, str]:
    """Number of tokens, ids joined by blanks, and the text that the decoder gives for them."""
    tokens = [*chain.from_iterable(encoded.runs(text))]
    return len(tokens), " ".join(map(str, tokens)), Decoder(encoded.vocab).decode(tokens)


class Digests:
    """Digests of a text's ids and of its decoded text, from one run of ids after the other."""

    def __init__(self, encoded: Ids, numerals: list[str]):
        self.decoder, self.numerals = Decoder(encoded.vocab), numerals
        self.count, self.ids, self.text = 0, sha256(), sha256()

    def add(self, run: list[int]) -> None:
        if self.count:
            self.ids.update(b" ")
        self.count += len(run)
        self.ids.update(" ".join(map(self.numerals.__getitem__, run)).encode())
        self.text.update(self.decoder.run(run).encode())

    def finish(self) -> tuple[int, str, str]:
        self.text.update(self.decoder.finish().encode())
        return self.count, self.ids.hexdigest(), self.text.hexdigest()


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, ids_sha256 and decoded_sha256."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = lookup("encode", path, encoder)
        numerals = lookup("numerals", path, lambda v: [str(n) for n in range(max(v.names) + 1)])
        rows = []
        for text in texts(batch.column(1)):
            digests = Digests(words, numerals)
            for ids in words.runs(text):
                digests.add(ids)
            rows.append(digests.finish())
        counts, ids, decoded = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids), pa.array(decoded)],
            ["doc", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(
        docs.select(id_col, text_col), run,
        f"doc {type_of(docs, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    ).withColumnRenamed("doc", id_col)

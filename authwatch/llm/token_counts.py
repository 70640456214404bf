"""Token counts by byte-pair merging on a heap and a linked list.

A word starts as a linked list of byte symbols. The adjacent pair with the
lowest rank (leftmost of equals) is popped from a heap and merged until no pair
of the merge list is left. The count is the number of initial symbols minus the
number of merges; no identifiers are emitted. A special string counts as one.

A null text counts as empty, with zero bytes and tokens. One output row per
input row, repeated rows included; no shuffle, and other columns are ignored. Texts
of any length are taken whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from authwatch.llm.batches import map_batches, texts, type_of
from authwatch.llm.bpe_files import PACK, Lookup, Vocabulary, lookup


def merge_linked(symbols: list[int], packed: dict[int, int]) -> tuple[int, list[int]]:
    """Number of merges that byte-pair encoding makes, and the list it ends with.

    A heap entry is one number: rank, merged id and place, so that the lowest
    rank and then the leftmost place comes first.
    """
    size = len(symbols)
    if size < 2:
        return 0, symbols
    pair_of = packed.get
    shift = size.bit_length()
    place = (1 << shift) - 1
    kind = [*symbols, -1]
    heap = [found << shift | at for at in range(size - 1)
            if (found := pair_of(kind[at] << PACK | kind[at + 1])) is not None]
    if not heap:
        return 0, symbols
    heapify(heap)
    after, before = [*range(1, size + 1)], [*range(-1, size)]
    merges = 0
    while heap:
        entry = heappop(heap)
        at, found = entry & place, entry >> shift
        following = after[at] if kind[at] >= 0 else size
        # Stale if either side has been merged meanwhile.
        if following == size or pair_of(kind[at] << PACK | kind[following]) != found:
            continue
        merges += 1
        merged = found & (1 << PACK) - 1
        kind[at], kind[following] = merged, -1
        after[at] = following = after[following]
        before[following] = at
        if following < size:
            found = pair_of(merged << PACK | kind[following])
            if found is not None:
                heappush(heap, found << shift | at)
        previous = before[at]
        if previous >= 0:
            found = pair_of(kind[previous] << PACK | merged)
            if found is not None:
                heappush(heap, found << shift | previous)
    return merges, [token for token in kind if token >= 0]


def counter(vocab: Vocabulary) -> Lookup:
    def of_word(word: str) -> int:
        symbols = vocab.symbols(word)
        return len(symbols) - merge_linked(symbols, vocab.packed)[0]
    return Lookup(vocab, of_word, lambda special: 1, sum)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """Per row: id, n_bytes, n_tokens and whether these are more than ``limit``."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts = lookup("count", path, counter)
        rows = texts(batch.column(1))
        tokens = [sum(counts.values(text)) for text in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(t.encode()) for t in rows], pa.int64()),
             pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens])],
            ["doc", "n_bytes", "n_tokens", "over_limit"])

    return map_batches(
        docs.select(id_col, text_col), run,
        f"doc {type_of(docs, id_col)}, n_bytes long, n_tokens long, over_limit boolean"
    ).withColumnRenamed("doc", id_col)

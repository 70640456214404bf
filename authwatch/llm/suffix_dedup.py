"""Suffix-array dedup: bytes covered by a long string that starts earlier.

Every byte string of ``width`` bytes that also starts earlier (in a document
with a smaller id, or further left in the same document) is removed, whatever
the language or line structure. Blocks that repeat whole are found by
``repeats``. What is left is sorted as suffixes: prefix polynomial hashes give
the common extension of two suffixes by binary search, so a comparison in the
mergesort takes logarithmic time; equal neighbours are then compared byte by
byte, and a hash collision makes the batch sort again by its bytes.

Columns may be null: a null text is empty, and null ids count as the smallest.
Texts shorter than ``width`` keep all bytes. Rows with equal ids are versions
of one document: a range found in one is removed from all, and a row that is
repeated whole is no repetition of itself. Texts of any length are taken whole, and
an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authwatch.llm.batches import encoded, map_batches, type_of
from authwatch.llm.repeats import (
    CLAIM, KNOWN, PROVEN, Cutting, by_document, proven_repeats, windows_of)
from authwatch.llm.rolling import PrefixHash

#: Windows that are sorted at once.
SORT_WINDOWS = 1 << 17


def byte_symbols(column: pa.Array, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    parts = encoded(column)
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in parts], dtype=np.int64)])
    return np.frombuffer(b"".join(parts), np.uint8), bounds.astype(np.int64)


# -- the suffix sort ---------------------------------------------------------

def common_extension(hashes: PrefixHash, left: np.ndarray, right: np.ndarray,
                     width: int) -> np.ndarray:
    """Length of the common prefix, at most ``width``, of suffixes in pairs."""
    low = np.zeros(len(left), np.int64)
    high = np.full(len(left), width, np.int64)
    for _ in range(int(width).bit_length()):
        middle = (low + high + 1) >> 1
        equal = hashes.of(left, left + middle) == hashes.of(right, right + middle)
        low = np.where(equal, middle, low)
        high = np.where(equal, high, np.maximum(middle - 1, low))
    return low


def suffix_order(symbols: np.ndarray, hashes: PrefixHash, starts: np.ndarray,
                 bucket: np.ndarray, width: int) -> np.ndarray:
    """Stable order of the suffixes by their first ``width`` symbols, bucket by bucket.

    ``bucket`` is ascending. A bottom-up mergesort over all buckets at once: each
    round, every element finds its rank in the neighbouring run by binary search.
    """
    total = len(starts)
    order = np.arange(total)
    begins = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if total else order
    sizes = np.diff(np.append(begins, total))
    base, size = np.repeat(begins, sizes), np.repeat(sizes, sizes)
    run = 1
    while run < (int(sizes.max()) if total else 0):
        active = np.flatnonzero(size > run)
        local = active - base[active]
        own = local // run
        other = own ^ 1
        begin = other * run
        stop = np.minimum(begin + run, size[active])
        paired = begin < size[active]
        active, local, own, begin, stop = (
            x[paired] for x in (active, local, own, begin, stop))
        origin, mine = base[active], starts[order[active]]
        is_left = (own & 1) == 0
        low, high = begin.copy(), stop.copy()
        searching = np.flatnonzero(low < high)
        while len(searching):
            middle = (low[searching] + high[searching]) >> 1
            theirs = starts[order[origin[searching] + middle]]
            ours = mine[searching]
            shared = common_extension(hashes, ours, theirs, width)
            equal = shared == width
            at = np.minimum(shared, width - 1)
            less = symbols[theirs + at] < symbols[ours + at]
            # Equal elements of the left run go first.
            before = np.where(equal, ~is_left[searching], less)
            low[searching] = np.where(before, middle + 1, low[searching])
            high[searching] = np.where(before, high[searching], middle)
            searching = searching[low[searching] < high[searching]]
        pair = np.minimum(begin, own * run)
        merged = order.copy()
        merged[origin + pair + (local - own * run) + (low - begin)] = order[active]
        order = merged
        run *= 2
    return order


def starts_earlier(symbols: np.ndarray, starts: np.ndarray, bucket: np.ndarray,
                   width: int) -> np.ndarray:
    """For suffixes in order of place within ascending buckets: does an equal one precede?"""
    hashes = PrefixHash(symbols)
    order = suffix_order(symbols, hashes, starts, bucket, width)
    before, after = order[:-1], order[1:]
    same = np.zeros(len(starts), bool)
    near = np.flatnonzero(bucket[before] == bucket[after])
    same[near + 1] = common_extension(
        hashes, starts[before[near]], starts[after[near]], width) == width
    # Collision verification: neighbours must hold the same bytes.
    rows = np.lib.stride_tricks.sliding_window_view(symbols, width)
    claimed = np.flatnonzero(same)
    for part in np.array_split(claimed, len(claimed) // 65536 + 1):
        if (rows[starts[order[part - 1]]] != rows[starts[order[part]]]).any():
            return _starts_earlier_by_bytes(symbols, starts, bucket, width)
    result = np.zeros(len(starts), bool)
    result[order[same]] = True
    return result


def _starts_earlier_by_bytes(symbols, starts, bucket, width) -> np.ndarray:
    seen: set[tuple[int, bytes]] = set()
    result = np.zeros(len(starts), bool)
    for number, (start, own) in enumerate(zip(starts.tolist(), bucket.tolist(), strict=True)):
        item = (own, symbols[start:start + width].tobytes())
        result[number] = item in seen
        seen.add(item)
    return result


# -- the operator ------------------------------------------------------------

def _sort_groups(width: int):
    """Runs of windows that start earlier within their (key, part)."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        pending, group = 0, None
        for batch in batches:
            is_known = pc.equal(batch.column(1), KNOWN)
            yield batch.filter(is_known).select(["doc", "start", "windows"])
            batch = batch.filter(pc.invert(is_known))
            if not batch.num_rows:
                continue
            key, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            windows = np.cumsum(batch.column(4).to_numpy())
            # Cut only where a group ends, so that groups stay whole.
            ends = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
            if pending >= SORT_WINDOWS and group != (key[0], part[0]):
                yield from _sorted(held, width)
                held, pending = [], 0
            done = counted = 0
            for end in ends.tolist():
                if pending + int(windows[end - 1]) - counted >= SORT_WINDOWS:
                    yield from _sorted([*held, batch.slice(done, end - done)], width)
                    held, pending, done, counted = [], 0, end, int(windows[end - 1])
            held.append(batch.slice(done))
            pending += int(windows[-1]) - counted
            group = (key[-1], part[-1])
        if held:
            yield from _sorted(held, width)
    return over


def _sorted(held: list[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(held).combine_chunks()
    key, part, start, windows = (table.column(i).to_numpy() for i in (0, 1, 3, 4))
    pieces = table.column(5).to_pylist()
    lengths = np.array([len(x) for x in pieces], np.int64)
    symbols = np.frombuffer(b"".join(pieces), np.uint8)
    begins = np.cumsum(lengths) - lengths
    ids = pa.concat_arrays(table.column(2).chunks)
    count = windows.astype(np.int64)
    row = np.repeat(np.arange(len(count)), count)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = begins[row] + offset
    hashes = PrefixHash(symbols)
    # Bucket by group and hash of the first bytes: few elements need many rounds.
    group = np.cumsum(np.r_[True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])])[row]
    head = hashes.of(at, at + min(32, width))
    place = np.lexsort((start[row] + offset, row, head, group))
    bucket = np.cumsum(np.r_[True, (group[place][1:] != group[place][:-1])
                             | (head[place][1:] != head[place][:-1])])
    # Rows arrive in order of document and start, so place is in order, too.
    found = np.zeros(len(row), bool)
    found[place] = starts_earlier(symbols, at[place], bucket, width)
    hit = np.flatnonzero(found)
    if not len(hit):
        return
    new = np.r_[True, (row[hit][1:] != row[hit][:-1]) | (hit[1:] != hit[:-1] + 1)]
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(hit)))
    yield pa.RecordBatch.from_arrays(
        [ids.take(pa.array(row[hit[first]])), pa.array(start[row[hit[first]]] + offset[hit[first]]),
         pa.array(size.astype(np.int32))], ["doc", "start", "windows"])


def _remove(width: int):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = [cut_ranges(text, spans or (), width) for text, spans in zip(
            encoded(batch.column(1)), batch.column(2).to_pylist(), strict=True)]
        size, removed, spans, digest = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(spans, pa.int64()), pa.array(digest)],
            ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


def merge_ranges(spans, width: int, limit: int) -> list[tuple[int, int]]:
    """Maximal runs of symbols covered by the windows of ``spans``."""
    runs: list[tuple[int, int]] = []
    for start, stop in sorted((x["start"], min(limit, x["start"] + x["windows"] - 1 + width))
                              for x in spans):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(stop, runs[-1][1]))
        elif start < stop:
            runs.append((start, stop))
    return runs


def cut_ranges(text: bytes, spans, width: int) -> tuple[int, int, int, str]:
    runs = merge_ranges(spans, width, len(text))
    hasher, done = sha256(), 0
    for start, stop in runs:
        hasher.update(text[done:start])
        done = stop
    hasher.update(text[done:])
    return len(text), sum(b - a for a, b in runs), len(runs), hasher.hexdigest()


def earlier_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   width: int = 100, k: int = 24) -> DataFrame:
    """Runs of ``windows`` byte strings from ``start`` on that also start earlier."""
    answers = proven_repeats(docs, id_col, text_col, Cutting(
        byte_symbols, bytes, bytes, width, k, same_document=True, sources=False))
    single = windows_of(answers).mapInArrow(
        _sort_groups(width), f"doc {type_of(docs, id_col)}, start long, windows int")
    return answers.filter(F.col("kind").isin(CLAIM, PROVEN)).select(
        "doc", "start", "windows").unionByName(single)


def remove_earlier(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   width: int = 100, k: int = 24) -> DataFrame:
    """Per document: its id, n_bytes, n_removed, n_spans and the digest of what stays."""
    ranges = by_document(earlier_ranges(docs, id_col, text_col, width, k), "start", "windows")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    joined = texts.join(ranges, F.col("id").eqNullSafe(F.col("doc")), "left")
    return map_batches(
        joined.select("id", "text", "ranges"), _remove(width),
        f"doc {type_of(docs, id_col)}, n_bytes long, n_removed long, n_spans long, "
        "kept_sha256 string").withColumnRenamed("doc", id_col)

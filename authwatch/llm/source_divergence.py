"""Source divergence audit: how far the words of each source are from the others'.

Terms are runs of letters A-Z, a-z and of all characters beyond ASCII, A-Z
lower-cased. They are counted per (lang, source) in tasks: terms of up to eight
bytes become one unsigned 64-bit word, those of up to sixteen two, which are
sorted by radix passes and counted as runs; longer terms are sorted as bytes, in
buckets of like length. Spark adds up the counts of all tasks.

A lang keeps the terms that at least ``min_docs`` of its documents have. With
counts and their sum N over the V kept terms, a term's share of a group is
``1 + floor(10^9 (count + 2) / (N + 2 V))``, and two shares p, q differ by
``floor((p - q)^2 / (p + q))``. ``pair`` rows add this up over all kept terms for
each two sources of a lang; ``term`` rows give the ``top`` terms whose share in a
source is above the one in the lang.

Pairs are computed in cells of a bucket of terms and two blocks of sources, where
a term that no source of the cell has is left out: all such terms of two sources
differ alike, so they are added as a number. Work and memory of a cell are bounded,
and each lang has as many cells as its terms need.

A null text, lang or source counts as empty. Every row is a document, repeated
rows too. A document without terms still makes its group. Terms and texts of any
length are taken whole; a lang without kept terms has pairs of value 0. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from authwatch.llm.batches import encoded, keep_table, split_by_size

#: Bytes of text counted at once, sources of a block, terms of a bucket (about).
BATCH_BYTES, BLOCK, BUCKET_TERMS = 16 << 20, 128, 20_000
#: Terms of a cell that are compared at once.
TERMS_AT_ONCE = 1024
SHARES = 10 ** 9

IS_TERM = np.zeros(256, bool)
IS_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def term_bounds(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased joined bytes, starts and sizes of terms, and the text of each term."""
    joined = LOWER[np.frombuffer(b" " + b" ".join(parts) + b" " * 17, np.uint8)]
    inside = IS_TERM[joined]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, stops = edges[::2], edges[1::2]
    begins = 1 + np.cumsum([0, *(len(x) + 1 for x in parts)])[:-1]
    return joined, starts, stops - starts, np.searchsorted(begins, starts, side="right") - 1


def packed(joined: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The first eight bytes of each term as a number, most significant first."""
    loads = np.ndarray(len(joined) - 7, dtype=">u8", buffer=joined, strides=(1,))
    unused = np.uint64(8) * (8 - np.clip(sizes, 0, 8)).astype(np.uint64)
    words = loads[starts].astype(np.uint64)
    half = unused // np.uint64(2)  # a shift by 64 is not defined
    return ((words >> half >> (unused - half)) << half) << (unused - half)


def radix_order(order: np.ndarray, words: np.ndarray) -> np.ndarray:
    """``order`` sorted stably by ``words``: a pass per 16 bits, least significant first."""
    for shift in range(0, 64, 16):
        digit = (words >> np.uint64(shift)).astype(np.uint16)
        if len(digit) and (digit != digit[0]).any():
            order = order[np.argsort(digit[order], kind="stable")]
    return order


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal entries begins."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


def count_runs(new: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, entries and distinct documents of each run; documents ascend inside."""
    first = np.flatnonzero(new)
    other = run_starts(docs) | new
    return (first, np.diff(np.append(first, len(new))),
            np.add.reduceat(other.astype(np.int64), first) if len(first) else first)


def short_counts(words: list[np.ndarray], groups: np.ndarray, docs: np.ndarray):
    """Group, document and occurrence counts and words of each (group, term).

    ``words`` are the packed columns, the most significant first.
    """
    order = np.arange(len(docs))
    for column in reversed(words):
        order = radix_order(order, column)
    order = radix_order(order, groups.astype(np.uint64))
    words, groups, docs = [w[order] for w in words], groups[order], docs[order]
    first, uses, held = count_runs(run_starts(groups, *words), docs)
    return groups[first], uses, held, [w[first] for w in words]


def unpacked(words: list[np.ndarray]) -> pa.Array:
    """Terms of packed words; no term holds a zero byte."""
    table = np.stack(words, axis=1).astype(">u8").view(np.uint8)
    used = table != 0
    offsets = np.concatenate([[0], np.cumsum(used.sum(axis=1))]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(table), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(table[used]))])


def long_counts(joined, starts, sizes, groups, docs):
    """The same for terms above sixteen bytes, sorted as bytes in buckets of length."""
    power = np.ceil(np.log2(sizes)).astype(int)
    for bucket in np.unique(power):
        at = np.flatnonzero(power == bucket)
        width = 1 << int(bucket)
        step = max(1, BATCH_BYTES // width)
        for begin in range(0, len(at), step):  # parts are added up later
            own = at[begin:begin + step]
            table = np.zeros((len(own), width), np.uint8)
            place = np.arange(width)
            used = place < sizes[own, None]
            table[used] = joined[(starts[own, None] + place)[used]]
            terms = table.view(f"S{width}").ravel()
            order = np.argsort(terms, kind="stable")
            order = order[np.argsort(groups[own][order], kind="stable")]
            own, terms = own[order], terms[order]
            first, uses, held = count_runs(run_starts(groups[own], terms), docs[own])
            yield (groups[own][first], uses, held,
                   pa.array(terms[first].tolist(), pa.binary()).cast(pa.string()))


def count_terms(parts: list[bytes], group_of: np.ndarray):
    """(groups, uses, documents, terms) parts of the terms in ``parts``."""
    joined, starts, sizes, docs = term_bounds(parts)
    groups = group_of[docs]
    for low, high in ((1, 8), (9, 16)):
        at = np.flatnonzero((sizes >= low) & (sizes <= high))
        if len(at):
            words = [packed(joined, starts[at], sizes[at])]
            if high > 8:
                words.append(packed(joined, starts[at] + 8, sizes[at] - 8))
            own, uses, held, words = short_counts(words, groups[at], docs[at])
            yield own, uses, held, unpacked(words)
    at = np.flatnonzero(sizes > 16)
    if len(at):
        yield from long_counts(joined, starts[at], sizes[at], groups[at], docs[at])


COUNTED = "lang string, source string, term string, uses long, docs long"


def _counting(batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split_by_size(whole, batch_bytes):
                yield from _counts_of(batch)
    return run


def _counts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Counts of a batch of texts, langs and sources; the empty term stands for a group."""
    keys = list(zip(*(batch.column(n).to_pylist() for n in (1, 2)), strict=True))
    numbers = {key: n for n, key in enumerate(dict.fromkeys(keys))}
    group_of = np.array([numbers[key] for key in keys], np.int64)
    names = [pa.array([key[n] for key in numbers], pa.string()) for n in (0, 1)]

    def rows(groups, uses, held, terms):
        return pa.RecordBatch.from_arrays(
            [name.take(pa.array(groups)) for name in names]
            + [terms, pa.array(uses, pa.int64()), pa.array(held, pa.int64())],
            ["lang", "source", "term", "uses", "docs"])

    none = np.zeros(len(numbers), np.int64)
    yield rows(np.arange(len(numbers)), none, none, pa.array([""] * len(numbers), pa.string()))
    for found in count_terms(encoded(batch.column(0)), group_of):
        yield rows(*found)


def group_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                 source_col: str = "source") -> DataFrame:
    """lang, source, term, uses, docs over all rows; the empty term for every group."""
    rows = docs.select(F.col(text_col).alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"))
    return (rows.mapInArrow(_counting(BATCH_BYTES), COUNTED).groupBy("lang", "source", "term")
            .agg(F.sum("uses").alias("uses"), F.sum("docs").alias("docs")))


def share(count, total, terms):
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), exact for any count."""
    wide = (count + 2).cast("decimal(20,0)") * F.lit(SHARES).cast("decimal(10,0)")
    below = (total + 2 * terms).cast("decimal(21,0)")
    return 1 + F.call_function("div", wide, below).cast("long")


def apart(p, q):
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pairs_of_cells(block: int, at_once: int):
    """Sums of a partition's cells; rows come by cell and term, the empty term first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = None
        for batch in batches:
            keys = list(zip(*(batch.column(n).to_pylist() for n in range(4)), strict=True))
            term, source, p = (batch.column(n).to_pylist() for n in (4, 5, 6))
            for row, key in enumerate(keys):
                if cell is None or cell.key != key:
                    if cell:
                        yield from cell.sums()
                    cell = Cell(key, block, at_once)
                cell.add(term[row], source[row], p[row])
        if cell:
            yield from cell.sums()
    return run


class Cell:
    """Shares of two blocks of sources in a bucket of terms."""

    def __init__(self, key: tuple, block: int, at_once: int):
        self.key, self.block, self.at_once = key, block, at_once
        self.rest: list[int] = []  # shares of a term that a source does not have
        self.place: dict[int, int] = {}
        self.term, self.rows, self.at, self.p = None, 0, [], []
        self.total, self.terms = None, 0

    def add(self, term: str, source: int, p: int) -> None:
        if term == "":
            self.place[source] = len(self.rest)
            self.rest.append(p)
            return
        if term != self.term:
            if self.rows == self.at_once:
                self._compare()
            self.term, self.rows = term, self.rows + 1
        self.at.append((self.rows - 1) * len(self.rest) + self.place[source])
        self.p.append(p)

    def _compare(self) -> None:
        shares = np.tile(np.array(self.rest, np.int64), (self.rows, 1))
        shares.ravel()[self.at] = self.p
        if self.total is None:
            self.total = np.zeros((len(self.rest),) * 2, np.int64)
        for n in range(len(self.rest)):
            p, q = shares[:, n:n + 1], shares[:, n + 1:]
            self.total[n, n + 1:] += ((p - q) ** 2 // (p + q)).sum(axis=0)
        self.terms += self.rows
        self.rows, self.at, self.p = 0, [], []

    def sums(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            self._compare()
        if not self.terms:
            return
        sources = np.array(sorted(self.place, key=self.place.get), np.int64)
        block = sources // self.block
        x, y = np.triu_indices(len(sources), 1)
        if self.key[2] != self.key[3]:  # pairs inside a block have a cell of their own
            x, y = x[block[x] != block[y]], y[block[x] != block[y]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([self.key[0]] * len(x), pa.string()), pa.array(sources[x]),
             pa.array(sources[y]), pa.array(self.total[x, y]),
             pa.array(np.full(len(x), self.terms))],
            ["lang", "a", "b", "value", "terms"])


def pair_sums(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b (numbers of sources, either order), value: shares' differences added up.

    ``groups`` has lang, source, number, blocks, buckets, rest and terms (V).
    """
    bucket = F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int")
    own = F.floor(F.col("number") / BLOCK).cast("int")
    named = groups.select("lang", "source", "number", "blocks", "buckets", "rest")
    rows = (shares.select("lang", "source", "term", "p").join(named, ["lang", "source"])
            .withColumn("bucket", bucket))
    marks = (named.withColumns({"term": F.lit(""), "p": F.col("rest"),
                                "bucket": F.explode(F.expr("sequence(0, buckets - 1)"))}))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (rows.select("lang", "number", "term", "p", "bucket", "blocks")
             .unionByName(marks.select("lang", "number", "term", "p", "bucket", "blocks"))
             .withColumn("own", own).withColumn("other", other)
             .select("lang", "bucket", F.least("own", "other").alias("low"),
                     F.greatest("own", "other").alias("high"), "term", "number", "p"))
    sums = (dealt.repartition("lang", "bucket", "low", "high")
            .sortWithinPartitions("lang", "bucket", "low", "high", "term")
            .mapInArrow(_pairs_of_cells(BLOCK, TERMS_AT_ONCE),
                        "lang string, a long, b long, value long, terms long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"),
                                           F.sum("terms").alias("seen")))
    return sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"),
                                        "value", "seen"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", min_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    counts = keep_table(group_counts(docs, text_col, lang_col, source_col))
    term = Window.partitionBy("lang", "term")
    kept = keep_table(
        counts.filter("term != ''")
        .withColumns({"lang_docs": F.sum("docs").over(term), "lang_uses": F.sum("uses").over(term)})
        .filter(F.col("lang_docs") >= min_docs)
        .select("lang", "source", "term", "uses", "lang_uses"))
    # One row per group, so every figure of a group stays small.
    lang = Window.partitionBy("lang")
    sizes = kept.groupBy("lang", "source").agg(F.sum("uses").alias("total"))
    terms = kept.groupBy("lang", "term").agg(F.lit(1).alias("one")).groupBy("lang").agg(
        F.count("*").alias("terms"))
    zero = F.lit(0).cast("long")
    groups = (counts.filter("term = ''").select("lang", "source")
              .join(sizes, ["lang", "source"], "left").join(terms, "lang", "left")
              .select("lang", "source", F.coalesce("total", zero).alias("total"),
                      F.coalesce("terms", zero).alias("terms")))
    groups = keep_table(groups.select(
        "*", F.sum("total").over(lang).alias("lang_total"),
        (F.row_number().over(lang.orderBy("source")) - 1).cast("long").alias("number"),
        F.ceil(F.count("*").over(lang) / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.greatest("terms", F.lit(1)) / BUCKET_TERMS).cast("int").alias("buckets"),
        F.when(F.col("terms") > 0, share(zero, F.col("total"), F.col("terms"))).alias("rest")))
    shares = kept.join(groups.select("lang", "source", "total", "lang_total", "terms"),
                       ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("uses"), F.col("total"), F.col("terms")).alias("p"),
        share(F.col("lang_uses"), F.col("lang_total"), F.col("terms")).alias("q"))
    return _ranked(_pair_rows(groups, pair_sums(shares, groups)), "pair").unionByName(
        _ranked(shares.filter("p > q").select(
            "lang", "source", F.col("term").alias("item"), apart(F.col("p"), F.col("q"))
            .alias("value")), "term", top))


def _pair_rows(groups: DataFrame, sums: DataFrame) -> DataFrame:
    """Every two sources of a lang, as the result lists them all."""
    left = groups.select("lang", "source", F.col("number").alias("a"), F.col("rest").alias("p"), "terms")
    right = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("b"),
                          F.col("rest").alias("q"))
    both = left.join(right, "lang").filter("a != b").join(sums, ["lang", "a", "b"], "left")
    zero = F.lit(0).cast("long")
    unseen = F.col("terms") - F.coalesce("seen", zero)
    return both.select("lang", "source", "item", F.when(
        F.col("terms") > 0, F.coalesce("value", zero) + unseen * apart(F.col("p"), F.col("q")))
        .otherwise(zero).alias("value"))


def _ranked(rows: DataFrame, part: str, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    ranked = ranked if top is None else ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")

"""Hard-negative mining by slots: what lies just under each positive of an anchor.

A vector's components become ``floor(scale * x)``; the score of two rows is the
integer inner product. An anchor's positives are its best rows of the same
label. A positive with score p asks for the best rows of other labels whose
score lies between ``low`` and ``high`` percent of p. The upper limits of an
anchor's positives cut its scores into disjoint slots: tasks and shuffles keep
the best ``k`` of each slot, and merging the slots from the lowest to the
highest gives the best ``k`` under every limit, of which a positive takes those
above its lower limit.

Anchors and rows are dealt in blocks; a cell of one block each holds its anchors
and streams its rows, so memory is bounded whatever the label or the table. The
blocks depend on counts only, and the result does not depend on them.

Rows with a null id, label or vector, or with a null, NaN or infinite component
take no part. A shorter vector counts as padded with zeros; an empty one scores
0. Scores are exact and cut to +-2^56. A repeated row takes a place each time;
rows that share their id with the anchor are not its positives or negatives, and
of several anchors with one id the least (label, vector) counts. Ties go to the
smaller id. A positive score below 0 asks for an empty range. An empty table, or
one without anchors, gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from authwatch.llm.batches import keep_table

#: Anchors that a cell holds, rows that it streams, and scores computed at once.
ANCHORS, ROWS, SCORES = 8192, 1 << 20, 1 << 20
LIMIT = 1 << 56
#: Below every score.
NONE = -(1 << 62)


def whole_components(column: pa.Array, scale: int) -> np.ndarray:
    """Rows of floor(scale * x) as doubles, shorter vectors padded with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == sizes[0]).all():
        values = flat[offsets[0]:offsets[-1]].reshape(len(sizes), int(sizes[0]))
    else:
        values = np.zeros((len(sizes), int(sizes.max(initial=0))))
        values[np.arange(values.shape[1]) < sizes[:, None]] = flat[offsets[0]:offsets[-1]]
    return np.floor(values * scale)


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, cut to +-LIMIT."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    most = [float(np.abs(x).max(initial=0)) for x in (left, right)]
    if most[0] * most[1] * max(1, width) < 2.0 ** 53:  # every partial sum is exact
        return (left @ right.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)
             for x in (left, right)]
    return np.clip(whole[0] @ whole[1].T, -LIMIT, LIMIT).astype(np.int64) if width \
        else np.zeros((len(left), len(right)), np.int64)


class Best:
    """The best ``k`` (score, id) of every list; ties go to the smaller id."""

    def __init__(self, lists: int, k: int):
        self.k, self.floor = k, np.full(lists, NONE, np.int64)
        self.at, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        at, score, ids = (np.concatenate(pair) for pair in (
            (self.at, at), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, at))
        at, score, ids = at[order], score[order], ids[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        kept = place < self.k
        full = place == self.k - 1
        self.floor[at[full]] = score[full]
        self.at, self.score, self.id = at[kept], score[kept], ids[kept]


class Cell:
    """Anchors of one block, and the best rows found for each of their lists.

    Without ``limits`` there is one list per anchor, of rows with its label;
    else one per anchor and slot, of rows with other labels.
    """

    def __init__(self, ids, labels, values, limits, least, k: int, at_once: int = SCORES):
        self.ids, self.labels, self.values = ids, labels, values
        self.limits, self.least, self.at_once = limits, least, at_once
        self.slots = 1 if limits is None else limits.shape[1]
        self.best = Best(len(ids) * self.slots, k)

    def add(self, ids: np.ndarray, labels: np.ndarray, values: np.ndarray) -> None:
        step = max(1, self.at_once // max(1, len(self.ids)))
        for start in range(0, len(ids), step):
            part = slice(start, start + step)
            self._score(ids[part], labels[part], values[part])

    def _score(self, ids, labels, values) -> None:
        scores = inner_products(self.values, values)
        fit = (self.labels[:, None] == labels) & (self.ids[:, None] != ids)
        slot = np.zeros_like(scores)
        if self.limits is not None:
            fit = (self.labels[:, None] != labels) & (self.ids[:, None] != ids)
            fit &= scores >= self.least[:, None]
            slot -= 1
            for n in range(self.slots):  # limits descend, so the last that holds is the slot
                slot += scores <= self.limits[:, n:n + 1]
            fit &= slot >= 0
        at = np.arange(len(self.ids))[:, None] * self.slots + slot
        fit[fit] = scores[fit] >= self.best.floor[at[fit]]
        row, column = np.nonzero(fit)
        if len(row):
            self.best.add(at[row, column], scores[row, column], ids[column])

    def found(self) -> Iterator[pa.RecordBatch]:
        at = self.best.at
        yield pa.RecordBatch.from_arrays(
            [pa.array(self.ids[at // self.slots]), pa.array(at % self.slots),
             pa.array(self.best.score), pa.array(self.best.id)],
            ["anchor", "slot", "score", "other"])


def _cells(scale: int, k: int, at_once: int):
    """A partition holds whole cells, one after the other, anchors of a cell first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, cell = None, [], None
        for batch in batches:
            ids, labels, limits, keys, role = (
                batch.column(n).to_numpy(zero_copy_only=False) for n in (0, 1, 3, 4, 5))
            least = batch.column(6).to_numpy(zero_copy_only=False)
            values = whole_components(batch.column(2), scale)
            group = keys * 2 + role
            cuts = np.flatnonzero(np.diff(group)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(group)], strict=True):
                part = slice(start, stop)
                if keys[start] != key:
                    if cell:
                        yield from cell.found()
                    key, parts, cell = keys[start], [], None
                if role[start] == 0:
                    parts.append((ids[part], labels[part], values[part], limits[part], least[part]))
                elif parts or cell:
                    if not cell:
                        cell, parts = _cell_of(parts, k, at_once), []
                    cell.add(ids[part], labels[part], values[part])
        if cell:
            yield from cell.found()
    return run


def _cell_of(parts: list, k: int, at_once: int) -> Cell:
    width = max(part[2].shape[1] for part in parts)
    values = np.concatenate([np.pad(p[2], ((0, 0), (0, width - p[2].shape[1]))) for p in parts])
    limits = [x for part in parts for x in part[3]]
    limits = None if limits[0] is None else np.array([np.asarray(x, np.int64) for x in limits])
    ids, labels, least = (np.concatenate([p[n] for p in parts]) for n in (0, 1, 4))
    return Cell(ids, labels, values, limits, least, k, at_once)


def best_rows(rows: DataFrame, anchors: DataFrame, cells: tuple[int, int], scale: int,
              k: int) -> DataFrame:
    """For each anchor and slot the best ``k`` rows: anchor, slot, score, other.

    ``rows`` has id, label, vector; ``anchors`` also limits and least (both null
    for the rows of the same label). Every row meets every anchor in one cell.
    """
    held, streamed = cells

    def block(count):
        return F.pmod(F.xxhash64("id"), F.lit(count))

    def dealt(df, own, other, others, role):
        key = F.col(own) * others + F.col(other) if role == 0 else F.col(other) * streamed + F.col(own)
        return (df.withColumn(own, block(streamed if role else held))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
                .select("id", "label", "vector", "limits", key.cast("long").alias("cell"),
                        F.lit(role).alias("role"), "least"))

    empty = rows.withColumns({"limits": F.lit(None).cast("array<long>"),
                              "least": F.lit(None).cast("long")})
    both = dealt(anchors.withColumn("least", F.coalesce("least", F.lit(NONE))),
                 "a", "r", streamed, 0).unionByName(
        dealt(empty.withColumn("least", F.lit(NONE)), "r", "a", held, 1))
    found = (both.repartition(held * streamed, "cell").sortWithinPartitions("cell", "role")
             .mapInArrow(_cells(scale, k, SCORES), "anchor long, slot long, score long, other long"))
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "other")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def under_limits(slots: DataFrame, positives: int, k: int) -> DataFrame:
    """Per anchor ``best``: for every limit the best ``k`` rows under it.

    Slots are disjoint and descend, so a limit's rows are those of its own slot
    followed by the ones already merged from the slots below.
    """
    item = F.struct((-F.col("score")).alias("minus"), F.col("other"))
    own = [F.sort_array(F.collect_list(F.when(F.col("slot") == n, item))).alias(f"slot{n}")
           for n in range(positives)]
    merged = slots.groupBy("anchor").agg(*own)
    for n in reversed(range(positives - 1)):
        merged = merged.withColumn(f"slot{n}", F.slice(F.concat(f"slot{n}", f"slot{n + 1}"), 1, k))
    return merged.select("anchor", F.array(*[f"slot{n}" for n in range(positives)]).alias("best"))


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding", positives: int = 5, k: int = 10, low: int = 30,
         high: int = 90, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(math.inf)))
    rows = (vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()
                           & F.coalesce(finite, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("id"),
                    F.col(label_col).cast("long").alias("label"),
                    F.col(vector_col).cast("array<double>").alias("vector"),
                    is_anchor.alias("is_anchor")))
    spark = vectors.sparkSession
    total, asked = rows.agg(F.count("*"), F.count_if("is_anchor")).first()
    held = max(1, -(-asked // ANCHORS))
    streamed = max(-(-total // ROWS), -(-4 * spark.sparkContext.defaultParallelism // held))
    cells, rows_only = (held, int(streamed)), rows.drop("is_anchor")
    anchors = (rows.filter("is_anchor").groupBy("id")
               .agg(F.min(F.struct("label", "vector")).alias("least"))
               .select("id", "least.*"))
    blank = anchors.withColumns({"limits": F.lit(None).cast("array<long>"),
                                 "least": F.lit(None).cast("long")})
    near = best_rows(rows_only, blank, cells, scale, positives)
    # Anchors with the limits of their positives, highest first; a slot for each.
    limits = keep_table(near.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct(
            "place", F.col("other").alias("positive_id"),
            F.col("score").alias("positive_score"))))
        .alias("asked")))
    upper = F.transform("asked", lambda p: F.when(
        p.positive_score >= 0, _share(p.positive_score, high, up=False)).otherwise(NONE))
    lower = F.array_min(F.transform("asked", lambda p: F.when(
        p.positive_score >= 0, _share(p.positive_score, low, up=True)).otherwise(-NONE)))
    padding = F.array_repeat(F.lit(NONE), positives)
    asking = (anchors.join(limits.withColumnRenamed("anchor", "id"), "id")
              .select("id", "label", "vector",
                      F.slice(F.concat(upper, padding), 1, positives).alias("limits"),
                      lower.alias("least")))
    far = under_limits(best_rows(rows_only, asking, cells, scale, k), positives, k)
    one = (limits.join(far, "anchor")
           .select("anchor", "best", F.inline("asked"))
           .withColumn("mine", F.expr("best[place - 1]"))
           .withColumn("mine", F.filter("mine", lambda x: (F.col("positive_score") >= 0) & (
               -x.minus >= _share(F.col("positive_score"), low, up=True)))))
    return (one.select("*", F.posexplode("mine").alias("at", "row"))
            .select(F.col("anchor").alias("anchor_id"), "positive_id",
                    (F.col("at") + 1).alias("rank"), F.col("row.other").alias("negative_id"),
                    "positive_score", (-F.col("row.minus")).alias("negative_score")))


def _share(score: Column, percent: int, up: bool) -> Column:
    """``percent`` of a score that is not negative, as a whole number."""
    product = score * F.lit(percent).cast("long") + F.lit(99 if up else 0).cast("long")
    return F.call_function("div", product, F.lit(100))

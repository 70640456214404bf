"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL.

Words and word pairs of the lower-cased text are hashed to ``DIMENSIONS``
buckets; a document is the sparse vector of their shares, and its score the
logistic function of a sparse dot product. Training follows the regularised
leader per coordinate. Labelled rows are dealt to a fixed number of shards by
hash of their id; each shard trains alone, and the weights are averaged (at most
``DIMENSIONS`` of them reach the driver). Only the text is an input of a score.

At most ``SAMPLE`` labelled rows train, those with the least hash of their id;
all rows are scored. A null text counts as empty and gets the score of the
bias. Rows without a label, or with a null one, do not train; a row that is
repeated trains again, and gets a score each time. Texts of any length are taken
whole, and an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authwatch.llm.batches import map_batches, type_of
from authwatch.llm.rolling import PrefixHash, mix
from authwatch.llm.words import word_bounds

DIMENSIONS = 1 << 18
#: Labelled rows that train at most, the shards they are dealt to, and passes over a shard.
SAMPLE, SHARDS, PASSES = 20_000, 8, 4
#: Every ``FOLDS``-th remainder of crc32(id) is held out.
FOLDS = 5
#: Values of features are shares times this.
SCALE = 80.0
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.01, 0.1
THRESHOLD = 0.3


def hashed_ngrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs, and the bounds of the texts among them."""
    lower = pc.utf8_lower(column.fill_null("")).cast(pa.binary()).to_pylist()
    joined, starts, stops, bounds = word_bounds(lower)
    words = mix(PrefixHash(joined).of(starts, stops) + (stops - starts).astype(np.uint64))
    pairs = mix(words[:-1] * np.uint64(3) + words[1:])
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.flatnonzero(owner[1:] == owner[:-1])
    buckets = np.concatenate([words, pairs[inside]]) & np.uint64(DIMENSIONS - 1)
    order = np.argsort(np.concatenate([owner, owner[inside]]), kind="stable")
    totals = np.maximum(0, 2 * sizes - (sizes > 0))
    return buckets[order].astype(np.int64), np.concatenate([[0], np.cumsum(totals)])


class Ftrl:
    """Follow-the-regularised-leader for logistic loss, per coordinate."""

    def __init__(self, dimensions: int = DIMENSIONS):
        # One more coordinate, the last, is the bias.
        self.z, self.n = np.zeros(dimensions + 1), np.zeros(dimensions + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0,
                        (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, buckets: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(buckets)
        gradient = (1 / (1 + np.exp(-np.clip(w @ values, -30, 30))) - label) * values
        rise = (np.sqrt(self.n[buckets] + gradient ** 2) - np.sqrt(self.n[buckets])) / ALPHA
        self.z[buckets] += gradient - rise * w
        self.n[buckets] += gradient ** 2


def sparse_vector(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, counts = np.unique(buckets, return_counts=True)
    return (np.append(own, DIMENSIONS),
            np.append(counts * (SCALE / max(1, len(buckets))), 1.0))


def train_shard(vectors: list, labels: list[int]) -> np.ndarray:
    model = Ftrl()
    for turn in range(PASSES):
        for number in np.random.default_rng(turn).permutation(len(vectors)):
            model.learn(*vectors[number], labels[number])
    return model.weights()


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights of each shard of a partition: a shard is at most a part of the bounded sample."""
    shards: dict[int, tuple[list, list]] = {}
    for batch in batches:
        buckets, bounds = hashed_ngrams(batch.column(1))
        for row, (shard, label) in enumerate(zip(
                batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
            vectors, labels = shards.setdefault(shard, ([], []))
            vectors.append(sparse_vector(buckets[bounds[row]:bounds[row + 1]]))
            labels.append(label)
    for shard in sorted(shards):
        weights = train_shard(*shards[shard])
        at = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard] * len(at), pa.int32()), pa.array(at), pa.array(weights[at])],
            ["shard", "bucket", "weight"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> np.ndarray:
    """Weights by bucket, the last of them the bias, from rows that are not held out."""
    number = F.xxhash64(id_col)
    chosen = (labels.select(id_col, label_col)
              .filter(F.col(label_col).isNotNull() & ~held_out(id_col))
              .orderBy(number, id_col, label_col).limit(SAMPLE))
    # The sample is bounded, so its ids and labels may be broadcast.
    rows = (docs.select(id_col, text_col)
            .join(F.broadcast(chosen), id_col)
            .select(F.pmod(number, F.lit(SHARDS)).cast("int").alias("shard"),
                    text_col, label_col, number.alias("place")))
    shards = (rows.repartition(SHARDS, "shard").sortWithinPartitions("shard", "place", text_col)
              .select("shard", text_col, label_col)
              .mapInArrow(_train, "shard int, bucket long, weight double"))
    mean = (shards.groupBy("bucket").agg(F.sum("weight").alias("weight"),
                                         F.max("shard").alias("last")))
    weights = np.zeros(DIMENSIONS + 1)
    found = mean.select("bucket", (F.col("weight") / SHARDS).alias("weight")).toPandas()
    weights[found["bucket"].to_numpy(np.int64)] = found["weight"].to_numpy()
    return weights


def held_out(id_col: str):
    return F.coalesce(
        F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def score_texts(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    buckets, bounds = hashed_ngrams(column)
    sums = np.concatenate([[0.0], np.cumsum(weights[buckets])])[bounds]
    sizes = np.diff(bounds)
    linear = np.diff(sums) * (SCALE / np.maximum(1, sizes)) + weights[-1]
    return 1 / (1 + np.exp(-np.clip(linear, -30, 30)))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """One row per row: id, held_out, score and predicted."""
    weights = docs.sparkSession.sparkContext.broadcast(
        train(docs, labels, id_col, text_col, label_col))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        scores = score_texts(batch.column(1), weights.value)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc", "score"])

    scored = map_batches(docs.select(id_col, text_col), run,
                         f"doc {type_of(docs, id_col)}, score double")
    return scored.select(
        F.col("doc").alias(id_col), held_out("doc").alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))

"""A corpus pipeline: quality rules, exact and near dedup, substring dedup, packing.

Every stage takes (spark, docs, sf_dir) and returns all that its operator keeps;
all but the last return the columns of ``documents``. ``run`` writes each
stage's rows as Parquet in the folder that all executors share and reads them
again. Rows that share a doc_id share their fate; a null doc_id is an id of its
own. Columns beyond those of ``documents`` are left out, and an empty table
passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authwatch.llm import exact_dedup, jaccard_trie, packing, quality_rules, substring_dedup
from authwatch.llm.batches import new_folder
from authwatch.llm.queries import documents, ship_package

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _kept(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is among ``ids``."""
    ids = ids.select(F.col("doc_id").alias("kept_id"))
    return docs.select(*COLUMNS).join(
        ids, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their boilerplate lines."""
    ship_package(spark)
    rows = quality_rules.kept_texts(docs, carried=("lang", "source", "n_chars"))
    chars = F.when(F.col("n_lines_removed") > 0, F.char_length("kept_text").cast("long"))
    return rows.select("doc_id", F.col("kept_text").alias("text"), "carried.lang",
                       "carried.source",
                       F.coalesce(chars, F.col("carried.n_chars")).alias("n_chars"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    ship_package(spark)
    return _kept(docs, exact_dedup.mark_copies(docs).filter("kept"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar documents, linked directly or through others, the one with the smallest id."""
    ship_package(spark)
    linked = jaccard_trie.link_documents(docs)
    return _kept(docs, linked.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of long spans that earlier documents have."""
    ship_package(spark)
    removed = substring_dedup.remove_repeated(docs, with_text=("lang", "source"))
    return removed.select("doc_id", F.col("kept_text").alias("text"), "carried.lang",
                          "carried.source",
                          F.char_length("kept_text").cast("long").alias("n_chars"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences."""
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("jaccard_join", near_stage),
    ("substring_dedup", substring_stage),
    ("packing", packing_stage),
]

#: Packing depends on how rows lie in partitions, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    rows = documents(spark, sf_dir)
    folder = new_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
    return rows

"""The operators applied to the given tables, one query each."""

from __future__ import annotations

import os
import shutil
import tempfile
import weakref

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authwatch.llm import (
    bpe_stream, exact_dedup, hard_negatives, jaccard_trie, packing, quality_classifier,
    quality_rules, source_divergence, substring_dedup, suffix_dedup, suffix_tree_lm,
    token_counts, warc_zip)
from authwatch.llm.batches import new_folder
from authwatch.llm.oracles import ORACLES  # noqa: F401  (SQL twins, by name of the query)

_SHIPPED: weakref.WeakSet = weakref.WeakSet()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, whatever their Python path; once per context."""
    context = spark.sparkContext
    if context not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="authwatch-code-")
        context.addPyFile(shutil.make_archive(
            os.path.join(folder, "authwatch"), "zip", os.path.dirname(package),
            os.path.basename(package)))
        _SHIPPED.add(context)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_earlier(documents(spark, sf_dir), width=100)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(documents(spark, sf_dir))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeated(documents(spark, sf_dir), width=13)


def op7_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_stream.round_trip(
        documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_jaccard_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_trie.link_counts(documents(spark, sf_dir))


def op10_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc_zip.round_trip(pages, new_folder(spark, "archives"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(documents(spark, sf_dir))


def op13_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    return suffix_tree_lm.score_texts(documents(spark, sf_dir), F.coalesce(rest != 2, F.lit(True)))


def _shipped(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    return run


QUERIES = {query.__name__: _shipped(query) for query in (
    op1_suffix_dedup, op2_token_counts, op3_exact_dedup, op4_packing, op5_quality_rules,
    op6_substring_dedup, op7_bpe_stream, op8_quality_classifier, op9_jaccard_trie,
    op10_warc_zip, op11_hard_negatives, op12_source_divergence,
    op13_suffix_tree_lm)}

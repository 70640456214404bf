"""Exact dedup with a heavy-hitter split, in DataFrame operations only.

Texts are equal if they are identical after every run of white space (blank and
\\t to \\r) becomes one blank. A Misra-Gries summary (``approx_top_k``, whose
sketch is of that family) names the digests that may be frequent. Their counts
are verified and their winners, at most ``tracked`` rows, are broadcast, so
copies of frequent texts are settled where they lie. All other digests are too
rare to weigh on a partition and go through one ordinary shuffle of digests.

The text is read once; ids and digests are kept as a table. A null text counts
as empty. Null ids count as the largest. Rows that share both id and text are
one document and get the same verdict. Texts of any length are taken whole, and an
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from authwatch.llm.batches import keep_table

#: Digests that the summary tracks and that are broadcast at most.
TRACKED = 4096
#: Copies from which a text counts as frequent.
FREQUENT = 32


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def frequent_winners(digests: DataFrame, tracked: int = TRACKED,
                     frequent: int = FREQUENT) -> DataFrame:
    """Exact (digest, keep, size) of the digests that the summary names and that are frequent."""
    named = (digests
             .agg(F.expr(f"approx_top_k(digest, {tracked // 4}, {tracked})").alias("top"))
             .select(F.explode("top").alias("top"))
             .filter(F.col("top.count") >= frequent)
             .select(F.col("top.item").alias("digest")))
    # At most ``tracked`` digests, so their broadcast has a bound.
    return (digests.join(F.broadcast(named), "digest", "left_semi")
            .groupBy("digest")
            .agg(F.min("id").alias("keep"), F.count("*").alias("size"))
            .filter(F.col("size") >= frequent))


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                tracked: int = TRACKED, frequent: int = FREQUENT) -> DataFrame:
    """One row per row: id, keep_id, group_size, kept and text_sha256."""
    digests = keep_table(docs.select(
        F.col(id_col).alias("id"), F.sha2(normalised(F.col(text_col)), 256).alias("digest")))
    winners = keep_table(frequent_winners(digests, tracked, frequent))
    heavy = digests.join(F.broadcast(winners), "digest")
    same = Window.partitionBy("digest")
    light = (digests.join(F.broadcast(winners), "digest", "left_anti")
             .withColumn("keep", F.min("id").over(same))
             .withColumn("size", F.count("*").over(same)))
    return heavy.unionByName(light).select(
        F.col("id").alias(id_col), F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"), F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        F.col("digest").alias("text_sha256"))

"""Log files as lines, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def logical_path(file_path: Column) -> Column:
    """Path of the log file a line belongs to.

    A per-day file written by Spark is a folder of parts, and the folder is
    the log file. Local paths lose their URI scheme.
    """
    # The path is percent-encoded; a plus stands for itself.
    decoded = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    plain = F.regexp_replace(decoded, "^file:/+", "/")
    return F.regexp_replace(plain, r"(?:[^/=]+=)?([^/]+\.log)/part-[^/]*$", "$1")


def read_logs(spark: SparkSession, glob: str) -> DataFrame:
    """Lines of all files: ``message, source_path, block_start, line_no``.

    ``(source_path, block_start, line_no)`` orders lines as in the file, also
    when a large file is read in several splits.
    """
    return spark.read.text(glob).select(
        F.col("value").alias("message"),
        logical_path(F.col("_metadata.file_path")).alias("source_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_no"))


def read_numbered_logs(spark: SparkSession, glob: str) -> DataFrame:
    """Lines of all files with their place in the file: ``message, source_path, line_number``.

    A file is read in any number of splits. Lines are counted per split, one row
    each; a running sum over the splits of a file gives the lines before each, and
    the line's place in its split is added. Parts of a per-day folder count on in
    the order of their names. The lines themselves are neither sorted nor shuffled:
    the rows of the splits, which also hold the log file's path, go to every task.
    """
    lines = spark.read.text(glob).select(
        F.col("value").alias("message"),
        F.col("_metadata.file_path").alias("part"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("place"))
    in_file = (Window.partitionBy("source_path").orderBy("part", "block_start")
               .rowsBetween(Window.unboundedPreceding, -1))
    splits = (lines.groupBy("part", "block_start")
              .agg(F.min("place").alias("first"), F.count("*").alias("n"))
              .withColumn("source_path", logical_path(F.col("part")))
              .select("part", "block_start", "source_path", "first",
                      F.coalesce(F.sum("n").over(in_file), F.lit(0)).alias("before")))
    return lines.join(F.broadcast(splits), ["part", "block_start"]).select(
        "message", "source_path",
        (F.col("before") + F.col("place") - F.col("first") + 1).alias("line_number"))


def stream_logs(spark: SparkSession, path: str, max_files: int | None = None,
                max_bytes: str | None = None, archive: str | None = None) -> DataFrame:
    """New log files as a stream; the checkpoint remembers finished files.

    ``max_files`` or ``max_bytes`` bounds a micro-batch. ``archive`` moves
    finished files to that folder.
    """
    options = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes}
    if archive:
        options.update(cleanSource="archive", sourceArchiveDir=archive)
    reader = spark.readStream.options(**{k: v for k, v in options.items() if v})
    return reader.text(path).select(
        F.col("value").alias("message"),
        logical_path(F.col("_metadata.file_path")).alias("source_path"))


def finished_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Files that a stream of log files has finished: ``file_path, source_path, modified``.

    ``checkpoint`` is that of a stream whose only source is ``stream_logs``. Files of a
    batch that was not committed are left out, since the next start reads them again.
    """
    def batches(kind: str) -> DataFrame:
        return spark.read.text(f"{checkpoint}/{kind}").select(
            "value", F.col("_metadata.file_name").try_cast("bigint").alias("batch"))

    last = batches("commits").agg(F.max("batch").alias("batch"))
    position = F.get_json_object("value", "$.logOffset").try_cast("bigint")
    reached = batches("offsets").join(last, "batch").agg(F.max(position)).first()[0]
    entry = F.from_json("value", "path string, timestamp bigint, batchId bigint")
    # Records are joined to larger ones from time to time; a file may be in both.
    return (spark.read.text(f"{checkpoint}/sources/0").select(entry.alias("file"))
            .filter(F.col("file.batchId") <= F.lit(reached).cast("bigint"))
            .select(F.regexp_replace(F.url_decode(F.replace(
                F.col("file.path"), F.lit("+"), F.lit("%2B"))), "^file:/+", "/")
                    .alias("file_path"),
                    logical_path(F.col("file.path")).alias("source_path"),
                    F.timestamp_millis("file.timestamp").alias("modified")).distinct())

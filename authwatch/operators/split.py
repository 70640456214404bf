"""Split raw lines by day, with or without a cap per day, and capped dumps."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from authwatch.functions import syslog
from authwatch.sources.tables import input_bytes

DATE_PATTERN = rf"^({syslog.MONTHS}) +([0-9]{{1,2}}) "
LINE_ORDER = ("source_path", "block_start", "line_no")
#: Bytes of input that a part of a split holds (about).
PART_BYTES = 128 << 20


def dated_lines(lines: DataFrame, year: int | str) -> DataFrame:
    """Add ``file_name``, the per-day file a line belongs to.

    A line that does not start with month and day gets NULL.
    """
    def part(group):
        return syslog.blank_to_null(F.regexp_extract("message", DATE_PATTERN, group))

    month = F.lpad(syslog.month_number(part(1)).cast("string"), 2, "0")
    name = F.concat(F.lit(f"ssh-{year}"), month, F.lpad(part(2), 2, "0"), F.lit(".log"))
    return lines.withColumn("file_name", name)


def write_split(dated: DataFrame, out: str, order=LINE_ORDER,
                part_bytes: int = PART_BYTES) -> None:
    """One folder ``file_name=ssh-YYYYMMDD.log`` per day, written in parallel.

    The parts of a day, by name, hold its lines in ``order``: one shuffle by
    ranges of day and order, as many as the input has ``part_bytes``, so that a
    large day has several.
    """
    parts = max(dated.sparkSession.sparkContext.defaultParallelism,
                math.ceil(input_bytes(dated) / part_bytes))
    keys = [F.col(c) for c in ("file_name", *order)]
    (dated.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
     .select("file_name", F.col("message").alias("value"))
     .write.mode("overwrite").partitionBy("file_name").text(out))


def split_by_date(lines: DataFrame, year: int | str, out: str, order=LINE_ORDER) -> None:
    write_split(dated_lines(lines, year), out, order)


def first_n_per_group(df: DataFrame, group: str, n: int, order=LINE_ORDER,
                      buckets: int = 256) -> DataFrame:
    """The first ``n`` rows of each group in ``order``.

    Two exact steps: first within (group, bucket of the input partition), then
    within the group, which gets ``n * buckets`` rows at most. Up to Spark's
    ``windowGroupLimitThreshold`` (1,000) rows are also cut to ``n`` per input
    task before the shuffle; with a larger ``n`` whole groups are shuffled.
    """
    keys = [F.col(c) for c in order]

    def first(rows, *by):
        window = Window.partitionBy(*by).orderBy(*keys)
        return rows.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= n)

    spread = df.withColumn("_bucket", F.pmod(F.spark_partition_id(), F.lit(buckets)))
    return first(first(spread, group, "_bucket"), group).drop("_n", "_bucket")


def capped_lines(lines: DataFrame, year: int | str, max_rows: int,
                 order=LINE_ORDER) -> DataFrame:
    return first_n_per_group(dated_lines(lines, year), "file_name", max_rows, order)


def split_by_date_capped(lines: DataFrame, year: int | str, out: str, max_rows: int,
                         order=LINE_ORDER) -> None:
    """As :func:`split_by_date`, with at most ``max_rows`` lines per day;
    :func:`split_left_out` tells what a day loses."""
    write_split(capped_lines(lines, year, max_rows, order), out, order)


def split_counts(dated: DataFrame) -> DataFrame:
    """Lines per output file."""
    return dated.groupBy("file_name").agg(F.count("*").alias("n_lines"))


def split_left_out(dated: DataFrame, max_rows: int) -> DataFrame:
    """Lines per output file, and how many of them a cap of ``max_rows`` leaves out."""
    lost = F.greatest(F.col("n_lines") - max_rows, F.lit(0).cast("bigint"))
    return split_counts(dated).withColumn("n_left_out", lost)


def capped_dump(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` events, in time order. No analytic operator uses this."""
    return df.orderBy("event_time", "row_hash").limit(n)


def dump_counts(df: DataFrame, n: int) -> DataFrame:
    """One row: how many events there are, and how many a dump of ``n`` leaves out."""
    total = F.count("*")
    return df.agg(total.alias("total_rows"), F.greatest(
        total - n, F.lit(0).cast("bigint")).alias("left_out"))

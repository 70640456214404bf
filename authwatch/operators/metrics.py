"""Counts, top lists and daily metrics over enriched events.

Raw rows are always pre-aggregated on the map side before any shuffle, so an
address or day that holds a third of all rows costs one partial-count row per
task. Ranking runs on aggregated rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from authwatch.functions import classify, syslog
from authwatch.operators.filters import as_date, daily_filter, failed_logins

PLACEHOLDER_IP = "N/A"
# grouping_id() over (metric_date, ip, hour) for the two levels of a profile.
BY_IP, BY_HOUR = 1, 2


def with_day(df: DataFrame, report_tz: str = "UTC", name: str = "metric_date") -> DataFrame:
    return df.withColumn(name, F.to_date(syslog.local_time(F.col("event_time"), report_tz)))


def hour_of_day(df: DataFrame, report_tz: str = "UTC") -> DataFrame:
    return df.withColumn("hour", F.hour(syslog.local_time(F.col("event_time"), report_tz)))


def count_per(df: DataFrame, keys, *aggs, name: str = "cnt") -> DataFrame:
    """Group by ``keys`` and count timed rows; groups without a time are dropped.

    An event without a time belongs to no day. The test is on the counted
    times after the aggregation: a filter on ``event_time`` before it would be
    pushed through the parsing projections and parse every line twice.
    """
    return (df.groupBy(*keys).agg(F.count("event_time").alias(name), *aggs)
            .filter(F.col(name) > 0))


def top_k_per_group(df: DataFrame, group: str, order, k: int) -> DataFrame:
    """First ``k`` rows per group with their ``rank``.

    The rank is filtered directly, so Spark cuts every task's input to ``k``
    rows per group before the shuffle.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def order_by_count(counts: DataFrame, col: str = "cnt", *keys: str) -> DataFrame:
    """Most frequent first; ``keys`` decide ties."""
    return counts.orderBy(F.desc(col), *keys)


def top_k(counts: DataFrame, k: int, col: str = "cnt", *keys: str) -> DataFrame:
    """The ``k`` most frequent rows overall, without sorting all of them."""
    return order_by_count(counts, col, *keys).limit(k)


def total_logs(df: DataFrame, report_tz: str = "UTC") -> DataFrame:
    return count_per(with_day(df, report_tz), ["metric_date"], name="total_logs")


def error_count(df: DataFrame, report_tz: str = "UTC") -> DataFrame:
    errors = F.count_if(F.col("log_level") == "ERROR").alias("error_count")
    return count_per(with_day(df, report_tz), ["metric_date"], errors).drop("cnt")


def unique_ips(df: DataFrame, count_null_ip: bool = False, approx: bool = False,
               report_tz: str = "UTC") -> DataFrame:
    """Distinct addresses per day; ``count_null_ip`` counts a missing one too."""
    distinct = F.approx_count_distinct("ip") if approx else F.count_distinct("ip")
    if count_null_ip:
        distinct = distinct + F.max(F.col("ip").isNull().cast("bigint"))
    return count_per(with_day(df, report_tz), ["metric_date"],
                     distinct.alias("unique_ips")).drop("cnt")


def unique_sources(df: DataFrame, source_col: str = "source_file",
                   report_tz: str = "UTC") -> DataFrame:
    distinct = F.count_distinct(source_col).alias("unique_sources")
    return count_per(with_day(df, report_tz), ["metric_date"], distinct).drop("cnt")


def hourly_counts(df: DataFrame, report_tz: str = "UTC") -> DataFrame:
    return count_per(hour_of_day(with_day(df, report_tz), report_tz), ["metric_date", "hour"])


def peak_hour(df: DataFrame, report_tz: str = "UTC") -> DataFrame:
    """Busiest hour per day; the earliest one on a tie."""
    busiest = F.max_by("hour", F.struct(F.col("cnt"), -F.col("hour")))
    return (hourly_counts(df, report_tz).groupBy("metric_date")
            .agg(busiest.alias("peak_hour"), F.max("cnt").alias("peak_hour_logs")))


def ip_counts(df: DataFrame, report_tz: str = "UTC") -> DataFrame:
    return count_per(with_day(df, report_tz), ["metric_date", "ip"])


def top_ips(df: DataFrame, k: int = 3, null_before_limit: bool = True,
            report_tz: str = "UTC") -> DataFrame:
    """Most frequent addresses per day.

    With ``null_before_limit=False`` lines without an address compete for a
    place and are dropped afterwards, so fewer than ``k`` rows may remain.
    """
    counts = ip_counts(df, report_tz)
    known = F.col("ip").isNotNull()
    if null_before_limit:
        counts = counts.filter(known)
    top = top_k_per_group(counts, "metric_date", (F.desc("cnt"), F.asc("ip")), k)
    return top.filter(known).select("metric_date", "rank", "ip", "cnt")


def brute_force_daily(df: DataFrame, threshold: int = 10,
                      failure_types=classify.FAILURE_TYPES,
                      report_tz: str = "UTC") -> DataFrame:
    """Addresses with at least ``threshold`` failed logins on a day."""
    return (ip_counts(failed_logins(df, failure_types), report_tz)
            .withColumnRenamed("cnt", "fail_cnt")
            .filter(F.col("fail_cnt") >= threshold))


def brute_force_top(df: DataFrame, threshold: int = 10, k: int = 3,
                    failure_types=classify.FAILURE_TYPES,
                    report_tz: str = "UTC") -> DataFrame:
    suspects = brute_force_daily(df, threshold, failure_types, report_tz)
    top = top_k_per_group(suspects, "metric_date", (F.desc("fail_cnt"), F.asc("ip")), k)
    return top.select("metric_date", "rank", "ip", "fail_cnt")


def brute_force_windowed(df: DataFrame, window: str = "1 minute", threshold: int = 60,
                         watermark: str | None = None) -> DataFrame:
    """Addresses with ``threshold`` failed logins in one tumbling window.

    Batch and stream alike; a stream needs ``watermark``.
    """
    failed = failed_logins(df)
    if watermark:
        failed = failed.withWatermark("event_time", watermark)
    return (failed.groupBy(F.window("event_time", window), "ip")
            .agg(F.count("*").alias("fail_cnt"))
            .filter(F.col("fail_cnt") >= threshold)
            .select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), "ip", "fail_cnt"))


def untimed_counts(df: DataFrame, source_col: str = "source_file") -> DataFrame:
    """Lines per source, and how many of them had no readable time."""
    return df.groupBy(source_col).agg(
        F.count("*").alias("total_logs"),
        F.count_if(F.col("event_time").isNull()).alias("untimed_logs"))


def success_rate(df: DataFrame, report_tz: str = "UTC") -> DataFrame:
    """Per day: share of lines that are no errors, and distinct user names."""
    per_day = count_per(
        with_day(df, report_tz), ["metric_date"],
        F.count_if(F.col("log_level") == "ERROR").alias("error_count"),
        F.count_distinct(syslog.blank_to_null(F.col("user"))).alias("unique_users"),
        name="total_logs")
    total, errors = F.col("total_logs"), F.col("error_count")
    return per_day.withColumn("success_rate",
                              F.round(100.0 * (total - errors) / total, 2))


def day_profile(df: DataFrame, failure_types=classify.FAILURE_TYPES,
                report_tz: str = "UTC") -> DataFrame:
    """Counters per (day, address) and per (day, hour), told apart by ``level``.

    Two grouping sets in one aggregation: one scan, and one shuffle of
    pre-aggregated rows. A NULL address is a group of its own.
    """
    timed = hour_of_day(with_day(df, report_tz), report_tz)
    return (timed.groupingSets([["metric_date", "ip"], ["metric_date", "hour"]],
                               "metric_date", "ip", "hour")
            .agg(F.count("event_time").alias("total"),
                 F.count_if(F.col("log_level") == "ERROR").alias("errors"),
                 F.count_if(classify.is_failure(failure_types)).alias("failures"),
                 F.grouping_id().cast("int").alias("level"))
            .filter(F.col("total") > 0))


def _top_list(candidates: str, k: int, name: str) -> Column:
    """Ordered ``[{ip, cnt}]`` of the first k, or the placeholder entry."""
    listed = (f"transform(filter(slice(sort_array({candidates}), 1, {k}), x -> x.ip IS NOT NULL), "
              "x -> named_struct('ip', x.ip, 'cnt', -x.neg_cnt))")
    return F.expr(f"if(size({listed}) > 0, {listed}, "
                  f"array(named_struct('ip', '{PLACEHOLDER_IP}', 'cnt', 0L))) AS {name}")


def daily_metrics(df: DataFrame, day=None, threshold: int = 10, k: int = 3,
                  count_null_ip: bool = False, null_before_limit: bool = True,
                  failure_types=classify.FAILURE_TYPES, report_tz: str = "UTC",
                  buckets: int = 256) -> DataFrame:
    """The daily KPI row, for every day at once or for one ``day``.

    Three shuffles, all of aggregated rows: by the keys of the profile; by
    (day, bucket of ip) to find each bucket's first ``k``; by day. Every
    address of a day is ranked inside one of ``buckets`` groups, and at most
    ``k`` per bucket and list go on, so a day with a very large number of
    addresses never meets in one task. An explicit day without events gives
    one row of zeros.
    """
    if day is not None:
        df = daily_filter(df, day, report_tz=report_tz)
    profile = (day_profile(df, failure_types, report_tz)
               .withColumn("_bucket", F.pmod(F.xxhash64("ip"), F.lit(buckets))))

    bucket = Window.partitionBy("metric_date", "level", "_bucket")
    null_last = [F.col("ip").isNull()] if null_before_limit else []
    ranked = profile.withColumns({
        "_by_total": F.row_number().over(
            bucket.orderBy(*null_last, F.desc("total"), F.asc("ip"))),
        "_by_failures": F.row_number().over(
            bucket.orderBy(F.desc("failures"), F.asc("ip"))),
    })
    if day is not None:
        ranked = ranked.unionByName(_empty_profile(df, day), allowMissingColumns=True)

    by_ip, by_hour = F.col("level") == BY_IP, F.col("level") == BY_HOUR
    known = by_ip & F.col("ip").isNotNull()
    suspect = known & (F.col("failures") >= threshold)
    in_total = (known if null_before_limit else by_ip) & (F.col("_by_total") <= k)
    in_failures = suspect & (F.col("_by_failures") <= k)

    def entry(counter):
        return F.struct((-F.col(counter)).alias("neg_cnt"), F.col("ip").alias("ip"))

    distinct = F.count_if(by_ip if count_null_ip else known)
    busiest = F.when(by_hour, F.struct(F.col("total"), -F.col("hour")))
    return ranked.groupBy("metric_date").agg(
        F.sum(F.when(by_hour, F.col("total")).otherwise(0)).alias("total_logs"),
        F.sum(F.when(by_hour, F.col("errors")).otherwise(0)).alias("error_count"),
        distinct.alias("unique_ips"),
        F.max_by("hour", busiest).alias("peak_hour"),
        F.max(F.when(by_hour, F.col("total")).otherwise(0)).alias("peak_hour_logs"),
        F.collect_list(F.when(in_total, entry("total"))).alias("_top"),
        F.count_if(suspect).alias("brute_force_ips"),
        F.collect_list(F.when(in_failures, entry("failures"))).alias("_brute"),
    ).select(
        "metric_date", "total_logs", "error_count", "unique_ips", "peak_hour",
        "peak_hour_logs", _top_list("_top", k, "top_ip_list"), "brute_force_ips",
        _top_list("_brute", k, "top_brute_list"))


def _empty_profile(df: DataFrame, day) -> DataFrame:
    """One profile row without a level, which puts the day into the result."""
    return df.sparkSession.range(1).select(F.lit(as_date(day)).alias("metric_date"))


def nested_top_list(metrics: DataFrame, col: str = "top_ip_list") -> DataFrame:
    """Flatten a nested list back to ``(metric_date, rank, ip, cnt)``."""
    return (metrics.select("metric_date", F.posexplode(col).alias("pos", "item"))
            .select("metric_date", (F.col("pos") + 1).alias("rank"),
                    F.col("item.ip").alias("ip"), F.col("item.cnt").alias("cnt")))

"""Report tables: value counts, summaries and the rows of the daily mail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from authwatch.functions import classify, syslog
from authwatch.operators.filters import daily_filter
from authwatch.operators.metrics import (
    count_per,
    hour_of_day,
    order_by_count,
    top_k,
    with_day,
)

MISSING = "N/A"

# Report column and the literal it counts. The counts may
# overlap, since one message can hold several of the literals.
SUMMARY_LITERALS = [
    ("failed_login_attempts", "Failed password"),
    ("successful_logins", "Accepted password"),
    ("invalid_users", "Invalid user"),
    ("connection_closed", "Connection closed"),
    ("sessions_opened", "session opened"),
    ("sessions_closed", "session closed"),
]


def value_counts(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first, missing values left out.

    With ``top`` the cut is a distributed top-k, and only its rows are ranked.
    """
    counts = (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
              .agg(F.count("*").alias("cnt")))
    return order_by_count(counts, "cnt", "value") if top is None else _ranked_top(counts, top)


def _ranked_top(counts: DataFrame, top: int) -> DataFrame:
    """The rank window sees the ``top`` rows that are left, and no others."""
    rank = F.row_number().over(Window.orderBy(F.desc("cnt"), F.asc("value")))
    return top_k(counts, top, "cnt", "value").withColumn("rank", rank)


def date_counts(df: DataFrame, report_tz: str = "UTC") -> DataFrame:
    return count_per(with_day(df, report_tz, "event_date"), ["event_date"]).orderBy("event_date")


def daily_summary(df: DataFrame, level_col: str = "log_level",
                  source_col: str = "source_file", report_tz: str = "UTC") -> DataFrame:
    level = F.col(level_col)
    return count_per(
        with_day(df, report_tz, "date"), ["date"],
        F.count_distinct(source_col).alias("unique_sources"),
        F.count_if(level == "ERROR").alias("error_count"),
        F.count_if(level == "WARN").alias("warning_count"),
        F.count_if(level == "INFO").alias("info_count"),
        name="total_records")


def auth_report_summary(df: DataFrame, source_col: str = "source_file") -> DataFrame:
    """One row: totals and the six literal counts."""
    return df.agg(
        F.count("*").alias("total_records"),
        F.count_distinct(source_col).alias("unique_sources"),
        *[F.count_if(classify.has_text(F.col("message"), literal)).alias(name)
          for name, literal in SUMMARY_LITERALS])


def report_cube(df: DataFrame, level_col: str = "log_level",
                source_col: str = "source_file", report_tz: str = "UTC") -> DataFrame:
    """All counters of the report in one pass over the events.

    One row per hour, level, source and pattern. Every table of the report is
    a further sum of this, which is small whatever the size of the log.
    """
    flags = [F.count_if(classify.has_text(F.col("message"), literal)).alias(name)
             for name, literal in SUMMARY_LITERALS]
    day = F.to_date(syslog.local_time(F.col("event_time"), report_tz))
    return (hour_of_day(df.withColumn("event_date", day), report_tz)
            .groupBy("event_date", "hour", F.col(level_col).alias("level"),
                     F.col(source_col).alias("source"),
                     classify.message_pattern(F.col("message")).alias("pattern"))
            .agg(F.count("*").alias("cnt"), *flags))


def _cube_counts(cube: DataFrame, col: str) -> DataFrame:
    return (cube.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
            .agg(F.sum("cnt").alias("cnt")))


def report_level_distribution(cube: DataFrame) -> DataFrame:
    return order_by_count(_cube_counts(cube, "level"), "cnt", "value")


def report_hourly_trend(cube: DataFrame) -> DataFrame:
    """Rows per hour of day over the whole report range."""
    return (cube.filter(F.col("hour").isNotNull()).groupBy("hour")
            .agg(F.sum("cnt").alias("cnt")).orderBy("hour"))


def report_source_top10(cube: DataFrame, top: int = 10) -> DataFrame:
    return _ranked_top(_cube_counts(cube, "source"), top)


def report_source_counts(cube: DataFrame) -> DataFrame:
    return order_by_count(_cube_counts(cube, "source"), "cnt", "value")


def report_pattern_distribution(cube: DataFrame) -> DataFrame:
    return order_by_count(_cube_counts(cube, "pattern"), "cnt", "value")


def report_summary(cube: DataFrame) -> DataFrame:
    """The one-row summary of :func:`auth_report_summary`, from the cube."""
    zero = F.lit(0).cast("bigint")
    return cube.agg(
        F.coalesce(F.sum("cnt"), zero).alias("total_records"),
        F.count_distinct("source").alias("unique_sources"),
        *[F.coalesce(F.sum(name), zero).alias(name) for name, _ in SUMMARY_LITERALS])


def report_summary_rows(summary: DataFrame) -> DataFrame:
    """One-row summary -> ``(metric, value)`` rows."""
    return summary.select(*[F.col(c).cast("bigint") for c in summary.columns]).unpivot(
        [], summary.columns, "metric", "value")


def report_detail_rows(df: DataFrame, day=None, day_to=None, report_tz: str = "UTC") -> DataFrame:
    """The events behind a report, for a partitioned write."""
    return df if day is None else daily_filter(df, day, day_to, report_tz)


def daily_report(df: DataFrame, day, day_to=None, level_col: str = "log_level",
                 source_col: str = "source_file", report_tz: str = "UTC") -> dict:
    """All tables of the report for a day or an inclusive range of days.

    The tables share one cube. Whoever writes several of them may persist it.
    """
    events = daily_filter(df, day, day_to, report_tz)
    return report_tables(report_cube(events, level_col, source_col, report_tz), events)


def report_tables(cube: DataFrame, events: DataFrame) -> dict:
    summary = report_summary(cube)
    return {
        "cube": cube,
        "summary": summary,
        "summary_rows": report_summary_rows(summary),
        "level_distribution": report_level_distribution(cube),
        "hourly_trend": report_hourly_trend(cube),
        "source_top10": report_source_top10(cube),
        "source_counts": report_source_counts(cube),
        "pattern_distribution": report_pattern_distribution(cube),
        "detail_rows": events,
    }


def thousands(col: Column) -> Column:
    """``1234567`` -> ``1,234,567``; missing -> ``N/A``."""
    return F.coalesce(F.format_number(col, 0), F.lit(MISSING))


def format_metric(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: thousands(F.col(c)) for c in cols})


def email_report_rows(metrics: DataFrame) -> DataFrame:
    """Rows of the daily mail: KPI table and the two top lists.

    One explode over the metrics row, so the metrics are computed once. What a
    day does not have is ``N/A``, for a day without metrics all of it.
    """
    def kpi(position, label, value):
        return F.struct(F.lit("summary").alias("section"), F.lit(position).alias("position"),
                        F.lit(label).alias("label"), value.alias("display"))

    hour = F.coalesce(F.col("peak_hour").cast("string"), F.lit(MISSING))
    peak = F.concat(thousands(F.col("peak_hour_logs")), F.lit(" (hour "), hour, F.lit(")"))
    summary = F.array(
        kpi(1, "total_logs", thousands(F.col("total_logs"))),
        kpi(2, "error_count", thousands(F.col("error_count"))),
        kpi(3, "unique_ips", thousands(F.col("unique_ips"))),
        kpi(4, "peak_hour_logs", peak),
        kpi(5, "brute_force_ips", thousands(F.col("brute_force_ips"))),
    )

    def listed(section, col):
        entries = F.coalesce(F.col(col), F.array(F.struct(
            F.lit(None).cast("string").alias("ip"), F.lit(None).cast("bigint").alias("cnt"))))
        return F.transform(entries, lambda x, i: F.struct(
            F.lit(section).alias("section"), (i + 1).alias("position"),
            F.coalesce(x["ip"], F.lit(MISSING)).alias("label"),
            thousands(x["cnt"]).alias("display")))

    rows = F.concat(summary, listed("top_ip", "top_ip_list"),
                    listed("top_brute", "top_brute_list"))
    return metrics.select("metric_date", F.inline(rows))


def alert_text(df: DataFrame) -> DataFrame:
    """Add ``body_line``, the text of one alert in the notification."""
    line = F.concat(F.lit("IP: "), F.col("ip"), F.lit("  failures: "),
                    F.col("fail_cnt").cast("string"))
    if "detected_at" in df.columns:
        line = F.concat(line, F.lit("  detected: "), F.col("detected_at").cast("string"))
    return df.withColumn("body_line", line)

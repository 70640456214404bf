"""Row filters. Each is a plain predicate that Catalyst can push down."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authwatch.functions import classify


def as_date(day) -> dt.date:
    return dt.date.fromisoformat(day) if isinstance(day, str) else day


def failed_logins(df: DataFrame, types=classify.FAILURE_TYPES) -> DataFrame:
    return df.filter(classify.is_failure(types))


def daily_filter(df: DataFrame, day, day_to=None, report_tz: str = "UTC") -> DataFrame:
    """Events of one day, or of ``day`` .. ``day_to`` inclusive.

    The bounds are literals on the bare column, so they reach the scan.
    """
    first, last = as_date(day), as_date(day_to or day)
    low, high = (F.to_utc_timestamp(F.lit(str(d)).cast("timestamp"), report_tz)
                 for d in (first, last + dt.timedelta(days=1)))
    return df.filter((F.col("event_time") >= low) & (F.col("event_time") < high))


def level_filter(df: DataFrame, level: str) -> DataFrame:
    return df.filter(F.col("log_level") == level)


def message_contains(df: DataFrame, literal: str) -> DataFrame:
    return df.filter(classify.has_text(F.col("message"), literal))


def metric_lookup(metrics: DataFrame, day) -> DataFrame:
    """All rows of the day: one, unless the table is damaged, which then shows."""
    return metrics.filter(F.col("metric_date") == F.lit(as_date(day)))


def having_threshold(df: DataFrame, col: str, threshold: int) -> DataFrame:
    return df.filter(F.col(col) >= threshold)

"""Daily jobs: settle the day, compute its metrics, write its report tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authwatch.functions import syslog
from authwatch.operators.filters import as_date, daily_filter, metric_lookup
from authwatch.operators.metrics import daily_metrics
from authwatch.operators.ranges import day_state
from authwatch.operators.report import email_report_rows, report_cube, report_tables
from authwatch.sources import files, snapshots
from authwatch.sources.tables import (
    read_events, read_metrics, settle_days, write_day_states, write_metrics)


def today_utc() -> dt.date:
    return dt.datetime.now(dt.timezone.utc).date()


def yesterday_utc() -> dt.date:
    return today_utc() - dt.timedelta(days=1)


def stored_days(day_from, day_to=None, report_tz: str = "UTC") -> tuple[dt.date, dt.date]:
    """First and last UTC day of storage that hold the given days of a zone."""
    margin = dt.timedelta(days=0 if report_tz == "UTC" else 1)
    return as_date(day_from) - margin, as_date(day_to or day_from) + margin


def read_report_days(spark: SparkSession, events: str, day_from, day_to=None,
                     report_tz: str = "UTC") -> DataFrame:
    """Stored events of whole days of ``report_tz``; partitions are pruned."""
    stored = read_events(spark, events, *stored_days(day_from, day_to, report_tz))
    return daily_filter(stored, day_from, day_to, report_tz)


def run_daily_metrics(spark: SparkSession, events: str, metrics: str, day=None,
                      live: str | None = None, report_tz: str = "UTC", **options) -> None:
    """Metrics of one day (default today, UTC) from the events table.

    With ``live`` the day is first settled from the stream's folder.
    """
    day = day or today_utc()
    if live:
        settle_days(spark, live, events, *stored_days(day, None, report_tz))
    rows = read_report_days(spark, events, day, None, report_tz)
    write_metrics(daily_metrics(rows, day, report_tz=report_tz, **options), metrics)


def backfill_metrics(spark: SparkSession, events: str, metrics: str, day_from=None,
                     day_to=None, report_tz: str = "UTC", live: str | None = None,
                     **options) -> None:
    """Metrics of all stored days, or of ``day_from`` .. ``day_to``, in one job.

    With ``live`` these days are first settled from the stream's folder.
    """
    if live:
        bounds = (None, None) if day_from is None else stored_days(day_from, day_to, report_tz)
        settle_days(spark, live, events, *bounds)
    if day_from is None:
        rows = read_events(spark, events)
    else:
        rows = read_report_days(spark, events, day_from, day_to, report_tz)
    write_metrics(daily_metrics(rows, report_tz=report_tz, **options), metrics)


THROUGH = "_through"


def refresh_metrics(spark: SparkSession, events: str, metrics: str, live: str | None = None,
                    report_tz: str = "UTC", state: str | None = None,
                    **options) -> set[dt.date]:
    """Metrics of exactly the days that have changed since the last refresh; returns them.

    The events table tells which days its merges changed, also by events that came
    after their day was settled. How far it was followed is kept beside the metrics,
    and noted last, so that a job that was cut off is made good by the next. With
    ``live`` everything that has arrived is settled first; with ``state`` the days'
    sketches for figures over ranges are stored there, too.
    """
    if live:
        settle_days(spark, live, events)
    done = [int(name) for name in files.names(spark, f"{metrics}/{THROUGH}") if name.isdigit()]
    version, texts = snapshots.changed_days(spark, events, max(done, default=0))
    changed = {as_date(text) for text in texts if text is not None}
    if not changed and version in (0, *done):
        return set()
    around = [dt.timedelta(days=n) for n in ((0,) if report_tz == "UTC" else (-1, 0, 1))]
    days = {day + step for day in changed for step in around}
    if days:
        rows = read_events(spark, events, version=version,
                           days={day + step for day in days for step in around})
        local = F.to_date(syslog.local_time(F.col("event_time"), report_tz))
        rows = rows.filter(local.isin(*days))
        write_metrics(daily_metrics(rows, report_tz=report_tz, **options), metrics)
        if state:
            write_day_states(day_state(rows, report_tz), state)
    files.write_once(spark, f"{metrics}/{THROUGH}/{version}", "")
    return days


def mail_rows(spark: SparkSession, metrics: str, day=None) -> DataFrame:
    """Rows of the mail for one day (default yesterday, UTC); all ``N/A`` if it has no metrics."""
    day = as_date(day or yesterday_utc())
    asked = spark.range(1).select(F.lit(day).alias("metric_date"))
    found = metric_lookup(read_metrics(spark, metrics), day)
    return email_report_rows(asked.join(found, "metric_date", "left"))


def write_report(spark: SparkSession, events: str, out: str, day, day_to=None,
                 report_tz: str = "UTC", live: str | None = None) -> None:
    """Write every table of the report below ``out``.

    With ``live`` the days are first settled from the stream's folder.
    """
    if live:
        settle_days(spark, live, events, *stored_days(day, day_to, report_tz))
    rows = read_report_days(spark, events, day, day_to, report_tz)
    cube = report_cube(rows, "log_level", "source_file", report_tz).persist()
    try:
        report = report_tables(cube, rows)
        report.pop("cube")
        for name, table in report.items():
            table.write.mode("overwrite").parquet(f"{out}/{name}")
    finally:
        cube.unpersist()

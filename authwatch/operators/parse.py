"""Raw line -> log event: provenance, time, fingerprint.

All of it is one narrow projection over the text scan: no shuffle, no UDF.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authwatch.functions import syslog
from authwatch.schema import LOG_EVENT


def add_provenance(df: DataFrame, host_name: str, log_type: str = "ssh") -> DataFrame:
    return df.withColumns({"host_name": F.lit(host_name), "log_type": F.lit(log_type)})


def source_file_name(df: DataFrame) -> DataFrame:
    return df.withColumn("source_file", syslog.file_stem(F.col("source_path")))


def parse_syslog_time(df: DataFrame) -> DataFrame:
    """Add ``log_time``; a line without one is kept with NULL."""
    return df.withColumn("log_time", syslog.syslog_time(F.col("message")))


def parse_syslog_header(df: DataFrame) -> DataFrame:
    """Add logdate, host, process, pid and msg from the syslog header."""
    names = ("logdate", "host", "process", "pid", "msg")
    parts = df.select("*", F.explode(F.array(syslog.header_parts(F.col("message")))).alias("_h"))
    return parts.withColumns({
        name: syslog.blank_to_null(F.get("_h", F.lit(place)))
        for place, name in enumerate(names)}).drop("_h")


def year_from_file(df: DataFrame) -> DataFrame:
    return df.withColumn("log_year", syslog.year_of(F.col("source_file")))


def event_time(df: DataFrame, year_col: str = "log_year", log_tz: str = "UTC") -> DataFrame:
    """Add ``event_time`` from the year and ``log_time`` columns.

    The value comes out of a one-element generator, which filters on the time
    cannot be pushed through. Otherwise each bound of a day filter would copy
    the whole parse of the line into the filter.
    """
    instant = syslog.instant(F.col(year_col), F.col("log_time"), log_tz)
    return df.drop("event_time").select("*", F.explode(F.array(instant)).alias("event_time"))


def kst_text(df: DataFrame) -> DataFrame:
    """Render ``event_time`` as +09:00 ISO text in ``event_time_kst_iso``."""
    return df.withColumn("event_time_kst_iso", syslog.kst_iso(F.col("event_time")))


def row_hash(df: DataFrame, fields=("source_path", "event_time", "message")) -> DataFrame:
    """SHA-256 over the named fields. Same line, file and time: same hash."""
    return df.withColumn(
        "row_hash", syslog.fingerprint(*[F.col(name).cast("string") for name in fields]))


def ensure_key(df: DataFrame) -> DataFrame:
    """Give rows without a ``row_hash`` the one of their path, time and message."""
    fields = [F.col(name).cast("string") for name in ("source_path", "event_time", "message")]
    return df.withColumn("row_hash", F.coalesce("row_hash", syslog.fingerprint(*fields)))


def parse_lines(df: DataFrame, host_name: str, log_type: str = "ssh",
                log_tz: str = "UTC") -> DataFrame:
    """``(source_path, message[, ingest_time])`` -> the log_event schema."""
    if "ingest_time" not in df.columns:
        df = df.withColumn("ingest_time", F.current_timestamp())
    df = source_file_name(add_provenance(df, host_name, log_type))
    df = event_time(year_from_file(parse_syslog_time(df)), log_tz=log_tz)
    return row_hash(df).select(*LOG_EVENT.names)

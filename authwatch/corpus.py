"""Authentication log lines derived from the ``events`` table.

One projection turns every event into one syslog line, so the corpus has as
many rows as the table and keeps its partitioning. ``BODY`` is valid in Spark
and in DuckDB once ``{S}`` is replaced by the name of the text type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from authwatch.operators.enrich import enrich
from authwatch.operators.parse import parse_lines

HOST = "LabSZ"
YEAR = 2024

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])

BODY = """
CASE event_type
 WHEN 'error' THEN CASE
   WHEN event_id % 7 = 0 THEN 'reverse mapping checking getaddrinfo for h' || CAST(user_id AS {S})
        || '.example.com [10.0.0.' || CAST(user_id % 8 AS {S}) || '] failed - POSSIBLE BREAK-IN ATTEMPT!'
   WHEN event_id % 3 = 0 THEN 'Failed password for invalid user u' || CAST(user_id AS {S})
        || ' from 10.0.0.' || CAST(user_id % 8 AS {S}) || ' port '
        || CAST(1024 + event_id % 60000 AS {S}) || ' ssh2'
   ELSE 'Failed password for root from 10.0.0.' || CAST(user_id % 8 AS {S}) || ' port '
        || CAST(1024 + event_id % 60000 AS {S}) || ' ssh2' END
 WHEN 'signup' THEN CASE
   WHEN event_id % 11 = 0 THEN 'Invalid user  from 10.0.0.' || CAST(user_id % 8 AS {S})
   WHEN event_id % 13 = 0 THEN 'input_userauth_request: invalid user u' || CAST(user_id AS {S}) || ' [preauth]'
   ELSE 'Invalid user u' || CAST(user_id AS {S}) || ' from 10.0.0.' || CAST(user_id % 8 AS {S}) END
 WHEN 'purchase' THEN 'Accepted password for u' || CAST(user_id AS {S}) || ' from 10.0.0.'
        || CAST(user_id % 8 AS {S}) || ' port '
        || CASE WHEN event_id % 17 = 0 THEN '99999999999' ELSE CAST(1024 + event_id % 60000 AS {S}) END
        || ' ssh2'
 WHEN 'click' THEN CASE
   WHEN event_id % 5 = 0 THEN 'Received disconnect from 10.0.0.' || CAST(user_id % 8 AS {S})
        || ': 11: Bye Bye [preauth]'
   ELSE 'Connection closed by 10.0.0.' || CAST(user_id % 8 AS {S}) || ' [preauth]' END
 ELSE 'pam_unix(sshd:session): session ' || CASE WHEN event_id % 2 = 0 THEN 'opened' ELSE 'closed' END
        || ' for user u' || CAST(user_id AS {S}) END
"""

LINE = """concat(date_format(ts, 'MMM'), ' ', lpad(cast(day(ts) as string), 2, ' '), ' ',
 date_format(ts, 'HH:mm:ss'), ' LabSZ sshd[', cast(20000 + user_id as string), ']: ', {body})"""


def render(events: DataFrame) -> DataFrame:
    """Events (batch or stream) -> ``event_id, ts, source_path, message``."""
    return events.select(
        "event_id", "ts",
        F.concat(F.lit("/data/ssh-"), F.date_format("ts", "yyyyMMdd"), F.lit(".log"))
         .alias("source_path"),
        F.expr(LINE.format(body=BODY.format(S="STRING"))).alias("message"))


#: Lines that a log file may also hold: no header, an impossible date, a cut line.
#: ``{S}`` is not needed; the text is the same in both engines.
BROKEN = """CASE event_id % 50 WHEN 0 THEN 'no header here' WHEN 1 THEN 'Feb 30' || substr(message, 7)
 WHEN 2 THEN substr(message, 1, 6) ELSE message END"""


def with_broken_lines(lines: DataFrame) -> DataFrame:
    return lines.withColumn("message", F.expr(BROKEN))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet"))


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream. As a glob the path may name a file or a folder."""
    return spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/{{events}}.parquet")


def stream_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(stream_events(spark, sf_dir))


def log_events(lines: DataFrame) -> DataFrame:
    """Parse rendered lines; the ingest time is a fixed lag, not the clock."""
    lag = F.col("ts").cast("timestamp") + F.expr("interval 5 seconds")
    return parse_lines(lines.withColumn("ingest_time", lag), HOST)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(log_events(raw_lines(spark, sf_dir)))

"""The live path: bus -> enriched events table, and bus -> brute-force alerts."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from authwatch.functions import classify
from authwatch.operators.enrich import decode_event_json, enrich, reject_counts
from authwatch.operators.metrics import brute_force_windowed
from authwatch.schema import BUS_FAILURE
from authwatch.sources import files as stored_files
from authwatch.streaming.sinks import alert_sink, event_sink

EVENTS, ALERTS, CHECKPOINTS = "events", "alerts", "checkpoints"


def events_path(root: str) -> str:
    """Folder of the live events below the stream's root."""
    return f"{root}/{EVENTS}/kind=event"


def malformed_path(root: str) -> str:
    return f"{root}/{EVENTS}/kind=malformed"


def alerts_path(root: str) -> str:
    return f"{root}/{ALERTS}"


def stream_enrich(bus: DataFrame) -> DataFrame:
    """Messages -> enriched events; the same functions as in batch."""
    return enrich(decode_event_json(bus))


def stream_failures(bus: DataFrame) -> DataFrame:
    """What the alerts need, of every readable message: time, type and valid address."""
    message = F.col("message")
    return (decode_event_json(bus, BUS_FAILURE).withColumn("_lower", F.lower(message))
            .select("event_time", classify.error_type(F.col("_lower")).alias("error_type"),
                    classify.valid_ipv4(classify.ip(message)).alias("ip")))


def deduplicated(events: DataFrame, within: str) -> DataFrame:
    """Drop redelivered keys that arrive within ``within`` of each other."""
    return (events.withWatermark("event_time", within)
            .dropDuplicatesWithinWatermark(["row_hash"]))


@contextmanager
def state_partitions(spark: SparkSession, number: int):
    """Start stateful queries inside this block with ``number`` state partitions.

    A query takes the setting over when it starts, and its checkpoint keeps it.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, number)
    try:
        yield
    finally:
        spark.conf.set(key, before)


FILE_MANAGER = "spark.sql.streaming.checkpointFileManagerClass"
BY_FILE_SYSTEM = ("org.apache.spark.sql.execution.streaming.checkpointing."
                  "FileSystemBasedCheckpointFileManager")


@contextmanager
def _plain_renames(spark: SparkSession, root: str):
    """Start queries inside this block whose checkpoint is on a local disk without processes
    of their own for each file of it.

    The usual manager starts about ten to write a small file there. Both check that the
    target does not exist and then rename, which is one step of the disk. In any other
    store, or if a manager was chosen, nothing changes.
    """
    if not stored_files.is_local(spark, root) or spark.conf.get(FILE_MANAGER, None):
        yield
        return
    spark.conf.set(FILE_MANAGER, BY_FILE_SYSTEM)
    try:
        yield
    finally:
        spark.conf.unset(FILE_MANAGER)


def _start(df: DataFrame, name: str, root: str, mode: str, sink, trigger: str | None):
    with _plain_renames(df.sparkSession, root):
        return _started(df, name, root, mode, sink, trigger)


def _started(df: DataFrame, name: str, root: str, mode: str, sink, trigger: str | None):
    writer = (df.writeStream.queryName(name).outputMode(mode).foreachBatch(sink)
              .option("checkpointLocation", f"{root}/{CHECKPOINTS}/{name}"))
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def start_events(bus: DataFrame, root: str, trigger: str | None = "5 seconds",
                 files: int | None = None, part: str | None = None) -> StreamingQuery:
    """Append every message to the live events table.

    The progress of the query counts what it rejects, under ``rejects``. ``part``
    names a query that reads a part of the bus, beside others on the same root.
    """
    rows = enrich(decode_event_json(bus, keep_malformed=True, corrupt_col="_corrupt"),
                  keep=("_corrupt",))
    rows = (rows.observe("rejects", *reject_counts(rows),
                         F.count_if(F.col("_corrupt").isNotNull()).alias("malformed"))
            .withColumn("ip", classify.valid_ipv4(F.col("ip"))))
    name = EVENTS if part is None else f"{EVENTS}-{part}"
    return _start(rows, name, root, "append", event_sink(f"{root}/{EVENTS}", files), trigger)


def start_alerts(bus: DataFrame, root: str, trigger: str | None = "5 seconds",
                 window: str = "1 minute", threshold: int = 60, watermark: str = "1 minute",
                 mode: str = "update", deliver=None) -> StreamingQuery:
    """Count failed logins per window and address, and store those over the threshold.

    ``update`` reports a window each time its count grows; ``append`` reports
    it once, after the watermark has closed it.
    """
    alerts = brute_force_windowed(stream_failures(bus), window, threshold, watermark)
    return _start(alerts, ALERTS, root, mode, alert_sink(alerts_path(root), deliver), trigger)


def run_stream(bus: DataFrame, root: str, trigger: str | None = "5 seconds",
               files: int | None = None, **alert_options) -> list[StreamingQuery]:
    """Start both queries on one bus. ``trigger=None`` drains the bus and stops."""
    return [start_events(bus, root, trigger, files),
            start_alerts(bus, root, trigger, **alert_options)]


def await_all(queries: list[StreamingQuery]) -> None:
    """Wait for queries that drain their input; the first failure is raised."""
    for query in queries:
        query.awaitTermination()


def await_any(spark: SparkSession) -> None:
    """Wait for endless queries; ends as soon as any of them stops or fails."""
    spark.streams.awaitAnyTermination()

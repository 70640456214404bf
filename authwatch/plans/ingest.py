"""Raw log files -> messages, as one projection without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from authwatch.operators.parse import parse_lines
from authwatch.sources.bus import TOPIC, to_bus
from authwatch.sources.logs import read_logs, stream_logs


def file_messages(spark: SparkSession, glob: str, host_name: str, log_type: str = "ssh",
                  log_tz: str = "UTC") -> DataFrame:
    return to_bus(parse_lines(read_logs(spark, glob), host_name, log_type, log_tz))


def file_message_stream(spark: SparkSession, path: str, host_name: str, log_type: str = "ssh",
                        log_tz: str = "UTC", **source_options) -> DataFrame:
    lines = stream_logs(spark, path, **source_options)
    return to_bus(parse_lines(lines, host_name, log_type, log_tz))


def start_ingest(messages: DataFrame, checkpoint: str, servers: str | None = None,
                 topic: str = TOPIC, out: str | None = None,
                 trigger: str | None = None) -> StreamingQuery:
    """Publish a message stream, or store it as files in ``out``.

    ``trigger=None`` takes what is there and stops.
    """
    writer = messages.writeStream.option("checkpointLocation", checkpoint)
    if servers:
        writer = (writer.format("kafka").option("kafka.bootstrap.servers", servers)
                  .option("kafka.acks", "all").option("topic", topic))
    else:
        writer = writer.format("parquet").option("path", out)
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()

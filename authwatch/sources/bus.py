"""The event bus: JSON messages keyed by ``row_hash``.

Kafka needs its connector package on the class path. The same pipeline runs
on a replay of message files, which deliver the same columns.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from authwatch.functions import syslog
from authwatch.sources import files

ROWS_PER_FILE = "_rows_per_file"
#: Folders of a stored bus that is dealt to several readers.
PARTITION = "partition"
#: How files of messages are written: in small row groups, so that a micro-batch of
#: one large file is read and decoded by many tasks.
ROW_GROUP = "parquet.block.size"
ROW_GROUP_BYTES = 4 << 20
TOPIC = "ssh-log"
MESSAGE_SCHEMA = T.StructType([T.StructField("key", T.StringType()),
                               T.StructField("value", T.StringType())])
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def bus_options(servers: str, topic: str = TOPIC, starting: str = "earliest",
                max_per_trigger: int | None = None, fail_on_data_loss: bool = False,
                **extra) -> dict:
    """Reader options: from the earliest offset, tolerant of lost data."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return {**options, **extra}


def read_bus(spark: SparkSession, options: dict) -> DataFrame:
    return (spark.readStream.format("kafka").options(**options).load()
            .select(F.col("key").cast("string"), F.col("value").cast("string"), "timestamp"))


def replay_bus(spark: SparkSession, path: str, max_files: int | None = None,
               max_rows: int | None = None, partition: str | None = None) -> DataFrame:
    """Stored messages as a stream with the columns of :func:`read_bus`.

    ``max_files`` bounds the files of a micro-batch, ``max_rows`` its messages: as
    many files as hold that many by the bound that :func:`store_messages` kept.
    ``partition`` is one of :func:`stored_partitions`; without it all are read.
    """
    if max_rows:
        bounds = [int(name) for name in files.names(spark, f"{path}/{ROWS_PER_FILE}")]
        if not bounds or max(bounds) > max_rows:
            raise ValueError(f"{path} holds files of up to {max(bounds, default='any number of')} "
                             f"messages: store it with rows_per_file of at most {max_rows}")
        max_files = min(max_files or max_rows, max_rows // max(bounds))
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path if partition is None else f"{path}/{partition}").select(
        "key", "value", F.col("_metadata.file_modification_time").alias("timestamp"))


def to_bus(df: DataFrame) -> DataFrame:
    """log_event or enriched rows -> ``key, value`` messages."""
    fields = [F.col(c).alias("@timestamp" if c == "ingest_time" else c) for c in df.columns]
    if "event_time_kst_iso" not in df.columns:
        fields.append(syslog.kst_iso(F.col("event_time")).alias("event_time_kst_iso"))
    message = F.to_json(F.struct(*fields), {"timestampFormat": JSON_TIME})
    return df.select(F.col("row_hash").alias("key"), message.alias("value"))


def write_bus(messages: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Publish a batch; every replica has to acknowledge."""
    (messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("kafka.acks", "all").option("topic", topic).save())


@contextmanager
def small_row_groups(spark: SparkSession):
    """Start streams that store messages inside this block; a file sink takes no option for it."""
    before = spark.conf.get(ROW_GROUP, None)
    spark.conf.set(ROW_GROUP, ROW_GROUP_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(ROW_GROUP) if before is None else spark.conf.set(ROW_GROUP, before)


def stored_partitions(spark: SparkSession, path: str) -> list[str]:
    """Names of the partitions that hold messages, each to be read by a query of its own."""
    return [name for name in files.names(spark, path) if name.startswith(f"{PARTITION}=")]


def store_messages(messages: DataFrame, path: str, rows_per_file: int | None = None,
                   partitions: int | None = None) -> None:
    """Keep messages as files for :func:`replay_bus`.

    ``rows_per_file`` bounds the messages of a file and notes the bound in the
    folder, so that a replay can bound its micro-batches by messages. Use it for
    all that is stored in a folder, or for nothing. ``partitions`` deals the files
    out, as a topic does with messages: each run of ``rows_per_file`` goes to the next.
    """
    if partitions and not rows_per_file:
        raise ValueError("partitions are dealt by files: give rows_per_file")
    if partitions:
        run = F.floor(F.monotonically_increasing_id() / rows_per_file)
        messages = messages.withColumn(PARTITION, F.pmod(run, F.lit(partitions)))
    writer = messages.write.mode("append").option(ROW_GROUP, ROW_GROUP_BYTES)
    if rows_per_file:
        files.write_once(messages.sparkSession, f"{path}/{ROWS_PER_FILE}/{rows_per_file}", "")
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partitions:
        writer = writer.partitionBy(PARTITION)
    writer.parquet(path)

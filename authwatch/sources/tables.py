"""Parquet tables: events keyed by ``row_hash``, metrics keyed by day, alerts.

Streams only append. Each micro-batch owns the partitions named after it and
writes them with dynamic partition overwrite, so a repeated batch replaces
itself. :func:`compact_live` joins small files meanwhile. Redelivered keys are
resolved when reading the live events, or once per closed day by
:func:`settle_days`, after which the day is read without any shuffle and its live
batches are retired.

The events table is versioned (``snapshots``). A merge rewrites only the stored
files that hold one of its keys, and small ones; its work is cut by bytes.
"""

from __future__ import annotations

import datetime as dt
import math
import uuid
from collections import Counter

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from authwatch.operators.enrich import enforce_schema, reject_counts
from authwatch.operators.filters import as_date
from authwatch.operators.parse import ensure_key
from authwatch.schema import ALERT, DAILY_METRICS, ENRICHED
from authwatch.sources import files, snapshots
from authwatch.sources.files import DataFile

EVENT_DAY = T.StructField("event_date", T.DateType())
BATCH = T.StructField("batch", T.StringType())
STORED_EVENT = T.StructType([*ENRICHED.fields, EVENT_DAY])
LIVE_EVENT = T.StructType([*ENRICHED.fields, EVENT_DAY, BATCH])
#: Bytes of a stored file that merges aim at.
TARGET_BYTES = 256 << 20
STORED_ALERT = T.StructType([*ALERT.fields, T.StructField("alert_date", T.DateType()), BATCH])


def _overwrite_partitions(df: DataFrame, path: str, *by: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table; a path that does not exist is an error, not an empty table."""
    return spark.read.schema(schema).parquet(path)


def _days(df: DataFrame, day_from, day_to, col: str = "event_date") -> DataFrame:
    if day_from is not None:
        df = df.filter(F.col(col) >= F.lit(as_date(day_from)))
    if day_to is not None:
        df = df.filter(F.col(col) <= F.lit(as_date(day_to)))
    return df


def with_event_date(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", F.to_date("event_time"))


def latest_by_key(df: DataFrame, key: str, *newest_first: Column) -> DataFrame:
    """The newest row per key.

    The filter on the row number lets Spark keep one row per key in each task
    before the shuffle, so a key with very many copies stays harmless.
    """
    window = Window.partitionBy(key).orderBy(*newest_first)
    return (df.withColumn("_n", F.row_number().over(window))
            .filter(F.col("_n") == 1).drop("_n"))


def upsert(existing: DataFrame, incoming: DataFrame, key: str = "row_hash",
           order_col: str = "ingest_time", delivery_col: str | None = None) -> DataFrame:
    """Both inputs with one row per key: the newest, incoming on a tie.

    ``delivery_col`` of ``incoming`` orders deliveries with equal ``order_col``.
    Events without a ``row_hash`` get the one of their path, time and message.
    """
    both = _deliveries(existing, incoming, delivery_col, key == "row_hash")
    return latest_by_key(both, key, F.desc(order_col), F.desc("_delivery")).drop("_delivery")


def _deliveries(existing: DataFrame, incoming: DataFrame, delivery_col: str | None,
                keyed: bool) -> DataFrame:
    late = incoming.withColumn(
        "_delivery", F.col(delivery_col) if delivery_col else F.lit("incoming"))
    if delivery_col:
        late = late.drop(delivery_col)
    both = existing.withColumn("_delivery", F.lit("")).unionByName(late)
    return ensure_key(both) if keyed else both


def append_batch(df: DataFrame, path: str, batch: str, *by: str,
                 files: int | None = None) -> None:
    """Write one micro-batch under its own name; repeating it changes nothing.

    Every task writes its own file per partition. ``files`` first spreads the
    rows evenly over that many tasks, so that thousands of source or state
    tasks do not each leave a tiny file behind.
    """
    if files:
        df = df.repartition(files)
    _overwrite_partitions(df.withColumn("batch", F.lit(batch)), path, *by, "batch")


def read_live_events(spark: SparkSession, path: str, day_from=None, day_to=None) -> DataFrame:
    """Events as appended by the stream, one row per key."""
    live = _days(_read(spark, path, LIVE_EVENT), day_from, day_to)
    return latest_by_key(live, "row_hash", F.desc("ingest_time"), F.desc("batch")).drop("batch")


def _date(day: str | None) -> dt.date | None:
    return None if day is None else dt.date.fromisoformat(day)


def _day_sizes(found: list[DataFile]) -> Counter:
    """Bytes of files by day."""
    sizes: Counter = Counter()
    for file in found:
        sizes[_date(file.part("event_date"))] += file.size
    return sizes


def _cut_by_bytes(df: DataFrame, sizes: Counter, target_bytes: int) -> DataFrame:
    """``df`` dealt by day and ``_bucket`` of the key: a bucket per ``target_bytes`` of a day.

    With more buckets than the session has shuffle partitions, there are as many
    partitions as buckets.
    """
    cuts = {day: max(1, math.ceil(size / target_bytes)) for day, size in sizes.items()}
    wanted = F.lit(max([1, *cuts.values()]))  # also for a day without a size
    for day, cut in cuts.items():
        if day is not None:
            wanted = F.when(F.col("event_date") == F.lit(day), F.lit(cut)).otherwise(wanted)
        else:
            wanted = F.when(F.col("event_date").isNull(), F.lit(cut)).otherwise(wanted)
    rows = df.withColumn("_bucket", F.pmod(F.xxhash64("row_hash"), wanted))
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ("event_date", "_bucket")
    total = sum(cuts.values())
    return rows.repartition(total, *by) if total > usual else rows.repartition(*by)


def _newest_dealt(df: DataFrame, *order: Column) -> DataFrame:
    """The newest row per key of rows dealt by day and bucket; no further shuffle."""
    window = Window.partitionBy("event_date", "_bucket", "row_hash").orderBy(*order)
    return df.withColumn("_n", F.row_number().over(window)).filter("_n = 1")


def _files_with_keys(spark: SparkSession, table: str, stored: list[DataFile],
                     keys: DataFrame) -> list[DataFile]:
    """The stored files that hold any of the keys.

    Only the key column is read. Spark filters it with a Bloom filter of the
    incoming keys before the join where the stored side is large.
    """
    def tail(path):  # commit folder, day folder, name
        return F.element_at(F.split(path, f"/{snapshots.FOLDER}="), -1)

    column = _read_files(spark, table, stored).select(
        "row_hash", tail(F.col("_metadata.file_path")).alias("file"))
    hits = column.join(keys, "row_hash", "left_semi").select("file").distinct()
    named = {row["file"] for row in hits.collect()}
    return [f for f in stored if f.path.rpartition(f"/{snapshots.FOLDER}=")[2] in named]


def _read_files(spark: SparkSession, table: str, found: list[DataFile]) -> DataFrame:
    return (spark.read.schema(STORED_EVENT).option("basePath", table)
            .parquet(*[f.path for f in found]))


def _write_days(df: DataFrame, folder: str) -> None:
    df.select(*STORED_EVENT.names).write.partitionBy("event_date").parquet(folder)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, counted once each; 0 if it reads none."""
    names = df.inputFiles()
    if not names:
        return 0
    sizes = df.sparkSession.read.format("binaryFile").option(
        "recursiveFileLookup", "true").load(names).select("path", "length").distinct()
    return sizes.agg(F.sum("length")).first()[0] or 0


class TooManyRejects(RuntimeError):
    """More values than allowed did not fit the table; nothing was stored."""


def upsert_days(spark: SparkSession, path: str, incoming: DataFrame, days=None,
                delivery_col: str | None = None, sizes: Counter | None = None,
                target_bytes: int = TARGET_BYTES,
                reject_limit: float | None = None) -> snapshots.Snapshot:
    """Merge ``incoming`` into the stored days it touches, as a new version of the table.

    Rows are typed, so an address that is none becomes NULL. Stored files
    without any incoming key stay as they are, but for those below a quarter of
    ``target_bytes``, which the merge joins. One shuffle, by day and bucket of the
    key, brings the deliveries of a key together; it holds because a key has one
    day. The number of buckets follows ``sizes`` (bytes by day) and the rewritten
    files. ``days`` names the touched days; else they are counted in ``incoming``
    first, and the bytes of the files that it reads are shared out by the counts.
    Days and names of files are all that reaches the driver.

    What the types reject is counted while the rows are written, and noted in the
    version. Above ``reject_limit`` values a row, the merge fails and stores nothing.
    """
    extra = [delivery_col] if delivery_col else []
    schema = T.StructType([*ENRICHED.fields, *(incoming.schema[c] for c in extra)])

    def typed(df: DataFrame) -> DataFrame:
        return ensure_key(with_event_date(enforce_schema(df, schema))
                          .select(*STORED_EVENT.names, *extra))

    rows, rejects = typed(incoming), Observation()
    if days is None:
        counts = dict(rows.groupBy("event_date").agg(F.count("*")).collect())
    else:
        counts = {None if day is None else as_date(day): 1 for day in days}
    days = set(counts)
    if sizes is None:
        read, total = input_bytes(incoming), sum(counts.values())
        sizes = Counter({day: read * n // total for day, n in counts.items()})
    base = snapshots.newest(spark, path)
    stored = base.of_days({snapshots.as_text(day) for day in days})
    hit = [f for f in stored if f.size < target_bytes // 4]
    others = [f for f in stored if f.size >= target_bytes // 4]
    if others:
        hit += _files_with_keys(spark, path, others, rows.select("row_hash"))
    old = (_read_files(spark, path, hit) if hit else spark.createDataFrame([], STORED_EVENT))
    counted = typed(incoming.observe(rejects, *reject_counts(incoming)))
    both = _deliveries(old.select(*STORED_EVENT.names), counted, delivery_col, False)
    merged = _newest_dealt(_cut_by_bytes(both, sizes + _day_sizes(hit), target_bytes),
                           F.desc("ingest_time"), F.desc("_delivery"))
    folder = f"{snapshots.FOLDER}={uuid.uuid4().hex}"
    try:
        _write_days(merged, f"{path}/{folder}")
    except BaseException:
        files.remove(spark, [f"{path}/{folder}"])
        raise
    found = {name: int(n) for name, n in rejects.get.items()}
    if reject_limit is not None and sum(found.values()) - found["total_rows"] > (
            reject_limit * found["total_rows"]):
        files.remove(spark, [f"{path}/{folder}"])
        raise TooManyRejects(f"rejected values above {reject_limit} a row: {found}")
    return snapshots.commit(spark, base, folder, hit, days, found)


def settle_days(spark: SparkSession, live: str, path: str, day_from=None, day_to=None,
                retire: bool = False, late: bool = True, target_bytes: int = TARGET_BYTES,
                reject_limit: float | None = None) -> snapshots.Snapshot | None:
    """Move closed days from the live folder into the events table.

    Without bounds everything is moved. With bounds also what came late: events of
    days before them (not with ``late=False``), and events without a time. Days and
    their bytes come from the listing of the folder. ``retire`` removes the merged
    batches afterwards, so that the folder stays small; what arrives meanwhile is a
    batch of its own and stays. The new version tells which days have changed;
    without anything to move there is none.
    """
    first = None if day_from is None or late else as_date(day_from)
    last = None if day_from is None and day_to is None else as_date(day_to or day_from)

    def wanted(file: DataFile) -> bool:
        day = _date(file.part("event_date"))
        return day is None or (first is None or day >= first) and (last is None or day <= last)

    # Listed before it is read: a batch that arrives in between is merged, but stays.
    found = [f for f in files.list_files(spark, live) if wanted(f)]
    if not found:
        return None
    sizes = _day_sizes(found)
    folder = _read(spark, live, LIVE_EVENT)
    rows = folder.filter(_any_day(sizes))
    made = upsert_days(spark, path, rows, set(sizes), "batch", sizes, target_bytes, reject_limit)
    if retire:
        files.remove(spark, sorted({f.path.rpartition("/")[0] for f in found}))
    return made


def _any_day(days) -> Column:
    known = [F.lit(day) for day in days if day is not None]
    touched = F.col("event_date").isin(*known) if known else F.lit(False)
    return touched | F.col("event_date").isNull() if None in days else touched


def compact_live(spark: SparkSession, live: str, day_from=None, day_to=None,
                 target_bytes: int = TARGET_BYTES, least_files: int = 2) -> int:
    """Join the small files of the live folder, a day's into files of ``target_bytes``.

    Returns how many files went. Whole batches are replaced by one that is named
    after the last of them, so that it stays older than the batches to come; keys
    delivered several times in them keep the newest row. Batches of a full file, and
    days of fewer than ``least_files`` small ones, stay. A day's batches are removed
    when the new one is there: until then rows are there twice under one key, which
    readers resolve, and a job that was cut off is made good by the next. Run it
    beside the stream, but not beside :func:`settle_days`.
    """
    batches: dict[tuple, list[DataFile]] = {}
    for file in files.list_files(spark, live):
        batches.setdefault((_date(file.part("event_date")), file.part("batch")), []).append(file)
    small: dict = {}
    for (day, batch), own in batches.items():
        inside = ((day_from is None or day is None or day >= as_date(day_from))
                  and (day_to is None or day is None or day <= as_date(day_to)))
        if inside and sum(f.size for f in own) < target_bytes:
            small.setdefault(day, {})[batch] = own
    small = {day: own for day, own in small.items()
             if len(own) > 1 and sum(map(len, own.values())) >= least_files}
    if not small:
        return 0
    found = [f for own in small.values() for part in own.values() for f in part]
    rows = (spark.read.schema(LIVE_EVENT).option("basePath", live)
            .parquet(*sorted({f.path.rpartition("/")[0] for f in found})))
    newest = _newest_dealt(_cut_by_bytes(rows, _day_sizes(found), target_bytes),
                           F.desc("ingest_time"), F.desc("batch"))
    names = {day: max(own) + "+" for day, own in small.items()}
    batch = F.lit(None).cast("string")
    for day, name in names.items():
        is_day = F.col("event_date").isNull() if day is None else F.col("event_date") == F.lit(day)
        batch = F.when(is_day, F.lit(name)).otherwise(batch)
    _overwrite_partitions(newest.withColumn("batch", batch).select(*LIVE_EVENT.names), live,
                          "event_date", "batch")
    files.remove(spark, sorted({f.path.rpartition("/")[0] for f in found}))
    return len(found)


def read_events(spark: SparkSession, path: str, day_from=None, day_to=None,
                version: int | None = None, days=None) -> DataFrame:
    """Stored events of the newest version, or of an older one that is still kept.

    The bounds, or a set of ``days``, choose files and prune partitions. What is
    returned stays the version it was opened at. A path without a table is an error.
    """
    if version is None:
        snapshot = snapshots.newest(spark, path)
        if not snapshot.version:
            return _read(spark, path, STORED_EVENT)  # which says that it does not exist
    else:
        snapshot = snapshots.at_version(spark, path, version)
    low, high = (None if day is None else as_date(day) for day in (day_from, day_to))
    bounded = low is not None or high is not None
    asked = {day for day in snapshot.stored_days() if not bounded or day is not None
             and (low is None or _date(day) >= low) and (high is None or _date(day) <= high)}
    if days is not None:
        asked &= {snapshots.as_text(as_date(day)) for day in days}
    found = snapshot.of_days(asked)
    rows = (_read_files(spark, path, found).select(*STORED_EVENT.names) if found
            else spark.createDataFrame([], STORED_EVENT))
    return _days(rows, day_from, day_to)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Store one row per day; a rerun replaces the day."""
    stamped = metrics.withColumn("created_at", F.current_timestamp())
    _overwrite_partitions(stamped.select(*DAILY_METRICS.names), path, "metric_date")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DAILY_METRICS).parquet(path).select(*DAILY_METRICS.names)


def write_day_states(states: DataFrame, path: str) -> None:
    """Store one state per day (``operators.ranges``); a rerun replaces the day."""
    _overwrite_partitions(states, path, "metric_date")


def read_day_states(spark: SparkSession, path: str, day_from=None, day_to=None) -> DataFrame:
    return _days(spark.read.parquet(path), day_from, day_to, "metric_date")


def read_alerts(spark: SparkSession, path: str, day_from=None, day_to=None) -> DataFrame:
    """One row per window and address, with the last count that was reported.

    Counts of a window only grow, so the last is the largest.
    """
    alerts = _days(_read(spark, path, STORED_ALERT), day_from, day_to, "alert_date")
    return (alerts.groupBy("window_start", "window_end", "ip")
            .agg(F.max("fail_cnt").alias("fail_cnt"), F.max("detected_at").alias("detected_at")))

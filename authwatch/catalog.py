"""The named queries over the log corpus of ``corpus.py``, one per operator.

Times are returned as ``timestamp_ntz`` so that they compare with engines that
have no session zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authwatch import corpus
from authwatch.operators import enrich as en
from authwatch.operators import filters as fl
from authwatch.operators import metrics as mt
from authwatch.operators import parse as ps
from authwatch.operators import ranges as rg
from authwatch.operators import report as rp
from authwatch.operators import split as sp
from authwatch.plans import daily, ingest
from authwatch.schema import ENRICHED
from authwatch.session import shared_dir
from authwatch.sources import bus, logs, tables
from authwatch.streaming import live

QUERIES = {}

# The one day that single-day operators are shown on, and a two-week range.
DAY = "2024-01-15"
DAY_FROM, DAY_TO = "2024-01-08", "2024-01-21"
# A day without events.
ABSENT_DAY = "2024-03-01"

# Brute-force parameters that find something on the sparse corpus.
BF_WINDOW, BF_THRESHOLD = "1 hour", 3
# A replay hands files over in any order, so its watermark spans the corpus.
REPLAY_WATERMARK = "31 days"


def query(function):
    QUERIES[function.__name__.removeprefix("q_")] = function
    return function


def ntz(df: DataFrame) -> DataFrame:
    times = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def lines(spark, sf_dir):
    return corpus.raw_lines(spark, sf_dir)


def events(spark, sf_dir):
    return corpus.enriched(spark, sf_dir)


def log_files(spark, sf_dir) -> str:
    """The corpus as one log file per day; returns the folder."""
    out = shared_dir(spark, "ssh-files")
    sp.split_by_date(lines(spark, sf_dir), corpus.YEAR, out, order=("event_id",))
    return out


# --- sources and sinks -----------------------------------------------------

@query
def q_read_log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = log_files(spark, sf_dir)
    read = logs.read_logs(spark, f"{folder}/file_name=ssh-*.log")
    return ps.source_file_name(read).select(
        F.expr(f"substr(source_path, {len(folder) + 2})").alias("source_path"),
        "source_file", "message")


# Bytes of a split at least, and splits of a folder at most (about), beside one per file.
SPLIT_BYTES, MOST_SPLITS = 16 << 10, 1000


@query
def q_line_numbers(spark, sf_dir):
    """Every line with its number in the day's file, which is read in many splits."""
    folder, out = log_files(spark, sf_dir), shared_dir(spark, "numbered")
    days = f"{folder}/file_name=ssh-*.log"
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    total = tables.input_bytes(spark.read.text(days))
    spark.conf.set(key, max(SPLIT_BYTES, total // MOST_SPLITS))
    try:
        logs.read_numbered_logs(spark, days).write.parquet(out)
    finally:
        spark.conf.set(key, before)
    return ps.source_file_name(spark.read.parquet(out)).select(
        "source_file", "line_number", "message")


@query
def q_stream_log_files(spark, sf_dir):
    """The stream runs twice on one checkpoint; the second run adds nothing."""
    files, out, done = (log_files(spark, sf_dir), shared_dir(spark, "sink"),
                        shared_dir(spark, "checkpoint"))
    for _ in range(2):
        stream = ps.source_file_name(logs.stream_logs(spark, f"{files}/file_name=ssh-*.log"))
        (stream.select("source_file", "message").writeStream
         .option("checkpointLocation", done).trigger(availableNow=True)
         .start(out, format="parquet").awaitTermination())
    return spark.read.parquet(out)


@query
def q_finished_files(spark, sf_dir):
    """Day files that a stream has finished, from its checkpoint; eight files a batch."""
    files, done = log_files(spark, sf_dir), shared_dir(spark, "checkpoint")
    stream = logs.stream_logs(spark, f"{files}/file_name=ssh-*.log", max_files=8)
    (stream.writeStream.option("checkpointLocation", done).trigger(availableNow=True)
     .start(shared_dir(spark, "sink"), format="parquet").awaitTermination())
    return logs.finished_files(spark, done).select(
        F.expr(f"substr(source_path, {len(files) + 2})").alias("source_path")).distinct()


def _messages(lines_df: DataFrame) -> DataFrame:
    return bus.to_bus(corpus.log_events(lines_df))


@query
def q_read_event_bus(spark, sf_dir):
    """Stored messages replayed as a stream into a table."""
    stored, out = shared_dir(spark, "bus"), shared_dir(spark, "sink")
    bus.store_messages(_messages(lines(spark, sf_dir)), stored)
    decoded = en.decode_event_json(bus.replay_bus(spark, stored))
    (decoded.select("row_hash", "message").writeStream
     .option("checkpointLocation", shared_dir(spark, "checkpoint"))
     .trigger(availableNow=True).start(out, format="parquet").awaitTermination())
    return spark.read.parquet(out)


@query
def q_write_event_bus(spark, sf_dir):
    messages = _messages(lines(spark, sf_dir))
    decoded = en.decode_event_json(messages)
    return ntz(decoded.select("ingest_time", "host_name", "row_hash", "event_time",
                              "source_path", "source_file", "message", "log_type"))


def _stored(spark, sf_dir, incoming: DataFrame | None = None) -> str:
    path = shared_dir(spark, "events")
    tables.upsert_days(spark, path, events(spark, sf_dir) if incoming is None else incoming)
    return path


def _parsed_once(spark, sf_dir) -> DataFrame:
    """The events, parsed and stored for merges that read them several times."""
    path = shared_dir(spark, "incoming")
    events(spark, sf_dir).write.parquet(path)
    return spark.read.schema(ENRICHED).parquet(path).select(*ENRICHED.names)


@query
def q_read_events_table(spark, sf_dir):
    stored = tables.read_events(spark, _stored(spark, sf_dir), DAY_FROM, DAY_TO)
    return ntz(stored.select("event_date", *ENRICHED.names).drop("ingest_time"))


def _redelivered(df: DataFrame) -> DataFrame:
    """Every event, and the ERROR events once more, an hour later."""
    later = df.filter(F.col("log_level") == "ERROR").withColumns({
        "ingest_time": F.col("ingest_time") + F.expr("interval 1 hour"),
        "host_name": F.lit("replay")})
    return df.unionByName(later)


@query
def q_upsert_events(spark, sf_dir):
    base = events(spark, sf_dir)
    return ntz(tables.upsert(base, _redelivered(base)).select(
        "row_hash", "host_name", "ingest_time", "event_time", "message"))


@query
def q_upsert_events_table(spark, sf_dir):
    """Two merges into a stored table; the second one is a full rerun."""
    incoming = _parsed_once(spark, sf_dir)
    path = _stored(spark, sf_dir, incoming)
    for _ in range(2):
        tables.upsert_days(spark, path, _redelivered(incoming))
    return ntz(tables.read_events(spark, path).select(
        "event_date", "row_hash", "host_name", "ingest_time"))


@query
def q_snapshot_read(spark, sf_dir):
    """A reader that was opened before a merge, and one opened after it."""
    incoming = _parsed_once(spark, sf_dir)
    path = _stored(spark, sf_dir, incoming)
    before = tables.read_events(spark, path)
    tables.upsert_days(spark, path, _redelivered(incoming))
    after = tables.read_events(spark, path)
    seen = before.withColumn("seen", F.lit("before")).unionByName(
        after.withColumn("seen", F.lit("after")))
    return ntz(seen.select("seen", "event_date", "row_hash", "host_name", "ingest_time"))


@query
def q_write_daily_metrics(spark, sf_dir):
    path = shared_dir(spark, "metrics")
    for _ in range(2):
        tables.write_metrics(mt.daily_metrics(events(spark, sf_dir)), path)
    return _metrics_text(tables.read_metrics(spark, path).drop("created_at"))


@query
def q_alert_sink(spark, sf_dir):
    """The texts that are delivered, the last one per window and address."""
    root, sent = shared_dir(spark, "live"), shared_dir(spark, "sent")

    def deliver(alerts, batch_id):
        alerts.write.mode("overwrite").parquet(f"{sent}/batch={batch_id}")

    with _state_partitions(spark):
        started = live.start_alerts(_bus_stream(spark, sf_dir), root, None, BF_WINDOW,
                                    BF_THRESHOLD, REPLAY_WATERMARK, deliver=deliver)
    started.awaitTermination()
    last = F.max_by("body_line", "fail_cnt")
    return ntz(spark.read.parquet(sent).groupBy("window_start", "ip").agg(
        F.regexp_replace(last, "  detected: .*", "").alias("body_line")))


@query
def q_enforce_event_schema(spark, sf_dir):
    """All columns arrive as text; what does not fit its type becomes NULL."""
    text = events(spark, sf_dir).select(*[F.col(c).cast("string").alias(c)
                                          for c in ENRICHED.names])
    odd = text.withColumns({
        "port": F.when(F.col("port").isNull(), F.lit("not a port")).otherwise(F.col("port")),
        "ip": F.when(F.col("error_type") == "login success", F.concat(F.col("ip"), F.lit(".7")))
               .otherwise(F.col("ip"))})
    return ntz(en.enforce_schema(odd).select(
        "row_hash", "event_time", "log_level", "error_type", "user", "ip", "port"))


@query
def q_schema_rejects(spark, sf_dir):
    """What a merge of text columns leaves out, by reason."""
    text = events(spark, sf_dir).select(*[F.col(c).cast("string").alias(c)
                                          for c in ENRICHED.names])
    level, kind = F.col("log_level"), F.col("error_type")
    odd = text.withColumns({
        "port": F.coalesce("port", F.lit("not a port")),
        "ip": F.when(kind == "login success", F.concat("ip", F.lit(".7"))).otherwise(F.col("ip")),
        "event_time": F.when(level == "WARN", "no time").otherwise(F.col("event_time")),
        "row_hash": F.when(kind != "connection closed", F.col("row_hash"))})
    made = tables.upsert_days(spark, shared_dir(spark, "events"), odd)
    return spark.createDataFrame(sorted(made.rejects.items()), "reason string, cnt long")


@query
def q_split_by_date(spark, sf_dir):
    """Lines without a day, and with an impossible one, have their files, too."""
    out = shared_dir(spark, "ssh-files")
    sp.split_by_date(corpus.with_broken_lines(lines(spark, sf_dir)), corpus.YEAR, out,
                     order=("event_id",))
    return sp.split_counts(spark.read.text(out).withColumnRenamed("value", "message"))


@query
def q_split_by_date_capped(spark, sf_dir):
    capped = sp.capped_lines(lines(spark, sf_dir), corpus.YEAR, 100, order=("event_id",))
    return capped.select("file_name", "event_id", "message")


@query
def q_split_counts(spark, sf_dir):
    return sp.split_counts(
        sp.capped_lines(lines(spark, sf_dir), corpus.YEAR, 100, order=("event_id",)))


@query
def q_split_left_out(spark, sf_dir):
    return sp.split_left_out(sp.dated_lines(lines(spark, sf_dir), corpus.YEAR), 100)


# Fewer than the events of any scale, so that the dump is cut.
DUMP_ROWS = 500


@query
def q_capped_dump(spark, sf_dir):
    return ntz(sp.capped_dump(events(spark, sf_dir), DUMP_ROWS).select(
        "row_hash", "event_time", "message"))


@query
def q_dump_counts(spark, sf_dir):
    return sp.dump_counts(events(spark, sf_dir), DUMP_ROWS)


# --- parsing ---------------------------------------------------------------

@query
def q_add_provenance(spark, sf_dir):
    return ps.add_provenance(lines(spark, sf_dir), corpus.HOST).select(
        "event_id", "source_path", "host_name", "log_type")


@query
def q_source_file_name(spark, sf_dir):
    return ps.source_file_name(lines(spark, sf_dir)).select(
        "event_id", "source_path", "source_file")


@query
def q_parse_syslog_time(spark, sf_dir):
    return ps.parse_syslog_time(corpus.with_broken_lines(lines(spark, sf_dir))).select(
        "event_id", "log_time")


@query
def q_parse_syslog_header(spark, sf_dir):
    return ps.parse_syslog_header(lines(spark, sf_dir)).select(
        "event_id", "logdate", "host", "process", "pid", "msg")


@query
def q_year_from_file(spark, sf_dir):
    return ps.year_from_file(ps.source_file_name(lines(spark, sf_dir))).select(
        "event_id", "log_year")


def _timed(spark, sf_dir, log_tz="UTC"):
    dated = ps.year_from_file(ps.source_file_name(lines(spark, sf_dir)))
    return ps.event_time(ps.parse_syslog_time(dated), log_tz=log_tz)


@query
def q_event_time(spark, sf_dir):
    return ntz(ps.kst_text(_timed(spark, sf_dir)).select(
        "event_id", "event_time", "event_time_kst_iso"))


@query
def q_event_time_log_tz(spark, sf_dir):
    """Header times written in Korean local time."""
    return ntz(ps.kst_text(_timed(spark, sf_dir, "Asia/Seoul")).select(
        "event_id", "event_time", "event_time_kst_iso"))


@query
def q_row_hash(spark, sf_dir):
    return ps.row_hash(_timed(spark, sf_dir)).select("event_id", "row_hash")


@query
def q_row_hash_message(spark, sf_dir):
    return ps.row_hash(_timed(spark, sf_dir), ("message",)).select("event_id", "row_hash")


@query
def q_parse_lines(spark, sf_dir):
    """The whole parse; ``drop_fields`` is its output schema."""
    return ntz(corpus.log_events(lines(spark, sf_dir)))


@query
def q_ingest_messages(spark, sf_dir):
    """Log files -> messages -> decoded events."""
    glob = f"{log_files(spark, sf_dir)}/file_name=ssh-*.log"
    decoded = en.decode_event_json(ingest.file_messages(spark, glob, corpus.HOST))
    return ntz(decoded.select("host_name", "event_time", "source_file", "message", "log_type"))


# --- decoding and enrichment -----------------------------------------------

def _mixed_messages(spark, sf_dir) -> DataFrame:
    """Messages of all events; those of disconnects arrive broken."""
    broken = F.contains("value", F.lit("Received disconnect"))
    return _messages(lines(spark, sf_dir)).withColumn(
        "value", F.when(broken, F.concat(F.lit("not json: "), F.col("key")))
        .otherwise(F.col("value")))


@query
def q_decode_event_json(spark, sf_dir):
    return ntz(en.decode_event_json(_mixed_messages(spark, sf_dir)).select(
        "ingest_time", "row_hash", "event_time", "event_time_kst_iso", "source_file", "message"))


@query
def q_decode_event_json_literal(spark, sf_dir):
    """Undecodable messages stay as events without fields."""
    kept = en.enrich(en.decode_event_json(_mixed_messages(spark, sf_dir), keep_malformed=True))
    return (kept.groupBy("log_level", "error_type", F.col("row_hash").isNull().alias("keyless"))
            .agg(F.count("*").alias("cnt")))


@query
def q_malformed_events(spark, sf_dir):
    return en.malformed_events(_mixed_messages(spark, sf_dir))


@query
def q_normalise_timestamps(spark, sf_dir):
    text = lines(spark, sf_dir).select(
        "event_id", F.when(F.contains("message", F.lit("Invalid user")), F.lit("no time"))
        .otherwise(F.col("ts").cast("string")).alias("event_time"))
    return ntz(en.normalise_timestamps(text, ("event_time",)))


@query
def q_classify_log_level(spark, sf_dir):
    return en.classify_log_level(lines(spark, sf_dir)).select("event_id", "log_level")


@query
def q_classify_error_type(spark, sf_dir):
    return en.classify_error_type(lines(spark, sf_dir)).select("event_id", "error_type")


@query
def q_extract_user(spark, sf_dir):
    return en.extract_user(lines(spark, sf_dir)).select("event_id", "user")


@query
def q_extract_ip(spark, sf_dir):
    return en.extract_ip(lines(spark, sf_dir)).select("event_id", "ip")


@query
def q_extract_port(spark, sf_dir):
    return en.extract_port(lines(spark, sf_dir)).select("event_id", "port")


@query
def q_enrich(spark, sf_dir):
    return ntz(events(spark, sf_dir))


@query
def q_epoch_to_timestamp(spark, sf_dir):
    """Milliseconds for even ids, seconds for odd ones; text; and cut to seconds."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    df = lines(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 2 == 0, F.floor(micros / 1000))
         .otherwise(F.floor(micros / 1_000_000)).cast("bigint").alias("mixed"),
        F.floor(micros / 1000).cast("bigint").alias("millis"),
        F.col("ts").cast("string").alias("text"),
        F.col("event_id").alias("nanos"))
    for name, unit in (("mixed", "auto"), ("millis", "ms"), ("text", "auto"), ("nanos", "auto")):
        df = en.epoch_to_timestamp(df, name, unit)
    return ntz(df)


@query
def q_fill_defaults(spark, sf_dir):
    holes = events(spark, sf_dir).select(
        "row_hash",
        F.when(F.col("log_level") != "WARN", F.col("log_level")).alias("log_level"),
        F.when(F.col("error_type") != "etc", F.col("message")).alias("message"))
    return en.fill_defaults(holes)


@query
def q_hour_of_day(spark, sf_dir):
    return mt.hour_of_day(events(spark, sf_dir)).select("row_hash", "hour")


@query
def q_classify_message_pattern(spark, sf_dir):
    return en.classify_message_pattern(lines(spark, sf_dir)).select("event_id", "pattern")


@query
def q_format_metric(spark, sf_dir):
    totals = mt.total_logs(events(spark, sf_dir))
    scaled = totals.withColumns({"big": F.col("total_logs") * 12345,
                                 "missing": F.lit(None).cast("bigint")})
    return rp.format_metric(scaled, ["total_logs", "big", "missing"])


@query
def q_alert_text(spark, sf_dir):
    alerts = mt.brute_force_windowed(events(spark, sf_dir), BF_WINDOW, BF_THRESHOLD)
    return ntz(rp.alert_text(alerts).select("window_start", "body_line"))


# --- filters ---------------------------------------------------------------

@query
def q_failed_logins(spark, sf_dir):
    return fl.failed_logins(events(spark, sf_dir)).select("row_hash", "error_type", "ip")


@query
def q_daily_filter(spark, sf_dir):
    return ntz(fl.daily_filter(events(spark, sf_dir), DAY).select("row_hash", "event_time"))


@query
def q_level_filter(spark, sf_dir):
    return fl.level_filter(events(spark, sf_dir), "ERROR").select("row_hash", "message")


@query
def q_message_contains(spark, sf_dir):
    return fl.message_contains(events(spark, sf_dir), "Failed password").select(
        "row_hash", "message")


@query
def q_metric_lookup(spark, sf_dir):
    return _metrics_text(fl.metric_lookup(mt.daily_metrics(events(spark, sf_dir)), DAY))


@query
def q_having_threshold(spark, sf_dir):
    return fl.having_threshold(mt.hourly_counts(events(spark, sf_dir)), "cnt", 15)


# --- metrics ---------------------------------------------------------------

def _metrics_text(metrics: DataFrame) -> DataFrame:
    """Nested lists as JSON text, which compares across engines."""
    return metrics.withColumns({c: F.to_json(c) for c in ("top_ip_list", "top_brute_list")})


@query
def q_total_logs(spark, sf_dir):
    return mt.total_logs(events(spark, sf_dir))


@query
def q_error_count(spark, sf_dir):
    return mt.error_count(events(spark, sf_dir))


@query
def q_unique_ips(spark, sf_dir):
    return mt.unique_ips(events(spark, sf_dir))


@query
def q_unique_ips_null_counts(spark, sf_dir):
    return mt.unique_ips(events(spark, sf_dir), count_null_ip=True)


@query
def q_unique_sources(spark, sf_dir):
    """Every third host writes a file of its own."""
    spread = events(spark, sf_dir).withColumn("source_file", F.concat(
        "source_file", F.lit("-"), F.crc32(F.col("message").cast("binary")) % 3))
    return mt.unique_sources(spread)


@query
def q_hourly_counts(spark, sf_dir):
    return mt.hourly_counts(events(spark, sf_dir))


@query
def q_peak_hour(spark, sf_dir):
    return mt.peak_hour(events(spark, sf_dir))


@query
def q_ip_counts(spark, sf_dir):
    return mt.ip_counts(events(spark, sf_dir))


def _numbered(ordered: DataFrame) -> DataFrame:
    """Rows with their place: a few aggregated rows, numbered where the sort left them."""
    return ordered.coalesce(1).withColumn("rank", (F.monotonically_increasing_id() + 1).cast("int"))


@query
def q_order_by_count(spark, sf_dir):
    """The place of each row in the sorted output."""
    ordered = mt.order_by_count(mt.ip_counts(events(spark, sf_dir)), "cnt", "metric_date", "ip")
    return _numbered(ordered)


@query
def q_top_k(spark, sf_dir):
    return _numbered(
        mt.top_k(mt.hourly_counts(events(spark, sf_dir)), 3, "cnt", "metric_date", "hour"))


@query
def q_untimed_counts(spark, sf_dir):
    broken = corpus.with_broken_lines(lines(spark, sf_dir))
    return mt.untimed_counts(corpus.log_events(broken))


@query
def q_top_ips(spark, sf_dir):
    return mt.top_ips(events(spark, sf_dir))


@query
def q_top_ips_null_competes(spark, sf_dir):
    return mt.top_ips(events(spark, sf_dir), null_before_limit=False)


def _day_states(spark, sf_dir) -> DataFrame:
    path = shared_dir(spark, "states")
    for _ in range(2):  # a rerun replaces its days
        tables.write_day_states(rg.day_state(events(spark, sf_dir)), path)
    return tables.read_day_states(spark, path)


@query
def q_unique_ips_range(spark, sf_dir):
    """Distinct addresses and users by week from the days' sketches; users are many,
    so their estimate is held against the exact count, within three standard errors."""
    week = F.to_date(F.date_trunc("week", "metric_date")).alias("week")
    estimates = rg.distinct_over(_day_states(spark, sf_dir), week)
    exact = mt.with_day(events(spark, sf_dir)).groupBy(week).agg(
        F.count_distinct(F.nullif("user", F.lit(""))).alias("exact"))
    off = F.abs(F.col("unique_users") - F.col("exact"))
    return estimates.join(exact, "week").select(
        "week", "total_logs", "unique_ips",
        (off <= F.ceil(3 * rg.STANDARD_ERROR * F.col("exact"))).alias("users_in_band"))


@query
def q_top_ips_range(spark, sf_dir):
    """The top list of two weeks from the days' states, counted exactly."""
    states = _day_states(spark, sf_dir).filter(
        F.col("metric_date").between(DAY_FROM, DAY_TO))
    return rg.top_ips_over(states, fl.daily_filter(events(spark, sf_dir), DAY_FROM, DAY_TO))


@query
def q_brute_force_daily(spark, sf_dir):
    return mt.brute_force_daily(events(spark, sf_dir))


@query
def q_brute_force_top(spark, sf_dir):
    return mt.brute_force_top(events(spark, sf_dir))


@query
def q_brute_force_windowed(spark, sf_dir):
    return ntz(mt.brute_force_windowed(events(spark, sf_dir), BF_WINDOW, BF_THRESHOLD))


@query
def q_nested_top_list(spark, sf_dir):
    return mt.nested_top_list(mt.daily_metrics(events(spark, sf_dir)))


@query
def q_daily_metrics(spark, sf_dir):
    return _metrics_text(mt.daily_metrics(events(spark, sf_dir)))


@query
def q_daily_metrics_kst(spark, sf_dir):
    """Days and hours of the report zone."""
    return _metrics_text(mt.daily_metrics(events(spark, sf_dir), report_tz="Asia/Seoul"))


@query
def q_daily_metrics_literal(spark, sf_dir):
    """The job as first deployed: NULL address counted and competing, and a
    failure type that no event has."""
    return _metrics_text(mt.daily_metrics(
        events(spark, sf_dir), count_null_ip=True, null_before_limit=False,
        failure_types=("ssh",)))


@query
def q_daily_metrics_one_day(spark, sf_dir):
    return _metrics_text(mt.daily_metrics(events(spark, sf_dir), DAY))


@query
def q_success_rate(spark, sf_dir):
    return mt.success_rate(events(spark, sf_dir))


# --- report ----------------------------------------------------------------

@query
def q_level_counts(spark, sf_dir):
    return rp.value_counts(events(spark, sf_dir), "log_level")


@query
def q_source_counts_top10(spark, sf_dir):
    return rp.value_counts(events(spark, sf_dir), "source_file", 10)


@query
def q_pattern_counts(spark, sf_dir):
    return rp.value_counts(en.classify_message_pattern(events(spark, sf_dir)), "pattern")


@query
def q_date_counts(spark, sf_dir):
    return rp.date_counts(events(spark, sf_dir))


@query
def q_daily_summary(spark, sf_dir):
    return rp.daily_summary(events(spark, sf_dir))


@query
def q_auth_report_summary(spark, sf_dir):
    return rp.auth_report_summary(events(spark, sf_dir))


def _cube(spark, sf_dir) -> DataFrame:
    return rp.report_cube(events(spark, sf_dir))


@query
def q_report_cube(spark, sf_dir):
    return _cube(spark, sf_dir)


@query
def q_report_level_distribution(spark, sf_dir):
    return rp.report_level_distribution(_cube(spark, sf_dir))


@query
def q_report_hourly_trend(spark, sf_dir):
    return rp.report_hourly_trend(_cube(spark, sf_dir))


@query
def q_report_source_top10(spark, sf_dir):
    return rp.report_source_top10(_cube(spark, sf_dir))


@query
def q_report_pattern_distribution(spark, sf_dir):
    return rp.report_pattern_distribution(_cube(spark, sf_dir))


@query
def q_report_summary_rows(spark, sf_dir):
    return rp.report_summary_rows(rp.report_summary(_cube(spark, sf_dir)))


@query
def q_report_detail_rows(spark, sf_dir):
    return ntz(rp.report_detail_rows(events(spark, sf_dir), DAY_FROM, DAY_TO)
               .select("row_hash", "event_time", "source_file", "message", "log_level"))


@query
def q_daily_report(spark, sf_dir):
    """Summary and distributions of a report range, as one long table."""
    report = rp.daily_report(events(spark, sf_dir), DAY_FROM, DAY_TO)
    out = report["summary_rows"].select(
        F.lit("summary").alias("part"), F.col("metric").alias("label"), "value")
    for part in ("level_distribution", "source_top10", "source_counts", "pattern_distribution"):
        out = out.unionByName(report[part].select(
            F.lit(part).alias("part"), F.col("value").alias("label"), F.col("cnt").alias("value")))
    hours = report["hourly_trend"].select(
        F.lit("hourly_trend").alias("part"), F.col("hour").cast("string").alias("label"),
        F.col("cnt").alias("value"))
    return out.unionByName(hours)


@query
def q_email_report_rows(spark, sf_dir):
    """The mail of every day, and of one that has no metrics."""
    metrics = mt.daily_metrics(events(spark, sf_dir))
    absent = spark.range(1).select(F.lit(ABSENT_DAY).cast("date").alias("metric_date"))
    days = metrics.select("metric_date").unionByName(absent)
    return rp.email_report_rows(days.join(metrics, "metric_date", "left"))


# --- streaming -------------------------------------------------------------

def _bus_stream(spark, sf_dir) -> DataFrame:
    """The table itself as a stream of messages; nothing is written first."""
    return _messages(corpus.stream_lines(spark, sf_dir))


def _state_partitions(spark, number: int | None = None):
    """As many state partitions as the session shuffles with, but no more than cores."""
    number = number or min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                 spark.sparkContext.defaultParallelism)
    return live.state_partitions(spark, number)


def _redelivered_bus(spark, sf_dir) -> DataFrame:
    """All messages, and those of 'error' events a second time."""
    again = corpus.stream_events(spark, sf_dir).filter(F.col("event_type") == "error")
    later = corpus.log_events(corpus.render(again)).withColumns({
        "ingest_time": F.col("ingest_time") + F.expr("interval 1 hour"),
        "host_name": F.lit("replay")})
    return _bus_stream(spark, sf_dir).unionByName(bus.to_bus(later))


@query
def q_stream_enrich(spark, sf_dir):
    out = shared_dir(spark, "enriched")
    (live.stream_enrich(_bus_stream(spark, sf_dir)).writeStream
     .option("checkpointLocation", shared_dir(spark, "checkpoint"))
     .trigger(availableNow=True).start(out, format="parquet").awaitTermination())
    return ntz(spark.read.schema(ENRICHED).parquet(out))


@query
def q_stream_upsert(spark, sf_dir):
    root = shared_dir(spark, "live")
    live.start_events(_redelivered_bus(spark, sf_dir), root, trigger=None).awaitTermination()
    stored = tables.read_live_events(spark, live.events_path(root))
    return ntz(stored.select("event_date", "row_hash", "host_name", "ingest_time"))


@query
def q_stream_dedup(spark, sf_dir):
    """Redelivered keys dropped on the way in."""
    out = shared_dir(spark, "dedup")
    unique = live.deduplicated(live.stream_enrich(_redelivered_bus(spark, sf_dir)),
                               REPLAY_WATERMARK)
    with _state_partitions(spark):
        started = (unique.select("row_hash", "message").writeStream
                   .option("checkpointLocation", shared_dir(spark, "checkpoint"))
                   .trigger(availableNow=True).start(out, format="parquet"))
    started.awaitTermination()
    return spark.read.parquet(out)


def _alerts(spark, sf_dir, mode: str, watermark: str, source: DataFrame | None = None,
            partitions: int | None = None) -> DataFrame:
    root = shared_dir(spark, "live")
    if source is None:
        source = _bus_stream(spark, sf_dir)
    with _state_partitions(spark, partitions):
        started = live.start_alerts(source, root, None, BF_WINDOW, BF_THRESHOLD, watermark, mode)
    started.awaitTermination()
    return ntz(tables.read_alerts(spark, live.alerts_path(root)).drop("detected_at"))


@query
def q_stream_bruteforce(spark, sf_dir):
    return _alerts(spark, sf_dir, "update", REPLAY_WATERMARK)


@query
def q_stream_bruteforce_final(spark, sf_dir):
    """Only windows that the watermark has closed; the newest stay open.

    The last failure comes three times more, so the open window has enough.
    """
    failed = corpus.stream_events(spark, sf_dir).filter("event_type = 'error'")
    at_end = (spark.read.schema(corpus.EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
              .filter("event_type = 'error' and event_id % 7 <> 0").agg(F.max("ts").alias("ts")))
    last = failed.join(F.broadcast(at_end), "ts").select(failed.columns)
    bus_again = _messages(corpus.render(last.select(
        F.explode(F.array(*[F.struct(*[F.col(c) for c in last.columns])] * 3)).alias("e"))
        .select("e.*")))
    return _alerts(spark, sf_dir, "append", "1 minute",
                   _bus_stream(spark, sf_dir).unionByName(bus_again))


@query
def q_keyless_events(spark, sf_dir):
    """Alerts count messages without a key, and the table stores them under a computed one."""
    keyless = _bus_stream(spark, sf_dir).withColumn("value", F.when(
        F.crc32(F.col("key").cast("binary")) % 3 == 0,
        F.regexp_replace("value", '"row_hash":"[^"]*",', "")).otherwise(F.col("value")))
    root = shared_dir(spark, "live")
    live.start_events(keyless, root, trigger=None).awaitTermination()
    stored = tables.read_live_events(spark, live.events_path(root))
    per_day = mt.total_logs(stored).withColumnRenamed("total_logs", "keys")
    alerts = (_alerts(spark, sf_dir, "update", REPLAY_WATERMARK, keyless)
              .groupBy(F.to_date("window_start").alias("metric_date"))
              .agg(F.sum("fail_cnt").alias("failures")))
    return per_day.join(alerts, "metric_date", "left").select(
        "metric_date", "keys", F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures"))


@query
def q_numeric_times(spark, sf_dir):
    """Messages whose times are epoch milliseconds, or seconds."""
    wanted = lines(spark, sf_dir).select(
        F.to_json(F.struct(
            F.when(F.col("event_id") % 2 == 0, F.unix_millis(F.col("ts").cast("timestamp")))
            .otherwise(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("event_time"),
            F.col("event_id").cast("string").alias("row_hash"), "message")).alias("value"))
    return ntz(en.decode_event_json(wanted).select("row_hash", "event_time", "message"))


# Messages of a micro-batch at most.
MAX_ROWS = 2000
# Queries that read a rate-limited bus side by side, each a part of it.
READERS = 8
# Files per slice of a bus that comes in a fixed order.
SLICE_FILES = 4


def _sliced_bus(spark, *slices: DataFrame) -> DataFrame:
    """Messages of the slices, one slice per micro-batch, in order."""
    stored = shared_dir(spark, "bus")
    for rows in slices:
        bus.store_messages(_messages(rows).repartition(SLICE_FILES, "key").sortWithinPartitions(
            "key"), stored)
    return bus.replay_bus(spark, stored, SLICE_FILES)


@query
def q_late_data(spark, sf_dir):
    """Every tenth event of the first half comes two batches after the clock has moved on."""
    rows, half = lines(spark, sf_dir), F.col("ts") < F.lit(DAY).cast("timestamp_ntz")
    late = half & (F.col("event_id") % 10 == 0)
    second = rows.filter(~half)
    return _alerts(spark, sf_dir, "update", "1 minute", _sliced_bus(
        spark, rows.filter(half & ~late), second.filter("event_id % 2 = 0"),
        second.filter("event_id % 2 = 1"), rows.filter(late)), SLICE_FILES)


@query
def q_rate_limit(spark, sf_dir):
    """Micro-batches of a limited number of messages: what they hold at most, and in all.

    A batch is small, so most of its time is no work of executors; the parts of the bus
    are read by as many queries at the same time.
    """
    stored, root = shared_dir(spark, "bus"), shared_dir(spark, "live")
    bus.store_messages(_messages(lines(spark, sf_dir)), stored, MAX_ROWS // 2, READERS)
    live.await_all([live.start_events(
        bus.replay_bus(spark, stored, max_rows=MAX_ROWS, partition=part), root, None, part=part)
        for part in bus.stored_partitions(spark, stored)])
    per_batch = spark.read.parquet(live.events_path(root)).groupBy("batch").count()
    return per_batch.agg((F.max("count") <= MAX_ROWS).alias("bounded"),
                         F.sum("count").alias("total_logs"))


def _run_both(spark, sf_dir, root: str) -> None:
    with _state_partitions(spark):
        started = live.run_stream(_bus_stream(spark, sf_dir), root, None, window=BF_WINDOW,
                                  threshold=BF_THRESHOLD, watermark=REPLAY_WATERMARK)
    live.await_all(started)


@query
def q_checkpoint_restart(spark, sf_dir):
    """Stopped, more arrives, started again: nothing lost, nothing twice."""
    root, stored = shared_dir(spark, "live"), shared_dir(spark, "bus")
    for part in (0, 1):
        arrived = lines(spark, sf_dir).filter(F.col("event_id") % 2 == part)
        bus.store_messages(_messages(arrived), stored)
        for _ in range(1 + part):
            with _state_partitions(spark):
                started = live.run_stream(
                    bus.replay_bus(spark, stored), root, None, window=BF_WINDOW,
                    threshold=BF_THRESHOLD, watermark=REPLAY_WATERMARK)
            live.await_all(started)
    per_day = spark.read.parquet(live.events_path(root)).groupBy(
        F.col("event_date").alias("metric_date")).agg(F.count("*").alias("total_logs"))
    alerts = tables.read_alerts(spark, live.alerts_path(root)).groupBy(
        F.to_date("window_start").alias("metric_date")).agg(F.sum("fail_cnt").alias("failures"))
    return per_day.join(alerts, "metric_date", "left").select(
        "metric_date", "total_logs", F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures"))


@query
def q_multi_query(spark, sf_dir):
    """Events and alerts side by side, from one bus definition."""
    root = shared_dir(spark, "live")
    _run_both(spark, sf_dir, root)
    stored = tables.read_live_events(spark, live.events_path(root))
    per_day = mt.total_logs(stored)
    alerts = (tables.read_alerts(spark, live.alerts_path(root))
              .groupBy(F.to_date("window_start").alias("metric_date"))
              .agg(F.count("*").alias("alerts")))
    return (per_day.join(alerts, "metric_date", "left")
            .select("metric_date", "total_logs",
                    F.coalesce("alerts", F.lit(0).cast("bigint")).alias("alerts")))


@query
def q_settle_days(spark, sf_dir):
    """Live days moved into the events table, with redelivered keys resolved."""
    root, table = shared_dir(spark, "live"), shared_dir(spark, "events")
    live.start_events(_redelivered_bus(spark, sf_dir), root, trigger=None).awaitTermination()
    tables.settle_days(spark, live.events_path(root), table)
    return ntz(tables.read_events(spark, table).select(
        "event_date", "row_hash", "host_name", "ingest_time"))


@query
def q_late_day_metrics(spark, sf_dir):
    """A tenth of the events comes after its day was settled; metrics follow the changed days."""
    root, table, metrics = (shared_dir(spark, n) for n in ("live", "events", "metrics"))
    stored, rows = shared_dir(spark, "bus"), lines(spark, sf_dir)
    for late in (False, True):
        bus.store_messages(_messages(rows.filter((F.col("event_id") % 10 == 0) == F.lit(late))),
                           stored)
        live.start_events(bus.replay_bus(spark, stored), root, trigger=None).awaitTermination()
        tables.settle_days(spark, live.events_path(root), table, DAY_TO, "2024-12-31", retire=True)
        daily.refresh_metrics(spark, table, metrics)
    return _metrics_text(tables.read_metrics(spark, metrics).drop("created_at"))


@query
def q_compact_live(spark, sf_dir):
    """Small live files joined between micro-batches; every key is still there once."""
    source = _redelivered_bus(spark, sf_dir)
    stored, root = shared_dir(spark, "bus"), shared_dir(spark, "live")
    with bus.small_row_groups(spark):
        started = (source.writeStream
                   .option("checkpointLocation", shared_dir(spark, "checkpoint"))
                   .trigger(availableNow=True).start(stored, format="parquet"))
    started.awaitTermination()
    live.start_events(bus.replay_bus(spark, stored, max_files=1), root, None).awaitTermination()
    tables.compact_live(spark, live.events_path(root))
    kept = tables.read_live_events(spark, live.events_path(root))
    return ntz(kept.select("event_date", "row_hash", "host_name", "ingest_time"))

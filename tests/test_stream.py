"""Streaming: late data, restart, redelivery, output modes, limits, sinks."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryException

from authwatch.operators import metrics as mt
from authwatch.schema import LOG_EVENT
from authwatch.sources import bus, logs, tables
from authwatch.streaming import live, sinks


def rows_at(clock, ip, count, start=0):
    when = dt.datetime.fromisoformat(f"2024-01-01 {clock}")
    return [(when, "h", f"{ip}-{clock}-{start + n}", when, "p", "f",
             f"Failed password for root from {ip} port 1 ssh2", "ssh")
            for n in range(count)]


@pytest.fixture()
def message_files(spark, tmp_path):
    """Write batches of messages as files with rising modification times."""
    folder = tmp_path / "bus"
    folder.mkdir()
    state = {"n": 0}

    def add(*batches):
        for rows in batches:
            number = state["n"] = state["n"] + 1
            part = str(tmp_path / f"part{number}")
            bus.to_bus(spark.createDataFrame(rows, LOG_EVENT)).coalesce(1).write.parquet(part)
            name = next(f for f in os.listdir(part) if f.endswith(".parquet"))
            target = folder / f"{number:04d}.parquet"
            target.write_bytes(open(os.path.join(part, name), "rb").read())
            os.utime(target, (1_700_000_000 + number, 1_700_000_000 + number))
        return str(folder)

    return add


def one_by_one(spark, folder):
    return bus.replay_bus(spark, folder, max_files=1)


def emitted(df, mode, tmp_path):
    """Rows per micro-batch of a query over one file per trigger."""
    got = {}

    def collect(batch, batch_id):
        got[batch_id] = sorted(tuple(r) for r in batch.collect())

    query = (df.writeStream.outputMode(mode).foreachBatch(collect)
             .option("checkpointLocation", str(tmp_path / "chk"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return [got[k] for k in sorted(got)], query


def counts(events, threshold=1):
    return (mt.brute_force_windowed(events, "1 minute", threshold, "1 minute")
            .select("ip", F.col("fail_cnt").alias("n")))


GROWING = [rows_at("00:00:10", "1.0.0.1", 3), rows_at("00:00:20", "1.0.0.1", 2),
           rows_at("00:05:00", "1.0.0.2", 1), rows_at("00:00:30", "1.0.0.1", 4),
           rows_at("00:05:30", "1.0.0.2", 3)]


def test_update_mode_reports_a_growing_window_again(spark, message_files, tmp_path):
    events = live.stream_enrich(one_by_one(spark, message_files(*GROWING)))
    batches, _ = emitted(counts(events, 3), "update", tmp_path)
    assert [b for b in batches if b] == [
        [("1.0.0.1", 3)], [("1.0.0.1", 5)], [("1.0.0.1", 9)], [("1.0.0.2", 4)]]


def test_append_mode_reports_a_closed_window_once(spark, message_files, tmp_path):
    events = live.stream_enrich(one_by_one(spark, message_files(*GROWING)))
    batches, _ = emitted(counts(events, 3), "append", tmp_path)
    assert [b for b in batches if b] == [[("1.0.0.1", 9)]]


def test_late_rows_are_dropped_after_the_watermark(spark, message_files, tmp_path):
    files = [rows_at("00:00:10", "1.0.0.1", 3), rows_at("00:00:10", "1.0.0.1", 3, 3),
             rows_at("00:05:00", "1.0.0.2", 1), rows_at("00:05:10", "1.0.0.2", 1),
             rows_at("00:00:30", "1.0.0.1", 4), rows_at("00:09:30", "1.0.0.3", 3)]
    events = live.stream_enrich(one_by_one(spark, message_files(*files)))
    batches, query = emitted(counts(events), "update", tmp_path)
    assert [b for b in batches if b] == [
        [("1.0.0.1", 3)], [("1.0.0.1", 6)], [("1.0.0.2", 1)], [("1.0.0.2", 2)], [("1.0.0.3", 3)]]
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress
                  for op in p["stateOperators"])
    assert dropped == 1  # one partial count of four rows


def test_redelivered_keys_are_dropped_within_the_watermark(spark, message_files, tmp_path):
    rows = rows_at("00:00:10", "1.0.0.1", 3)
    folder = message_files(rows, rows, rows_at("00:00:20", "1.0.0.1", 1))
    unique = live.deduplicated(live.stream_enrich(one_by_one(spark, folder)), "1 minute")
    batches, _ = emitted(unique.select("row_hash"), "append", tmp_path)
    assert sum(len(b) for b in batches) == 4


def test_limit_of_files_per_trigger(spark, message_files, tmp_path):
    folder = message_files(*GROWING)
    _, query = emitted(live.stream_enrich(one_by_one(spark, folder)).select("row_hash"),
                       "append", tmp_path)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [3, 2, 1, 4, 3]


def test_restart_continues_and_redelivery_overwrites(spark, message_files, tmp_path):
    root = str(tmp_path / "live")

    def run(folder):
        live.await_all(live.run_stream(one_by_one(spark, folder), root, None, threshold=3,
                                       watermark="1 hour"))

    def state():
        stored = tables.read_live_events(spark, live.events_path(root))
        alerts = tables.read_alerts(spark, live.alerts_path(root))
        return stored.count(), sorted((r["ip"], r["fail_cnt"]) for r in alerts.collect())

    run(message_files(*GROWING[:2]))
    assert state() == (5, [("1.0.0.1", 5)])
    folder = message_files(*GROWING[2:])
    run(folder)
    assert state() == (13, [("1.0.0.1", 9), ("1.0.0.2", 4)])
    run(folder)
    assert state() == (13, [("1.0.0.1", 9), ("1.0.0.2", 4)])
    later = [(r[0] + dt.timedelta(hours=1), "again", *r[2:]) for r in GROWING[0]]
    run(message_files(later))
    stored = tables.read_live_events(spark, live.events_path(root))
    assert stored.count() == 13
    assert stored.filter("host_name = 'again'").count() == 3


def test_stream_equals_batch_for_any_file_split(spark, message_files, tmp_path):
    folder = message_files(*GROWING)
    root = str(tmp_path / "live")
    live.start_alerts(one_by_one(spark, folder), root, None, threshold=1,
                      watermark="1 hour").awaitTermination()
    batch = mt.brute_force_windowed(live.stream_enrich(spark.read.parquet(folder)), threshold=1)
    streamed = tables.read_alerts(spark, live.alerts_path(root)).drop("detected_at")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_malformed_messages_go_to_quarantine(spark, message_files, tmp_path):
    folder = message_files(GROWING[0])
    bad = spark.createDataFrame([(None, "not json"), (None, "{}")], bus.MESSAGE_SCHEMA)
    bad.coalesce(1).write.mode("append").parquet(folder)
    root = str(tmp_path / "live")
    live.start_events(bus.replay_bus(spark, folder), root, None).awaitTermination()
    # A message without fields is an event; one that is no JSON is not.
    assert tables.read_live_events(spark, live.events_path(root)).count() == 4
    quarantine = spark.read.parquet(live.malformed_path(root))
    assert [r["_corrupt"] for r in quarantine.collect()] == ["not json"]


def test_alerts_count_messages_without_a_key(spark, message_files, tmp_path):
    rows = rows_at("00:00:10", "1.0.0.1", 5)
    folder = message_files([(*r[:2], r[2] if n < 2 else None, *r[3:]) for n, r in enumerate(rows)])
    root = str(tmp_path / "live")
    live.await_all(live.run_stream(bus.replay_bus(spark, folder), root, None, threshold=5))
    (alert,) = tables.read_alerts(spark, live.alerts_path(root)).collect()
    assert alert["fail_cnt"] == 5
    keys = [r["row_hash"] for r in tables.read_live_events(
        spark, live.events_path(root)).collect()]
    # The three without a key are one line: same path, time and message.
    assert len(keys) == 3 and None not in keys


def test_alerts_are_delivered_once_per_batch_and_never_empty(spark, message_files, tmp_path):
    sent = []

    def deliver(df, batch_id):
        sent.append(sorted(r["body_line"].split("  detected")[0] for r in df.collect()))

    live.start_alerts(one_by_one(spark, message_files(*GROWING)), str(tmp_path / "live"), None,
                      threshold=3, watermark="1 hour", deliver=deliver).awaitTermination()
    assert sent == [["IP: 1.0.0.1  failures: 3"], ["IP: 1.0.0.1  failures: 5"],
                    ["IP: 1.0.0.1  failures: 9"], ["IP: 1.0.0.2  failures: 4"]]


def test_repeated_micro_batch_changes_nothing(spark, message_files, tmp_path):
    rows = live.stream_enrich(spark.read.parquet(message_files(GROWING[0])))
    sink = sinks.event_sink(str(tmp_path / "events"), writer="w")
    for batch_id in (0, 0, 1):
        sink(rows, batch_id)
    assert spark.read.parquet(str(tmp_path / "events")).count() == 6
    assert tables.read_live_events(spark, str(tmp_path / "events/kind=event")).count() == 3


def test_failure_of_any_query_is_seen(spark, message_files, tmp_path):
    def broken(df, batch_id):
        raise RuntimeError("delivery failed")

    queries = live.run_stream(one_by_one(spark, message_files(GROWING[0])), str(tmp_path / "live"),
                              None, threshold=1, deliver=broken)
    with pytest.raises(StreamingQueryException):
        live.await_all(queries)


def test_log_files_stream_once_and_are_archived(spark, tmp_path):
    folder, out = tmp_path / "logs", str(tmp_path / "out")
    folder.mkdir()

    def run():
        stream = logs.stream_logs(spark, str(folder), max_files=1,
                                  archive=str(tmp_path / "archive"))
        query = (stream.writeStream.option("checkpointLocation", str(tmp_path / "chk"))
                 .trigger(availableNow=True).start(out, format="parquet"))
        query.awaitTermination()
        return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]

    for day in (1, 2, 3):
        (folder / f"ssh-2024010{day}.log").write_text(f"line {day}\n")
    assert run() == [1, 1, 1]
    (folder / "ssh-20240104.log").write_text("line 4\n")
    assert run() == [1]
    assert run() == []
    got = {(r["source_path"].rsplit("/", 1)[1], r["message"])
           for r in spark.read.parquet(out).collect()}
    assert got == {(f"ssh-2024010{d}.log", f"line {d}") for d in (1, 2, 3, 4)}
    assert any((tmp_path / "archive").rglob("ssh-*.log"))


def test_finished_files_are_those_of_committed_batches(spark, tmp_path):
    folder, checkpoint = tmp_path / "logs", tmp_path / "chk"
    folder.mkdir()

    def run():
        (logs.stream_logs(spark, str(folder), max_files=1).writeStream
         .option("checkpointLocation", str(checkpoint)).trigger(availableNow=True)
         .start(str(tmp_path / "out"), format="parquet").awaitTermination())

    def finished():
        return sorted(r["file_path"] for r in logs.finished_files(
            spark, str(checkpoint)).collect())

    run()
    assert finished() == []
    # More batches than records are kept apart, and names that are encoded in paths.
    names = [f"ssh-202401{d:02d}.log" for d in range(1, 13)] + ["a b+c%20.log"]
    for name in names[:12]:
        (folder / name).write_text("line\n")
    run()
    assert finished() == sorted(str(folder / name) for name in names[:12])
    (folder / names[12]).write_text("line\n")
    run()
    assert finished() == sorted(str(folder / name) for name in names)
    # Read, but not committed.
    commits = checkpoint / "commits"
    newest = max((int(f.name) for f in commits.iterdir() if f.name.isdigit()))
    (commits / str(newest)).unlink()
    assert finished() == sorted(str(folder / name) for name in names[:12])


def test_bus_options():
    options = bus.bus_options("a:1,b:2", max_per_trigger=10000,
                              **{"kafka.max.poll.records": "2000"})
    assert options == {
        "kafka.bootstrap.servers": "a:1,b:2", "subscribe": "ssh-log",
        "startingOffsets": "earliest", "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "10000", "kafka.max.poll.records": "2000"}
    assert "maxOffsetsPerTrigger" not in bus.bus_options("a:1")


def test_messages_keep_key_and_times(spark):
    frame = spark.createDataFrame(rows_at("00:00:10", "1.0.0.1", 1), LOG_EVENT)
    row = bus.to_bus(frame).first()
    assert row["key"] == "1.0.0.1-00:00:10-0"
    assert '"@timestamp":"2024-01-01T00:00:10.000000Z"' in row["value"]
    assert '"event_time_kst_iso":"2024-01-01T09:00:10.000+09:00"' in row["value"]


def test_state_partitions_are_taken_over_and_restored(spark, message_files, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with live.state_partitions(spark, 3):
        query = live.start_alerts(one_by_one(spark, message_files(GROWING[0])),
                                  str(tmp_path / "live"), None, threshold=1)
    query.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert query.recentProgress[0]["stateOperators"][0]["numShufflePartitions"] == 3


def test_a_replay_is_bounded_by_messages(spark, tmp_path):
    stored, root = str(tmp_path / "bus"), str(tmp_path / "live")
    rows = spark.range(100).select(F.col("id").cast("string").alias("key"), F.to_json(F.struct(
        F.col("id").cast("string").alias("row_hash"), F.lit("2024-01-01 10:00:00").alias("event_time"),
        F.lit("Invalid user a from 1.2.3.999").alias("message"))).alias("value"))
    with pytest.raises(ValueError, match="rows_per_file"):
        bus.replay_bus(spark, stored, max_rows=20)
    bus.store_messages(rows.repartition(3), stored, rows_per_file=10)
    with pytest.raises(ValueError, match="rows_per_file"):
        bus.replay_bus(spark, stored, max_rows=5)
    query = live.start_events(bus.replay_bus(spark, stored, max_rows=25), root, None)
    query.awaitTermination()
    batches = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert max(batches) <= 20 and sum(batches) == 100
    rejected = [p["observedMetrics"]["rejects"] for p in query.recentProgress if p["numInputRows"]]
    assert sum(r["bad_ip"] for r in rejected) == 100 and sum(r["malformed"] for r in rejected) == 0


def test_logs_of_a_local_stream_are_written_without_file_context(spark, tmp_path, monkeypatch):
    """The manager is taken over when the query starts, and the session is left as it was."""
    used = []
    started = live._started

    def noted(df, *args):
        used.append(df.sparkSession.conf.get(live.FILE_MANAGER, None))
        return started(df, *args)

    monkeypatch.setattr(live, "_started", noted)
    stored, root = str(tmp_path / "bus"), str(tmp_path / "live")
    rows = bus.to_bus(spark.createDataFrame(rows_at("00:00:00", "10.0.0.1", 60), LOG_EVENT))
    bus.store_messages(rows.coalesce(1), stored, rows_per_file=10)
    query = live.start_events(bus.replay_bus(spark, stored, max_rows=20), root, None)
    query.awaitTermination()
    events = spark.read.parquet(live.events_path(root))
    assert [r["count"] for r in events.groupBy("batch").count().collect()] == [20, 20, 20]
    assert used == [live.BY_FILE_SYSTEM]
    assert spark.conf.get(live.FILE_MANAGER, None) is None
    # What the query wrote is read by the usual manager: nothing is left to do.
    again = live.start_events(bus.replay_bus(spark, stored, max_rows=20), root, None)
    again.awaitTermination()
    assert spark.read.parquet(live.events_path(root)).count() == 60


def test_parts_of_a_bus_are_read_side_by_side(spark, tmp_path):
    stored, root = str(tmp_path / "bus"), str(tmp_path / "live")
    rows = spark.range(0, 100, 1, 2).select(F.col("id").cast("string").alias("key"), F.to_json(
        F.struct(F.col("id").cast("string").alias("row_hash"), F.lit("2024-01-01 10:00:00")
                 .alias("event_time"), F.lit("m").alias("message"))).alias("value"))
    with pytest.raises(ValueError, match="rows_per_file"):
        bus.store_messages(rows, stored, partitions=3)
    bus.store_messages(rows, stored, 10, 3)
    parts = bus.stored_partitions(spark, stored)
    assert parts == ["partition=0", "partition=1", "partition=2"]
    started = [live.start_events(bus.replay_bus(spark, stored, max_rows=20, partition=part),
                                 root, None, part=part) for part in parts]
    live.await_all(started)
    batches = [[p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
               for query in started]
    assert all(max(own) <= 20 and sum(own) >= 20 for own in batches)
    kept = spark.read.parquet(live.events_path(root))
    assert sorted(int(r["row_hash"]) for r in kept.collect()) == list(range(100))
    assert kept.select("batch").distinct().count() == sum(map(len, batches))
    again = live.start_events(bus.replay_bus(spark, stored, max_rows=20, partition=parts[0]),
                              root, None, part=parts[0])
    again.awaitTermination()
    assert not [p for p in again.recentProgress if p["numInputRows"]]


def test_one_large_file_of_messages_is_read_by_several_tasks(spark, tmp_path):
    rows = spark.range(150_000).select(F.sha2(F.col("id").cast("string"), 256).alias("key"),
                                       F.sha2(F.col("id").cast("string"), 512).alias("value"))
    stored, again = str(tmp_path / "bus"), str(tmp_path / "again")
    bus.store_messages(rows.coalesce(1), stored)
    with bus.small_row_groups(spark):
        query = (bus.replay_bus(spark, stored).select("key", "value").coalesce(1).writeStream
                 .option("checkpointLocation", str(tmp_path / "done")).trigger(availableNow=True)
                 .start(again, format="parquet"))
    query.awaitTermination()
    assert spark.conf.get(bus.ROW_GROUP, None) is None
    for folder in (stored, again):
        assert len([name for name in os.listdir(folder) if name.endswith(".parquet")]) == 1
        read = spark.read.parquet(folder).groupBy(F.spark_partition_id()).count().collect()
        assert len(read) >= 3 and sum(r["count"] for r in read) == 150_000

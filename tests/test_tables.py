"""Events, metrics and alert tables: keys, reruns, pruning."""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections import Counter

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from authwatch.operators import metrics as mt
from authwatch.plans import daily
from authwatch.schema import ENRICHED
from authwatch.sources import files, snapshots, tables


def event(key, ingest, time="2024-01-01 10:00:00", host="h"):
    when = dt.datetime.fromisoformat(time) if time else None
    return (dt.datetime.fromisoformat(ingest), host, key, when, "p", "f", "m", "ssh",
            "INFO", "etc", "", None, None, when)


@pytest.fixture()
def frame(spark):
    return lambda *rows: spark.createDataFrame(list(rows), ENRICHED)


def content(df):
    return sorted((r["row_hash"], r["host_name"]) for r in df.collect())


def test_newest_wins_and_incoming_wins_a_tie(frame):
    old = frame(event("a", "2024-01-01", host="old"), event("b", "2024-01-03", host="old"),
                event("c", "2024-01-01", host="old"))
    new = frame(event("a", "2024-01-02", host="new"), event("b", "2024-01-02", host="new"),
                event("c", "2024-01-01", host="new"), event("d", "2024-01-01", host="new"),
                event(None, "2024-01-01", host="new"))
    once = tables.upsert(old, new)
    # The row without a key got the one of its path, time and message.
    computed = hashlib.sha256(b"p:2024-01-01 10:00:00:m").hexdigest()
    want = sorted([("a", "new"), ("b", "old"), ("c", "new"), ("d", "new"), (computed, "new")])
    assert content(once) == want
    assert content(tables.upsert(once, new)) == want


def test_one_key_with_a_third_of_all_rows(spark, frame):
    hot = frame(event("hot", "2024-01-01")).crossJoin(spark.range(20_000)).withColumn(
        "ingest_time", F.col("ingest_time") + F.make_interval(secs=F.col("id"))).drop("id")
    cold = frame(event("x", "2024-01-01")).crossJoin(spark.range(40_000)).withColumn(
        "row_hash", F.col("id").cast("string")).drop("id")
    out = tables.upsert(cold, hot)
    assert out.count() == 40_001
    newest = out.filter("row_hash = 'hot'").first()["ingest_time"]
    assert newest == dt.datetime(2024, 1, 1) + dt.timedelta(seconds=19_999)


def test_merge_touches_only_its_days(spark, frame, tmp_path):
    path = str(tmp_path / "events")
    tables.upsert_days(spark, path, frame(
        event("a", "2024-01-01"), event("b", "2024-01-01", "2024-01-02 00:00:00"),
        event("n", "2024-01-01", None)))
    def of_second():
        return snapshots.newest(spark, path).of_days({"2024-01-02"})

    untouched = of_second()
    tables.upsert_days(spark, path, frame(
        event("a", "2024-01-05", host="new"), event("m", "2024-01-05", None)))
    assert of_second() == untouched and len(untouched) == 1
    assert content(tables.read_events(spark, path)) == [
        ("a", "new"), ("b", "h"), ("m", "h"), ("n", "h")]
    assert content(tables.read_events(spark, path, "2024-01-02")) == [("b", "h")]
    assert content(tables.read_events(spark, path, None, "2024-01-01")) == [("a", "new")]


def test_batches_replace_themselves_and_keys_resolve_on_read(spark, frame, tmp_path):
    path = str(tmp_path / "live")

    def append(df, batch):
        tables.append_batch(tables.with_event_date(df), path, batch, "event_date")

    append(frame(event("a", "2024-01-01"), event("b", "2024-01-01")), "q-0")
    append(frame(event("a", "2024-01-02", host="again")), "q-1")
    append(frame(event("a", "2024-01-02", host="again")), "q-1")
    assert spark.read.parquet(path).count() == 3
    want = [("a", "again"), ("b", "h")]
    assert content(tables.read_live_events(spark, path)) == want
    settled = str(tmp_path / "events")
    for _ in range(2):
        tables.settle_days(spark, path, settled, "2024-01-01")
        assert content(tables.read_events(spark, settled)) == want


def test_a_missing_folder_is_an_error_and_wipes_nothing(spark, events, tmp_path):
    for read in (tables.read_live_events, tables.read_alerts, tables.read_events):
        with pytest.raises(AnalysisException):
            read(spark, str(tmp_path / "none"))
    stored, metrics = str(tmp_path / "events"), str(tmp_path / "metrics")
    tables.upsert_days(spark, stored, events([("2024-01-01 01:00:00", "1.1.1.1", "etc", "INFO")]))
    daily.run_daily_metrics(spark, stored, metrics, "2024-01-01")
    with pytest.raises(AnalysisException):
        daily.run_daily_metrics(spark, stored, metrics, "2024-01-01", str(tmp_path / "none"))
    assert [r["total_logs"] for r in tables.read_metrics(spark, metrics).collect()] == [1]


def test_settled_batches_are_retired_and_later_ones_stay(spark, frame, tmp_path):
    path, settled = str(tmp_path / "live"), str(tmp_path / "events")

    def append(df, batch):
        tables.append_batch(tables.with_event_date(df), path, batch, "event_date")

    append(frame(event("a", "2024-01-01"), event("n", "2024-01-01", None)), "q-0")
    append(frame(event("b", "2024-01-01", "2024-01-02 00:00:00")), "q-1")
    for _ in range(2):
        tables.settle_days(spark, path, settled, "2024-01-01", retire=True)
        assert content(tables.read_events(spark, settled)) == [("a", "h"), ("n", "h")]
    assert content(tables.read_live_events(spark, path)) == [("b", "h")]
    append(frame(event("a", "2024-01-03", host="again")), "q-2")
    tables.settle_days(spark, path, settled, retire=True)
    assert content(tables.read_events(spark, settled)) == [("a", "again"), ("b", "h"), ("n", "h")]
    assert tables.read_live_events(spark, path).count() == 0


def test_a_failed_merge_leaves_the_day_readable(spark, frame, tmp_path):
    path = str(tmp_path / "events")
    tables.upsert_days(spark, path, frame(event("a", "2024-01-01")))
    broken = frame(event("b", "2024-01-02")).withColumn(
        "message", F.raise_error(F.lit("half way")))
    with pytest.raises(Exception, match="half way"):
        tables.upsert_days(spark, path, broken, ["2024-01-01"])
    assert len([x for x in (tmp_path / "events").iterdir() if "commit=" in x.name]) == 1
    assert content(tables.read_events(spark, path)) == [("a", "h")]


@pytest.mark.parametrize("days", [1, 30])
def test_merge_shuffles_once(spark, frame, tmp_path, days, monkeypatch):
    rows = frame(*[event(f"k{d}", "2024-01-01", f"2024-01-{d + 1:02d} 00:00:00")
                   for d in range(days)])
    plans = []
    write = tables._write_days
    monkeypatch.setattr(tables, "_write_days", lambda df, *a: (
        plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a)))
    tables.upsert_days(spark, str(tmp_path / "events"), rows)
    tables.upsert_days(spark, str(tmp_path / "events"), rows)
    assert [len(re.findall(r"Exchange hashpartitioning", plan)) for plan in plans] == [1, 1]


def many(frame, spark, count, prefix, time="2024-01-01 10:00:00"):
    """Events with keys of a prefix; wide texts, so that they fill files."""
    return frame(event("x", "2024-01-01", time)).crossJoin(spark.range(count)).withColumns({
        "row_hash": F.concat(F.lit(prefix), F.col("id").cast("string")),
        "message": F.sha2(F.col("id").cast("string"), 512)}).drop("id")


def test_one_large_day_is_cut_by_its_bytes(spark, frame, tmp_path):
    live, path = str(tmp_path / "live"), str(tmp_path / "events")
    tables.append_batch(tables.with_event_date(many(frame, spark, 20_000, "k")), live, "q-0",
                        "event_date")
    size = sum(f.size for f in files.list_files(spark, live))
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = tables.settle_days(spark, live, path, "2024-01-01", target_bytes=size // 20)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(made.files) > 8  # each is the work of another task
    assert tables.read_events(spark, path).count() == 20_000


def test_more_parts_than_shuffle_partitions_get_their_own(spark, frame, tmp_path):
    path = str(tmp_path / "events")
    made = tables.upsert_days(spark, path, many(frame, spark, 5_000, "k"), ["2024-01-01"],
                              sizes=Counter({dt.date(2024, 1, 1): 1000}), target_bytes=25)
    assert len(made.files) > 16


def test_a_merge_rewrites_only_the_files_with_its_keys(spark, frame, tmp_path):
    path = str(tmp_path / "events")
    for prefix in "abcde":
        tables.upsert_days(spark, path, many(frame, spark, 2_000, prefix),
                           target_bytes=40_000)
    before = snapshots.newest(spark, path)
    assert len(before.files) >= 5
    again = many(frame, spark, 100, "c").withColumns({
        "host_name": F.lit("again"), "ingest_time": F.lit("2024-02-01").cast("timestamp")})
    after = tables.upsert_days(spark, path, again.unionByName(many(frame, spark, 10, "new")),
                               target_bytes=40_000)
    gone = set(before.files) - set(after.files)
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/{name}" for name in gone])
    assert rows.select(F.substring("row_hash", 1, 1)).distinct().collect() == [("c",)]
    assert len(gone) < len(before.files) / 2
    stored = tables.read_events(spark, path)
    assert stored.count() == 10_010 == stored.select("row_hash").distinct().count()
    assert stored.filter("host_name = 'again'").count() == 100


def test_small_files_of_a_day_are_joined_by_the_next_merge(spark, frame, tmp_path):
    path = str(tmp_path / "events")
    for n in range(4):
        tables.upsert_days(spark, path, frame(event(f"k{n}", "2024-01-01")))
    assert len(snapshots.newest(spark, path).files) == 1
    assert tables.read_events(spark, path).count() == 4


def test_a_reader_keeps_its_version(spark, frame, tmp_path):
    path = str(tmp_path / "events")
    tables.upsert_days(spark, path, frame(event("a", "2024-01-01"), event("b", "2024-01-01")))
    opened = tables.read_events(spark, path)
    tables.upsert_days(spark, path, frame(event("a", "2024-01-02", host="new")))
    want = [("a", "h"), ("b", "h")]
    assert content(opened) == want == content(tables.read_events(spark, path, version=1))
    assert content(tables.read_events(spark, path)) == [("a", "new"), ("b", "h")]
    # Files that no version names are not read.
    frame(event("z", "2024-01-01")).write.parquet(f"{path}/commit=other/event_date=2024-01-01")
    assert tables.read_events(spark, path).count() == 2
    assert snapshots.expire(spark, path, keep=1) == 1
    assert snapshots.versions(spark, path) == [2]
    assert content(tables.read_events(spark, path)) == [("a", "new"), ("b", "h")]


def test_of_two_writers_one_fails(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "events")
    tables.upsert_days(spark, path, frame(event("a", "2024-01-01")))
    write = tables._write_days

    def overtaken(df, folder):
        monkeypatch.setattr(tables, "_write_days", write)
        tables.upsert_days(spark, path, frame(event("b", "2024-01-01")))
        write(df, folder)

    monkeypatch.setattr(tables, "_write_days", overtaken)
    with pytest.raises(snapshots.VersionTaken):
        tables.upsert_days(spark, path, frame(event("c", "2024-01-01")))
    assert content(tables.read_events(spark, path)) == [("a", "h"), ("b", "h")]
    tables.upsert_days(spark, path, frame(event("c", "2024-01-01")))
    assert tables.read_events(spark, path).count() == 3


def test_late_events_change_their_days_only(spark, frame, tmp_path):
    live, path, out = (str(tmp_path / n) for n in ("live", "events", "metrics"))

    def arrive(batch, *rows):
        tables.append_batch(tables.with_event_date(frame(*rows)), live, batch, "event_date")

    def totals():
        return {str(r["metric_date"]): r["total_logs"]
                for r in tables.read_metrics(spark, out).collect()}

    days = [f"2024-01-0{d} 10:00:00" for d in (1, 2, 3)]
    arrive("q-0", *[event(f"k{n}", "2024-01-04", day) for n, day in enumerate(days)])
    tables.settle_days(spark, live, path, "2024-01-02", retire=True)
    assert daily.refresh_metrics(spark, path, out) == {dt.date(2024, 1, 1), dt.date(2024, 1, 2)}
    assert tables.read_live_events(spark, live).count() == 1  # the third day is not closed
    arrive("q-1", event("late", "2024-01-05", days[0]), event("n", "2024-01-05", None))
    tables.settle_days(spark, live, path, "2024-01-03", retire=True, late=False)
    assert totals() == {"2024-01-01": 1, "2024-01-02": 1}
    assert daily.refresh_metrics(spark, path, out) == {dt.date(2024, 1, 3)}
    tables.settle_days(spark, live, path, "2024-01-03", retire=True)
    assert daily.refresh_metrics(spark, path, out) == {dt.date(2024, 1, 1)}
    assert daily.refresh_metrics(spark, path, out) == set()
    assert totals() == {"2024-01-01": 2, "2024-01-02": 1, "2024-01-03": 1}
    # A feed that was followed too late for the kept versions gives every day.
    snapshots.expire(spark, path, keep=1)
    assert snapshots.changed_days(spark, path, 1)[1] == {
        None, "2024-01-01", "2024-01-02", "2024-01-03"}


def test_small_live_files_are_joined(spark, frame, tmp_path):
    live = str(tmp_path / "live")
    rows = [event(f"k{n % 150}", f"2024-01-01 00:00:{n % 7:02d}", f"2024-01-0{1 + n % 2} 10:00:00",
                  host=str(n)) for n in range(200)]
    whole = frame(*rows).withColumn("n", F.col("host_name").cast("int")).persist()
    for n in range(0, 200, 10):  # ten small batches in one write each, as a stream leaves them
        part = whole.filter(F.col("n").between(n, n + 9)).withColumn(
            "batch", F.format_string("q-%012d", "n")).drop("n")
        tables._overwrite_partitions(tables.with_event_date(part), live, "event_date", "batch")
    before = sorted(map(tuple, tables.read_live_events(spark, live).collect()), key=repr)
    assert len(files.list_files(spark, live)) == 200
    assert tables.compact_live(spark, live) == 200
    left = files.list_files(spark, live)
    assert len(left) <= 2
    assert sorted(map(tuple, tables.read_live_events(spark, live).collect()), key=repr) == before
    # What comes later is newer than the joined batch, also with an equal time.
    tables.append_batch(tables.with_event_date(frame(event(
        "k0", "2024-01-01 00:00:06", host="later"))), live, "q-000000000200", "event_date")
    assert ("k0", "later") in content(tables.read_live_events(spark, live))
    assert tables.compact_live(spark, live, target_bytes=1) == 0
    assert tables.compact_live(spark, live) == 2
    assert ("k0", "later") in content(tables.read_live_events(spark, live))


def test_rejects_are_counted_and_limited(spark, events, tmp_path):
    path = str(tmp_path / "events")
    rows = events([("2024-01-01 01:00:00", ip, "etc", "INFO")
                   for ip in ("1.2.3.4", "2001", None, "1.1.1.1")])
    odd = rows.withColumns({"port": F.when(F.col("ip") == "2001", "x").otherwise("22"),
                            "row_hash": F.when(F.col("ip") != "1.1.1.1", F.col("row_hash"))})
    with pytest.raises(tables.TooManyRejects, match="bad_port"):
        tables.upsert_days(spark, path, odd, reject_limit=0.5)
    assert snapshots.newest(spark, path).version == 0 and not list(tmp_path.rglob("*.parquet"))
    made = tables.upsert_days(spark, path, odd, reject_limit=1)
    want = {"total_rows": 4, "bad_ip": 1, "bad_port": 1, "bad_time": 0, "keyless": 2}
    assert made.rejects == want == snapshots.newest(spark, path).rejects
    assert tables.read_events(spark, path).count() == 4


def test_stored_addresses_are_typed(spark, events, tmp_path):
    rows = [("2024-01-01 01:00:00", ip, "etc", "INFO") for ip in ("1.2.3.4", "2001")]
    tables.upsert_days(spark, str(tmp_path / "events"), events(rows))
    got = tables.read_events(spark, str(tmp_path / "events")).collect()
    assert sorted((r["ip"] for r in got), key=str) == ["1.2.3.4", None]


def test_metrics_rerun_replaces_the_day(spark, events, tmp_path):
    path = str(tmp_path / "metrics")
    first = [("2024-01-01 01:00:00", "1.1.1.1", "etc", "INFO"),
             ("2024-01-02 01:00:00", "1.1.1.1", "etc", "INFO")]
    tables.write_metrics(mt.daily_metrics(events(first)), path)
    tables.write_metrics(mt.daily_metrics(events(first[:1] * 4)), path)
    rows = {str(r["metric_date"]): r for r in tables.read_metrics(spark, path).collect()}
    assert {day: r["total_logs"] for day, r in rows.items()} == {"2024-01-01": 4, "2024-01-02": 1}
    assert rows["2024-01-01"]["created_at"] is not None
    assert rows["2024-01-01"]["top_ip_list"][0].asDict() == {"ip": "1.1.1.1", "cnt": 4}


def test_queries_parse_the_events_once_for_all_their_merges(spark, sf_dir, monkeypatch):
    from authwatch import catalog
    merge, read = tables.upsert_days, []

    def recorded(session, path, incoming, *args, **kwargs):
        read.append(incoming.inputFiles())
        return merge(session, path, incoming, *args, **kwargs)

    monkeypatch.setattr(catalog.tables, "upsert_days", recorded)
    for query, merges in ((catalog.q_upsert_events_table, 3), (catalog.q_snapshot_read, 2)):
        read.clear()
        query(spark, sf_dir)
        assert len(read) == merges and all(read)
        assert not [name for names in read for name in names if "events.parquet" in name]
        assert len({name.rpartition("/")[0] for names in read for name in names}) == 1

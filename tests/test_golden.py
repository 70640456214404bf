"""Literal lines with expected values, and the parse edge cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from authwatch.operators import enrich as en
from authwatch.operators import parse as ps
from authwatch.schema import ENRICHED, LOG_EVENT

P = "LabSZ sshd"
# line, level, error type, user, ip, port, pattern, event time
GOLDEN = [
    (f"Dec 10 06:55:46 {P}[24200]: reverse mapping checking getaddrinfo for ns.example.com "
     "[173.234.31.186] failed - POSSIBLE BREAK-IN ATTEMPT!",
     "ERROR", "etc", "", None, None, "Other", "2024-12-10 06:55:46"),
    (f"Dec 10 06:55:46 {P}[24200]: Invalid user webmaster from 173.234.31.186",
     "WARN", "invalid user", "webmaster", "173.234.31.186", None, "Invalid user",
     "2024-12-10 06:55:46"),
    (f"Dec 10 06:55:46 {P}[24200]: input_userauth_request: invalid user webmaster [preauth]",
     "WARN", "invalid user", "webmaster", None, None, "Other", "2024-12-10 06:55:46"),
    (f"Dec  1 06:55:48 {P}[24200]: Failed password for invalid user webmaster from "
     "173.234.31.186 port 38926 ssh2",
     "ERROR", "login failed", "webmaster", "173.234.31.186", 38926, "Failed password",
     "2024-12-01 06:55:48"),
    (f"Dec 10 07:07:45 {P}[24206]: Failed password for root from 1.2.3.4 port 99999999999 ssh2",
     "ERROR", "login failed", "", "1.2.3.4", None, "Failed password", "2024-12-10 07:07:45"),
    (f"Dec 10 09:32:20 {P}[24680]: Accepted password for fztu from 119.137.62.142 port 49116 ssh2",
     "INFO", "login success", "", "119.137.62.142", 49116, "Accepted password",
     "2024-12-10 09:32:20"),
    (f"Dec 10 09:32:20 {P}[24680]: pam_unix(sshd:session): session opened for user fztu by (uid=0)",
     "INFO", "etc", "fztu", None, None, "Session opened", "2024-12-10 09:32:20"),
    (f"Dec 10 07:13:31 {P}[24227]: pam_unix(sshd:auth): check pass; user unknown",
     "INFO", "etc", "unknown", None, None, "Other", "2024-12-10 07:13:31"),
    (f"Dec 10 07:13:43 {P}[24227]: Connection closed by 5.36.59.76 [preauth]",
     "INFO", "connection closed", "", None, None, "Connection closed", "2024-12-10 07:13:43"),
    (f"Dec 10 07:07:38 {P}[24206]: Received disconnect from 52.80.34.196: 11: Bye Bye [preauth]",
     "INFO", "etc", "", "52.80.34.196", None, "Other", "2024-12-10 07:07:38"),
    (f"Dec 10 08:00:00 {P}[1]: Invalid user  from 1.2.3.4",
     "WARN", "invalid user", "", "1.2.3.4", None, "Invalid user", "2024-12-10 08:00:00"),
    (f"Dec 10 08:00:01 {P}[1]: Failed password for root from 2001:db8::1 port 22 ssh2",
     "ERROR", "login failed", "", "2001", 22, "Failed password", "2024-12-10 08:00:01"),
    (f"Dec 10 08:00:02 {P}[1]: FAILED PASSWORD FOR ROOT FROM 1.2.3.4",
     "ERROR", "login failed", "", None, None, "Other", "2024-12-10 08:00:02"),
    ("no header here", "INFO", "etc", "", None, None, "Other", None),
    ("", "INFO", "etc", "", None, None, "Other", None),
    (None, "INFO", "etc", None, None, None, "Other", None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    lines = spark.createDataFrame(
        [(n, "/data/ssh-20241210.log", g[0]) for n, g in enumerate(GOLDEN)],
        "n int, source_path string, message string")
    events = ps.parse_lines(lines.withColumn("ingest_time", F.timestamp_seconds("n")), "host")
    out = en.classify_message_pattern(en.enrich(events))
    return {int(r["ingest_time"].timestamp()): r for r in out.collect()}


@pytest.mark.parametrize("n", range(len(GOLDEN)))
def test_golden_line(parsed, n):
    line, level, kind, user, ip, port, pattern, time = GOLDEN[n]
    row = parsed[n]
    assert row["message"] == (line or "")
    assert (row["log_level"], row["error_type"]) == (level, kind)
    assert (row["user"], row["ip"], row["port"]) == (user, ip, port)
    assert row["pattern"] == pattern
    assert row["event_time"] == (dt.datetime.fromisoformat(time) if time else None)


def times(spark, rows, **options):
    df = spark.createDataFrame(rows, "log_year string, log_time string")
    return [r["event_time"] for r in ps.event_time(df, **options).collect()]


@pytest.mark.parametrize("mark", ["\u0001", "\u0002", "\u00020", "\u00021\u0001\u0002"])
def test_a_header_may_hold_the_separator(spark, mark):
    lines = [f"Dec 10 06:55:46 LabSZ sshd[1]: Invalid user a{mark}b from 1.2.3.4",
             f"Dec 10 06:55:46 La{mark}SZ ss{mark}hd: x", f"no header{mark}x{mark}y{mark}z{mark}w"]
    rows = ps.parse_syslog_header(spark.createDataFrame([(x,) for x in lines], "message string"))
    got = {r["message"]: (r["logdate"], r["host"], r["process"], r["pid"], r["msg"])
           for r in rows.collect()}
    assert got == {
        lines[0]: ("Dec 10 06:55:46", "LabSZ", "sshd", "1", f"Invalid user a{mark}b from 1.2.3.4"),
        lines[1]: ("Dec 10 06:55:46", f"La{mark}SZ", f"ss{mark}hd", None, "x"),
        lines[2]: (None,) * 5}


def test_impossible_dates_become_null(spark):
    assert times(spark, [("2023", "Feb 29 00:00:00"), ("2024", "Feb 29 00:00:00"),
                         ("part", "Feb  1 00:00:00"), ("2024", "Feb  1 25:00:00"),
                         ("2024", None), (None, "Feb  1 00:00:00")]) == [
        None, dt.datetime(2024, 2, 29), None, None, None, None]


def test_log_zone_shifts_the_instant(spark):
    assert times(spark, [("2024", "Jan  1 09:00:00")], log_tz="Asia/Seoul") == [
        dt.datetime(2024, 1, 1)]


def test_same_instant_in_kst_text(spark):
    df = spark.sql("select timestamp'2024-01-01 12:47:05' as event_time")
    assert ps.kst_text(df).first()["event_time_kst_iso"] == "2024-01-01T21:47:05.000+09:00"


def test_source_file_follows_path_prefix_and_extension(spark):
    df = spark.createDataFrame([("/data/ssh-20240131.log",), ("/data/x/other.log",),
                                ("ssh-1.txt",), ("/a/ssh-ssh-2.log.log",)], "source_path string")
    assert [r["source_file"] for r in ps.source_file_name(df).collect()] == [
        "20240131", "other", "ssh-1.txt".removeprefix("ssh-"), "ssh-2.log"]


def test_parse_gives_the_log_event_schema(spark):
    lines = spark.createDataFrame([("/data/ssh-20241210.log", GOLDEN[1][0])],
                                  "source_path string, message string")
    events = ps.parse_lines(lines, "host")
    assert events.columns == LOG_EVENT.names
    assert en.enrich(events).columns == ENRICHED.names


def test_row_hash_depends_on_all_three_fields(spark):
    rows = [("p", "2024-01-01 00:00:00", "m"), ("q", "2024-01-01 00:00:00", "m"),
            ("p", "2024-01-01 00:00:01", "m"), ("p", "2024-01-01 00:00:00", "n"),
            ("p", "2024-01-01 00:00:00", "m")]
    df = spark.createDataFrame(rows, "source_path string, event_time string, message string")
    df = df.withColumn("event_time", F.col("event_time").cast("timestamp"))
    hashes = [r["row_hash"] for r in ps.row_hash(df).collect()]
    assert len(set(hashes)) == 4 and hashes[0] == hashes[4]
    assert len({r["row_hash"] for r in ps.row_hash(df, ("message",)).collect()}) == 2


def test_schema_nulls_what_does_not_fit(spark):
    df = spark.createDataFrame([("2001", "22"), ("1.2.3.4", "x"), ("1.2.3.256", None)],
                               "ip string, port string").withColumn("extra", F.lit(1))
    out = en.enforce_schema(df)
    assert out.schema == ENRICHED
    assert [(r["ip"], r["port"]) for r in out.select("ip", "port").collect()] == [
        (None, 22), ("1.2.3.4", None), (None, None)]


MESSAGES = ['{"row_hash":"a","message":"Failed password","event_time":"2024-01-01T00:00:00Z"}',
            "not json", None, "{}", "[1]",
            '{"row_hash":"b","message":"m","event_time":"never"}']


def test_malformed_messages_are_set_apart(spark):
    df = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    good = {r["row_hash"]: r for r in en.decode_event_json(df).collect()}
    # A readable message without a key is an event.
    assert set(good) == {"a", "b", None} and good[None]["message"] is None
    assert good["a"]["event_time"] == dt.datetime(2024, 1, 1)
    assert good["b"]["event_time"] is None and good["b"]["message"] == "m"
    bad = [r["_corrupt"] for r in en.malformed_events(df).collect()]
    assert sorted(bad) == ["", "[1]", "not json"]


def test_literal_mode_keeps_empty_events(spark):
    df = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    rows = en.enrich(en.decode_event_json(df, keep_malformed=True, corrupt_col="_corrupt"),
                     keep=("_corrupt",)).collect()
    assert len(rows) == len(MESSAGES)
    empty = [r for r in rows if r["row_hash"] is None]
    assert {(r["message"], r["log_level"], r["error_type"]) for r in empty} == {("", "INFO", "etc")}
    assert sorted(r["_corrupt"] for r in empty if r["_corrupt"] is not None) == [
        "", "[1]", "not json"]


def test_times_are_text_or_epoch_numbers(spark):
    texts = ['"2024-01-01T00:00:00Z"', "1704067200000", "1704067200", '"1704067200000"', '"never"',
             "null"]
    df = spark.createDataFrame([(f'{{"event_time":{t}}}',) for t in texts], "value string")
    when = dt.datetime(2024, 1, 1)
    assert [r["event_time"] for r in en.decode_event_json(df).collect()] == [
        when, when, when, when, None, None]


def test_epoch_units(spark):
    df = spark.createDataFrame([(1704067200999,), (1704067200,), (5,), (None,)], "t bigint")
    auto = [r["t"] for r in en.epoch_to_timestamp(df, "t").collect()]
    assert auto == [dt.datetime(2024, 1, 1, 0, 0, 0, 999000), dt.datetime(2024, 1, 1),
                    dt.datetime(1970, 1, 1), None]
    cut = en.epoch_to_timestamp(df.limit(1), "t", "ms").first()["t"]
    assert cut == dt.datetime(2024, 1, 1)

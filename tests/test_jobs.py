"""The command line jobs, end to end on files."""

from __future__ import annotations

import pytest

from authwatch.jobs.cli import main, parser
from authwatch.plans import daily
from authwatch.session import shared_dir
from authwatch.sources import tables

LINES = [f"Jan {d:2d} 0{d}:00:{n:02d} h sshd[1]: Failed password for root from 1.0.0.{d} port {n} ssh2"
         for d in (1, 2) for n in range(10 + d)]


def test_files_to_report(spark, tmp_path):
    def at(name):
        return str(tmp_path / name)

    (tmp_path / "logs").mkdir()
    for day in (1, 2):
        (tmp_path / "logs" / f"ssh-2024010{day}.log").write_text(
            "\n".join(x for x in LINES if x.startswith(f"Jan  {day}")) + "\n")
    main(["ingest", "--logs", at("logs/*.log"), "--host", "h", "--out", at("bus")], spark)
    main(["live", "--root", at("live"), "--replay", at("bus"), "--drain", "--threshold", "11"], spark)
    main(["settle", "--root", at("live"), "--events", at("events")], spark)
    assert tables.read_events(spark, at("events")).count() == len(LINES)
    alerts = tables.read_alerts(spark, at("live/alerts")).collect()
    assert sorted((r["ip"], r["fail_cnt"]) for r in alerts) == [("1.0.0.1", 11), ("1.0.0.2", 12)]

    main(["metrics", "--events", at("events"), "--out", at("metrics"), "--date", "2024-01-02"], spark)
    main(["metrics", "--events", at("events"), "--out", at("metrics"), "--all"], spark)
    rows = {str(r["metric_date"]): r for r in tables.read_metrics(spark, at("metrics")).collect()}
    assert {d: (r["total_logs"], r["peak_hour"], r["brute_force_ips"]) for d, r in rows.items()} == {
        "2024-01-01": (11, 1, 1), "2024-01-02": (12, 2, 1)}
    mail = {(r["section"], r["label"]): r["display"]
            for r in daily.mail_rows(spark, at("metrics"), "2024-01-02").collect()}
    assert mail[("top_brute", "1.0.0.2")] == "12"

    main(["report", "--events", at("events"), "--out", at("report"),
          "--from", "2024-01-01", "--to", "2024-01-02"], spark)
    assert spark.read.parquet(at("report/summary")).first()["failed_login_attempts"] == len(LINES)
    assert spark.read.parquet(at("report/detail_rows")).count() == len(LINES)


def test_mail_of_a_day_without_metrics_and_split(spark, events, tmp_path):
    def at(name):
        return str(tmp_path / name)

    tables.upsert_days(spark, at("events"), events([("2024-01-01 01:00:00", "1.1.1.1", "etc", "INFO")]))
    main(["metrics", "--events", at("events"), "--out", at("metrics"), "--all"], spark)
    main(["mail", "--metrics", at("metrics"), "--date", "2024-01-02", "--out", at("mail")], spark)
    rows = spark.read.json(at("mail")).collect()
    assert {r["label"] for r in rows if r["section"] == "summary"} == {
        "total_logs", "error_count", "unique_ips", "peak_hour_logs", "brute_force_ips"}
    assert {r["display"] for r in rows} == {"N/A", "N/A (hour N/A)"}
    (tmp_path / "ssh.log").write_text("\n".join(LINES) + "\n")
    main(["split", "--logs", at("ssh.log"), "--year", "2024", "--out", at("days")], spark)
    assert spark.read.text(at("days")).count() == len(LINES)
    main(["split", "--logs", at("ssh.log"), "--year", "2024", "--out", at("days"),
          "--max-rows", "3"], spark)
    assert spark.read.text(at("days")).count() == 6


def test_days_of_another_zone_reach_over_the_stored_days(spark, events, tmp_path):
    def at(name):
        return str(tmp_path / name)

    rows = [(f"2024-01-0{d} {h:02d}:30:00", "1.1.1.1", "etc", "INFO")
            for d in (1, 2) for h in range(24)]
    tables.upsert_days(spark, at("events"), events(rows))
    for job in (lambda out: daily.run_daily_metrics(spark, at("events"), out, "2024-01-02",
                                                    report_tz="Asia/Seoul"),
                lambda out: daily.backfill_metrics(spark, at("events"), out, "2024-01-02",
                                                   report_tz="Asia/Seoul")):
        out = at(f"metrics{id(job)}")
        job(out)
        (row,) = tables.read_metrics(spark, out).collect()
        assert (str(row["metric_date"]), row["total_logs"]) == ("2024-01-02", 24)
    daily.write_report(spark, at("events"), at("report"), "2024-01-02", report_tz="Asia/Seoul")
    assert spark.read.parquet(at("report/summary")).first()["total_records"] == 24


def test_ingest_with_checkpoint_reads_each_file_once(spark, tmp_path):
    (tmp_path / "logs").mkdir()

    def run(name):
        (tmp_path / "logs" / name).write_text("Jan  1 00:00:00 h sshd[1]: Invalid user a from 1.1.1.1\n")
        main(["ingest", "--logs", str(tmp_path / "logs"), "--host", "h", "--checkpoint",
              str(tmp_path / "chk"), "--out", str(tmp_path / "bus")], spark)
        return spark.read.parquet(str(tmp_path / "bus")).count()

    assert [run("ssh-20240101.log"), run("ssh-20240102.log")] == [1, 2]
    main(["files", "--checkpoint", str(tmp_path / "chk"), "--out", str(tmp_path / "files")], spark)
    assert {r["file_path"] for r in spark.read.json(str(tmp_path / "files")).collect()} == {
        str(tmp_path / "logs" / f"ssh-2024010{d}.log") for d in (1, 2)}


def test_defaults_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("BF_THRESHOLD", "7")
    monkeypatch.setenv("BF_WINDOW_MIN", "2")
    args = parser().parse_args(["live", "--root", "r"])
    assert (args.threshold, args.window_min, args.trigger) == (7, 2, "5 seconds")


class _Session:
    """Just the settings of a session."""

    def __init__(self, **settings):
        self.settings, self.conf = settings, self

    def get(self, key, default=None):
        return self.settings.get(key.replace(".", "_"), default)


def test_shared_folder_comes_from_the_session():
    session = _Session(spark_checkpoint_dir="/shared/base/", spark_master="yarn")
    assert shared_dir(session, "x").startswith("/shared/base/x-")
    assert shared_dir(session, "x") != shared_dir(session, "x")


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        shared_dir(_Session(spark_master="yarn"), "x")
    assert shared_dir(_Session(spark_master="local[2]"), "x")

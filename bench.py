"""Headline timings; prints one JSON line.

Every query runs once to warm up and then ``REPEATS`` times; the best time
counts. Input is the ``events`` table, rendered as log lines.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from authwatch import corpus  # noqa: E402
from authwatch.operators import enrich as en  # noqa: E402
from authwatch.operators import metrics as mt  # noqa: E402
from authwatch.operators import report as rp  # noqa: E402
from authwatch.operators import split as sp  # noqa: E402
from authwatch.plans import ingest  # noqa: E402
from authwatch.session import build_session, shared_dir  # noqa: E402
from authwatch.sources import bus, tables  # noqa: E402
from authwatch.streaming import live  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = 3


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(run) -> float:
    run()
    best = float("inf")
    for _ in range(REPEATS):
        start = time.perf_counter()
        run()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    spark = build_session("authwatch-bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")

    # Stored inputs, spread over as many files as there are cores.
    lines_dir, bus_dir, events_dir = (shared_dir(spark, n) for n in ("lines", "bus", "events"))
    corpus.raw_lines(spark, SF_DIR).repartition(int(CPUS)).write.parquet(lines_dir)
    lines = spark.read.parquet(lines_dir)
    bus.store_messages(bus.to_bus(corpus.log_events(lines)), bus_dir)
    parsed = en.enrich(corpus.log_events(lines))
    tables.upsert_days(spark, events_dir, parsed)
    events = tables.read_events(spark, events_dir)
    messages = spark.read.parquet(bus_dir)
    rows = lines.count()

    # The published path: text files named as logs are, stored messages out.
    files_dir = shared_dir(spark, "files")
    sp.split_by_date(lines, corpus.YEAR, files_dir, order=("event_id",))

    def file_messages():
        return ingest.file_messages(spark, f"{files_dir}/file_name=ssh-*.log", corpus.HOST)

    untimed = en.decode_event_json(file_messages()).filter("event_time IS NULL").count()
    assert untimed == 0, f"{untimed} of the lines have no time"

    def ingest_files():
        bus.store_messages(file_messages(), shared_dir(spark, "stored"))

    live_root = shared_dir(spark, "settled")
    live.start_events(bus.replay_bus(spark, bus_dir), live_root, None).awaitTermination()

    def settle():
        tables.settle_days(spark, live.events_path(live_root), shared_dir(spark, "table"))

    def drain(start):
        start(bus.replay_bus(spark, bus_dir), shared_dir(spark, "live"), None).awaitTermination()

    runs = {
        "parse_enrich": lambda: noop(parsed),
        "ingest_files": ingest_files,
        "encode_messages": lambda: noop(bus.to_bus(corpus.log_events(lines))),
        "decode_enrich": lambda: noop(en.enrich(en.decode_event_json(messages))),
        "daily_metrics": lambda: noop(mt.daily_metrics(events)),
        "daily_metrics_from_lines": lambda: noop(mt.daily_metrics(parsed)),
        "top_ips": lambda: noop(mt.top_ips(events)),
        "brute_force_daily": lambda: noop(mt.brute_force_daily(events)),
        "brute_force_windowed": lambda: noop(mt.brute_force_windowed(events, threshold=3)),
        "report_cube": lambda: noop(rp.report_cube(events)),
        "success_rate": lambda: noop(mt.success_rate(events)),
        "split_by_date_capped": lambda: noop(
            sp.capped_lines(lines, corpus.YEAR, 100, order=("event_id",))),
        "upsert_events": lambda: noop(tables.upsert(events, events)),
        "settle_days": settle,
        "stream_upsert": lambda: drain(live.start_events),
        "stream_bruteforce": lambda: drain(live.start_alerts),
    }
    times = {name: seconds(run) for name, run in runs.items()}
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "rows": rows, "cpus": int(CPUS),
        "rows_per_sec": {name: round(rows / times[name]) for name in
                         ("parse_enrich", "ingest_files", "encode_messages", "decode_enrich", "stream_upsert",
                          "stream_bruteforce")}}))
    spark.stop()


if __name__ == "__main__":
    main()

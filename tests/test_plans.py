"""Shapes of the physical plans that the design relies on."""

from __future__ import annotations

import re

import pytest

from authwatch import corpus
from authwatch.catalog import QUERIES
from authwatch.operators import filters as fl
from authwatch.operators import metrics as mt
from authwatch.operators import report as rp
from authwatch.operators import split as sp
from authwatch.operators.enrich import decode_event_json, enrich
from authwatch.sources import tables
from authwatch.streaming import live


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(text: str, operator: str) -> int:
    return len(re.findall(rf"(?m)^[\s:+\-*()0-9]*{operator}\b", text))


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "events")
    tables.upsert_days(spark, path, corpus.enriched(spark, sf_dir))
    return path


def test_day_bounds_prune_partitions(spark, stored):
    text = plan(tables.read_events(spark, stored, "2024-01-15", "2024-01-15"))
    assert re.search(r"PartitionFilters: \[[^]]*event_date[^]]*2024-01-15", text)


def test_day_filter_and_level_reach_the_scan(spark, stored):
    events = tables.read_events(spark, stored)
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema",
                       plan(fl.level_filter(fl.daily_filter(events, "2024-01-15"), "ERROR")))[1]
    assert "GreaterThanOrEqual(event_time,2024-01-15" in pushed
    assert "LessThan(event_time,2024-01-16" in pushed
    assert "EqualTo(log_level,ERROR)" in pushed


def test_daily_metrics_scan_once_and_shuffle_thrice(spark, stored):
    text = plan(mt.daily_metrics(tables.read_events(spark, stored)))
    assert count(text, "FileScan") == 1
    assert count(text, "Exchange") == 3
    assert count(text, "Expand") == 1
    schema = re.search(r"ReadSchema: struct<(.*)>", text)[1]
    assert "message" not in schema and "row_hash" not in schema
    assert re.search(r"HashAggregate\(keys=\[metric_date#\d+, ip#\d+, hour#\d+, spark_grouping_id#\d+L?\], "
                     r"functions=\[partial_count", text)


def test_report_cube_scans_once(spark, stored):
    text = plan(rp.report_pattern_distribution(rp.report_cube(tables.read_events(spark, stored))))
    assert count(text, "FileScan") == 1


def test_ranking_is_cut_before_the_shuffle(spark, stored):
    events = tables.read_events(spark, stored)
    for df, windows in ((mt.top_ips(events), 1), (mt.brute_force_top(events), 1),
                        (tables.latest_by_key(events, "row_hash", events.ingest_time.desc()), 1),
                        (sp.capped_lines(events, 2024, 100, order=("row_hash",)), 2)):
        assert plan(df).count("WindowGroupLimit") == 2 * windows


def test_top_ten_is_no_full_sort(spark, stored):
    assert "TakeOrderedAndProject" in plan(
        rp.value_counts(tables.read_events(spark, stored), "source_file", 10))
    assert "TakeOrderedAndProject" in plan(sp.capped_dump(tables.read_events(spark, stored), 100))


def test_lines_and_messages_are_parsed_once_below_any_filter(spark, sf_dir):
    lines = corpus.raw_lines(spark, sf_dir)
    text = plan(fl.daily_filter(enrich(corpus.log_events(lines)), "2024-01-15"))
    assert text.count("((?:Jan|Feb") == 1
    messages = spark.createDataFrame([("{}",)], "value string")
    decoded = plan(fl.failed_logins(enrich(decode_event_json(messages))))
    assert decoded.count("from_json") == 1


def test_alerts_parse_only_what_they_need(spark):
    messages = spark.createDataFrame([("{}",)], "value string")
    text = plan(live.stream_failures(messages))
    schema = re.search(r"from_json\(StructField\((.*?)\), \(", text)
    assert text.count("from_json") == 1
    assert "source_path" not in text and "host_name" not in text, schema


def test_no_python_in_any_plan(spark, sf_dir):
    skip = {name for name in QUERIES if name.startswith("stream_")}
    skip |= {"read_event_bus", "checkpoint_restart", "multi_query", "settle_days", "alert_sink",
             "upsert_events_table", "keyless_events", "late_data", "rate_limit"}
    for name, query in QUERIES.items():
        if name not in skip:
            text = plan(query(spark, sf_dir))
            assert not re.search("PythonUDF|EvalPython|InPandas|InArrow", text), name
            assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text, name


def test_ingest_has_no_shuffle(spark, tmp_path):
    from authwatch.plans import ingest

    (tmp_path / "ssh-20240101.log").write_text("Jan  1 00:00:00 h sshd[1]: x\n")
    text = plan(ingest.file_messages(spark, str(tmp_path / "*.log"), "h"))
    assert "Exchange" not in text

"""Figures over ranges of days from the states of the days."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from authwatch.operators import ranges
from authwatch.plans import daily
from authwatch.sources import tables


def skewed(events, n):
    """Address a has a third of all rows; the others have few or many."""
    return events([(f"2024-01-0{1 + i % 5} 01:00:00", "a" if i % 3 == 0 else f"ip{i % (7 + i % 40)}",
                    "etc", "INFO") for i in range(n)]
                  + [(None, "ip1", "etc", "INFO"), ("2024-01-01 02:00:00", None, "etc", "INFO")])


def top(rows, k):
    counts = Counter(r["ip"] for r in rows if r["ip"] and r["event_time"])
    return [(n + 1, ip, c) for n, (ip, c) in enumerate(
        sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k])]


@pytest.mark.parametrize("candidates", [100, 3])
def test_top_lists_are_exact_whatever_the_states_name(events, monkeypatch, candidates):
    monkeypatch.setattr(ranges, "CANDIDATES", candidates)
    rows = skewed(events, 900)
    states = ranges.day_state(rows)
    assert [tuple(r) for r in ranges.top_ips_over(states, rows, 4).collect()] == top(rows.collect(), 4)


def test_flat_counts_and_few_addresses(events):
    flat = events([("2024-01-01 01:00:00", f"ip{i % 300:03d}", "etc", "INFO") for i in range(900)])
    got = ranges.top_ips_over(ranges.day_state(flat), flat, 3).collect()
    assert [tuple(r) for r in got] == [(1, "ip000", 3), (2, "ip001", 3), (3, "ip002", 3)]
    few = events([("2024-01-01 01:00:00", "x", "etc", "INFO")])
    assert [tuple(r) for r in ranges.top_ips_over(ranges.day_state(few), few).collect()] == [(1, "x", 1)]
    none = few.filter("false")
    assert ranges.top_ips_over(ranges.day_state(none), none).count() == 0


def test_distinct_counts_unite_over_days(spark, events):
    rows = events([(f"2024-01-0{1 + i % 5} 01:00:00", f"ip{i % 3999}", "etc", "INFO")
                   for i in range(20_000)])
    (row,) = ranges.distinct_over(ranges.day_state(rows)).collect()
    assert row["total_logs"] == 20_000
    assert abs(row["unique_ips"] - 4000) <= 3 * ranges.STANDARD_ERROR * 3999
    by_day = ranges.distinct_over(ranges.day_state(rows), F.col("metric_date")).collect()
    assert len(by_day) == 5 and sum(r["unique_ips"] for r in by_day) > 2 * row["unique_ips"]


def test_states_follow_changed_days(spark, events, tmp_path):
    path, out, state = (str(tmp_path / n) for n in ("events", "metrics", "state"))
    first = [("2024-01-01 01:00:00", "a", "etc", "INFO"), ("2024-01-02 01:00:00", "b", "etc", "INFO")]
    for rows in (first, [("2024-01-01 03:00:00", "c", "login failed", "INFO")]):
        keyless = events(rows).withColumns({
            "row_hash": F.lit(None).cast("string"), "ip": F.concat(F.lit("1.1.1."), F.ascii("ip"))})
        tables.upsert_days(spark, path, keyless)
        daily.refresh_metrics(spark, path, out, state=state)
    kept = {str(r["metric_date"]): r["unique_ips"] for r in ranges.distinct_over(
        tables.read_day_states(spark, state), F.col("metric_date")).collect()}
    assert kept == {"2024-01-01": 2, "2024-01-02": 1}

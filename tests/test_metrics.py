"""Daily metrics: decisions on NULL, ties and empty days; skewed input."""

from __future__ import annotations

import collections
import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from authwatch.operators import metrics as mt
from authwatch.operators import report as rp

FAIL, OK = ("login failed", "ERROR"), ("login success", "INFO")


def by_day(df):
    return {str(r["metric_date"]): r for r in df.collect()}


def as_pairs(items):
    return [(i["ip"], i["cnt"]) for i in items]


def test_null_address_and_ties(events):
    rows = ([("2024-01-01 05:00:00", None, *OK)] * 5 + [("2024-01-01 03:00:00", "9.9.9.9", *OK)] * 2
            + [("2024-01-01 04:00:00", ip, *OK) for ip in ("3.3.3.3", "1.1.1.1", "2.2.2.2")]
            + [("2024-01-01 03:00:00", "1.1.1.1", *OK)])
    row = by_day(mt.daily_metrics(events(rows)))["2024-01-01"]
    assert row["unique_ips"] == 4
    assert as_pairs(row["top_ip_list"]) == [("1.1.1.1", 2), ("9.9.9.9", 2), ("2.2.2.2", 1)]
    literal = by_day(mt.daily_metrics(events(rows), count_null_ip=True,
                                      null_before_limit=False))["2024-01-01"]
    assert literal["unique_ips"] == 5
    assert as_pairs(literal["top_ip_list"]) == [("1.1.1.1", 2), ("9.9.9.9", 2)]


def test_earliest_hour_wins_a_tie(events):
    rows = [("2024-01-01 07:00:00", None, *OK), ("2024-01-01 05:00:00", None, *OK)]
    for df in (mt.daily_metrics(events(rows)), mt.peak_hour(events(rows))):
        row = df.first()
        assert (row["peak_hour"], row["peak_hour_logs"]) == (5, 1)


def test_empty_day_gives_zeros(events):
    df = events([("2024-01-01 07:00:00", "1.1.1.1", *FAIL)])
    row = mt.daily_metrics(df, "2024-02-01").first()
    assert row["metric_date"] == dt.date(2024, 2, 1)
    assert (row["total_logs"], row["error_count"], row["unique_ips"]) == (0, 0, 0)
    assert (row["peak_hour"], row["peak_hour_logs"], row["brute_force_ips"]) == (None, 0, 0)
    assert as_pairs(row["top_ip_list"]) == as_pairs(row["top_brute_list"]) == [("N/A", 0)]
    assert mt.daily_metrics(df, "2024-01-01").first()["total_logs"] == 1
    assert mt.daily_metrics(df.limit(0)).count() == 0


def test_failure_types(events):
    df = events([("2024-01-01 07:00:00", "1.1.1.1", *FAIL)] * 10)
    found = mt.daily_metrics(df).first()
    assert found["brute_force_ips"] == 1
    assert as_pairs(found["top_brute_list"]) == [("1.1.1.1", 10)]
    literal = mt.daily_metrics(df, failure_types=("ssh",)).first()
    assert literal["brute_force_ips"] == 0
    assert as_pairs(literal["top_brute_list"]) == [("N/A", 0)]
    assert mt.daily_metrics(df, threshold=11).first()["brute_force_ips"] == 0


def test_untimed_events_belong_to_no_day(events):
    df = events([(None, "1.1.1.1", *FAIL), ("2024-01-01 07:00:00", "1.1.1.1", *FAIL)])
    for result in (mt.daily_metrics(df), mt.total_logs(df), mt.hourly_counts(df),
                   mt.ip_counts(df), mt.unique_ips(df), rp.date_counts(df), rp.daily_summary(df),
                   mt.success_rate(df)):
        assert result.count() == 1


def test_untimed_lines_are_counted_per_source(events):
    df = events([(None, None, *OK), ("2024-01-01 07:00:00", None, *OK)])
    assert mt.untimed_counts(df).first().asDict() == {
        "source_file": "20240101", "total_logs": 2, "untimed_logs": 1}


def test_day_bounds_are_half_open(events):
    df = events([("2024-01-01 23:59:59.900", "1.1.1.1", *OK),
                 ("2024-01-02 00:00:00", "1.1.1.1", *OK)])
    assert mt.daily_metrics(df, "2024-01-01").first()["total_logs"] == 1


def test_report_zone_moves_the_day(events):
    df = events([("2024-01-01 20:00:00", "1.1.1.1", *OK)])
    row = mt.daily_metrics(df, report_tz="Asia/Seoul").first()
    assert (row["metric_date"], row["peak_hour"]) == (dt.date(2024, 1, 2), 5)
    assert mt.daily_metrics(df, "2024-01-02", report_tz="Asia/Seoul").first()["total_logs"] == 1


def plain_metrics(rows, threshold, k):
    """The daily row by plain counting."""
    days = collections.defaultdict(list)
    for row in rows:
        days[row[0][:10]].append(row)
    out = {}
    for day, items in days.items():
        hours = collections.Counter(int(r[0][11:13]) for r in items)
        ips = collections.Counter(r[1] for r in items if r[1])
        failed = collections.Counter(r[1] for r in items
                                     if r[1] and r[2] in ("login failed", "invalid user"))
        suspects = {ip: n for ip, n in failed.items() if n >= threshold}
        peak = max(hours.values())

        def top(counts):
            return sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k] or [("N/A", 0)]

        out[day] = (len(items), sum(r[3] == "ERROR" for r in items), len(ips),
                    min(h for h, n in hours.items() if n == peak), peak, top(ips),
                    len(suspects), top(suspects))
    return out


def spark_metrics(df):
    return {day: (r["total_logs"], r["error_count"], r["unique_ips"], r["peak_hour"],
                  r["peak_hour_logs"], as_pairs(r["top_ip_list"]), r["brute_force_ips"],
                  as_pairs(r["top_brute_list"]))
            for day, r in by_day(df).items()}


@pytest.mark.parametrize("buckets", [1, 7, 256])
def test_skewed_input_equals_plain_counting(events, buckets):
    rng = random.Random(7)
    rows = []
    for n in range(3000):
        day, hour = rng.choice((1, 1, 1, 2, 3)), rng.randrange(24)
        ip = "9.9.9.9" if n % 3 == 0 else rng.choice((None, f"1.1.{rng.randrange(9)}.{rng.randrange(99)}"))
        kind = rng.choice((FAIL, OK, ("invalid user", "WARN")))
        rows.append((f"2024-01-0{day} {hour:02d}:00:00", ip, *kind))
    df = mt.daily_metrics(events(rows), threshold=3, k=5, buckets=buckets)
    assert spark_metrics(df) == plain_metrics(rows, 3, 5)


ROW = st.tuples(
    st.sampled_from(["2024-01-01 00:00:00", "2024-01-01 13:00:00", "2024-01-02 23:59:59"]),
    st.sampled_from([None, "1.1.1.1", "2.2.2.2", "3.3.3.3"]),
    st.sampled_from(["login failed", "invalid user", "etc"]),
    st.sampled_from(["ERROR", "WARN", "INFO"]))


def test_random_input_equals_plain_counting(events):
    @settings(max_examples=8, deadline=None)
    @given(st.lists(ROW, min_size=1, max_size=25))
    def check(rows):
        df = events(rows)
        assert spark_metrics(mt.daily_metrics(df, threshold=2, k=2)) == plain_metrics(rows, 2, 2)
        hourly = sum(r["cnt"] for r in mt.hourly_counts(df).collect())
        assert hourly == len(rows)
        assert sum(r["cnt"] for r in rp.value_counts(df, "ip").collect()) <= len(rows)

    check()


def test_approximate_distinct_is_close(events):
    df = events([("2024-01-01 00:00:00", f"1.1.{n // 250}.{n % 250}", *OK) for n in range(2000)])
    exact = mt.unique_ips(df).first()["unique_ips"]
    approx = mt.unique_ips(df, approx=True).first()["unique_ips"]
    assert exact == 2000 and abs(approx - exact) < 200


def test_report_cube_serves_all_tables(spark, sf_dir):
    from authwatch import corpus

    df = corpus.enriched(spark, sf_dir).cache()
    cube = rp.report_cube(df)
    assert rp.report_summary(cube).first() == rp.auth_report_summary(df).first()
    assert (rp.report_level_distribution(cube).collect()
            == rp.value_counts(df, "log_level").collect())
    assert (rp.report_source_top10(cube).collect()
            == rp.value_counts(df, "source_file", 10).collect())
    df.unpersist()


def test_missing_mail_values_show_as_missing(spark):
    from authwatch.schema import DAILY_METRICS

    empty = spark.createDataFrame(
        [(dt.date(2024, 1, 1), None, None, None, None, None, [], None, [(None, None)], None)],
        DAILY_METRICS)
    rows = {(r["section"], r["position"]): (r["label"], r["display"])
            for r in rp.email_report_rows(empty).collect()}
    assert rows[("summary", 1)] == ("total_logs", "N/A")
    assert rows[("summary", 4)] == ("peak_hour_logs", "N/A (hour N/A)")
    assert rows[("top_brute", 1)] == ("N/A", "N/A")

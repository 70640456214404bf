"""Figures over any range of days from small states kept per day.

A day's state holds sketches that can be united: distinct addresses and users
(HyperLogLog), and its frequent addresses. A range is answered from its days'
states, without a scan for distinct counts, and with one pushed-down scan for
top lists, whose counts are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authwatch.functions import syslog
from authwatch.operators.metrics import count_per, order_by_count, with_day

#: log2 of the registers of a distinct sketch; its relative standard error.
LOG_REGISTERS = 14
STANDARD_ERROR = 1.04 / 2 ** (LOG_REGISTERS / 2)
#: Addresses that a day's state tracks, and candidates that a range checks.
TRACKED, CANDIDATES = 10_000, 100
#: A tracked address is off by at most this share of all counted rows.
ITEM_ERROR = 3.5 * 0.75 / TRACKED


def day_state(df: DataFrame, report_tz: str = "UTC") -> DataFrame:
    """metric_date, timed rows, and the mergeable sketches of the day."""
    return count_per(
        with_day(df, report_tz), ["metric_date"],
        F.hll_sketch_agg("ip", LOG_REGISTERS).alias("ip_sketch"),
        F.hll_sketch_agg(syslog.blank_to_null(F.col("user")), LOG_REGISTERS).alias("user_sketch"),
        F.expr(f"approx_top_k_accumulate(ip, {TRACKED})").alias("ip_items"), name="total_logs")


def distinct_over(state: DataFrame, *by: Column) -> DataFrame:
    """Estimated distinct addresses and users of all days, or per group of days.

    Off by more than three times ``STANDARD_ERROR`` in about one case of 370;
    small numbers are exact.
    """
    def estimate(name):
        return F.hll_sketch_estimate(F.hll_union_agg(name))

    return state.groupBy(*by).agg(
        F.sum("total_logs").alias("total_logs"), estimate("ip_sketch").alias("unique_ips"),
        estimate("user_sketch").alias("unique_users"))


def top_ips_over(state: DataFrame, events: DataFrame, k: int = 3) -> DataFrame:
    """rank, ip, cnt: the ``k`` most frequent addresses of all days of ``state``.

    ``events`` are the rows of these days. The states name candidates, whose rows are
    counted exactly by one filtered scan. An address that is no candidate has at most
    the last candidate's estimate, or the sketch's error; if the ``k``-th count is not
    above that, as with flat counts, all addresses are counted instead.
    """
    combined = F.expr(f"approx_top_k_estimate(approx_top_k_combine(ip_items), {CANDIDATES})")
    found = state.groupBy(F.lit("").alias("range")).agg(F.sum("total_logs").alias("total"),
                                        combined.alias("items")).first()  # none without a day
    total, candidates = (found["total"], found["items"]) if found else (0, [])
    known = events.filter(F.col("ip").isNotNull() & F.col("event_time").isNotNull())
    names = [row["item"] for row in candidates if row["item"] is not None]
    # Fewer candidates than asked for are all that the states track.
    listed = candidates[-1]["count"] if len(candidates) == CANDIDATES else 0
    unseen = max(listed, total * ITEM_ERROR)
    counted = order_by_count(_counts(known.filter(F.col("ip").isin(names))), "cnt", "ip")
    top = [(row["ip"], row["cnt"]) for row in counted.limit(k).collect()]
    if len(top) < k and unseen >= 1 or len(top) == k and top[-1][1] <= unseen:
        top = [(row["ip"], row["cnt"])
               for row in order_by_count(_counts(known), "cnt", "ip").limit(k).collect()]
    ranked = [(n + 1, ip, cnt) for n, (ip, cnt) in enumerate(top)]
    return events.sparkSession.createDataFrame(ranked, "rank int, ip string, cnt long")


def _counts(df: DataFrame) -> DataFrame:
    return df.groupBy("ip").agg(F.count("*").alias("cnt"))

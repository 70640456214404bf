"""Fixed schemas. Nothing in the package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _TS, _L, _I, _D = (T.StringType(), T.TimestampType(), T.LongType(),
                       T.IntegerType(), T.DateType())

LOG_EVENT = _struct(
    ("ingest_time", _TS), ("host_name", _S), ("row_hash", _S), ("event_time", _TS),
    ("source_path", _S), ("source_file", _S), ("message", _S), ("log_type", _S),
)

# Column names below are fixed values: stored tables and messages carry them.
ENRICHED = T.StructType(LOG_EVENT.fields + _struct(
    ("log_level", _S), ("error_type", _S), ("user", _S), ("ip", _S), ("port", _I),
    ("event_time_kst_iso", _TS),
).fields)

# JSON message on the bus. Every field is read as text: times may come as ISO
# text or as epoch numbers. The last five fields may be present; enrichment
# computes them anew.
BUS_EVENT = _struct(
    ("@timestamp", _S), ("host_name", _S), ("row_hash", _S), ("event_time", _S),
    ("event_time_kst_iso", _S), ("source_path", _S), ("source_file", _S),
    ("message", _S), ("log_type", _S), ("log_level", _S), ("error_type", _S),
    ("user", _S), ("ip", _S), ("port", _S),
)
BUS_TIMES = ("@timestamp", "event_time", "event_time_kst_iso")

# What the alerts need of a message.
BUS_FAILURE = _struct(("event_time", _S), ("message", _S))

IP_COUNT = T.ArrayType(_struct(("ip", _S), ("cnt", _L)))

DAILY_METRICS = _struct(
    ("metric_date", _D), ("total_logs", _L), ("error_count", _L), ("unique_ips", _L),
    ("peak_hour", _I), ("peak_hour_logs", _L), ("top_ip_list", IP_COUNT),
    ("brute_force_ips", _L), ("top_brute_list", IP_COUNT), ("created_at", _TS),
)

ALERT = _struct(
    ("window_start", _TS), ("window_end", _TS), ("ip", _S), ("fail_cnt", _L),
    ("detected_at", _TS),
)

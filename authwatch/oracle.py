"""SQL twins of the queries in ``catalog.py``, for DuckDB over ``events``."""

from __future__ import annotations

from authwatch.catalog import (
    ABSENT_DAY, BF_THRESHOLD, BF_WINDOW, DAY, DAY_FROM, DAY_TO, DUMP_ROWS)
from authwatch.corpus import BODY

# The rendered line and its parse, level by level.
CORPUS = f"""
lines AS (
  SELECT event_id, ts, '/data/ssh-' || strftime(ts, '%Y%m%d') || '.log' AS source_path,
         strftime(ts, '%b') || ' ' || lpad(CAST(day(ts) AS VARCHAR), 2, ' ') || ' '
           || strftime(ts, '%H:%M:%S') || ' LabSZ sshd[' || CAST(20000 + user_id AS VARCHAR)
           || ']: ' || {BODY.format(S="VARCHAR")} AS message
  FROM events),
stems AS (
  SELECT *, regexp_extract(source_path, 'ssh-([0-9]+)[.]log', 1) AS source_file,
         nullif(regexp_extract(message, '[A-Z][a-z]{{2}} +[0-9]+ [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}'), '')
           AS log_time
  FROM lines),
timed AS (
  SELECT *, try_strptime(substr(source_file, 1, 4) || ' '
                         || regexp_replace(log_time, ' +', ' ', 'g'), '%Y %b %d %H:%M:%S')
              AS event_time
  FROM stems),
logs AS (
  SELECT event_id, ts + INTERVAL 5 SECOND AS ingest_time, 'LabSZ' AS host_name,
         sha256(concat_ws(':', source_path, CAST(event_time AS VARCHAR), message)) AS row_hash,
         event_time, source_path, source_file, message, 'ssh' AS log_type
  FROM timed),
enriched AS (
  SELECT *,
    CASE WHEN lower(message) LIKE '%failed%' THEN 'ERROR'
         WHEN lower(message) LIKE '%invalid%' THEN 'WARN' ELSE 'INFO' END AS log_level,
    CASE WHEN lower(message) LIKE '%failed password%' THEN 'login failed'
         WHEN lower(message) LIKE '%invalid user%' THEN 'invalid user'
         WHEN lower(message) LIKE '%accepted password%' THEN 'login success'
         WHEN lower(message) LIKE '%connection closed%' THEN 'connection closed'
         ELSE 'etc' END AS error_type,
    CASE WHEN message LIKE '%Failed password%' THEN 'Failed password'
         WHEN message LIKE '%Accepted password%' THEN 'Accepted password'
         WHEN message LIKE '%Invalid user%' THEN 'Invalid user'
         WHEN message LIKE '%Connection closed%' THEN 'Connection closed'
         WHEN message LIKE '%session opened%' THEN 'Session opened'
         WHEN message LIKE '%session closed%' THEN 'Session closed'
         ELSE 'Other' END AS pattern,
    regexp_extract(message, 'user ([^ ]+)', 1) AS "user",
    nullif(regexp_extract(message, 'from ([0-9.]+)', 1), '') AS ip,
    TRY_CAST(nullif(regexp_extract(message, 'port ([0-9]+)', 1), '') AS INTEGER) AS port,
    CAST(event_time AS DATE) AS event_date, CAST(hour(event_time) AS INTEGER) AS hour
  FROM logs)"""

LOG_FIELDS = ("ingest_time, host_name, row_hash, event_time, source_path, source_file, "
              "message, log_type")
ENRICHED_FIELDS = (LOG_FIELDS + ', log_level, error_type, "user", ip, port, '
                   "event_time AS event_time_kst_iso")
FAILED = "error_type IN ('login failed', 'invalid user') AND ip IS NOT NULL"
KST_TEXT = "strftime({} + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S.%g+09:00')"
RANGE = f"event_date BETWEEN DATE '{DAY_FROM}' AND DATE '{DAY_TO}'"
NO_TOP = """'[{"ip":"N/A","cnt":0}]'"""
REPORT_COUNTS = """
  count(*) FILTER (WHERE message LIKE '%Failed password%') AS failed_login_attempts,
  count(*) FILTER (WHERE message LIKE '%Accepted password%') AS successful_logins,
  count(*) FILTER (WHERE message LIKE '%Invalid user%') AS invalid_users,
  count(*) FILTER (WHERE message LIKE '%Connection closed%') AS connection_closed,
  count(*) FILTER (WHERE message LIKE '%session opened%') AS sessions_opened,
  count(*) FILTER (WHERE message LIKE '%session closed%') AS sessions_closed"""
WINDOWED = f"""SELECT time_bucket(INTERVAL '{BF_WINDOW}', event_time) AS window_start,
  time_bucket(INTERVAL '{BF_WINDOW}', event_time) + INTERVAL '{BF_WINDOW}' AS window_end,
  ip, count(*) AS fail_cnt
  FROM enriched WHERE {FAILED} GROUP BY ALL HAVING count(*) >= {BF_THRESHOLD}"""
# Newest delivery per key, where ERROR events came again an hour later.
REDELIVERED = """deliveries AS (
  SELECT row_hash, host_name, ingest_time, event_time, event_date, message FROM enriched
  UNION ALL
  SELECT row_hash, 'replay', ingest_time + INTERVAL 1 HOUR, event_time, event_date, message
  FROM enriched WHERE {again}),
newest AS (
  SELECT * FROM deliveries
  QUALIFY row_number() OVER (PARTITION BY row_hash ORDER BY ingest_time DESC) = 1)"""
ERRORS_AGAIN = REDELIVERED.format(again="log_level = 'ERROR'")
ERROR_EVENTS_AGAIN = REDELIVERED.format(
    again="event_id IN (SELECT event_id FROM events WHERE event_type = 'error')")
FILE_NAME = "'ssh-' || strftime(event_time, '%Y%m%d') || '.log'"
CAPPED = f"""capped AS (
  SELECT {FILE_NAME} AS file_name, event_id, message FROM enriched
  QUALIFY row_number() OVER (PARTITION BY event_date ORDER BY event_id) <= 100)"""


def sql(select: str, *more: str) -> str:
    return "WITH " + ",\n".join((CORPUS.strip(), *more)) + "\n" + select


def metrics_ctes(shift: str = "", null_counts: bool = False, null_competes: bool = False,
                 failed: str = FAILED) -> str:
    """Daily metrics, written level by level, ending in the CTE ``metrics``."""
    t = f"(event_time{shift})"
    first = "c DESC, ip NULLS FIRST" if null_competes else "ip IS NULL, c DESC, ip"
    distinct = "count(DISTINCT ip)" + (" + CAST(bool_or(ip IS NULL) AS INTEGER)" if null_counts else "")
    return f"""days AS (
  SELECT CAST({t} AS DATE) AS metric_date, count(*) AS total_logs,
         count(*) FILTER (WHERE log_level = 'ERROR') AS error_count, {distinct} AS unique_ips
  FROM enriched GROUP BY 1),
per_hour AS (
  SELECT CAST({t} AS DATE) AS metric_date, CAST(hour({t}) AS INTEGER) AS peak_hour,
         count(*) AS peak_hour_logs FROM enriched GROUP BY 1, 2),
hours AS (
  SELECT * FROM per_hour QUALIFY row_number() OVER (
    PARTITION BY metric_date ORDER BY peak_hour_logs DESC, peak_hour) = 1),
ips AS (
  SELECT CAST({t} AS DATE) AS metric_date, ip, count(*) AS c,
         count(*) FILTER (WHERE {failed}) AS f FROM enriched GROUP BY 1, 2),
tops AS (
  SELECT metric_date, ip, c, row_number() OVER (PARTITION BY metric_date ORDER BY {first}) AS rn
  FROM ips),
top_lists AS (
  SELECT metric_date, '[' || string_agg('{{"ip":"' || ip || '","cnt":' || c || '}}', ','
                                        ORDER BY rn) || ']' AS top_ip_list
  FROM tops WHERE rn <= 3 AND ip IS NOT NULL GROUP BY 1),
suspects AS (
  SELECT metric_date, ip, f, row_number() OVER (PARTITION BY metric_date ORDER BY f DESC, ip) AS rn
  FROM ips WHERE f >= 10),
brute_lists AS (
  SELECT metric_date, count(*) AS n, '[' || string_agg(
           '{{"ip":"' || ip || '","cnt":' || f || '}}', ',' ORDER BY rn) FILTER (WHERE rn <= 3)
           || ']' AS top_brute_list
  FROM suspects GROUP BY 1),
metrics AS (
  SELECT metric_date, total_logs, error_count, CAST(unique_ips AS BIGINT) AS unique_ips,
         peak_hour, peak_hour_logs, coalesce(top_ip_list, {NO_TOP}) AS top_ip_list,
         coalesce(n, 0) AS brute_force_ips, coalesce(top_brute_list, {NO_TOP}) AS top_brute_list
  FROM days LEFT JOIN hours USING (metric_date) LEFT JOIN top_lists USING (metric_date)
       LEFT JOIN brute_lists USING (metric_date))"""


def value_counts(col: str, where: str = "true") -> str:
    return (f"SELECT {col} AS value, count(*) AS cnt FROM enriched "
            f"WHERE {where} AND {col} IS NOT NULL GROUP BY 1")


def top10(col: str, where: str = "true") -> str:
    return (f"SELECT value, cnt, row_number() OVER (ORDER BY cnt DESC, value)::INTEGER AS rank "
            f"FROM ({value_counts(col, where)}) QUALIFY rank <= 10")


METRICS = metrics_ctes()
SUMMARY_UNPIVOT = f"""SELECT metric, value FROM (
  UNPIVOT (SELECT count(*) AS total_records, count(DISTINCT source_file) AS unique_sources,
           {REPORT_COUNTS} FROM enriched WHERE {{where}})
  ON COLUMNS(*) INTO NAME metric VALUE value)"""

ORACLES = {
    # sources and sinks
    "read_log_files": sql("SELECT 'ssh-' || source_file || '.log' AS source_path, source_file, "
                          "message FROM logs"),
    "stream_log_files": sql("SELECT source_file, message FROM logs"),
    "finished_files": sql("SELECT DISTINCT 'ssh-' || source_file || '.log' AS source_path FROM logs"),
    "read_event_bus": sql("SELECT row_hash, message FROM logs"),
    "write_event_bus": sql(f"SELECT {LOG_FIELDS} FROM logs"),
    "read_events_table": sql(f"SELECT event_date, {ENRICHED_FIELDS.removeprefix('ingest_time, ')} "
                             f"FROM enriched WHERE {RANGE}"),
    "upsert_events": sql("SELECT row_hash, host_name, ingest_time, event_time, message FROM newest",
                         ERRORS_AGAIN),
    "upsert_events_table": sql("SELECT event_date, row_hash, host_name, ingest_time FROM newest",
                               ERRORS_AGAIN),
    "snapshot_read": sql("""
        SELECT 'before' AS seen, event_date, row_hash, host_name, ingest_time FROM enriched
        UNION ALL SELECT 'after', event_date, row_hash, host_name, ingest_time FROM newest""",
                         ERRORS_AGAIN),
    "line_numbers": sql("""
        SELECT source_file, message, row_number() OVER (
          PARTITION BY source_file ORDER BY event_id) AS line_number FROM logs"""),
    "schema_rejects": sql("""
        SELECT reason, cnt FROM (UNPIVOT (
          SELECT count(*) AS total_rows,
                 count(*) FILTER (WHERE error_type = 'login success' AND ip IS NOT NULL) AS bad_ip,
                 count(*) FILTER (WHERE port IS NULL) AS bad_port,
                 count(*) FILTER (WHERE log_level = 'WARN') AS bad_time,
                 count(*) FILTER (WHERE error_type = 'connection closed') AS keyless
          FROM enriched) ON COLUMNS(*) INTO NAME reason VALUE cnt)"""),
    "unique_ips_range": sql("""
        SELECT CAST(date_trunc('week', event_date) AS DATE) AS week, count(*) AS total_logs,
               count(DISTINCT ip) AS unique_ips, true AS users_in_band
        FROM enriched GROUP BY 1"""),
    "top_ips_range": sql(f"""
        SELECT row_number() OVER (ORDER BY count(*) DESC, ip)::INTEGER AS rank, ip,
               count(*) AS cnt
        FROM enriched WHERE {RANGE} AND ip IS NOT NULL GROUP BY ip QUALIFY rank <= 3"""),
    "late_day_metrics": sql("SELECT * FROM metrics", METRICS),
    "compact_live": sql("SELECT event_date, row_hash, host_name, ingest_time FROM newest",
                        ERROR_EVENTS_AGAIN),
    "write_daily_metrics": sql("SELECT * FROM metrics", METRICS),
    "alert_sink": sql("SELECT window_start, ip, 'IP: ' || ip || '  failures: ' || fail_cnt "
                      f"AS body_line FROM ({WINDOWED})"),
    "enforce_event_schema": sql("""SELECT row_hash, event_time, log_level, error_type, "user",
        CASE WHEN error_type <> 'login success' THEN ip END AS ip, port FROM enriched"""),
    "split_by_date": sql("""
        SELECT CASE WHEN event_id % 50 = 1 THEN 'ssh-20240230.log'
                    WHEN event_id % 50 > 2 THEN 'ssh-' || strftime(ts, '%Y%m%d') || '.log'
               END AS file_name, count(*) AS n_lines FROM lines GROUP BY 1"""),
    "split_left_out": sql(f"""
        SELECT {FILE_NAME} AS file_name, count(*) AS n_lines,
               greatest(count(*) - 100, 0) AS n_left_out FROM enriched GROUP BY 1"""),
    "dump_counts": sql(f"SELECT count(*) AS total_rows, greatest(count(*) - {DUMP_ROWS}, 0) "
                       "AS left_out FROM enriched"),
    "split_by_date_capped": sql("SELECT * FROM capped", CAPPED),
    "split_counts": sql("SELECT file_name, count(*) AS n_lines FROM capped GROUP BY 1", CAPPED),
    "capped_dump": sql("SELECT row_hash, event_time, message FROM logs "
                       f"ORDER BY event_time NULLS FIRST, row_hash LIMIT {DUMP_ROWS}"),
    # parsing
    "add_provenance": sql("SELECT event_id, source_path, 'LabSZ' AS host_name, 'ssh' AS log_type "
                          "FROM lines"),
    "source_file_name": sql("SELECT event_id, source_path, source_file FROM stems"),
    "parse_syslog_time": sql("""
        SELECT event_id, CASE WHEN event_id % 50 = 1 THEN 'Feb 30' || substr(message, 7, 9)
                              WHEN event_id % 50 > 2 THEN substr(message, 1, 15) END AS log_time
        FROM lines"""),
    "parse_syslog_header": sql(r"""
        SELECT event_id, substr(message, 1, 15) AS logdate,
               string_split(substr(message, 17), ' ')[1] AS host,
               regexp_extract(message, '^.{15} [^ ]+ ([^[]+)', 1) AS process,
               regexp_extract(message, '[[]([0-9]+)[]]:', 1) AS pid,
               regexp_extract(message, '[]]: (.*)$', 1) AS msg FROM lines"""),
    "year_from_file": sql("SELECT event_id, strftime(ts, '%Y') AS log_year FROM lines"),
    "event_time": sql("SELECT event_id, date_trunc('second', ts) AS event_time, "
                      f"{KST_TEXT.format('event_time')} AS event_time_kst_iso FROM timed"),
    "event_time_log_tz": sql("SELECT event_id, event_time - INTERVAL 9 HOUR AS event_time, "
                             "strftime(event_time, '%Y-%m-%dT%H:%M:%S.%g+09:00') "
                             "AS event_time_kst_iso FROM timed"),
    "row_hash": sql("SELECT event_id, row_hash FROM logs"),
    "row_hash_message": sql("SELECT event_id, sha256(message) AS row_hash FROM logs"),
    "parse_lines": sql(f"SELECT {LOG_FIELDS} FROM logs"),
    "ingest_messages": sql("SELECT host_name, event_time, source_file, message, log_type FROM logs"),
    # decoding and enrichment
    "decode_event_json": sql(f"""
        SELECT ingest_time, row_hash, event_time, event_time AS event_time_kst_iso, source_file,
               message FROM logs WHERE message NOT LIKE '%Received disconnect%'"""),
    "decode_event_json_literal": sql("""
        SELECT CASE WHEN keyless THEN 'INFO' ELSE log_level END AS log_level,
               CASE WHEN keyless THEN 'etc' ELSE error_type END AS error_type, keyless,
               count(*) AS cnt
        FROM (SELECT *, message LIKE '%Received disconnect%' AS keyless FROM enriched)
        GROUP BY ALL"""),
    "malformed_events": sql("SELECT 'not json: ' || row_hash AS _corrupt FROM logs "
                            "WHERE message LIKE '%Received disconnect%'"),
    "normalise_timestamps": sql("SELECT event_id, CASE WHEN message NOT LIKE '%Invalid user%' "
                                "THEN ts END AS event_time FROM lines"),
    "classify_log_level": sql("SELECT event_id, log_level FROM enriched"),
    "classify_error_type": sql("SELECT event_id, error_type FROM enriched"),
    "extract_user": sql('SELECT event_id, "user" FROM enriched'),
    "extract_ip": sql("SELECT event_id, ip FROM enriched"),
    "extract_port": sql("SELECT event_id, port FROM enriched"),
    "enrich": sql(f"SELECT {ENRICHED_FIELDS} FROM enriched"),
    "epoch_to_timestamp": sql("""
        SELECT event_id, CASE WHEN event_id % 2 = 0 THEN date_trunc('millisecond', ts)
                              ELSE date_trunc('second', ts) END AS mixed,
               date_trunc('second', ts) AS millis, ts AS text,
               make_timestamp(event_id // 1000) AS nanos FROM lines"""),
    "fill_defaults": sql("""SELECT row_hash, CASE log_level WHEN 'WARN' THEN 'INFO'
        ELSE log_level END AS log_level,
        CASE error_type WHEN 'etc' THEN '' ELSE message END AS message FROM enriched"""),
    "hour_of_day": sql("SELECT row_hash, hour FROM enriched"),
    "classify_message_pattern": sql("SELECT event_id, pattern FROM enriched"),
    "format_metric": sql("SELECT event_date AS metric_date, format('{:,}', count(*)) AS total_logs, "
                         "format('{:,}', count(*) * 12345) AS big, 'N/A' AS missing "
                         "FROM enriched GROUP BY 1"),
    "alert_text": sql("SELECT window_start, 'IP: ' || ip || '  failures: ' || fail_cnt "
                      f"AS body_line FROM ({WINDOWED})"),
    # filters
    "failed_logins": sql(f"SELECT row_hash, error_type, ip FROM enriched WHERE {FAILED}"),
    "daily_filter": sql(f"SELECT row_hash, event_time FROM enriched WHERE event_date = DATE '{DAY}'"),
    "level_filter": sql("SELECT row_hash, message FROM enriched WHERE log_level = 'ERROR'"),
    "message_contains": sql("SELECT row_hash, message FROM logs "
                            "WHERE contains(message, 'Failed password')"),
    "metric_lookup": sql(f"SELECT * FROM metrics WHERE metric_date = DATE '{DAY}'", METRICS),
    "having_threshold": sql("SELECT event_date AS metric_date, hour, count(*) AS cnt "
                            "FROM enriched GROUP BY 1, 2 HAVING count(*) >= 15"),
    # metrics
    "total_logs": sql("SELECT metric_date, total_logs FROM metrics", METRICS),
    "error_count": sql("SELECT metric_date, error_count FROM metrics", METRICS),
    "unique_ips": sql("SELECT metric_date, unique_ips FROM metrics", METRICS),
    "unique_ips_null_counts": sql("SELECT metric_date, unique_ips FROM metrics",
                                  metrics_ctes(null_counts=True)),
    "unique_sources": sql("""
        SELECT event_date AS metric_date, least(3, count(DISTINCT message)) AS unique_sources
        FROM enriched GROUP BY 1"""),
    "hourly_counts": sql("SELECT event_date AS metric_date, hour, count(*) AS cnt "
                         "FROM enriched GROUP BY 1, 2"),
    "peak_hour": sql("SELECT metric_date, peak_hour, peak_hour_logs FROM metrics", METRICS),
    "ip_counts": sql("SELECT metric_date, ip, c AS cnt FROM ips", METRICS),
    "order_by_count": sql("""SELECT metric_date, ip, c AS cnt, row_number() OVER (
        ORDER BY c DESC, metric_date, ip NULLS FIRST)::INTEGER AS rank FROM ips""", METRICS),
    "top_k": sql("""SELECT *, row_number() OVER (
          ORDER BY cnt DESC, metric_date, hour)::INTEGER AS rank
        FROM (SELECT event_date AS metric_date, hour, count(*) AS cnt FROM enriched GROUP BY 1, 2)
        QUALIFY rank <= 3"""),
    "untimed_counts": sql("""
        SELECT strftime(ts, '%Y%m%d') AS source_file, count(*) AS total_logs,
               count(*) FILTER (WHERE event_id % 50 <= 2) AS untimed_logs
        FROM lines GROUP BY 1"""),
    "top_ips": sql("SELECT metric_date, rn::INTEGER AS rank, ip, c AS cnt FROM tops "
                   "WHERE rn <= 3 AND ip IS NOT NULL", METRICS),
    "top_ips_null_competes": sql("SELECT metric_date, rn::INTEGER AS rank, ip, c AS cnt FROM tops "
                                 "WHERE rn <= 3 AND ip IS NOT NULL",
                                 metrics_ctes(null_competes=True)),
    "brute_force_daily": sql("SELECT metric_date, ip, f AS fail_cnt FROM suspects", METRICS),
    "brute_force_top": sql("SELECT metric_date, rn::INTEGER AS rank, ip, f AS fail_cnt "
                           "FROM suspects WHERE rn <= 3", METRICS),
    "brute_force_windowed": sql(WINDOWED),
    "nested_top_list": sql("SELECT metric_date, rn::INTEGER AS rank, ip, c AS cnt FROM tops "
                           "WHERE rn <= 3 AND ip IS NOT NULL", METRICS),
    "daily_metrics": sql("SELECT * FROM metrics", METRICS),
    "daily_metrics_kst": sql("SELECT * FROM metrics", metrics_ctes(shift=" + INTERVAL 9 HOUR")),
    "daily_metrics_literal": sql("SELECT * FROM metrics", metrics_ctes(
        null_counts=True, null_competes=True, failed="error_type = 'ssh'")),
    "daily_metrics_one_day": sql(f"SELECT * FROM metrics WHERE metric_date = DATE '{DAY}'", METRICS),
    "success_rate": sql("""
        SELECT event_date AS metric_date, count(*) AS total_logs,
               count(*) FILTER (WHERE log_level = 'ERROR') AS error_count,
               count(DISTINCT nullif("user", '')) AS unique_users,
               round(100.0 * count(*) FILTER (WHERE log_level <> 'ERROR')::DOUBLE / count(*), 2)
                 AS success_rate
        FROM enriched GROUP BY 1"""),
    # report
    "level_counts": sql(value_counts("log_level")),
    "source_counts_top10": sql(top10("source_file")),
    "pattern_counts": sql(value_counts("pattern")),
    "date_counts": sql("SELECT event_date, count(*) AS cnt FROM enriched GROUP BY 1"),
    "daily_summary": sql("""
        SELECT event_date AS date, count(*) AS total_records,
               count(DISTINCT source_file) AS unique_sources,
               count(*) FILTER (WHERE log_level = 'ERROR') AS error_count,
               count(*) FILTER (WHERE log_level = 'WARN') AS warning_count,
               count(*) FILTER (WHERE log_level = 'INFO') AS info_count
        FROM enriched GROUP BY 1"""),
    "auth_report_summary": sql("SELECT count(*) AS total_records, count(DISTINCT source_file) "
                               f"AS unique_sources, {REPORT_COUNTS} FROM enriched"),
    "report_cube": sql(f"""
        SELECT event_date, hour, log_level AS level, source_file AS source, pattern,
               count(*) AS cnt, {REPORT_COUNTS} FROM enriched GROUP BY 1, 2, 3, 4, 5"""),
    "report_level_distribution": sql(value_counts("log_level")),
    "report_hourly_trend": sql("SELECT hour, count(*) AS cnt FROM enriched GROUP BY 1"),
    "report_source_top10": sql(top10("source_file")),
    "report_pattern_distribution": sql(value_counts("pattern")),
    "report_summary_rows": sql(SUMMARY_UNPIVOT.format(where="true")),
    "report_detail_rows": sql("SELECT row_hash, event_time, source_file, message, log_level "
                              f"FROM enriched WHERE {RANGE}"),
    "daily_report": sql(f"""
        SELECT 'summary' AS part, metric AS label, value
          FROM ({SUMMARY_UNPIVOT.format(where=RANGE)})
        UNION ALL SELECT 'level_distribution', value, cnt FROM ({value_counts("log_level", RANGE)})
        UNION ALL SELECT 'source_top10', value, cnt FROM ({top10("source_file", RANGE)})
        UNION ALL SELECT 'source_counts', value, cnt FROM ({value_counts("source_file", RANGE)})
        UNION ALL SELECT 'pattern_distribution', value, cnt FROM ({value_counts("pattern", RANGE)})
        UNION ALL SELECT 'hourly_trend', CAST(hour AS VARCHAR), count(*) FROM enriched
          WHERE {RANGE} GROUP BY hour"""),
    "email_report_rows": sql("""
        SELECT metric_date, 'summary' AS section, 1 AS position, 'total_logs' AS label,
               format('{:,}', total_logs) AS display FROM metrics
        UNION ALL SELECT metric_date, 'summary', 2, 'error_count', format('{:,}', error_count)
          FROM metrics
        UNION ALL SELECT metric_date, 'summary', 3, 'unique_ips', format('{:,}', unique_ips)
          FROM metrics
        UNION ALL SELECT metric_date, 'summary', 4, 'peak_hour_logs',
          format('{:,}', peak_hour_logs) || ' (hour ' || peak_hour || ')' FROM metrics
        UNION ALL SELECT metric_date, 'summary', 5, 'brute_force_ips',
          format('{:,}', brute_force_ips) FROM metrics
        UNION ALL SELECT metric_date, 'top_ip', rn::INTEGER, ip, format('{:,}', c)
          FROM tops WHERE rn <= 3 AND ip IS NOT NULL
        UNION ALL SELECT metric_date, 'top_brute', rn::INTEGER, ip, format('{:,}', f)
          FROM suspects WHERE rn <= 3
        UNION ALL SELECT metric_date, 'top_brute', 1, 'N/A', '0' FROM metrics
          WHERE brute_force_ips = 0
        UNION ALL SELECT DATE '""" + ABSENT_DAY + """', section, position, label, display FROM (VALUES
          ('summary', 1, 'total_logs', 'N/A'), ('summary', 2, 'error_count', 'N/A'),
          ('summary', 3, 'unique_ips', 'N/A'), ('summary', 4, 'peak_hour_logs', 'N/A (hour N/A)'),
          ('summary', 5, 'brute_force_ips', 'N/A'), ('top_ip', 1, 'N/A', 'N/A'),
          ('top_brute', 1, 'N/A', 'N/A')) AS absent(section, position, label, display)""", METRICS),
    # streaming
    "stream_enrich": sql(f"SELECT {ENRICHED_FIELDS} FROM enriched"),
    "stream_upsert": sql("SELECT event_date, row_hash, host_name, ingest_time FROM newest",
                         ERROR_EVENTS_AGAIN),
    "stream_dedup": sql("SELECT DISTINCT row_hash, message FROM logs"),
    "stream_bruteforce": sql(WINDOWED),
    "stream_bruteforce_final": sql(f"""
        SELECT * FROM ({WINDOWED}) WHERE window_end <= (
          SELECT max(event_time) - INTERVAL 1 MINUTE FROM enriched WHERE {FAILED})"""),
    "keyless_events": sql(f"""
        SELECT event_date AS metric_date, count(DISTINCT row_hash) AS keys,
               CAST(coalesce(any_value(f), 0) AS BIGINT) AS failures
        FROM enriched LEFT JOIN (
          SELECT CAST(window_start AS DATE) AS event_date, sum(fail_cnt) AS f
          FROM ({WINDOWED}) GROUP BY 1) USING (event_date) GROUP BY 1"""),
    "numeric_times": sql("""
        SELECT CAST(event_id AS VARCHAR) AS row_hash, message,
               CASE WHEN event_id % 2 = 0 THEN date_trunc('millisecond', ts)
                    ELSE date_trunc('second', ts) END AS event_time FROM lines"""),
    # Whatever of the first half comes late is not counted.
    "late_data": sql(WINDOWED.replace("FROM enriched", f"""FROM (
        SELECT enriched.* FROM enriched JOIN lines USING (event_id)
        WHERE ts >= TIMESTAMP '{DAY}' OR event_id % 10 <> 0)""")),
    "rate_limit": sql("SELECT true AS bounded, count(*) AS total_logs FROM logs"),
    "checkpoint_restart": sql(f"""
        SELECT event_date AS metric_date, count(*) AS total_logs,
               CAST(coalesce(any_value(f), 0) AS BIGINT) AS failures
        FROM enriched LEFT JOIN (
          SELECT CAST(window_start AS DATE) AS event_date, sum(fail_cnt) AS f
          FROM ({WINDOWED}) GROUP BY 1) USING (event_date) GROUP BY 1"""),
    "multi_query": sql(f"""
        SELECT event_date AS metric_date, count(DISTINCT row_hash) AS total_logs,
               coalesce(any_value(alerts), 0) AS alerts
        FROM enriched LEFT JOIN (
          SELECT CAST(window_start AS DATE) AS event_date, count(*) AS alerts
          FROM ({WINDOWED}) GROUP BY 1) USING (event_date)
        GROUP BY 1"""),
    "settle_days": sql("SELECT event_date, row_hash, host_name, ingest_time FROM newest",
                       ERROR_EVENTS_AGAIN),
}

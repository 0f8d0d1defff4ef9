"""Oracle SQL (DuckDB dialect) for the registered queries.

Each statement recomputes the query from the ``events`` view with plain SQL:
row_number for first arrivals, an interval RANGE frame for the trailing mean,
an unpartitioned running max for late rows. It is deliberately the simple
single-node formulation, so it checks the distributed plans of ``queries``.
"""

from __future__ import annotations

TS_FMT = "%Y-%m-%d %H:%M:%S"


def raw_ctes(late: bool = True, batch_rows: int = 20, late_unit: str = "minutes",
             batch_sql: str | None = None) -> list[str]:
    """Planted readings; ``batch_sql`` re-defines ``batch_id`` of the result (e.g. staged file index)."""
    batch_replace = f"* REPLACE (({batch_sql}) AS batch_id)" if batch_sql else "*"
    shift = "to_minutes" if late_unit == "minutes" else "to_days"
    late_case = (f"WHEN bucket IN (20, 40, 60) THEN strftime(ts - {shift}(CAST(6 + batch_id % 10 AS INTEGER)), "
                 f"'{TS_FMT}') ") if late else ""
    return [
        f"""base AS (
  SELECT event_id, event_id // {batch_rows} AS batch_id, event_id % 100 AS bucket, ts,
         'sensor_' || CAST(user_id % 10 + 1 AS VARCHAR) AS sensor_id,
         value / 5 AS temperature0,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity,
         event_type AS status
  FROM events)""",
        f"""faulted AS (
  SELECT event_id, batch_id, bucket, sensor_id,
         CASE WHEN bucket IN (5, 6) THEN 'NOT_A_TIMESTAMP' {late_case}
              ELSE strftime(ts, '{TS_FMT}') END AS timestamp,
         CASE WHEN bucket IN (0, 1, 2) THEN NULL
              WHEN bucket IN (3, 4) THEN CAST([-50.0, 150.0, -25.5, 120.0][event_id % 4 + 1] AS DOUBLE)
              ELSE temperature0 END AS temperature,
         humidity, status
  FROM base)""",
        """copies AS (
  SELECT t.event_id, t.batch_id, s.sensor_id, s.timestamp, s.temperature, s.humidity, s.status
  FROM faulted t JOIN faulted s ON s.event_id = t.event_id - (t.bucket - 9) AND s.bucket = 9
  WHERE t.bucket IN (10, 11))""",
        """raw AS (
  SELECT *, CAST(CAST(('0x' || substr(md5(sensor_id), 1, 8)) AS UBIGINT) % 3 AS INTEGER) AS partition
  FROM (SELECT event_id, batch_id, sensor_id, timestamp, temperature, humidity, status
        FROM faulted WHERE bucket NOT IN (10, 11)
        UNION ALL SELECT * FROM copies))""",
        f"""parsed AS (SELECT {batch_replace}, try_strptime(timestamp, '{TS_FMT}') AS event_time FROM raw)""",
    ]


def annot_ctes(width: int = 300, arrival: str = "event_id", by_batch: bool = False, feedback: bool = False) -> list[str]:
    """Outcome per row. ``by_batch``: history holds what had arrived (batches up to the row's own); ``feedback``: and fills."""
    imp = f"""imp AS (
  SELECT *, CASE WHEN need_ THEN avg(CASE WHEN use_ THEN temperature END) OVER (
      PARTITION BY sensor_id ORDER BY event_time
      RANGE BETWEEN INTERVAL {int(width)} SECOND PRECEDING AND CURRENT ROW) END AS imputed
  FROM flags)"""
    if by_batch:
        imp = f"""imp AS (
  SELECT f.*, h.mean AS imputed FROM flags f LEFT JOIN (
    SELECT n.event_id, avg(u.temperature) AS mean FROM flags n JOIN flags u ON u.use_ AND u.sensor_id = n.sensor_id AND u.batch_id <= n.batch_id
      AND u.event_time BETWEEN n.event_time - INTERVAL {int(width)} SECOND AND n.event_time
    WHERE n.need_ GROUP BY n.event_id) h ON f.event_id = h.event_id)"""
    if feedback:
        # one missing row of each sensor per step, in time order; its window holds observed values and earlier fills
        imp = f"""needs AS (
  SELECT event_id, sensor_id, event_time, row_number() OVER (PARTITION BY sensor_id ORDER BY event_time) AS k FROM flags WHERE need_),
seen AS (
  SELECT n.*, coalesce(s.total, 0) AS total, coalesce(s.n, 0) AS n FROM needs n LEFT JOIN (
    SELECT n.event_id, sum(u.temperature) AS total, count(*) AS n FROM needs n JOIN flags u ON u.use_ AND u.sensor_id = n.sensor_id
      AND u.event_time >= n.event_time - INTERVAL {int(width)} SECOND AND u.event_time < n.event_time GROUP BY n.event_id) s ON n.event_id = s.event_id),
fills AS (
  SELECT sensor_id, k, event_id, CASE WHEN n > 0 THEN total / n END AS value,
    CASE WHEN n > 0 THEN [{{'t': event_time, 'v': total / n}}] ELSE [] END AS past FROM seen WHERE k = 1
  UNION ALL
  SELECT sensor_id, k, event_id, value, CASE WHEN value IS NULL THEN past ELSE list_append(past, {{'t': event_time, 'v': value}}) END FROM (
    SELECT s.sensor_id, s.k, s.event_id, s.event_time, [x for x in f.past if x.t >= s.event_time - INTERVAL {int(width)} SECOND] AS past,
      CASE WHEN s.n + len([x for x in f.past if x.t >= s.event_time - INTERVAL {int(width)} SECOND]) > 0
        THEN (s.total + coalesce(list_sum([x.v for x in f.past if x.t >= s.event_time - INTERVAL {int(width)} SECOND]), 0))
          / (s.n + len([x for x in f.past if x.t >= s.event_time - INTERVAL {int(width)} SECOND])) END AS value
    FROM fills f JOIN seen s ON s.sensor_id = f.sensor_id AND s.k = f.k + 1)),
imp AS (SELECT g.*, f.value AS imputed FROM flags g LEFT JOIN fills f ON g.event_id = f.event_id)"""
    return [
        f"""firsts AS (
  SELECT *, row_number() OVER (PARTITION BY sensor_id, timestamp ORDER BY {arrival}) = 1 AS is_first
  FROM parsed)""",
        """flags AS (
  SELECT *,
    is_first AND event_time IS NOT NULL AND temperature IS NOT NULL
      AND temperature BETWEEN -20 AND 100 AND NOT isnan(temperature) AS use_,
    is_first AND event_time IS NOT NULL AND temperature IS NULL AS need_
  FROM firsts)""",
        imp,
        """annot AS (
  SELECT *,
    CASE WHEN NOT is_first THEN 'duplicate'
         WHEN event_time IS NULL THEN 'bad_timestamp'
         WHEN coalesce(temperature, imputed) IS NULL THEN 'no_history'
         WHEN NOT (coalesce(temperature, imputed) BETWEEN -20 AND 100)
              OR isnan(coalesce(temperature, imputed)) THEN 'out_of_range'
         ELSE 'kept' END AS outcome,
    temperature IS NULL AND imputed IS NOT NULL AS temp_corrected,
    coalesce(temperature, imputed) AS temp_filled
  FROM imp)""",
    ]


CLEAN_CTES = [
    "kept AS (SELECT * FROM annot WHERE outcome = 'kept')",
    "bmax AS (SELECT batch_id, max(event_time) AS bmax FROM kept GROUP BY batch_id)",
    """prevmax AS (
  SELECT batch_id, max(bmax) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max
  FROM bmax)""",
    """lated AS (
  SELECT k.*, p.prev_max, (p.prev_max IS NOT NULL AND k.event_time < p.prev_max) AS is_late
  FROM kept k LEFT JOIN prevmax p ON k.batch_id = p.batch_id)""",
    """clean AS (
  SELECT event_id, batch_id, sensor_id, event_time, temp_filled AS temperature, humidity, status,
    CAST(hour(event_time) AS BIGINT) AS hour_of_day,
    CAST(isodow(event_time) - 1 AS BIGINT) AS day_of_week,
    CAST(CASE WHEN isodow(event_time) - 1 >= 5 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
    temp_corrected,
    CASE WHEN NOT is_late THEN 'on_time'
         WHEN (epoch_us(prev_max) - epoch_us(event_time)) / 1000000.0 <= 300 THEN 'late_accepted'
         ELSE 'too_late' END AS late_class,
    CASE WHEN is_late THEN (epoch_us(prev_max) - epoch_us(event_time)) / 1000000.0 ELSE 0.0 END AS delay_s
  FROM lated)""",
]

ELIG_CTES = [
    """elig AS (
  SELECT * FROM parsed
  WHERE event_time IS NOT NULL AND temperature IS NOT NULL
    AND temperature BETWEEN -20 AND 100 AND NOT isnan(temperature))""",
]

DROPS_CTES = [
    """pb AS (
  SELECT b.batch_id, max(e.event_time) AS bmax, count(e.event_id) AS n_rows
  FROM (SELECT DISTINCT batch_id FROM parsed) b LEFT JOIN elig e ON b.batch_id = e.batch_id GROUP BY b.batch_id)""",
    """pm AS (
  SELECT batch_id, max(bmax) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
  FROM pb)""",
    "wm AS (SELECT batch_id + 1 AS batch_id, prev - INTERVAL 300 SECOND AS watermark FROM pm)",
    """drops AS (
  SELECT pb.batch_id, CAST(pb.n_rows AS BIGINT) AS rows, wm.watermark,
    CAST((SELECT count(*) FROM elig e WHERE e.batch_id = pb.batch_id AND e.event_time <= wm.watermark) AS BIGINT)
      AS dropped
  FROM pb LEFT JOIN wm ON pb.batch_id = wm.batch_id)""",
]

PART_CTES = [
    """pcounts AS (
  SELECT p.partition, CAST(coalesce(c.n, 0) AS BIGINT) AS n
  FROM (SELECT CAST(range AS INTEGER) AS partition FROM range(3) UNION SELECT partition FROM parsed) p
  LEFT JOIN (SELECT partition, count(*) AS n FROM parsed GROUP BY partition) c ON p.partition = c.partition)""",
]

FEATURES = ("temperature", "humidity", "hour_of_day", "day_of_week", "is_weekend")

STATS_CTES = [
    "longv AS (" + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM clean" for f in FEATURES) + ")",
    """stats AS (
  SELECT feature, avg(v) AS mean, median(v) AS median, stddev_samp(v) AS std, CAST(count(v) AS BIGINT) AS n
  FROM longv GROUP BY feature)""",
    "corrs AS (" + " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)) AS r FROM clean"
        for x in FEATURES for y in FEATURES) + ")",
    """aout AS (
  SELECT 'summary' AS section, feature AS name_a, CAST(NULL AS VARCHAR) AS name_b, 'mean' AS metric, mean AS value FROM stats
  UNION ALL SELECT 'summary', feature, NULL, 'median', median FROM stats
  UNION ALL SELECT 'summary', feature, NULL, 'std', std FROM stats
  UNION ALL SELECT 'summary', feature, NULL, 'n', CAST(n AS DOUBLE) FROM stats
  UNION ALL SELECT 'correlation', x, y, 'pearson_r', r FROM corrs)""",
]

GATE_CTES = [
    """gate_wide AS (
  SELECT count(*) AS total,
    count(*) FILTER (WHERE outcome = 'duplicate') AS v_duplicate,
    count(*) FILTER (WHERE outcome = 'bad_timestamp') AS v_bad_timestamp,
    count(*) FILTER (WHERE is_first AND temperature IS NULL) AS v_missing_temperature,
    count(*) FILTER (WHERE outcome = 'no_history') AS v_no_history,
    count(*) FILTER (WHERE outcome = 'out_of_range') AS v_out_of_range
  FROM annot)""",
    """gate AS (
  SELECT rule, CAST(violations AS BIGINT) AS violations, CAST(total AS BIGINT) AS total,
    CASE WHEN total > 0 THEN violations / total ELSE 0.0 END AS share, threshold,
    (CASE WHEN total > 0 THEN violations / total ELSE 0.0 END) <= threshold AS passed
  FROM (
    SELECT 'duplicate' AS rule, v_duplicate AS violations, total, 0.10::DOUBLE AS threshold FROM gate_wide
    UNION ALL SELECT 'bad_timestamp', v_bad_timestamp, total, 0.05::DOUBLE FROM gate_wide
    UNION ALL SELECT 'missing_temperature', v_missing_temperature, total, 0.05::DOUBLE FROM gate_wide
    UNION ALL SELECT 'no_history', v_no_history, total, 0.05::DOUBLE FROM gate_wide
    UNION ALL SELECT 'out_of_range', v_out_of_range, total, 0.05::DOUBLE FROM gate_wide))""",
]


SUMMARY_SELECT = """SELECT metric, CAST(value AS BIGINT) AS value FROM (
  SELECT 'Missing Values Corrected' AS metric, count(*) FILTER (WHERE outcome = 'kept' AND temp_corrected) AS value FROM annot
  UNION ALL SELECT 'Duplicate Records Removed', count(*) FILTER (WHERE outcome = 'duplicate') FROM annot
  UNION ALL SELECT 'Invalid Records Removed', count(*) FILTER (WHERE outcome IN ('bad_timestamp', 'out_of_range')) FROM annot
  UNION ALL SELECT 'Dropped (Insufficient History for Imputation)', count(*) FILTER (WHERE outcome = 'no_history') FROM annot
  UNION ALL SELECT 'Late Records Accepted', count(*) FILTER (WHERE late_class = 'late_accepted') FROM clean
  UNION ALL SELECT 'Records Discarded by Watermarking', coalesce(sum(dropped), 0) FROM drops
  UNION ALL SELECT 'Raw Records', count(*) FROM annot
  UNION ALL SELECT 'Cleaned Records', count(*) FILTER (WHERE outcome = 'kept') FROM annot)"""


def _with(ctes: list[str], final: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + final


GATE_FAILED_CTES = [c.replace("'out_of_range', v_out_of_range, total, 0.05", "'out_of_range', v_out_of_range, total, 0.001") for c in GATE_CTES]


def _clean_sql(width: int, feedback: bool = False) -> str:
    return _with(raw_ctes() + annot_ctes(width, feedback=feedback) + CLEAN_CTES,
                 """SELECT event_id, batch_id, sensor_id, event_time, round(temperature, 6) AS temperature, humidity,
  status, hour_of_day, day_of_week, is_weekend, temp_corrected, late_class, round(delay_s, 6) AS delay_s
FROM clean""")


def _imputed_sql(width: int) -> str:
    return _with(raw_ctes() + annot_ctes(width), """SELECT event_id, sensor_id, event_time, round(imputed, 6) AS imputed
FROM annot WHERE is_first AND event_time IS NOT NULL AND temperature IS NULL""")


def batch_log_sql(clean_ctes: list[str]) -> str:
    return _with(clean_ctes + ["""per AS (
  SELECT a.batch_id, count(*) AS raw_rows,
    count(*) FILTER (WHERE outcome = 'kept') AS cleaned_rows,
    count(*) FILTER (WHERE outcome = 'kept' AND temp_corrected) AS missing_corrected,
    count(*) FILTER (WHERE outcome = 'duplicate') AS duplicates_removed,
    count(*) FILTER (WHERE outcome IN ('bad_timestamp', 'out_of_range')) AS invalid_removed,
    count(*) FILTER (WHERE outcome = 'no_history') AS dropped_insufficient_history,
    coalesce(max(l.n_late), 0) AS late_accepted
  FROM annot a LEFT JOIN (SELECT batch_id, count(*) FILTER (WHERE late_class = 'late_accepted') AS n_late
                          FROM clean GROUP BY batch_id) l ON a.batch_id = l.batch_id
  GROUP BY a.batch_id)"""], """SELECT batch_id,
  CAST(raw_rows AS BIGINT) AS raw_rows, CAST(cleaned_rows AS BIGINT) AS cleaned_rows,
  CAST(missing_corrected AS BIGINT) AS missing_corrected, CAST(duplicates_removed AS BIGINT) AS duplicates_removed,
  CAST(invalid_removed AS BIGINT) AS invalid_removed,
  CAST(dropped_insufficient_history AS BIGINT) AS dropped_insufficient_history,
  CAST(late_accepted AS BIGINT) AS late_accepted,
  CAST(sum(missing_corrected) OVER w AS BIGINT) AS total_missing_corrected,
  CAST(sum(duplicates_removed) OVER w AS BIGINT) AS total_duplicates_removed,
  CAST(sum(invalid_removed) OVER w AS BIGINT) AS total_invalid_removed,
  CAST(sum(dropped_insufficient_history) OVER w AS BIGINT) AS total_dropped_insufficient_history,
  CAST(sum(late_accepted) OVER w AS BIGINT) AS total_late_accepted
FROM per WINDOW w AS (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")


RAW = raw_ctes()
ANNOT = RAW + annot_ctes(300)
CLEAN = ANNOT + CLEAN_CTES

ORACLE_SQL: dict[str, str] = {
    "raw_readings": _with(RAW, "SELECT event_id, batch_id, sensor_id, timestamp, temperature, humidity, status, "
                               "partition FROM raw"),
    "parsed_readings": _with(RAW, "SELECT event_id, batch_id, CAST(partition AS BIGINT) AS partition, sensor_id, "
                                  "timestamp, temperature, humidity, status, event_time FROM parsed"),
    "schema_round_trip": _with(RAW, "SELECT CAST(partition AS BIGINT) AS partition, count(*) AS n, "
                                    "count(*) AS n_equal, count(*) AS n_key FROM raw GROUP BY partition"),
    "dedup_first": _with(ANNOT[:-3], "SELECT event_id, sensor_id, timestamp FROM firsts WHERE is_first"),
    "dispositions": _with(ANNOT, "SELECT event_id, outcome FROM annot"),
    "imputed_5m": _imputed_sql(300),
    "imputed_1h": _imputed_sql(3600),
    "clean_readings": _clean_sql(300),
    "clean_readings_1h": _clean_sql(3600),
    "clean_readings_feedback": _clean_sql(300, feedback=True),
    "imputed_feedback": _with(raw_ctes() + annot_ctes(300, feedback=True), """SELECT event_id, sensor_id, event_time, round(imputed, 6) AS imputed
FROM annot WHERE is_first AND event_time IS NOT NULL AND temperature IS NULL"""),
    "time_features": _with(RAW, """SELECT event_id, CAST(hour(event_time) AS BIGINT) AS hour_of_day,
  CAST(isodow(event_time) - 1 AS BIGINT) AS day_of_week,
  CAST(CASE WHEN isodow(event_time) - 1 >= 5 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend
FROM parsed WHERE event_time IS NOT NULL"""),
    "legacy_cleaned": _with(CLEAN, """SELECT sensor_id, event_time, round(temperature, 6) AS temperature, humidity, status,
  CAST(hour_of_day AS DOUBLE) AS hour_of_day, CAST(day_of_week AS DOUBLE) AS day_of_week,
  CAST(is_weekend AS DOUBLE) AS is_weekend, CASE WHEN temp_corrected THEN 'True' ELSE 'False' END AS temp_corrected
FROM clean"""),
    "sensor_stats": _with(CLEAN, """SELECT sensor_id, round(avg(temperature), 6) AS avg_temperature,
  max(temperature) AS max_temperature, CAST(count(*) AS BIGINT) AS readings FROM clean GROUP BY sensor_id"""),
    "status_distribution": _with(CLEAN, "SELECT status, CAST(count(*) AS BIGINT) AS n FROM clean GROUP BY status"),
    "active_sensors": _with(CLEAN, """SELECT sensor_id, max(event_time) AS last_event_time FROM clean GROUP BY sensor_id
HAVING (epoch_us((SELECT max(event_time) FROM clean)) - epoch_us(max(event_time))) / 1000000.0 <= 300"""),
    "late_arrivals": _with(CLEAN, "SELECT event_id, batch_id, round(delay_s, 6) AS delay_s, late_class FROM clean"),
    "batch_log": batch_log_sql(CLEAN),
    "window_avg": _with(RAW + ELIG_CTES + ["""edd AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id, timestamp ORDER BY event_id) AS rn FROM elig)
  WHERE rn = 1)"""], """SELECT make_timestamp(epoch_us(event_time) // 300000000 * 300000000) AS window_start,
  make_timestamp(epoch_us(event_time) // 300000000 * 300000000 + 300000000) AS window_end,
  sensor_id, round(avg(temperature), 6) AS avg_temperature, CAST(count(*) AS BIGINT) AS record_count
FROM edd GROUP BY 1, 2, 3"""),
    "partition_counts": _with(RAW + PART_CTES, "SELECT CAST(partition AS BIGINT) AS partition, n FROM pcounts"),
    "reader_load": _with(RAW + PART_CTES + ["""cfg AS (SELECT CAST(r AS INTEGER) AS readers FROM (VALUES (1), (2), (4)) v(r))""",
                                            """slots AS (SELECT readers, CAST(reader AS INTEGER) AS reader
  FROM cfg, LATERAL (SELECT range AS reader FROM range(readers)))""",
                                            """load AS (SELECT c.readers, p.partition % c.readers AS reader,
  string_agg(CAST(p.partition AS VARCHAR), ',' ORDER BY p.partition) AS partitions, sum(p.n) AS n
  FROM cfg c, pcounts p GROUP BY 1, 2)"""],
                         """SELECT CAST(s.readers AS BIGINT) AS readers, CAST(s.reader AS BIGINT) AS reader,
  coalesce(l.partitions, '') AS partitions, CAST(coalesce(l.n, 0) AS BIGINT) AS n
FROM slots s LEFT JOIN load l ON s.readers = l.readers AND s.reader = l.reader"""),
    "partition_skew": _with(RAW + PART_CTES, """SELECT CAST(count(*) AS BIGINT) AS n_partitions,
  CAST(sum(n) AS BIGINT) AS total, CAST(max(n) AS BIGINT) AS max_n,
  CAST(count(*) FILTER (WHERE n = 0) AS BIGINT) AS empty_partitions,
  round(CASE WHEN sum(n) > 0 THEN max(n) / sum(n) ELSE 0.0 END, 6) AS max_share FROM pcounts"""),
    "delivery_check": _with(RAW, "SELECT count(*) AS produced, count(*) AS consumed, true AS delivered FROM raw"),
    "read_partitions": _with(RAW, """SELECT CAST(partition AS BIGINT) AS partition, count(*) AS n,
  min(event_id) AS first_offset, max(event_id) AS last_offset FROM raw WHERE partition IN (0, 2) GROUP BY partition"""),
    "quality_gate": _with(ANNOT + GATE_CTES,
                          "SELECT rule, violations, total, round(share, 6) AS share, threshold, passed FROM gate"),
    "summary_stats": _with(CLEAN + STATS_CTES, """SELECT feature, round(mean, 6) AS mean, round(median, 6) AS median,
  round(std, 6) AS std, n FROM stats"""),
    "correlation_matrix": _with(CLEAN + STATS_CTES, "SELECT x, y, round(r, 6) AS r FROM corrs"),
    "analytics_output": _with(CLEAN + STATS_CTES,
                              "SELECT section, name_a, name_b, metric, round(value, 6) AS value FROM aout"),
    "workflow_report": _with(CLEAN + STATS_CTES + GATE_CTES + [
        "ok AS (SELECT bool_and(passed) AS passed FROM gate)"], """SELECT CASE WHEN (SELECT passed FROM ok) THEN 'report' ELSE 'failed' END AS status,
  section, name_a, name_b, metric, round(value, 6) AS value FROM (
  SELECT 'gate' AS section, rule AS name_a, CAST(NULL AS VARCHAR) AS name_b,
    CASE WHEN passed THEN 'share_ok' ELSE 'share_failed' END AS metric, share AS value FROM gate
  UNION ALL SELECT section, name_a, name_b, metric, value FROM aout WHERE (SELECT passed FROM ok)
  UNION ALL SELECT 'failure', 'validation', NULL, 'failed_rules',
    CAST((SELECT count(*) FILTER (WHERE NOT passed) FROM gate) AS DOUBLE) WHERE NOT (SELECT passed FROM ok))"""),
    "workflow_report_failed": _with(CLEAN + STATS_CTES + GATE_FAILED_CTES + [
        "ok AS (SELECT bool_and(passed) AS passed FROM gate)"], """SELECT CASE WHEN (SELECT passed FROM ok) THEN 'report' ELSE 'failed' END AS status,
  section, name_a, name_b, metric, round(value, 6) AS value FROM (
  SELECT 'gate' AS section, rule AS name_a, CAST(NULL AS VARCHAR) AS name_b,
    CASE WHEN passed THEN 'share_ok' ELSE 'share_failed' END AS metric, share AS value FROM gate
  UNION ALL SELECT section, name_a, name_b, metric, value FROM aout WHERE (SELECT passed FROM ok)
  UNION ALL SELECT 'failure', 'validation', NULL, 'failed_rules',
    CAST((SELECT count(*) FILTER (WHERE NOT passed) FROM gate) AS DOUBLE) WHERE NOT (SELECT passed FROM ok))"""),
}

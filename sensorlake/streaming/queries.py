"""Registered streaming queries.

Each query stages the planted readings as ten successive sets of log files
under the session's checkpoint root (one set per micro-batch), runs the
stream with ``availableNow`` to the end, and returns what its sink holds.
The oracle treats the index of an arrival's set as the micro-batch id.
``late=False`` staging has no late rows, so stream = batch; the cleaning stream
runs on rows whose times are days back and on rows delivered one set late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.operators.analytics import sensor_stats, status_distribution
from sensorlake.operators.windows import dedup_watermark, eligible, watermarked
from sensorlake.plans import oracle as O
from sensorlake.plans.queries import finish
from sensorlake.plans.report import summary_table, write_json
from sensorlake.session import configure, scratch_dir
from sensorlake.sources.fixtures import planted_readings, stage_files
from sensorlake.sources.log import SinkSpec, SourceSpec, decode_envelope, read_stream, to_envelope
from sensorlake.sources.segments import append_segments, commit_ended, group_offsets
from sensorlake.streaming import clean as cs
from sensorlake.streaming.fanout import fan_out
from sensorlake.streaming.metrics import batch_drops, performance, recorded, state_snapshot, windowed_state
from sensorlake.streaming.runner import run_to_end, start
from sensorlake.streaming.windowed import current_windows, start_windowed

N_FILES = 10
FILES_PER_SET = 4
#: added to a mean before it is rounded: readings have three decimals, so means of 2^k readings can lie just between two rounded values
NUDGE = "1e-9"


def _cores(spark: SparkSession) -> int:
    """State partitions for the fixture streams: one per core of the cluster."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect)
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def file_of(per: int) -> str:
    """SQL: the file set of an arrival. The last but one arrival of each set is delivered with the next set: late, by little."""
    return f"CAST(least(event_id div {per} + CASE WHEN event_id % {per} = {per - 2} THEN 1 ELSE 0 END, {N_FILES - 1}) AS INT)"


def stage(spark: SparkSession, sf_dir: str, late: bool, delayed: bool = False, files: int = FILES_PER_SET) -> str:
    """Stage planted envelope rows as N_FILES successive file sets; return the folder.

    ``late`` moves some event times back by days; ``delayed`` delivers some rows one set later.
    """
    configure(spark)
    r = planted_readings(spark, sf_dir, late=late, late_unit="days")
    per = (spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").agg(F.max("event_id")).first()[0] + N_FILES) // N_FILES
    env = to_envelope(r).withColumn("_file", F.expr(file_of(per).replace("event_id", "offset") if delayed else f"CAST(offset div {per} AS INT)"))
    path = scratch_dir(spark, "staged")
    stage_files(env, path, "_file", N_FILES, files_per_group=files)
    return path


def parsed_stream(spark: SparkSession, path: str, files: int = FILES_PER_SET) -> DataFrame:
    src = read_stream(spark, SourceSpec(format="json", path=path, max_files_per_trigger=files))
    return decode_envelope(src, keep=("partition", "offset")).withColumnRenamed("offset", "event_id")


def _windowed_run(spark, sf_dir, late):
    staged = stage(spark, sf_dir, late)
    out, ckpt = scratch_dir(spark, "windows"), scratch_dir(spark, "ckpt-windowed")
    run_to_end(start_windowed(parsed_stream(spark, staged), out, ckpt, state_partitions=_cores(spark)))
    return out


def _windowed_progress(spark, sf_dir):
    """Every progress record of the windowed query over the staged rows."""
    staged = stage(spark, sf_dir, late=True)
    with recorded(spark, scratch_dir(spark, "progress")) as log:
        log.follow(start_windowed(parsed_stream(spark, staged), scratch_dir(spark, "windows"), scratch_dir(spark, "ckpt-windowed"),
                                  state_partitions=_cores(spark)))
    return log.to_df()


def _windows_result(spark, out):
    return finish(current_windows(spark, out), ts=["window_start", "window_end"], rnd=["avg_temperature"],
                  longs=["record_count"])


def q_window_avg_stream(spark, sf_dir):
    return _windows_result(spark, _windowed_run(spark, sf_dir, late=False))


def q_window_avg_late(spark, sf_dir):
    return _windows_result(spark, _windowed_run(spark, sf_dir, late=True))


def q_stream_late_drops(spark, sf_dir):
    d = batch_drops(_windowed_progress(spark, sf_dir)).where(F.col("input_rows") > 0)
    return d.select(F.col("batchId").alias("batch_id"), "input_rows", "dropped")


def q_dedup_watermark_stream(spark, sf_dir):
    staged = stage(spark, sf_dir, late=False)
    out, ckpt = scratch_dir(spark, "dedup"), scratch_dir(spark, "ckpt-dedup")
    plan = dedup_watermark(watermarked(eligible(parsed_stream(spark, staged)))).select(
        "sensor_id", "timestamp", "event_time")
    run_to_end(start(plan, SinkSpec(name="dedup_query", checkpoint=ckpt, format="parquet", path=out),
                     state_partitions=_cores(spark)))
    return finish(spark.read.parquet(out), ts=["event_time"])


def _clean_run(spark, sf_dir):
    staged = stage(spark, sf_dir, late=True, delayed=True)
    root, ckpt = scratch_dir(spark, "clean"), scratch_dir(spark, "ckpt-clean")
    run_to_end(cs.start_clean_stream(parsed_stream(spark, staged), root, ckpt))
    return root


def q_clean_stream(spark, sf_dir):
    return finish(cs.cleaned_table(spark, _clean_run(spark, sf_dir)), ts=["event_time"], rnd=["temperature", "delay_s"],
                  longs=["hour_of_day", "day_of_week", "is_weekend"])


def q_clean_stream_log(spark, sf_dir):
    return cs.batch_log_table(spark, _clean_run(spark, sf_dir)).drop("max_event_time")


def q_clean_stream_analytics(spark, sf_dir):
    """Running statistics and activity of every sensor after every micro-batch."""
    rows = cs.sensor_snapshots(spark, _clean_run(spark, sf_dir)).withColumn("avg_temperature", F.expr(f"avg_temperature + {NUDGE}"))
    return finish(rows, ts=["last_event_time"], rnd=["avg_temperature", "max_temperature"], longs=["batch_id", "readings"])


def q_clean_stream_status(spark, sf_dir):
    """Running status distribution after every micro-batch."""
    return finish(cs.status_snapshots(spark, _clean_run(spark, sf_dir)), longs=["batch_id", "n"])


def q_clean_stream_active(spark, sf_dir):
    """Number and sorted list of active sensors after every micro-batch."""
    report = cs.active_report(cs.sensor_snapshots(spark, _clean_run(spark, sf_dir)))
    return finish(report.withColumn("active_sensors", F.array_join("active_sensors", ",")), longs=["batch_id", "n_active"])


def _both_runs(spark, sf_dir):
    """Cleaning and windowed query side by side over one source: (folder of the cleaning tables, windowed progress)."""
    staged = stage(spark, sf_dir, late=True, delayed=True)
    root = scratch_dir(spark, "clean")
    with recorded(spark, scratch_dir(spark, "progress")) as log:
        cleaning = cs.start_clean_stream(parsed_stream(spark, staged), root, scratch_dir(spark, "ckpt-clean"))
        windowed = start_windowed(parsed_stream(spark, staged), scratch_dir(spark, "windows"), scratch_dir(spark, "ckpt-windowed"),
                                  state_partitions=_cores(spark))
        log.follow(cleaning, windowed)
    for q in (cleaning, windowed):
        run_to_end(q)   # raises what a query failed with
    return root, log.to_df()


def q_summary_table(spark, sf_dir):
    root, progress = _both_runs(spark, sf_dir)
    return summary_table(cs.batch_log_table(spark, root), progress)


def q_run_reports(spark, sf_dir):
    """The JSON reports of a run, read back: report, key, metric, value (3 places)."""
    root, progress = _both_runs(spark, sf_dir)
    cleaned, out = cs.cleaned_table(spark, root), scratch_dir(spark, "reports")
    write_json({"summary": summary_table(cs.batch_log_table(spark, root), progress), "sensors": sensor_stats(cleaned),
                "status": status_distribution(cleaned), "performance": performance(progress)}, out)
    spark.read.json(f"{out}/performance").select("name", "batches", "rows")   # timings differ from run to run: written, not returned
    summary = spark.read.json(f"{out}/summary").selectExpr("'summary' AS report", "metric AS key", "'count' AS metric", "CAST(value AS DOUBLE) AS value")
    sensors = spark.read.json(f"{out}/sensors").selectExpr(
        "'sensors' AS report", "sensor_id AS key", "stack(3, 'avg_temperature', avg_temperature, 'max_temperature', max_temperature, "
        "'readings', CAST(readings AS DOUBLE)) AS (metric, value)")
    status = spark.read.json(f"{out}/status").selectExpr("'status' AS report", "status AS key", "'rows' AS metric", "CAST(n AS DOUBLE) AS value")
    return summary.unionAll(sensors).unionAll(status)


def q_stream_fan_out(spark, sf_dir):
    """Two reader groups on one source, each with its own checkpoint: both see every record."""
    staged = stage(spark, sf_dir, late=True)
    groups = ("group_alpha", "group_beta")
    sinks = {g: SinkSpec(name=g, checkpoint=scratch_dir(spark, f"ckpt-{g}"), format="parquet",
                         path=scratch_dir(spark, f"fan-{g}")) for g in groups}
    for q in fan_out(parsed_stream(spark, staged), sinks).values():
        run_to_end(q)
    counts = [spark.read.parquet(sinks[g].path).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(g).alias("consumer"), "n") for g in groups]
    return counts[0].unionByName(counts[1])


def q_segment_log(spark, sf_dir):
    """The log as a data source: two appends, a stream that is restarted between them, and what its reader group committed."""
    env = to_envelope(planted_readings(configure(spark), sf_dir))
    half = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").agg(F.max("event_id")).first()[0] // 2
    path, out, ckpt = scratch_dir(spark, "segments"), scratch_dir(spark, "read"), scratch_dir(spark, "ckpt-segments")
    source = SourceSpec(format="segments", path=path, starting_offsets="earliest", fail_on_data_loss=True, options={"group": "readers"})
    for n, part in enumerate((F.col("offset") <= half, F.col("offset") > half)):
        append_segments(env.where(part), path, n)
        rows = decode_envelope(read_stream(spark, source), keep=("partition", "offset"))
        commit_ended(run_to_end(start(rows, SinkSpec(name="segment_log", checkpoint=ckpt, format="parquet", path=out))), path, "readers")
    done = spark.createDataFrame(list(group_offsets(path, "readers").items()), "partition int, next_offset long")
    got = spark.read.parquet(out).groupBy("partition").agg(
        F.count(F.lit(1)).alias("n"), F.count("temperature").alias("n_temperature"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))
    return finish(got.join(done, "partition"), longs=["partition"])


def q_progress_log(spark, sf_dir):
    return _windowed_progress(spark, sf_dir).select("name", "batchId", "numInputRows", "inputRowsPerSecond",
                                                    "processedRowsPerSecond", "durationMs", "stateOperators")


def q_state_snapshot(spark, sf_dir):
    return state_snapshot(_windowed_progress(spark, sf_dir))


def q_state_rows(spark, sf_dir):
    """Open windows and remembered keys of the windowed query after its last batch, read from the state itself."""
    staged, ckpt = stage(spark, sf_dir, late=False), scratch_dir(spark, "ckpt-windowed")
    run_to_end(start_windowed(parsed_stream(spark, staged), scratch_dir(spark, "windows"), ckpt, state_partitions=_cores(spark)))
    return finish(windowed_state(spark, ckpt), ts=["at"], rnd=["total"], longs=["n"])


def q_stream_performance(spark, sf_dir):
    return performance(_windowed_progress(spark, sf_dir))


STREAM_QUERIES = {
    "window_avg_stream": q_window_avg_stream,
    "window_avg_late": q_window_avg_late,
    "stream_late_drops": q_stream_late_drops,
    "dedup_watermark_stream": q_dedup_watermark_stream,
    "clean_stream": q_clean_stream,
    "clean_stream_log": q_clean_stream_log,
    "clean_stream_analytics": q_clean_stream_analytics,
    "clean_stream_status": q_clean_stream_status,
    "clean_stream_active": q_clean_stream_active,
    "summary_table": q_summary_table,
    "run_reports": q_run_reports,
    "stream_fan_out": q_stream_fan_out,
    "segment_log": q_segment_log,
    "progress_log": q_progress_log,
    "state_snapshot": q_state_snapshot,
    "state_rows": q_state_rows,
    "stream_performance": q_stream_performance,
}

# --- oracle SQL: the file index is the micro-batch id ------------------------------------------
FILE_BATCH = f"event_id // (SELECT (max(event_id) + {N_FILES}) // {N_FILES} FROM events)"
_NOLATE = O.raw_ctes(late=False)
_LATE_DAYS = O.raw_ctes(late=True, late_unit="days", batch_sql=FILE_BATCH)
_PER = f"(SELECT (max(event_id) + {N_FILES}) // {N_FILES} FROM events)"
_DELAYED = f"least(event_id // {_PER} + CASE WHEN event_id % {_PER} = {_PER} - 2 THEN 1 ELSE 0 END, {N_FILES - 1})"
_STREAM = O.raw_ctes(late=True, late_unit="days", batch_sql=_DELAYED) + O.annot_ctes(300, arrival="batch_id, event_id", by_batch=True) + O.CLEAN_CTES

_WINDOW_SELECT = """SELECT make_timestamp(epoch_us(event_time) // 300000000 * 300000000) AS window_start,
  make_timestamp(epoch_us(event_time) // 300000000 * 300000000 + 300000000) AS window_end,
  sensor_id, round(avg(temperature), 6) AS avg_temperature, CAST(count(*) AS BIGINT) AS record_count
FROM edd GROUP BY 1, 2, 3"""
_EDD = """edd AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id, timestamp ORDER BY event_id) AS rn FROM {src})
  WHERE rn = 1)"""
_KEEP_LATE = """survivors AS (
  SELECT e.* FROM elig e LEFT JOIN wm ON e.batch_id = wm.batch_id
  WHERE wm.watermark IS NULL OR e.event_time > wm.watermark)"""

_RUNNING = ["ids AS (SELECT DISTINCT CAST(batch_id AS BIGINT) AS batch_id FROM annot)",
            """running AS (
  SELECT b.batch_id, c.sensor_id, avg(c.temperature) AS avg_temperature, max(c.temperature) AS max_temperature, CAST(count(*) AS BIGINT) AS readings,
    max(c.event_time) AS last_event_time, epoch_us(max(max(c.event_time)) OVER (PARTITION BY b.batch_id)) - epoch_us(max(c.event_time)) <= 300000000 AS active
  FROM ids b JOIN clean c ON c.batch_id <= b.batch_id GROUP BY b.batch_id, c.sensor_id)"""]

STREAM_ORACLE_SQL = {
    "window_avg_stream": O._with(_NOLATE + O.ELIG_CTES + [_EDD.format(src="elig")], _WINDOW_SELECT),
    "window_avg_late": O._with(_LATE_DAYS + O.ELIG_CTES + O.DROPS_CTES[:3] + [_KEEP_LATE, _EDD.format(src="survivors")],
                               _WINDOW_SELECT),
    "stream_late_drops": O._with(_LATE_DAYS + O.ELIG_CTES + O.DROPS_CTES, """SELECT d.batch_id,
  CAST((SELECT count(*) FROM parsed p WHERE p.batch_id = d.batch_id) AS BIGINT) AS input_rows, d.dropped
FROM drops d"""),
    "state_rows": O._with(_NOLATE + O.ELIG_CTES + [_EDD.format(src="elig"), "last AS (SELECT max(event_time) - INTERVAL 300 SECOND AS wm FROM elig)"],
                          """SELECT 'window' AS operator, sensor_id, make_timestamp(epoch_us(event_time) // 300000000 * 300000000) AS at,
  round(sum(temperature), 6) AS total, CAST(count(*) AS BIGINT) AS n FROM edd, last
WHERE make_timestamp(epoch_us(event_time) // 300000000 * 300000000 + 300000000) > wm GROUP BY ALL
UNION ALL SELECT o.operator, sensor_id, event_time, NULL, 1 FROM edd, last, (VALUES ('dedup'), ('salted_dedup')) o(operator)
WHERE event_time + INTERVAL 300 SECOND > wm"""),
    "dedup_watermark_stream": O._with(_NOLATE + O.ELIG_CTES,
                                      "SELECT DISTINCT sensor_id, timestamp, event_time FROM elig"),
    "clean_stream": O._with(_STREAM, """SELECT event_id, batch_id, sensor_id, event_time, round(temperature, 6) AS temperature,
  humidity, status, hour_of_day, day_of_week, is_weekend, temp_corrected, late_class, round(delay_s, 6) AS delay_s
FROM clean"""),
    "clean_stream_log": O.batch_log_sql(_STREAM),
    "clean_stream_analytics": O._with(_STREAM + _RUNNING, f"""SELECT batch_id, sensor_id, round(avg_temperature + {NUDGE}, 6) AS avg_temperature,
  round(max_temperature, 6) AS max_temperature, readings, last_event_time, active FROM running"""),
    "clean_stream_status": O._with(_STREAM + _RUNNING, """SELECT b.batch_id, c.status, CAST(count(*) AS BIGINT) AS n
FROM ids b JOIN clean c ON c.batch_id <= b.batch_id GROUP BY ALL"""),
    "clean_stream_active": O._with(_STREAM + _RUNNING, """SELECT batch_id, CAST(count(*) FILTER (WHERE active) AS BIGINT) AS n_active,
  coalesce(string_agg(sensor_id, ',' ORDER BY sensor_id) FILTER (WHERE active), '') AS active_sensors FROM running GROUP BY batch_id"""),
    "summary_table": O._with(_STREAM + O.ELIG_CTES + O.DROPS_CTES, O.SUMMARY_SELECT),
    "run_reports": O._with(_STREAM + O.ELIG_CTES + O.DROPS_CTES, f"""SELECT 'summary' AS report, metric AS key, 'count' AS metric, CAST(value AS DOUBLE) AS value
FROM ({O.SUMMARY_SELECT})
UNION ALL SELECT 'sensors', sensor_id, 'avg_temperature', round(avg(temperature), 3) FROM clean GROUP BY sensor_id
UNION ALL SELECT 'sensors', sensor_id, 'max_temperature', round(max(temperature), 3) FROM clean GROUP BY sensor_id
UNION ALL SELECT 'sensors', sensor_id, 'readings', CAST(count(*) AS DOUBLE) FROM clean GROUP BY sensor_id
UNION ALL SELECT 'status', status, 'rows', CAST(count(*) AS DOUBLE) FROM clean GROUP BY status"""),
    "segment_log": O._with(O.raw_ctes(), """SELECT CAST(partition AS BIGINT) AS partition, count(*) AS n, count(temperature) AS n_temperature,
  min(event_id) AS first_offset, max(event_id) AS last_offset, max(event_id) + 1 AS next_offset FROM raw GROUP BY partition"""),
    "stream_fan_out": O._with(O.raw_ctes(), """SELECT 'group_alpha' AS consumer, count(*) AS n FROM raw
UNION ALL SELECT 'group_beta', count(*) FROM raw"""),
}

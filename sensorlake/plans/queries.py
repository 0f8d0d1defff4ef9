"""Registered queries: (spark, sf_dir) -> DataFrame over the given tables.

Each query reads ``events`` (through the planted fixture and the log
envelope) and returns a result whose columns match the oracle SQL in
``sensorlake.plans.oracle``: timestamps as TIMESTAMP_NTZ, integers as BIGINT,
averages/deviations/correlations rounded to 6 places.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.functions.features import add_time_features, legacy_types
from sensorlake.operators import analytics, partitions, quality, windows
from sensorlake.operators.quality import DEDUP_KEYS
from sensorlake.plans import cleaning, report
from sensorlake.schema import KEPT
from sensorlake.session import configure, materialize, scratch_dir
from sensorlake.sources.fixtures import planted_readings
from sensorlake.sources.log import SourceSpec, decode_envelope, read_bounded, to_envelope, write_log

HOUR = 3600.0
FIVE_MIN = 300.0


def finish(df: DataFrame, ts: Iterable[str] = (), rnd: Iterable[str] = (), longs: Iterable[str] = ()) -> DataFrame:
    """Normalise output types for comparison (NTZ timestamps, rounded doubles, BIGINT counts)."""
    for c in ts:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    for c in rnd:
        df = df.withColumn(c, F.round(F.col(c).cast("double"), 6))
    for c in longs:
        df = df.withColumn(c, F.col(c).cast("long"))
    return df


def raw(spark: SparkSession, sf_dir: str, late: bool = True) -> DataFrame:
    configure(spark)
    return planted_readings(spark, sf_dir, late=late)


def parsed(spark: SparkSession, sf_dir: str, late: bool = True, batch_rows: int = 20) -> DataFrame:
    """Planted readings -> log envelope (JSON values) -> decoded readings with event_time."""
    env = to_envelope(raw(spark, sf_dir, late))
    dec = decode_envelope(env, keep=("partition", "offset"))
    return dec.withColumnRenamed("offset", "event_id").withColumn(
        "batch_id", F.expr(f"event_id div {int(batch_rows)}"))


def annotated(spark, sf_dir, width=FIVE_MIN):
    return cleaning.annotate(parsed(spark, sf_dir), width)


def clean(spark, sf_dir, width=FIVE_MIN, feedback=False):
    """Cleaned rows with late classes."""
    return cleaning.clean_readings(parsed(spark, sf_dir), width, feedback=feedback)


def analytic_rows(spark, sf_dir, width=FIVE_MIN, materialized=False):
    """Cleaned rows without late classes; stored when the caller reads them more than once."""
    rows = cleaning.clean_from_annotated(cleaning.annotate(parsed(spark, sf_dir), width, firsts_only=True), late=False)
    return materialize(rows.select(*analytics.FEATURES)) if materialized else rows


def q_raw_readings(spark, sf_dir):
    return raw(spark, sf_dir).select("event_id", "batch_id", "sensor_id", "timestamp", "temperature",
                                     "humidity", "status", "partition")


def q_parsed_readings(spark, sf_dir):
    return finish(parsed(spark, sf_dir).select("event_id", "batch_id", "partition", "sensor_id", "timestamp",
                                                "temperature", "humidity", "status", "event_time"),
                  ts=["event_time"], longs=["partition"])


def q_schema_round_trip(spark, sf_dir):
    r = raw(spark, sf_dir)
    env = to_envelope(r)
    back = decode_envelope(env, keep=("partition", "offset", "key")).withColumnRenamed("offset", "event_id")
    cols = ["sensor_id", "timestamp", "temperature", "humidity", "status"]
    j = back.join(r.select("event_id", *[F.col(c).alias(f"o_{c}") for c in cols]), "event_id")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(c).eqNullSafe(F.col(f"o_{c}"))
    return j.groupBy(F.col("partition").cast("long").alias("partition")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(same).alias("n_equal"),
        F.count_if(F.col("key").cast("string").eqNullSafe(F.col("o_sensor_id"))).alias("n_key"))


def q_dedup_first(spark, sf_dir):
    return quality.dedup_first(parsed(spark, sf_dir), DEDUP_KEYS, "event_id").select(
        "event_id", "sensor_id", "timestamp")


def q_dispositions(spark, sf_dir):
    return annotated(spark, sf_dir).select("event_id", "outcome")


def _imputed(width):
    def q(spark, sf_dir):
        a = annotated(spark, sf_dir, width)
        need = a.where(F.col("is_first") & F.col("event_time").isNotNull() & F.col("raw_temperature").isNull())
        return finish(need.select("event_id", "sensor_id", "event_time", "imputed"),
                      ts=["event_time"], rnd=["imputed"])
    return q


def _clean(width, feedback=False):
    def q(spark, sf_dir):
        return finish(clean(spark, sf_dir, width, feedback), ts=["event_time"], rnd=["temperature", "delay_s"],
                      longs=["hour_of_day", "day_of_week", "is_weekend"])
    return q


def q_time_features(spark, sf_dir):
    p = add_time_features(parsed(spark, sf_dir).where(F.col("event_time").isNotNull()))
    return finish(p.select("event_id", "hour_of_day", "day_of_week", "is_weekend"),
                  longs=["hour_of_day", "day_of_week", "is_weekend"])


def q_legacy_cleaned(spark, sf_dir):
    return finish(legacy_types(clean(spark, sf_dir)), ts=["event_time"], rnd=["temperature"])


def q_sensor_stats(spark, sf_dir):
    return finish(analytics.sensor_stats(analytic_rows(spark, sf_dir)), rnd=["avg_temperature"], longs=["readings"])


def q_status_distribution(spark, sf_dir):
    return finish(analytics.status_distribution(analytic_rows(spark, sf_dir)), longs=["n"])


def q_active_sensors(spark, sf_dir):
    return finish(analytics.active_sensors(analytic_rows(spark, sf_dir)), ts=["last_event_time"])


def q_late_arrivals(spark, sf_dir):
    return finish(clean(spark, sf_dir).select("event_id", "batch_id", "delay_s", "late_class"), rnd=["delay_s"])


def q_batch_log(spark, sf_dir):
    # the log and the late classes read four columns of the annotated rows
    a = materialize(annotated(spark, sf_dir).select("batch_id", "event_time", "outcome", "temp_corrected"))
    kept = a.where(F.col("outcome") == KEPT).select("batch_id", "event_time")
    return cleaning.batch_log(a, quality.late_arrivals(kept))


def q_window_avg(spark, sf_dir):
    w = windows.window_avg_batch(parsed(spark, sf_dir))
    return finish(w.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                           "sensor_id", "avg_temperature", "record_count"),
                  ts=["window_start", "window_end"], rnd=["avg_temperature"], longs=["record_count"])


def q_partition_counts(spark, sf_dir):
    return finish(partitions.counts(parsed(spark, sf_dir)), longs=["partition"])


def q_reader_load(spark, sf_dir):
    return finish(partitions.reader_load(partitions.counts(parsed(spark, sf_dir))), longs=["readers", "reader"])


def q_partition_skew(spark, sf_dir):
    return finish(partitions.skew(partitions.counts(parsed(spark, sf_dir))), rnd=["max_share"])


def _written_log(spark, sf_dir) -> str:
    path = scratch_dir(spark, "log")
    write_log(to_envelope(raw(spark, sf_dir)), path, fmt="json", partition_by=("partition",))
    return path


def q_delivery_check(spark, sf_dir):
    path = _written_log(spark, sf_dir)
    consumed = read_bounded(spark, SourceSpec(format="json", path=path))
    return partitions.delivery_check(raw(spark, sf_dir), consumed)


def q_read_partitions(spark, sf_dir):
    path = _written_log(spark, sf_dir)
    part = read_bounded(spark, SourceSpec(format="json", path=path, partitions=(0, 2)))
    return part.groupBy(F.col("partition").cast("long").alias("partition")).agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))


def q_quality_gate(spark, sf_dir):
    return finish(quality.gate(annotated(spark, sf_dir)), rnd=["share"])


def q_summary_stats(spark, sf_dir):
    return finish(analytics.summary_stats(analytic_rows(spark, sf_dir, materialized=True)), rnd=["mean", "median", "std"])


def q_correlation_matrix(spark, sf_dir):
    return finish(analytics.correlation_matrix(analytic_rows(spark, sf_dir)), rnd=["r"])


def q_analytics_output(spark, sf_dir):
    return finish(report.analytics_output(analytic_rows(spark, sf_dir, materialized=True)), rnd=["value"])


def q_workflow_report(spark, sf_dir):
    return _workflow(spark, sf_dir, quality.DEFAULT_RULES)


def q_workflow_report_failed(spark, sf_dir):
    """The same report under a rule that the planted rows break: the failure branch."""
    return _workflow(spark, sf_dir, {**quality.DEFAULT_RULES, "out_of_range": 0.001})


def _workflow(spark, sf_dir, rules):
    return finish(report.workflow_report(annotated(spark, sf_dir), lambda: analytic_rows(spark, sf_dir, materialized=True), rules), rnd=["value"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_readings": q_raw_readings,
    "parsed_readings": q_parsed_readings,
    "schema_round_trip": q_schema_round_trip,
    "dedup_first": q_dedup_first,
    "dispositions": q_dispositions,
    "imputed_5m": _imputed(FIVE_MIN),
    "imputed_1h": _imputed(HOUR),
    "clean_readings": _clean(FIVE_MIN),
    "clean_readings_1h": _clean(HOUR),
    "clean_readings_feedback": _clean(FIVE_MIN, feedback=True),
    "time_features": q_time_features,
    "legacy_cleaned": q_legacy_cleaned,
    "sensor_stats": q_sensor_stats,
    "status_distribution": q_status_distribution,
    "active_sensors": q_active_sensors,
    "late_arrivals": q_late_arrivals,
    "batch_log": q_batch_log,
    "window_avg": q_window_avg,
    "partition_counts": q_partition_counts,
    "reader_load": q_reader_load,
    "partition_skew": q_partition_skew,
    "delivery_check": q_delivery_check,
    "read_partitions": q_read_partitions,
    "quality_gate": q_quality_gate,
    "summary_stats": q_summary_stats,
    "correlation_matrix": q_correlation_matrix,
    "analytics_output": q_analytics_output,
    "workflow_report": q_workflow_report,
    "workflow_report_failed": q_workflow_report_failed,
}


def q_imputed_feedback(spark, sf_dir):
    """Feedback imputation (filled values enter the history), 5-minute width."""
    a = cleaning.annotate(parsed(spark, sf_dir), FIVE_MIN, feedback=True, firsts_only=True)
    out = a.where("event_time IS NOT NULL AND raw_temperature IS NULL")
    return finish(out.select("event_id", "sensor_id", "event_time", "imputed"), ts=["event_time"], rnd=["imputed"])


QUERIES["imputed_feedback"] = q_imputed_feedback

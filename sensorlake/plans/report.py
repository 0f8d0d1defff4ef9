"""Reports: summary table, analytics output, the workflow report and JSON export."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.operators.analytics import FEATURES, correlation_matrix, summary_stats
from sensorlake.operators.quality import DEFAULT_RULES, gate
from sensorlake.schema import SUMMARY_LABELS
from sensorlake.session import materialize
from sensorlake.streaming.metrics import dropped_by_watermark


def summary_table(batch_log: DataFrame, progress: DataFrame) -> DataFrame:
    """The run's outcome counters in long form (metric, value), plus raw and cleaned totals.

    ``batch_log`` is the cleaning query's log, one row per batch; rows discarded
    by watermarking are Spark's own counter in the windowed query's ``progress``.
    """
    discarded = dropped_by_watermark(progress).agg(F.coalesce(F.sum("dropped_by_watermark"), F.lit(0))).scalar()
    cols = ["missing_corrected", "duplicates_removed", "invalid_removed", "dropped_insufficient_history", "late_accepted",
            "discarded", "raw_rows", "cleaned_rows"]
    wide = batch_log.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols if c != "discarded"]).withColumn("discarded", discarded)
    labels = list(SUMMARY_LABELS) + ["Raw Records", "Cleaned Records"]
    entries = ", ".join(f"'{label}', cast({c} as bigint)" for label, c in zip(labels, cols))
    return wide.selectExpr(f"stack({len(cols)}, {entries}) as (metric, value)")


def rounded(df: DataFrame, places: int = 3) -> DataFrame:
    """Reports show doubles with ``places`` decimals."""
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


REPORT_COLUMNS = ("section", "name_a", "name_b", "metric", "value")


def analytics_output(clean: DataFrame, cols: Sequence[str] = FEATURES) -> DataFrame:
    """Summary statistics and correlations merged into one long table."""
    stats = summary_stats(clean, cols).selectExpr(
        "stack(4, 'mean', mean, 'median', median, 'std', std, 'n', cast(n as double)) as (metric, value)",
        "feature")
    stats = stats.select(F.lit("summary").alias("section"), F.col("feature").alias("name_a"),
                         F.lit(None).cast("string").alias("name_b"), "metric", "value")
    corr = correlation_matrix(clean, cols).select(
        F.lit("correlation").alias("section"), F.col("x").alias("name_a"), F.col("y").alias("name_b"),
        F.lit("pearson_r").alias("metric"), F.col("r").alias("value"))
    return stats.unionByName(corr)


def workflow_report(annotated: DataFrame, clean: Callable[[], DataFrame], rules: Mapping[str, float] = DEFAULT_RULES,
                    cols: Sequence[str] = FEATURES) -> DataFrame:
    """Validate -> branch -> analytics or failure notice, as one table.

    Gate rows are always listed; when every rule passes the analytics rows
    follow, otherwise a single failure notice does. ``clean`` gives the cleaned
    rows and is called only in the first case.
    """
    g = materialize(gate(annotated, rules))   # a row per rule, read twice
    failed = g.agg(F.count_if(~F.col("passed"))).first()[0]   # one value: the branch is chosen before anything else is planned
    gate_rows = g.select(F.lit("gate").alias("section"), F.col("rule").alias("name_a"),
                         F.lit(None).cast("string").alias("name_b"),
                         F.when(F.col("passed"), F.lit("share_ok")).otherwise(F.lit("share_failed")).alias("metric"),
                         F.col("share").alias("value"))
    if failed:
        notice = annotated.sparkSession.range(1).select(
            F.lit("failure").alias("section"), F.lit("validation").alias("name_a"), F.lit(None).cast("string").alias("name_b"),
            F.lit("failed_rules").alias("metric"), F.lit(float(failed)).alias("value"))
        out = gate_rows.unionByName(notice)
    else:
        out = gate_rows.unionByName(analytics_output(clean(), cols))
    return out.select(F.lit("failed" if failed else "report").alias("status"), *REPORT_COLUMNS)


def write_json(frames: Mapping[str, DataFrame], out_dir: str) -> None:
    """Write each (small, aggregated) frame as JSON under ``out_dir/<name>``, doubles to 3 places."""
    for name, df in frames.items():
        rounded(df).write.mode("overwrite").json(f"{out_dir.rstrip('/')}/{name}")

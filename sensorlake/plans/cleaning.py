"""The cleaning query as one DataFrame plan.

parsed readings
  -> first arrival per (sensor_id, timestamp text)      [grouped min_by; flags by a join on the arrival id]
  -> trailing-mean imputation of missing temperatures   [bucketed range window]
  -> outcome per row: duplicate | bad_timestamp | no_history | out_of_range | kept
  -> late class of kept rows vs. earlier batches         [blocked running max]
  -> time features
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.features import add_time_features
from sensorlake.operators.impute import trailing_mean, trailing_mean_feedback
from sensorlake.operators.quality import DEDUP_KEYS, dedup_first, first_flags, in_range_sql, late_arrivals, outcome_sql
from sensorlake.session import materialize
from sensorlake.schema import BAD_TIMESTAMP, DUPLICATE, HISTORY_SECONDS, KEPT, LATE_ACCEPTED, NO_HISTORY, OUT_OF_RANGE, TOO_LATE

CLEAN_COLUMNS = ("event_id", "batch_id", "sensor_id", "event_time", "temperature", "humidity", "status",
                 "hour_of_day", "day_of_week", "is_weekend", "temp_corrected", "late_class", "delay_s")


def fill(d: DataFrame, width_seconds: float, order: str, bucket_seconds: float | None = None, feedback: bool = False,
         history: str = "false") -> DataFrame:
    """Rows flagged ``is_first`` -> ``imputed``, ``outcome``, ``temp_corrected``, filled ``temperature`` (raw one kept apart).

    ``history`` (SQL) marks extra rows that only serve as history. With ``feedback`` a filled value is history for later rows.
    """
    valid_time = f"is_first AND event_time IS NOT NULL AND NOT ({history})"
    d = d.selectExpr("*", f"({history}) OR {valid_time} AND temperature IS NOT NULL AND {in_range_sql('temperature')} AS _use",
                     f"{valid_time} AND temperature IS NULL AS _need")
    mean = trailing_mean_feedback if feedback else trailing_mean
    d = mean(d, width_seconds, "temperature", use_col="_use", need_col="_need", id_col=order, out_col="imputed",
             bucket_seconds=bucket_seconds)
    return d.selectExpr(
        *[f"`{c}`" for c in d.columns if c not in ("temperature", "_use", "_need")],
        "temperature AS raw_temperature",
        f"{outcome_sql()} AS outcome",
        "temperature IS NULL AND imputed IS NOT NULL AS temp_corrected",
        "coalesce(temperature, imputed) AS temperature",
    )


def annotate(parsed: DataFrame, width_seconds: float = HISTORY_SECONDS, order: str = "event_id",
             bucket_seconds: float | None = None, feedback: bool = False, firsts_only: bool = False,
             materialized: bool = False) -> DataFrame:
    """Every input row with ``is_first``, ``imputed``, ``outcome``, ``temp_corrected`` and the filled ``temperature``.

    ``firsts_only`` leaves the duplicates out, which spares the join that flags
    them: enough for the cleaned rows and everything made from them. Nothing is
    stored unless ``materialized``; a caller with several consumers better stores the columns that they need.
    """
    d = dedup_first(parsed, DEDUP_KEYS, order).withColumn("is_first", F.lit(True)) if firsts_only else first_flags(
        parsed, DEDUP_KEYS, order)
    out = fill(d, width_seconds, order, bucket_seconds, feedback)
    return materialize(out) if materialized else out


ANALYTIC_COLUMNS = tuple(c for c in CLEAN_COLUMNS if c not in ("late_class", "delay_s"))


def clean_from_annotated(annotated: DataFrame, batch_col: str = "batch_id", late: bool = True,
                         drop_too_late: bool = False) -> DataFrame:
    """Kept rows with time features, and with the late class unless ``late=False``
    (analytics do not need it, which spares the running maximum over batches).
    ``drop_too_late`` leaves out rows that are later than accepted."""
    kept = annotated.where(F.col("outcome") == KEPT)
    if not late:
        return add_time_features(kept).select(*ANALYTIC_COLUMNS)
    classed = late_arrivals(kept, batch_col)
    return add_time_features(classed.where(F.col("late_class") != TOO_LATE) if drop_too_late else classed).select(*CLEAN_COLUMNS)


def clean_readings(parsed: DataFrame, width_seconds: float = HISTORY_SECONDS, order: str = "event_id",
                   batch_col: str = "batch_id", feedback: bool = False, drop_too_late: bool = False) -> DataFrame:
    """The cleaned readings table (flagship plan); the kept rows are stored once, as the late class reads them twice."""
    kept = annotate(parsed, width_seconds, order, feedback=feedback, firsts_only=True).where(F.col("outcome") == KEPT)
    columns = [c for c in CLEAN_COLUMNS if c in kept.columns] + ["outcome"]
    return clean_from_annotated(materialize(kept.select(*columns)), batch_col, drop_too_late=drop_too_late)


def outcome_counts() -> list[Column]:
    """Aggregates over annotated rows: the outcome counters of reports and batch logs."""
    o = F.col("outcome")
    return [
        F.count_if(o == KEPT).alias("cleaned_rows"),
        F.count_if((o == KEPT) & F.col("temp_corrected")).alias("missing_corrected"),
        F.count_if(o == DUPLICATE).alias("duplicates_removed"),
        F.count_if(o.isin(BAD_TIMESTAMP, OUT_OF_RANGE)).alias("invalid_removed"),
        F.count_if(o == NO_HISTORY).alias("dropped_insufficient_history"),
    ]


BATCH_COUNTERS = ("raw_rows", "cleaned_rows", "missing_corrected", "duplicates_removed", "invalid_removed",
                  "dropped_insufficient_history", "late_accepted")


def batch_log(annotated: DataFrame, clean: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Per micro-batch: raw and cleaned rows, outcome counters, and their running totals."""
    per = annotated.groupBy(batch_col).agg(F.count(F.lit(1)).alias("raw_rows"), *outcome_counts())
    late = clean.groupBy(batch_col).agg(F.count_if(F.col("late_class") == LATE_ACCEPTED).alias("late_accepted"))
    per = per.join(late, batch_col, "left").withColumn("late_accepted", F.coalesce("late_accepted", F.lit(0)))
    from sensorlake.operators.prefix import inclusive_prefix

    running = inclusive_prefix(per, batch_col, {c: "sum" for c in BATCH_COUNTERS if c not in ("raw_rows", "cleaned_rows")},
                               prefix="total_")
    return running.select(batch_col, *[F.col(c).cast("long").alias(c) for c in BATCH_COUNTERS],
                          *[F.col(f"total_{c}").cast("long").alias(f"total_{c}") for c in BATCH_COUNTERS[2:]])

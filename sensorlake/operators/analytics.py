"""Per-sensor analytics, summary statistics and correlations over cleaned readings."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement, product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.scalar import seconds_between
from sensorlake.operators.quantile import exact_median
from sensorlake.schema import HISTORY_SECONDS

FEATURES = ("temperature", "humidity", "hour_of_day", "day_of_week", "is_weekend")


def sensor_stats(clean: DataFrame, key: str = "sensor_id", value: str = "temperature") -> DataFrame:
    """Average, maximum and count of the value per key (imputed rows included)."""
    return clean.groupBy(key).agg(
        F.avg(value).alias("avg_temperature"),
        F.max(value).alias("max_temperature"),
        F.count(F.lit(1)).alias("readings"),
    )


def status_distribution(clean: DataFrame, col: str = "status") -> DataFrame:
    """Rows per status; NULL status is its own group."""
    return clean.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def active_sensors(clean: DataFrame, within_seconds: float = HISTORY_SECONDS, key: str = "sensor_id",
                   time_col: str = "event_time") -> DataFrame:
    """Keys whose newest reading is within ``within_seconds`` of the newest reading overall.

    The overall maximum is a scalar subquery (one value), not a join.
    """
    per_key = clean.groupBy(key).agg(F.max(time_col).alias("last_event_time"))
    newest = clean.agg(F.max(time_col)).scalar()
    return per_key.where(seconds_between(newest, F.col("last_event_time")) <= within_seconds)


def _stack(wide: DataFrame, n_cols: int, entries: Sequence[str], names: str) -> DataFrame:
    return wide.selectExpr(f"stack({n_cols}, {', '.join(entries)}) as ({names})")


def summary_stats(clean: DataFrame, cols: Sequence[str] = FEATURES) -> DataFrame:
    """mean / median / sample standard deviation / count per feature, long form.

    Mean, deviation and count come from one aggregate over the wide rows;
    the exact median from the distributed selection in ``quantile``.
    """
    cols = list(cols)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_samp(x).alias(f"s_{c}"), F.count(x).alias(f"n_{c}")]
    wide = clean.agg(*aggs)
    stats = _stack(wide, len(cols), [f"'{c}', m_{c}, s_{c}, n_{c}" for c in cols], "feature, mean, std, n")
    long_vals = clean.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])).alias("_x")
    ).select("_x.feature", "_x.v")
    med = exact_median(long_vals, "feature", "v", "median")
    return stats.join(med, "feature", "left").select(
        "feature", "mean", "median", "std", F.col("n").cast("long").alias("n"))


def correlation_matrix(clean: DataFrame, cols: Sequence[str] = FEATURES) -> DataFrame:
    """Pearson correlation of every ordered feature pair in one aggregate, long form (x, y, r).

    NULLs are dropped pairwise; a constant feature gives NULL.
    """
    cols = list(cols)
    pairs = list(combinations_with_replacement(range(len(cols)), 2))   # the other half is the mirror image
    wide = clean.agg(*[F.corr(F.col(cols[i]).cast("double"), F.col(cols[j]).cast("double")).alias(f"r_{i}_{j}") for i, j in pairs])
    entries = [f"'{cols[i]}', '{cols[j]}', r_{min(i, j)}_{max(i, j)}" for i, j in product(range(len(cols)), repeat=2)]
    return _stack(wide, len(entries), entries, "x, y, r")

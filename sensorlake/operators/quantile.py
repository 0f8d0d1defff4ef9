"""Exact median per group without gathering a group into one task.

``percentile``/``median`` merge a per-group map of every distinct value in a
single task, so a group holding a third of the data breaks it. Here:

1. distinct values are counted per (group, value) - partially aggregated;
2. each round splits the current value range of every target into ``bins``
   equal-width bins, counts per bin (at most ``bins`` rows per group), picks
   the bin holding the wanted rank with a running count, and narrows the range
   to that bin's own min/max;
3. refinement stops once every chosen bin holds a single value (checked on the
   few-row target table), else after ``rounds`` rounds; the distinct values left
   in the chosen bin are then ordered directly (each round shrinks the range by
   ``bins``, so only values within range/bins**rounds of the answer remain).

The median of ``n`` values is the mean of the values at ranks
``floor((n+1)/2)`` and ``floor(n/2)+1`` (interpolated, as SQL ``median``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_median(long_df: DataFrame, group_col: str, value_col: str, out_col: str = "median",
                 bins: int = 65536, rounds: int = 4) -> DataFrame:
    """(group, median) over non-NULL values of ``value_col``."""
    vals = long_df.where(F.col(value_col).isNotNull()).select(
        F.col(group_col).alias("_g"), F.col(value_col).cast("double").alias("_v"))
    from sensorlake.session import materialize

    distinct = materialize(vals.groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_c")))
    finite = F.expr("CASE WHEN abs(_v) < double('Infinity') THEN _v END")
    stats = distinct.groupBy("_g").agg(F.sum("_c").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"),
                                       F.min(finite).alias("_flo"), F.max(finite).alias("_fhi"))
    # two rank targets per group (equal when n is odd); params stay one row per target
    params = stats.select(
        "_g", "_lo", "_hi", "_flo", "_fhi",
        F.explode(F.array(
            F.struct(F.lit(0).alias("_tid"), F.expr("(_n + 1) div 2").alias("_k")),
            F.struct(F.lit(1).alias("_tid"), F.expr("_n div 2 + 1").alias("_k")),
        )).alias("_t"),
    ).select("_g", "_lo", "_hi", "_flo", "_fhi", "_t._tid", "_t._k")

    def in_range(p: DataFrame) -> DataFrame:
        # two rows of params for each group: the join is left to the size that is measured
        return distinct.join(p, "_g").where(F.col("_v").between(F.col("_lo"), F.col("_hi")))

    params = materialize(params)
    for _ in range(rounds):
        if params.where(F.col("_lo") < F.col("_hi")).isEmpty():
            break
        cand = in_range(params)
        # infinities and NaN (the greatest value) are bins of their own; halves keep the width finite
        bin_ = F.expr(
            f"CASE WHEN _v = double('-Infinity') THEN -1L WHEN isnan(_v) THEN {bins + 1}L WHEN _v = double('Infinity') THEN {bins}L "
            f"WHEN _fhi > _flo THEN least(CAST(floor((_v / 2 - _flo / 2) / (_fhi / 2 - _flo / 2) * {bins}) AS BIGINT), {bins - 1}L) ELSE 0L END")
        per_bin = cand.groupBy("_g", "_tid", "_k", bin_.alias("_b")).agg(
            F.sum("_c").alias("_bc"), F.min("_v").alias("_blo"), F.max("_v").alias("_bhi"))
        w = Window.partitionBy("_g", "_tid").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        per_bin = per_bin.withColumn("_cum", F.sum("_bc").over(w))
        params = per_bin.where((F.col("_cum") - F.col("_bc") < F.col("_k")) & (F.col("_k") <= F.col("_cum"))).select(
            "_g", F.col("_blo").alias("_lo"), F.col("_bhi").alias("_hi"), F.col("_blo").alias("_flo"), F.col("_bhi").alias("_fhi"), "_tid",
            (F.col("_k") - (F.col("_cum") - F.col("_bc"))).alias("_k"))
        params = materialize(params)

    cand = in_range(params)
    w = Window.partitionBy("_g", "_tid").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = cand.withColumn("_cum", F.sum("_c").over(w))
    picked = ranked.where((F.col("_cum") - F.col("_c") < F.col("_k")) & (F.col("_k") <= F.col("_cum")))
    return picked.groupBy("_g").agg(F.avg("_v").alias(out_col)).withColumnRenamed("_g", group_col)

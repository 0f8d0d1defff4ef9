"""Trailing-window mean imputation per key.

A missing value becomes the mean of the same key's usable values whose time
lies in ``[t - width, t]`` (inclusive both ends; never newer than ``t``).

Partitioning: a plain ``Window.partitionBy(key)`` sends a key's whole series
to one task, and one sensor may hold a third of all rows. Instead the series
is cut into time buckets of ``bucket_seconds``; a usable row is also copied
into the following bucket(s) whose start lies within ``width`` of it, so each
bucket sees all the history it needs and the result is exact. Rows that take
no part (duplicates, unparseable times) get a partition of their own, keyed by
their unique arrival id, so hot groups of copies never meet in one task.
After dedup a key has at most one row per distinct timestamp text, so a
bucket group is bounded by the bucket's length in seconds.
"""

from __future__ import annotations

import math
from collections import deque
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.schema import HISTORY_SECONDS

#: length of the slices in which chains of dependent fills are solved: at most one row a second after dedup
SLICE_SECONDS = 86_400.0


def trailing_mean(df: DataFrame, width_seconds: float = HISTORY_SECONDS, value_col: str = "temperature",
                  key_col: str = "sensor_id", time_col: str = "event_time", use_col: str | None = None,
                  need_col: str | None = None, id_col: str = "event_id", out_col: str = "imputed",
                  bucket_seconds: float | None = None, exclude_current: bool = False) -> DataFrame:
    """Add ``out_col`` = trailing mean for rows flagged ``need_col`` (NULL when no history).

    ``use_col`` flags rows whose value may serve as history (default: value and
    time present); ``need_col`` flags rows to fill (default: value missing,
    time present). ``id_col`` must be unique per row. ``exclude_current``
    leaves the row's own instant out of its frame (``[t - width, t)``).
    """
    w_us = int(round(width_seconds * 1_000_000))
    b_us = int(round((bucket_seconds or max(12 * width_seconds, 3600)) * 1_000_000))
    # column logic as SQL expressions (one JVM call each while the plan is built)
    use = f"`{use_col}`" if use_col else f"(`{value_col}` IS NOT NULL AND `{time_col}` IS NOT NULL)"
    need = f"`{need_col}`" if need_col else f"(`{value_col}` IS NULL AND `{time_col}` IS NOT NULL)"
    t = f"unix_micros(`{time_col}`)"
    own = f"(({t} - pmod({t}, {b_us})) div {b_us})"
    last = f"((({t} + {w_us}) - pmod({t} + {w_us}, {b_us})) div {b_us})"
    staged = df.selectExpr(
        "*",
        f"{t} AS _tm_t",
        f"({use} OR {need}) AS _tm_part",
        f"{use} AS _tm_use",
        f"{need} AS _tm_need",
        f"{own} AS _tm_own",
        f"explode(CASE WHEN {use} THEN sequence({own}, {last}) WHEN {need} THEN array({own}) "
        f"ELSE array(CAST(`{id_col}` AS BIGINT)) END) AS _tm_pb",
    )
    upper = -1 if exclude_current else 0
    frame = (f"PARTITION BY _tm_part, `{key_col}`, _tm_pb ORDER BY _tm_t "
             f"RANGE BETWEEN {w_us} PRECEDING AND {'1 PRECEDING' if upper else 'CURRENT ROW'}")
    out = staged.selectExpr("*", f"avg(CASE WHEN _tm_use THEN `{value_col}` END) OVER ({frame}) AS _tm_mean")
    out = out.where("NOT _tm_part OR _tm_pb = _tm_own")
    keep = [f"`{c}`" for c in df.columns if c != out_col]
    return out.selectExpr(*keep, f"CASE WHEN _tm_need THEN _tm_mean END AS `{out_col}`")


def _trailing(df: DataFrame, measures: dict[str, str], width_seconds: float, key_col: str, time_col: str, use: str, need: str,
              id_sql: str, bucket_seconds: float | None) -> DataFrame:
    """Adds each SQL aggregate in ``measures`` over the rows flagged ``use`` in ``[t - width, t)`` to the rows flagged ``need``."""
    w_us = int(round(width_seconds * 1_000_000))
    b_us = int(round((bucket_seconds or max(12 * width_seconds, 3600)) * 1_000_000))
    t = f"unix_micros(`{time_col}`)"
    own, last = f"(({t} - pmod({t}, {b_us})) div {b_us})", f"((({t} + {w_us}) - pmod({t} + {w_us}, {b_us})) div {b_us})"
    staged = df.selectExpr("*", f"{t} AS _t", f"{own} AS _own", f"({use} OR {need}) AS _part", f"explode(CASE WHEN {use} THEN sequence({own}, {last}) "
                           f"WHEN {need} THEN array({own}) ELSE array({id_sql}) END) AS _bucket")
    frame = f"(PARTITION BY _part, `{key_col}`, _bucket ORDER BY _t RANGE BETWEEN {w_us} PRECEDING AND 1 PRECEDING)"
    out = staged.selectExpr("*", *[f"{sql} OVER {frame} AS `{name}`" for name, sql in measures.items()])
    return out.where("NOT _part OR _bucket = _own").drop("_t", "_own", "_part", "_bucket")


def solve_slice(width_us: int, pdf):
    """Fills of one slice of an island in time order; rows that come with a fill are of the slice before and only seen.

    A fill counts for rows of later times, up to ``width_us`` on. The window's sum is carried along and added up anew whenever the
    window has turned over, so its cost does not depend on the window's length and its error does not grow.
    """
    pdf = pdf.sort_values("_us", kind="stable")
    window, waiting, total, gone, fills = deque(), [], 0.0, 0, []
    for t, s, n, old in zip(pdf["_us"].tolist(), pdf["_sum"].tolist(), pdf["_n"].tolist(), pdf["_fill"].tolist(), strict=True):
        while waiting and waiting[0][0] < t:
            window.append(waiting.pop(0))
            total += window[-1][1]
        while window and window[0][0] < t - width_us:
            total -= window.popleft()[1]
            gone += 1
        if gone > len(window):
            total, gone = math.fsum(v for _, v in window), 0
        seen = old is not None and not math.isnan(old)
        if seen:
            value = old
        else:
            k = int(n) + len(window)
            value = (s + total) / k if k else None
        if value is not None:
            waiting.append((t, value))
        fills.append(None if seen else value)
    new = pdf["_fill"].isna()
    return pdf.assign(_fill=[math.nan if f is None else f for f in fills]).loc[new, [c for c in pdf.columns if c not in ("_sum", "_n")]]


def trailing_mean_feedback(df: DataFrame, width_seconds: float = HISTORY_SECONDS, value_col: str = "temperature",
                           key_col: str = "sensor_id", time_col: str = "event_time", use_col: str | None = None,
                           need_col: str | None = None, id_col: str = "event_id", out_col: str = "imputed",
                           bucket_seconds: float | None = None, slice_seconds: float = SLICE_SECONDS) -> DataFrame:
    """Trailing mean where filled values count as history for later rows (in time order, ``[t - width, t)``).

    A fill depends on the observed values of its window, a sum and a count that
    the bucketed windows give, and on the fills in it. Missing rows of a key that lie within
    ``width`` of each other form an island; no fill reaches beyond its island. Islands are numbered by their first time, a
    running maximum in blocks; one of a single row needs no pass. The others are cut into slices of ``slice_seconds`` from their
    start and solved in rounds, slice after slice: a task holds one slice of an island and the fills of the last ``width`` seconds
    before it, however long the chain of dependent fills is. Rounds = slices of the longest island; most have one.
    """
    from sensorlake.operators.prefix import inclusive_prefix
    from sensorlake.operators.quality import arrival
    from sensorlake.session import materialize, scratch_dir

    use = f"`{use_col}`" if use_col else f"(`{value_col}` IS NOT NULL AND `{time_col}` IS NOT NULL)"
    need = f"`{need_col}`" if need_col else f"(`{value_col}` IS NULL AND `{time_col}` IS NOT NULL)"
    ids = arrival(df, id_col)
    spread = f"xxhash64({', '.join(f'`{c}`' for c in ids)})"
    slim = df.selectExpr(*[f"`{c}`" for c in ids], f"`{key_col}` AS _k", f"`{time_col}` AS _time", f"CASE WHEN {use} THEN `{value_col}` END AS _v",
                         f"{use} AS _use", f"{need} AS _need").where("_use OR _need")
    seen = _trailing(slim, {"_sum": "sum(_v)", "_n": "count(CASE WHEN _use THEN _v END)"}, width_seconds, "_k", "_time", "_use", "_need", spread, bucket_seconds)
    gaps = _trailing(seen.where("_need").withColumn("_all", F.lit(True)), {"_before": "count(1)"}, width_seconds, "_k", "_time", "_all", "_all", spread, bucket_seconds)
    missing = materialize(gaps.selectExpr(*[f"`{c}`" for c in ids], "_k", "unix_micros(_time) AS _us", "coalesce(_sum, 0D) AS _sum", "_n", "_before = 0 AS _starts"))
    # an island is named by its first time; rows of a key and second share the running maximum
    keyed = missing.selectExpr("*", "concat(CASE WHEN _k IS NULL THEN 'n' ELSE 's' END, coalesce(CAST(_k AS STRING), '')) AS _key", "_us div 1000000 AS _sec")
    least = keyed.agg(F.coalesce(F.min("_sec"), F.lit(0)).alias("m")).first()["m"]
    starts = keyed.where("_starts").groupBy("_key", "_sec").agg(F.max("_us").alias("_island"))
    marks = keyed.select("_key", "_sec").distinct().join(starts, ["_key", "_sec"], "left").withColumn("_at", F.col("_sec") - F.lit(least))
    islands = inclusive_prefix(marks, "_at", {"_island": "max"}, group_cols=["_key"]).select("_key", "_sec", F.col("cum__island").alias("_island"))
    width_us, slice_us = int(round(width_seconds * 1_000_000)), max(1, int(round(slice_seconds * 1_000_000)))
    kinds = dict(df.dtypes)
    placed = keyed.join(islands, ["_key", "_sec"]).select(*ids, "_key", "_island", "_us", "_sum", "_n")
    sizes = placed.groupBy("_key", "_island").agg(F.count(F.lit(1)).alias("_rows"), F.max(F.expr(f"(_us - _island) div {slice_us}")).alias("_slices"))
    folder = scratch_dir(df.sparkSession, "islands")
    placed.join(sizes, ["_key", "_island"]).withColumn("_slice", F.expr(f"(_us - _island) div {slice_us}")).write.partitionBy("_slice").parquet(folder)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in ids], "_key string, _island long, _us long, _sum double, _n long, _rows long, _slices long, _slice long"])
    placed = df.sparkSession.read.schema(schema).parquet(folder)
    alone = placed.where("_rows = 1").select(*ids, F.expr("CASE WHEN _n > 0 THEN _sum / _n END").alias("_fill"))
    chains = placed.where("_rows > 1")
    last = chains.agg(F.max("_slices")).first()[0]
    solved, carry = alone, None
    for k in range(0 if last is None else last + 1):
        rows = chains.where(F.col("_slice") == k).select(*ids, "_key", "_island", "_us", "_sum", "_n", "_slices", F.lit(None).cast("double").alias("_fill"))
        if carry is not None:
            rows = rows.unionByName(carry)
        fills = materialize(rows.groupBy("_key", "_island").applyInPandas(
            partial(solve_slice, width_us), ", ".join([*[f"`{c}` {kinds[c]}" for c in ids], "_key string, _island long, _us long, _slices long, _fill double"])))
        solved = solved.unionByName(fills.select(*ids, "_fill"))
        # what the next slice of a longer island still sees; its sums are not needed again
        carry = fills.where(f"_slices > {k} AND _fill IS NOT NULL AND _us >= _island + {(k + 1) * slice_us} - {width_us}").select(
            *ids, "_key", "_island", "_us", F.lit(0.0).alias("_sum"), F.lit(None).cast("long").alias("_n"), "_slices", "_fill")
    keep = [c for c in df.columns if c != out_col]
    return df.join(solved, ids, "left").select(*keep, F.col("_fill").alias(out_col))

"""Distributed running aggregates over an integer order column.

``Window.orderBy(x)`` without a partition puts every row into one task. Here
the order range is cut into blocks of ``fanout`` consecutive values: a running
aggregate inside each block (window partitioned by block), then the same one
level up over block totals, and so on. Every window group holds at most
``fanout`` rows; the top level holds ``n / fanout**levels`` rows, which stays
small for any realistic ``n``. Each level's result is joined back by block id.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_OPS = ("max", "min", "sum")


def _combine(op: str, a: str, b: str) -> str:
    """SQL for combining two partial aggregates (NULL = nothing seen)."""
    if op == "max":
        return f"greatest({a}, {b})"
    if op == "min":
        return f"least({a}, {b})"
    return f"CASE WHEN {a} IS NULL AND {b} IS NULL THEN NULL ELSE coalesce({a}, 0) + coalesce({b}, 0) END"


def exclusive_prefix(df: DataFrame, order_col: str, values: Mapping[str, str],
                     group_cols: Sequence[str] = (), fanout: int = 65536, levels: int = 2,
                     prefix: str = "prev_", materialized: bool = True) -> DataFrame:
    """Add ``prev_<col>``: ``op(col)`` over rows of the same group with a smaller order value.

    ``values`` maps column -> ``max`` | ``min`` | ``sum``. Order values must be
    non-negative integers, unique within a group (one row per batch, say).
    Rows with no predecessor get NULL. The input is read by every level, so it
    is stored once first (``materialized``; it is small - one row per batch).
    """
    if materialized:
        from sensorlake.session import materialize

        df = materialize(df)
    groups = [f"`{g}`" for g in group_cols]
    cols = list(values)
    if any(values[c] not in _OPS for c in cols):
        raise ValueError(f"ops must be one of {_OPS}")
    blk = [f"_blk{i}" for i in range(levels + 1)]
    orig = [f"`{c}`" for c in df.columns]
    base = df.selectExpr("*", f"CAST(`{order_col}` AS BIGINT) AS {blk[0]}",
                         *[f"CAST(`{order_col}` AS BIGINT) div {int(fanout) ** i} AS {blk[i]}"
                           for i in range(1, levels + 1)])

    def running(within: list[str], order: str, c: str) -> str:
        part = f"PARTITION BY {', '.join(within)} " if within else ""
        return (f"{values[c]}(`{c}`) OVER ({part}ORDER BY {order} "
                "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")

    # level 0: inside blocks of `fanout` consecutive order values
    keep = orig + blk
    out = base.selectExpr(*keep, *[f"{running(groups + [blk[1]], blk[0], c)} AS _acc_{i}" for i, c in enumerate(cols)])
    totals = base.groupBy(*[F.col(g.strip("`")) for g in groups], *blk[1:]).agg(
        *[F.expr(f"{values[c]}(`{c}`)").alias(c) for c in cols])
    for lvl in range(1, levels + 1):
        within = groups + ([blk[lvl + 1]] if lvl < levels else [])
        level = totals.selectExpr(*groups, blk[lvl],
                                  *[f"{running(within, blk[lvl], c)} AS _l_{i}" for i, c in enumerate(cols)])
        out = out.join(level, [g.strip("`") for g in groups] + [blk[lvl]], "left").selectExpr(
            *keep, *[f"{_combine(values[c], f'_acc_{i}', f'_l_{i}')} AS _acc_{i}" for i, c in enumerate(cols)])
        if lvl < levels:
            totals = totals.groupBy(*[F.col(g.strip("`")) for g in groups], *blk[lvl + 1:]).agg(
                *[F.expr(f"{values[c]}(`{c}`)").alias(c) for c in cols])
    return out.selectExpr(*orig, *[f"_acc_{i} AS `{prefix}{c}`" for i, c in enumerate(cols)])

def inclusive_prefix(df: DataFrame, order_col: str, values: Mapping[str, str],
                     group_cols: Sequence[str] = (), prefix: str = "cum_", **kw) -> DataFrame:
    """Running aggregate including the row itself (``cum_<col>``)."""
    out = exclusive_prefix(df, order_col, values, group_cols, prefix="_ex_", **kw)
    return out.selectExpr(*[f"`{c}`" for c in df.columns], *[
        f"{_combine(op, f'`_ex_{c}`', f'`{c}`')} AS `{prefix}{c}`" for c, op in values.items()])

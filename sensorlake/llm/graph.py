"""Connected components of a distributed edge list (large-star / small-star rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.tables import stored


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.shiftright(F.xxhash64("u", "v"), 32))).first()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) edges -> (u, v): every vertex that is not its component's smallest, with the smallest.

    Each round replaces edges by edges to the smallest neighbour, in two
    aggregations that combine on the map side and joins with one row per
    vertex, so a vertex with many edges is never gathered. Rounds end when the
    edges no longer change (logarithmically many in practice).
    """
    edges = stored(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").selectExpr("v AS u", "m AS v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").selectExpr("v AS u", "m AS v").union(
            least.selectExpr("u", "m AS v"))
        edges = stored(small.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges

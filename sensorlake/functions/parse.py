"""Decoding of log values into typed readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorlake.schema import READING, TIMESTAMP_PATTERN


def event_time_expr(text: Column | str = "timestamp", pattern: str = TIMESTAMP_PATTERN) -> Column:
    """Text -> TIMESTAMP with an exact pattern; NULL when the text does not parse."""
    col = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(col, F.lit(pattern))


def with_event_time(df: DataFrame, src: str = "timestamp", dst: str = "event_time",
                    pattern: str = TIMESTAMP_PATTERN) -> DataFrame:
    """Add ``dst`` = parsed ``src`` (TIMESTAMP, NULL if unparseable)."""
    return df.withColumn(dst, event_time_expr(src, pattern))


def parse_readings(df: DataFrame, schema: StructType = READING, value_col: str = "value",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Decode the JSON ``value`` column under a fixed schema (PERMISSIVE).

    A malformed message yields all-NULL fields, a wrongly typed field yields
    NULL for that field only. ``keep`` lists envelope columns to carry along
    (e.g. ``partition``, ``offset``).

    The struct is expanded by a generator (``inline`` of a one-element array):
    later filters on the reading's fields cannot be pushed below a generator,
    so the JSON is parsed exactly once per row instead of once per predicate
    plus once for the projection.
    """
    parsed = F.from_json(F.col(value_col).cast("string"), schema)
    return df.select(*keep, F.inline(F.array(parsed)))

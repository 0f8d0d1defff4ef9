"""Small scalar helpers used across operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_rate(count: Column | str, seconds: Column | str) -> Column:
    """count / seconds, or 0.0 when seconds is not positive (or NULL)."""
    c, s = _c(count).cast("double"), _c(seconds).cast("double")
    return F.when(s > 0, c / s).otherwise(F.lit(0.0))


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Exact difference in seconds (fractions kept) between two timestamps."""
    return (F.unix_micros(_c(later)) - F.unix_micros(_c(earlier))) / F.lit(1_000_000.0)


def to_ntz(col: Column | str) -> Column:
    """Session-zone TIMESTAMP -> TIMESTAMP_NTZ (wall clock), for zone-free output."""
    return _c(col).cast("timestamp_ntz")

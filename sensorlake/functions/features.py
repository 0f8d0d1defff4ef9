"""Derived time features and the legacy output types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_time_features(df: DataFrame, time_col: str = "event_time") -> DataFrame:
    """hour_of_day 0-23, day_of_week Monday=0..Sunday=6, is_weekend 1 if Saturday/Sunday."""
    t = f"`{time_col}`"
    return df.selectExpr("*", f"hour({t}) AS hour_of_day", f"weekday({t}) AS day_of_week",
                         f"CASE WHEN weekday({t}) >= 5 THEN 1 ELSE 0 END AS is_weekend")

def legacy_types(df: DataFrame) -> DataFrame:
    """The reference's on-disk cleaned form: nine columns, features as DOUBLE,
    the correction flag as the text ``True``/``False``."""
    return df.select(
        "sensor_id",
        "event_time",
        F.col("temperature").cast("double").alias("temperature"),
        F.col("humidity").cast("double").alias("humidity"),
        "status",
        F.col("hour_of_day").cast("double").alias("hour_of_day"),
        F.col("day_of_week").cast("double").alias("day_of_week"),
        F.col("is_weekend").cast("double").alias("is_weekend"),
        F.initcap(F.col("temp_corrected").cast("string")).alias("temp_corrected"),
    )

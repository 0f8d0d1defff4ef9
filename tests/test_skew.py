"""A key holding a third of all rows: exact results, and no plan step that sends it to one task."""

import re

from pyspark.sql import functions as F

from sensorlake.functions.parse import with_event_time
from sensorlake.plans.cleaning import annotate, clean_from_annotated


def _hot_input(spark, n=3000):
    # rows 0..n-1: ordinary readings spread over 3 sensors, one per 7 s; every third row is a copy
    # of the hot reading (sensor_1, 2024-01-01 00:00:00), so one dedup key holds a third of the rows
    base = spark.range(n).select(
        F.col("id").alias("event_id"),
        F.expr("id div 20").alias("batch_id"),
        F.when(F.col("id") % 3 == 0, F.lit("sensor_1")).otherwise(F.concat(F.lit("sensor_"), (F.col("id") % 3 + 1).cast("string"))).alias("sensor_id"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01 00:00:00")).otherwise(
            F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 7), "yyyy-MM-dd HH:mm:ss")).alias("timestamp"),
        F.when(F.col("id") % 11 == 5, F.lit(None)).otherwise((F.col("id") % 40).cast("double")).alias("temperature"),
        F.lit(50.0).alias("humidity"),
        F.lit("active").alias("status"),
    )
    return with_event_time(base)


def test_hot_key_results(spark):
    parsed = _hot_input(spark)
    a = annotate(parsed, 300)
    counts = {r.outcome: r["count"] for r in a.groupBy("outcome").count().collect()}
    assert counts["duplicate"] == 999          # all copies but the first of the hot key
    assert sum(counts.values()) == 3000
    first_hot = a.where("sensor_id = 'sensor_1' AND timestamp = '2024-01-01 00:00:00' AND is_first").collect()
    assert [r.event_id for r in first_hot] == [0]


def test_no_window_on_hot_partitions(spark):
    parsed = _hot_input(spark)
    plan = clean_from_annotated(annotate(parsed, 300, materialized=False))._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"windowspecdefinition\(([^)]*)\)", plan)
    for spec in windows:
        # no window keyed by the dedup key, and none keyed by the sensor alone
        assert not re.match(r"sensor_id#\d+, timestamp#\d+", spec)
        assert not re.match(r"sensor_id#\d+, [a-z_]+#\d+ ASC", spec)
    assert any("_tm_pb" in spec for spec in windows)

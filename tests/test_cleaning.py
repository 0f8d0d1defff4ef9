"""Hand-traced cleaning case (two micro-batches, 5-minute history)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sensorlake.functions.parse import with_event_time
from sensorlake.operators.analytics import active_sensors, sensor_stats, status_distribution
from sensorlake.plans.cleaning import annotate, batch_log, clean_from_annotated
from sensorlake.schema import READING

ROWS = [
    # batch 0, arrival order
    (0, 0, "s1", "2024-01-01 10:00:00", 20.0, 50.0, "active"),
    (1, 0, "s1", "2024-01-01 10:02:00", None, 50.0, "active"),
    (2, 0, "s1", "2024-01-01 10:02:00", 99.0, 50.0, "idle"),
    (3, 0, "s1", "2024-01-01 10:05:00", 30.0, 50.0, "active"),
    (4, 0, "s1", "2024-01-01 10:05:01", None, 50.0, "active"),
    (5, 0, "s1", "2024-01-01 10:05:02", 150.0, 50.0, "active"),
    (6, 0, "s2", "2024-01-01 10:01:00", None, 50.0, "active"),
    (7, 0, "s2", "NOT_A_TIMESTAMP", 22.0, 50.0, "error"),
    (8, 0, "s2", "NOT_A_TIMESTAMP", 23.0, 50.0, "error"),
    # batch 1
    (9, 1, "s1", "2024-01-01 09:50:00", 12.0, 50.0, "active"),
    (10, 1, "s1", "2024-01-01 10:03:00", 10.0, 50.0, "active"),
    (11, 1, "s3", "2024-01-01 10:20:00", 5.0, 50.0, None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    schema = "event_id long, batch_id long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in READING)
    return with_event_time(spark.createDataFrame(ROWS, schema))


def test_outcomes_and_conservation(parsed):
    a = annotate(parsed, 300).select("event_id", "outcome", "imputed").orderBy("event_id").collect()
    outcomes = [r.outcome for r in a]
    assert outcomes == ["kept", "kept", "duplicate", "kept", "kept", "out_of_range", "no_history",
                        "bad_timestamp", "duplicate", "kept", "kept", "kept"]
    assert a[1].imputed == 20.0            # mean{20}
    # batch semantics: every observed reading in [t-300 s, t] counts, also the late 10:03:00 of batch 1
    assert a[4].imputed == 20.0
    assert len(a) == sum(outcomes.count(o) for o in set(outcomes))


def test_imputation_first_batch_only(parsed):
    a = {r.event_id: r.imputed for r in annotate(parsed.where("batch_id = 0"), 300).collect()}
    assert a[1] == 20.0
    assert a[4] == 30.0                    # 10:00:00 is 301 s old: only 30 remains (observed history)


def test_late_classes_and_features(parsed):
    c = {r.event_id: r for r in clean_from_annotated(annotate(parsed, 300)).collect()}
    assert c[9].late_class == "too_late" and c[9].delay_s == 901.0
    assert c[10].late_class == "late_accepted" and c[10].delay_s == 121.0
    assert c[11].late_class == "on_time"
    assert c[0].hour_of_day == 10 and c[0].day_of_week == 0 and c[0].is_weekend == 0   # 2024-01-01 is a Monday
    assert c[1].temp_corrected and not c[0].temp_corrected


def test_exactly_300_seconds_is_kept_in_history(spark, parsed):
    # the reading at 10:00:00 is exactly 300 s older than 10:05:00 -> stays; tie on the boundary
    extra = spark.createDataFrame([(12, 2, "s1", "2024-01-01 10:05:00.5", None, 1.0, "x")], parsed.drop(
        "event_time").schema)
    assert with_event_time(extra).first().event_time is None   # fractions do not parse with the exact pattern
    row = [r for r in annotate(parsed, 300).collect() if r.event_id == 1][0]
    assert row.imputed == 20.0


def test_analytics(parsed):
    clean = clean_from_annotated(annotate(parsed, 300))
    stats = {r.sensor_id: r for r in sensor_stats(clean).collect()}
    assert stats["s1"].readings == 6 and stats["s1"].max_temperature == 30.0
    assert {r.sensor_id for r in active_sensors(clean).collect()} == {"s3"}
    dist = {r.status: r.n for r in status_distribution(clean).collect()}
    assert dist[None] == 1 and sum(dist.values()) == 7


def test_batch_log_running_totals(parsed):
    a = annotate(parsed, 300)
    log = {r.batch_id: r for r in batch_log(a, clean_from_annotated(a)).collect()}
    assert log[0].raw_rows == 9 and log[0].cleaned_rows == 4
    assert log[1].late_accepted == 1 and log[1].total_late_accepted == 1
    assert log[1].total_duplicates_removed == 2 and log[1].total_invalid_removed == 2


def test_feedback_imputation(parsed):
    from sensorlake.operators.impute import trailing_mean_feedback
    from sensorlake.operators.quality import first_flags, in_range

    d = first_flags(parsed.where("batch_id = 0"))
    first, t, temp = F.col("is_first"), F.col("event_time"), F.col("temperature")
    d = d.withColumn("_use", first & t.isNotNull() & temp.isNotNull() & in_range(temp)).withColumn(
        "_need", first & t.isNotNull() & temp.isNull())
    out = {r.event_id: r.imputed for r in trailing_mean_feedback(d, 300, use_col="_use", need_col="_need").collect()}
    assert out[1] == 20.0
    assert out[4] == 25.0       # imputed 20 at 10:02:00 counts as history
    assert out[6] is None


def test_event_time_exact_pattern(spark):
    df = spark.createDataFrame([(" 2024-01-01 10:00:00",), ("2024-01-01 10:00:00",), ("2024-01-01T10:00:00",)], "t string")
    got = [r.e for r in df.select(F.try_to_timestamp("t", F.lit("yyyy-MM-dd HH:mm:ss")).alias("e")).collect()]
    assert got[0] is None and got[1] == datetime(2024, 1, 1, 10, 0, 0) and got[2] is None

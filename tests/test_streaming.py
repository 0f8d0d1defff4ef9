"""Streams: stream = batch on in-order files, restart from checkpoint, replay of a batch."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from sensorlake.session import scratch_dir
from sensorlake.sources.fixtures import planted_readings, stage_files
from sensorlake.sources.log import to_envelope
from sensorlake.streaming import clean as cs
from sensorlake.streaming.queries import parsed_stream
from sensorlake.streaming.runner import run_to_end


def _stage(spark, groups):
    r = planted_readings(spark, SF_SMALL, late=False)
    per = (r.agg(F.max("event_id")).first()[0] + 10) // 10
    env = to_envelope(r).withColumn("_file", F.expr(f"offset div {per}"))
    return env, per


def test_restart_from_checkpoint_gives_same_result(spark):
    env, _ = _stage(spark, 10)
    # one uninterrupted run
    path_a = scratch_dir(spark, "t-staged-a")
    stage_files(env, path_a, "_file", 10)
    root_a, ck_a = scratch_dir(spark, "t-root-a"), scratch_dir(spark, "t-ck-a")
    run_to_end(cs.start_clean_stream(parsed_stream(spark, path_a), root_a, ck_a))
    # stopped after 4 files, restarted from the checkpoint once the rest arrived
    path_b = scratch_dir(spark, "t-staged-b")
    stage_files(env.where("_file < 4"), path_b, "_file", 4)
    root_b, ck_b = scratch_dir(spark, "t-root-b"), scratch_dir(spark, "t-ck-b")
    run_to_end(cs.start_clean_stream(parsed_stream(spark, path_b), root_b, ck_b))
    stage_files(env.where("_file >= 4").withColumn("_file", F.col("_file") - 4), path_b, "_file", 6)
    run_to_end(cs.start_clean_stream(parsed_stream(spark, path_b), root_b, ck_b))
    a = cs.cleaned_table(spark, root_a)
    b = cs.cleaned_table(spark, root_b)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_replayed_batch_is_idempotent(spark):
    env, per = _stage(spark, 10)
    from sensorlake.sources.log import decode_envelope

    parsed = decode_envelope(env.drop("_file"), keep=("partition", "offset")).withColumnRenamed("offset", "event_id")
    root = scratch_dir(spark, "t-replay")
    fn = cs.CleanStream(root)
    fn(parsed.where(F.col("event_id") < per), 0)
    fn(parsed.where((F.col("event_id") >= per) & (F.col("event_id") < 2 * per)), 1)
    first = cs.cleaned_table(spark, root).count()
    log1 = cs.batch_log_table(spark, root).orderBy("batch_id").collect()
    fn(parsed.where((F.col("event_id") >= per) & (F.col("event_id") < 2 * per)), 1)   # replay batch 1
    assert cs.cleaned_table(spark, root).count() == first
    assert cs.batch_log_table(spark, root).orderBy("batch_id").collect() == log1


def test_history_across_batches_uses_observed_readings_only(spark):
    rows = [
        (0, "s1", "2024-01-01 10:00:00", 20.0),
        (1, "s1", "2024-01-01 10:01:00", None),     # batch 0: filled with 20
        (2, "s1", "2024-01-01 10:02:00", None),     # batch 1: history is {20} only, not the fill of row 1
        (3, "s1", "2024-01-01 10:02:30", 40.0),
        (4, "s1", "2024-01-01 10:03:00", None),     # batch 1: mean{20, 40}
    ]
    df = spark.createDataFrame([(i, k, t, v, 50.0, "active") for i, k, t, v in rows],
                               "event_id long, sensor_id string, timestamp string, temperature double, "
                               "humidity double, status string")
    from sensorlake.functions.parse import with_event_time

    parsed = with_event_time(df)
    root = scratch_dir(spark, "t-hist")
    fn = cs.CleanStream(root)
    fn(parsed.where("event_id < 2"), 0)
    fn(parsed.where("event_id >= 2"), 1)
    got = {r.event_id: r.temperature for r in cs.cleaned_table(spark, root).collect()}
    assert got[1] == 20.0 and got[2] == 20.0
    assert got[4] == 30.0                           # 26.67 if the earlier fill leaked into the history

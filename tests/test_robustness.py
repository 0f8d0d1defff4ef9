"""Row identity, data kept whole, safe stream writes, long fill chains, infinities."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorlake.functions.parse import with_event_time
from sensorlake.operators.impute import trailing_mean_feedback
from sensorlake.operators.partitions import counts, reader_load
from sensorlake.operators.quality import dedup_first, first_flags
from sensorlake.operators.quantile import exact_median
from sensorlake.plans.cleaning import annotate, clean_readings
from sensorlake.session import checkpoint_root, scratch_dir
from sensorlake.streaming import clean as cs
from sensorlake.streaming.metrics import PROGRESS_SCHEMA, ProgressLog

FIELDS = "event_id long, partition int, sensor_id string, timestamp string, temperature double, humidity double, status string"


def readings(spark, rows):
    return with_event_time(spark.createDataFrame([(i, p, k, t, v, 50.0, "active") for i, p, k, t, v in rows], FIELDS))


def test_offsets_repeat_across_partitions(spark):
    rows = [(0, 0, "a", "2024-01-01 10:00:00", 1.0), (0, 1, "b", "2024-01-01 10:00:00", 2.0), (0, 2, "c", "2024-01-01 10:00:00", None),
            (1, 0, "a", "2024-01-01 10:00:00", 9.0), (1, 1, "b", "2024-01-01 10:01:00", None)]
    df = readings(spark, rows)
    assert first_flags(df).count() == 5 and first_flags(df).where("is_first").count() == 4
    firsts = {(r.sensor_id, r.timestamp): r.temperature for r in dedup_first(df).collect()}
    assert len(firsts) == 4 and firsts[("a", "2024-01-01 10:00:00")] == 1.0
    for feedback in (False, True):
        out = annotate(df, feedback=feedback).select("partition", "event_id", "outcome", "temperature").collect()
        assert len(out) == 5 and {(r.partition, r.event_id): r.outcome for r in out} == {
            (0, 0): "kept", (1, 0): "kept", (2, 0): "no_history", (0, 1): "duplicate", (1, 1): "kept"}
    assert clean_readings(df.withColumn("batch_id", F.lit(0).cast("long"))).count() == 3
    root = scratch_dir(spark, "t-ids")
    fn = cs.CleanStream(root)
    fn(df.where("event_id = 0"), 0)
    fn(df.where("event_id = 1"), 1)
    assert cs.cleaned_table(spark, root).count() == 3


def test_counts_keep_every_partition(spark):
    df = spark.range(120).select((F.col("id") % 12).cast("int").alias("partition"))
    got = {r.partition: r.n for r in counts(df).collect()}
    assert got == {p: 10 for p in range(12)}
    load = {(r.readers, r.reader): r.partitions for r in reader_load(counts(df), readers=(1,)).collect()}
    assert load[(1, 0)] == ",".join(map(str, range(12)))


@pytest.fixture
def static_overwrite(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "static")
    yield
    spark.conf.set(key, before)


def test_stream_keeps_earlier_batches_in_static_mode(spark, static_overwrite):
    rows = [(i, 0, "s", f"2024-01-01 10:0{i}:00", 20.0 + i) for i in range(4)]
    df, root = readings(spark, rows), scratch_dir(spark, "t-static")
    fn = cs.CleanStream(root)
    for n in (0, 1, 1):                                          # batch 1 is replayed
        fn(df.where(f"event_id div 2 = {n}"), n)
    fn(df.where("false"), 2)                                     # an empty batch has a log row
    fn(df.where("event_id = 0").withColumn("event_id", F.lit(9).cast("long")), 3)
    assert sorted(r.event_id for r in cs.cleaned_table(spark, root).collect()) == [0, 1, 2, 3]
    log = {r.batch_id: (r.raw_rows, r.cleaned_rows, r.duplicates_removed) for r in cs.batch_log_table(spark, root).collect()}
    assert log == {0: (2, 2, 0), 1: (2, 2, 0), 2: (0, 0, 0), 3: (1, 0, 1)}
    assert cs.batch_durations(spark, root).where("duration_ms >= 0").count() == 4
    stats = {r.batch_id: (r.avg_temperature, r.max_temperature, r.readings, r.active) for r in cs.sensor_snapshots(spark, root).collect()}
    assert stats == {0: (20.5, 21.0, 2, True), **{n: (21.5, 23.0, 4, True) for n in (1, 2, 3)}}       # running, and carried over batches without news
    assert {r.batch_id: (r.status, r.n) for r in cs.status_snapshots(spark, root).collect()} == {0: ("active", 2), **{n: ("active", 4) for n in (1, 2, 3)}}
    assert {tuple(r) for r in cs.active_report(cs.sensor_snapshots(spark, root)).selectExpr("n_active", "active_sensors[0]").collect()} == {(1, "s")}
    running = {r.batch_id: str(r.running_max) for r in spark.read.parquet(fn.log_path).collect()}
    assert running[1] == running[2] == running[3] == "2024-01-01 10:03:00"


def test_history_spans_all_days_of_the_width(spark):
    df = readings(spark, [(0, 0, "s", "2024-01-01 00:00:00", 30.0), (1, 0, "s", "2024-01-02 12:00:00", None)])
    root = scratch_dir(spark, "t-days")
    fn = cs.CleanStream(root, width_seconds=3 * 86400.0)
    fn(df.where("event_id = 0"), 0)
    fn(df.where("event_id = 1"), 1)
    assert {r.event_id: r.temperature for r in cs.cleaned_table(spark, root).collect()} == {0: 30.0, 1: 30.0}


def test_unparsed_keys_repeat_across_batches(spark):
    df = readings(spark, [(0, 0, "s", "bad", 1.0), (1, 0, "s", None, 1.0), (2, 0, "s", "bad", 1.0), (3, 0, "s", None, 1.0), (4, 0, "s", "worse", 1.0)])
    root = scratch_dir(spark, "t-bad")
    fn = cs.CleanStream(root)
    fn(df.where("event_id < 2"), 0)
    fn(df.where("event_id >= 2"), 1)
    log = {r.batch_id: (r.duplicates_removed, r.invalid_removed) for r in cs.batch_log_table(spark, root).collect()}
    assert log == {0: (0, 2), 1: (2, 1)}


def test_feedback_across_batches(spark):
    rows = [(0, 0, "s", "2024-01-01 10:00:00", 20.0), (1, 0, "s", "2024-01-01 10:04:00", None), (2, 0, "s", "2024-01-01 10:08:00", None)]
    df = readings(spark, rows)
    for feedback, kept in ((False, 2), (True, 3)):
        root = scratch_dir(spark, "t-fb")
        fn = cs.CleanStream(root, feedback=feedback)
        fn(df.where("event_id < 2"), 0)
        fn(df.where("event_id = 2"), 1)
        assert cs.cleaned_table(spark, root).count() == kept


def test_fill_chain_of_thousands(spark):
    n = 3000
    rows = [(0, "k", 1_700_000_000, 10.0)] + [(i, "k", 1_700_000_000 + i, None) for i in range(1, n)] + [(n, None, 1_700_000_000, 4.0), (n + 1, None, 1_700_000_002, None)]
    df = spark.createDataFrame(rows, "event_id long, sensor_id string, ts long, temperature double").withColumn("event_time", F.timestamp_seconds("ts"))
    got = {r.event_id: r.imputed for r in trailing_mean_feedback(df, 5).collect()}
    assert all(abs(got[i] - 10.0) < 1e-9 for i in range(1, n)) and got[0] is None and got[n] is None and got[n + 1] == 4.0


def test_fill_chains_in_slices(spark):
    """Chains over many slices give what one slice gives, and no group holds more than a slice and the width before it."""
    from sensorlake.operators import impute

    rng = np.random.default_rng(4)
    rows = [(0, "k", 0, 10.0)] + [(i, "k", i, None) for i in range(1, 200)] + [(1000 + i, "g", 7 * i, float(i) if rng.random() < 0.4 else None) for i in range(60)]
    rows += [(2000 + i, None, 3 * i, 5.0 if i in (0, 9) else None) for i in range(30)] + [(3000, "lone", 5, None)]
    df = spark.createDataFrame(rows, "event_id long, sensor_id string, ts long, temperature double").withColumn("event_time", F.timestamp_seconds("ts"))
    want = {r.event_id: r.imputed for r in trailing_mean_feedback(df, 20).collect()}
    got = {r.event_id: r.imputed for r in trailing_mean_feedback(df, 20, slice_seconds=45).collect()}
    assert got.keys() == want.keys() and all((got[i] is None) == (want[i] is None) and (got[i] is None or abs(got[i] - want[i]) < 1e-9) for i in want)
    assert sum(v is not None for v in want.values()) > 200
    part = pd.DataFrame({"_us": [0, 5, 30], "_sum": [0.0, 2.0, 0.0], "_n": [None, 1, 0], "_fill": [4.0, None, None]})
    assert [None if math.isnan(v) else v for v in impute.solve_slice(20, part)["_fill"]] == [3.0, None]


def test_median_with_infinities_and_nan(spark):
    data = {"a": [1.0, 2.0, 3.0, math.inf], "b": [-math.inf, -math.inf, 5.0, 6.0, math.inf], "c": [math.inf] * 3, "d": [1e308, -1e308, 0.5] + list(np.linspace(0, 1, 100)),
            "e": [1.0, 2.0, math.nan, math.nan, math.nan], "f": [1.0, 7.0, math.nan]}
    df = spark.createDataFrame([(g, float(x)) for g, xs in data.items() for x in xs], "g string, v double")
    got = {r.g: r.median for r in exact_median(df, "g", "v", bins=16).collect()}
    assert got["a"] == 2.5 and got["b"] == 5.0 and got["c"] == math.inf and got["d"] == float(np.median(data["d"]))
    assert math.isnan(got["e"]) and got["f"] == 7.0


def test_progress_table_keeps_all_records(spark):
    log = ProgressLog(spark, scratch_dir(spark, "t-progress"), waiting=3)
    names = [f.strip().split()[0] for f in PROGRESS_SCHEMA.split(", ")][:6]
    for i in range(250):
        log.records.append({**dict.fromkeys(names), "name": "q", "batchId": i, "durationMs": {}, "stateOperators": []})
        if len(log.records) >= 100:
            log.flush()
    assert log.to_df().select("batchId").distinct().count() == 250


def test_shared_folder_is_required_off_local_mode(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context

        class conf:
            get = staticmethod(lambda key, default=None: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session)
    Context.getCheckpointDir = staticmethod(lambda: "hdfs://shared")
    assert checkpoint_root(Session) == "hdfs://shared"


def test_too_late_rows_and_dedup_horizon(spark):
    rows = [(0, 0, "s", "2024-01-05 10:00:00", 20.0), (1, 0, "s", "2024-01-05 09:58:00", 21.0), (2, 0, "s", "2024-01-01 10:00:00", 22.0),
            (3, 0, "s", "2024-01-09 10:00:00", 23.0), (4, 0, "s", "2024-01-05 10:00:00", 24.0)]
    df = readings(spark, rows).withColumn("batch_id", F.expr("CASE WHEN event_id = 0 THEN 0L WHEN event_id < 3 THEN 1L ELSE 2L END"))
    kept = {r.event_id: r.late_class for r in clean_readings(df).collect()}
    assert kept == {0: "on_time", 1: "late_accepted", 2: "too_late", 3: "on_time"}
    assert {r.event_id for r in clean_readings(df, drop_too_late=True).collect()} == {0, 1, 3}
    for options, want, cleaned in (({}, {0, 1, 2, 3}, 2), ({"drop_too_late": True}, {0, 1, 3}, 1), ({"dedup_days": 2}, {0, 1, 2, 3, 4}, 2)):
        root = scratch_dir(spark, "t-late")
        fn = cs.CleanStream(root, **options)
        for n in range(3):
            fn(df.where(f"batch_id = {n}").drop("batch_id"), n)
        assert {r.event_id for r in cs.cleaned_table(spark, root).collect()} == want
        log = {r.batch_id: r for r in cs.batch_log_table(spark, root).collect()}
        assert log[1].cleaned_rows == cleaned and log[1].late_accepted == 1


def test_console_sink_and_processing_time(spark, tmp_path):
    from sensorlake.sources.log import SinkSpec
    from sensorlake.streaming.runner import run_to_end, start

    src = str(tmp_path / "in")
    spark.range(5).write.json(src)
    stream = spark.readStream.schema("id long").json(src)
    run_to_end(start(stream, SinkSpec(name="t_console", checkpoint=str(tmp_path / "c1"), format="console")))
    q = start(stream, SinkSpec(name="t_timed", checkpoint=str(tmp_path / "c2"), format="memory", processing_time="1 second"))
    q.processAllAvailable()
    q.stop()
    assert spark.table("t_timed").count() == 5

"""State tables of the streams: merged key ledger, history by need, committed reads, upsert snapshots."""

import re

import pytest
from pyspark.sql import functions as F

from sensorlake.functions.parse import with_event_time
from sensorlake.session import scratch_dir
from sensorlake.streaming import clean as cs
from sensorlake.streaming.folders import UpsertLog, numbered
from sensorlake.streaming.ledger import KeyLedger

FIELDS = "event_id long, partition int, sensor_id string, timestamp string, temperature double, humidity double, status string"


def readings(spark, rows):
    return with_event_time(spark.createDataFrame([(i, 0, k, t, v, 50.0, "active") for i, k, t, v in rows], FIELDS))


def test_ledger_runs_stay_bounded_and_complete(spark):
    ledger, fan, batches = KeyLedger(scratch_dir(spark, "t-ledger"), ("sensor_id", "timestamp"), fan=3, bits=15), 3, 14
    kinds = "sensor_id string, timestamp string, event_day int"
    rows = lambda n: [(f"s{i}" if i else None, f"t{n}-{i}", n % 2) for i in range(4)]
    for n in range(batches):
        ledger.merge(spark, [0, 1], n)
        ledger.add(spark.createDataFrame(rows(n), kinds), n)
        if n == 7:
            ledger.add(spark.createDataFrame(rows(n), kinds), n)        # replayed
    found = ledger.merge(spark, [0, 1], batches)
    assert all(len(runs) < fan for runs in found.values()) and max(level for level, _ in found) >= 1
    whole = ledger.read(spark, found).distinct().collect()
    assert {tuple(r) for r in whole} == {r for n in range(batches) for r in rows(n)}
    # new keys open no merged run; an old key opens the runs of its day that hold it
    fresh = spark.createDataFrame([("new", f"x{i}", 0) for i in range(3)], kinds)
    merged = {at: runs for at, runs in ledger.candidates(spark, fresh, F.col("event_day"), found).items() if at[0]}
    assert not any(merged.values())
    old = spark.createDataFrame([rows(0)[0], rows(2)[3]], kinds)
    got = ledger.read(spark, ledger.candidates(spark, old, F.col("event_day"), found))
    assert {tuple(r) for r in got.collect()} >= {rows(0)[0], rows(2)[3]}
    assert [d for level, d in ledger.runs(spark, [0, 1], batches)] and ledger.days(spark) == [0, 1]


def test_stream_dedups_through_merged_ledger(spark, monkeypatch):
    monkeypatch.setattr(cs.CleanStream, "ledger", property(lambda self: KeyLedger(f"{self.root}/ledger", cs.DEDUP_KEYS, fan=2)))
    root = scratch_dir(spark, "t-merged")
    fn = cs.CleanStream(root)
    for n in range(6):      # each batch repeats one key of every earlier batch
        rows = [(10 * n + k, "s", f"2024-01-01 10:{k:02d}:00", float(n)) for k in range(n + 1)]
        fn(readings(spark, rows), n)
    assert sorted(r.temperature for r in cs.cleaned_table(spark, root).collect()) == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    assert numbered(spark, f"{root}/ledger/keys1", "event_day")


def test_history_is_read_by_need(spark):
    root = scratch_dir(spark, "t-need")
    fn = cs.CleanStream(root)
    days = [f"2024-03-{d:02d}" for d in range(1, 13)]
    fn(readings(spark, [(i, "s", "2023-03-01 10:00:00", 5.0) for i in (1000,)] + [(i, "s", f"{d} 10:00:00", float(i)) for i, d in enumerate(days)]), 0)
    batch = readings(spark, [(1, "s", "2023-03-01 10:03:00", None), (2, "s", "2024-03-12 10:10:00", 7.0), (3, "s", "2024-03-12 10:11:00", 8.0)]).withColumn(
        "batch_id", F.lit(1).cast("long"))
    touched = fn.touched(batch, fn.ledger.days(spark), numbered(spark, fn.cleaned_path, "event_day"))
    assert sorted(kind for kind, _ in touched) == [0, 0, 1]     # two days of keys, one day of history out of thirteen stored ones
    past = fn.history(batch, [d for kind, d in touched if kind], 1)
    files = past.inputFiles()
    assert len(files) == 1 and len({re.search(r"event_day=(\d+)", f)[1] for f in files}) == 1
    assert [r.temperature for r in past.collect()] == [5.0]
    fn(batch.drop("batch_id"), 1)
    assert {r.event_id: r.temperature for r in cs.cleaned_table(spark, root).collect() if r.batch_id == 1} == {1: 5.0, 2: 7.0, 3: 8.0}


def test_readers_see_committed_batches_only(spark, monkeypatch):
    root = scratch_dir(spark, "t-commit")
    fn = cs.CleanStream(root)
    fn(readings(spark, [(0, "s", "2024-01-01 10:00:00", 1.0)]), 0)
    second = readings(spark, [(1, "s", "2024-01-01 10:01:00", 2.0), (2, "r", "2024-01-01 10:01:00", None)])
    with monkeypatch.context() as m:
        m.setattr(cs.CleanStream, "_write_log", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            fn(second, 1)
    assert len(numbered(spark, f"{root}/sensor_state/tail", "batch_id")) == 2     # the failed batch has written its rows
    assert [r.event_id for r in cs.cleaned_table(spark, root).collect()] == [0]
    assert cs.sensor_snapshots(spark, root).count() == 1 and cs.batch_log_table(spark, root).count() == 1
    fn(second, 1)
    assert sorted(r.event_id for r in cs.cleaned_table(spark, root).collect()) == [0, 1]
    assert {(r.batch_id, r.readings) for r in cs.sensor_snapshots(spark, root).collect()} == {(0, 1), (1, 2)}


def test_upsert_log_reads_snapshot_and_tail(spark):
    log = UpsertLog(scratch_dir(spark, "t-upsert"), "k string, v long", ("k",), every=3)
    want = {}
    for n in range(11):
        log.compact(spark, n)
        rows = [(None if (n + i) % 4 == 0 else f"k{(n + i) % 4}", 100 * n + i) for i in range(2)]
        log.write(spark.createDataFrame(rows, "k string, v long"), n)
        if n == 5:
            log.write(spark.createDataFrame(rows, "k string, v long"), n)      # replayed
        want |= dict(rows)
        assert {r.k: r.v for r in log.current(spark).collect()} == want if n in (2, 3, 6, 10) else True
    mark, tail = log._parts(spark, None)
    assert mark is not None and tail == list(range(mark + 1, 11)) and len(tail) <= 3
    assert len(log.snapshots(spark)) <= 2 and len(numbered(spark, f"{log.path}/tail", "batch_id")) <= 6
    files = log.current(spark).inputFiles()
    assert all(f"upto={mark}" in f or any(f"batch_id={b}/" in f for b in tail) for f in files)
    assert log.current(spark, 100).count() == len(want) and UpsertLog(scratch_dir(spark, "t-none"), "k string, v long", ("k",)).current(spark).count() == 0


def test_hot_key_is_spread_before_it_is_dropped(spark, tmp_path):
    """800 copies of one key in a batch: the same rows as one-step dedup, and no state partition meets more than its salts' copies."""
    from sensorlake.operators.windows import dedup_watermark, watermarked
    from sensorlake.sources.log import SinkSpec
    from sensorlake.streaming.metrics import state_operators, state_rows
    from sensorlake.streaming.runner import run_to_end, start

    rows = [(i, "hot" if i < 800 else f"k{i % 7}", "2024-01-01 10:00:00" if i < 800 else f"2024-01-01 10:0{i % 4}:00", 1.0) for i in range(1000)]
    src = str(tmp_path / "in")
    readings(spark, rows).select("event_id", "sensor_id", "timestamp", "event_time").repartition(2).write.parquet(src)
    stream = spark.readStream.schema("event_id long, sensor_id string, timestamp string, event_time timestamp").parquet(src)
    got = {}
    for salts in (1, 8):
        out, ckpt = str(tmp_path / f"out{salts}"), str(tmp_path / f"ckpt{salts}")
        plan = dedup_watermark(watermarked(stream), salts=salts).select("sensor_id", "timestamp")
        run_to_end(start(plan, SinkSpec(name=f"t_dedup{salts}", checkpoint=ckpt, format="parquet", path=out), state_partitions=4))
        got[salts] = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got[1] == got[8] == sorted({(k, t) for _, k, t, _ in rows})
    first = max(r.operator_id for r in state_operators(spark, ckpt).collect())      # the salted step comes first in the plan, last in the numbering
    hot = state_rows(spark, ckpt, first).where("key.sensor_id = 'hot'")
    assert hot.count() == 8 and hot.select("partition_id").distinct().count() > 1
    salt = {i: s for i, s in spark.range(800).selectExpr("id", "pmod(xxhash64(id), 8) AS s").collect()}
    part = {r.s: r.partition_id for r in hot.selectExpr("key._salt AS s", "partition_id").collect()}
    load = {p: sum(part[salt[i]] == p for i in range(800)) for p in set(part.values())}
    assert max(load.values()) < 800

"""The partitioned log source: offsets, restart, reader groups, chosen partitions, removed segments."""

import os

import pytest
from pyspark.sql import functions as F

from sensorlake.session import scratch_dir
from sensorlake.sources.log import SinkSpec, SourceSpec, read_bounded, read_stream
from sensorlake.sources.segments import Log, append_segments, commit_ended, group_offsets, register
from sensorlake.streaming.runner import run_to_end, start


def records(spark, lo, hi):
    return spark.range(lo, hi, 1, 3).selectExpr("CAST(concat('k', id % 3) AS BINARY) AS key", "CAST(concat('v', id) AS BINARY) AS value", "'t' AS topic",
                                                "CAST(id % 3 AS INT) AS partition", "id AS offset", "timestamp_seconds(id) AS timestamp")


def stored_log(spark, *appends):
    path = scratch_dir(spark, "t-log")
    for n, (lo, hi) in enumerate(appends):
        append_segments(records(spark, lo, hi), path, n)
    return path


def offsets(df):
    return sorted(r.offset for r in df.select("offset").collect())


def test_bounded_reads(spark):
    path = stored_log(spark, (0, 30), (30, 47))
    whole = read_bounded(spark, SourceSpec(format="segments", path=path))
    assert whole.columns == ["key", "value", "topic", "partition", "offset", "timestamp"] and offsets(whole) == list(range(47))
    assert whole.exceptAll(records(spark, 0, 47)).count() == 0
    assert offsets(read_bounded(spark, SourceSpec(format="segments", path=path, partitions=(0, 2)))) == [i for i in range(47) if i % 3 != 1]
    some = read_bounded(spark, SourceSpec(format="segments", path=path, starting_offsets='{"0": 33, "1": 100}'))
    assert offsets(some) == [i for i in range(47) if i % 3 == 2 or (i % 3 == 0 and i >= 33)]
    assert offsets(read_bounded(spark, SourceSpec(format="segments", path=path, partitions=()))) == []
    for rows in Log(path).segments().values():
        assert all(a["end"] == b["base"] for a, b in zip(rows, rows[1:], strict=False))      # the segments tile the offsets
    append_segments(records(spark, 30, 47), path, 1)      # repeated
    assert offsets(read_bounded(spark, SourceSpec(format="segments", path=path))) == list(range(47))


def run(spark, path, out, ckpt, **options):
    spec = SourceSpec(format="segments", path=path, options={k: v for k, v in options.items() if k != "starting"}, fail_on_data_loss=options.get("strict", True),
                      starting_offsets=options.get("starting", "earliest"))
    query = run_to_end(start(read_stream(spark, spec).select("partition", "offset"), SinkSpec(name="t_log", checkpoint=ckpt, format="parquet", path=out)))
    if "group" in options:
        commit_ended(query, path, options["group"])
    return offsets(spark.read.parquet(out))


def test_restart_groups_and_removed_segment(spark):
    path, out, ckpt = stored_log(spark, (0, 20)), scratch_dir(spark, "t-out"), scratch_dir(spark, "t-ck")
    assert run(spark, path, out, ckpt, group="alpha") == list(range(20))
    assert group_offsets(path, "alpha") == {0: 19, 1: 20, 2: 18}
    append_segments(records(spark, 20, 26), path, 1)
    assert run(spark, path, out, ckpt, group="alpha") == list(range(26))            # restarted: only the new records
    late = scratch_dir(spark, "t-late")
    assert run(spark, path, scratch_dir(spark, "t-out2"), scratch_dir(spark, "t-ck2"), group="beta") == list(range(26))
    append_segments(records(spark, 26, 32), path, 2)
    assert run(spark, path, late, scratch_dir(spark, "t-ck3"), group="alpha", starting="group") == list(range(26, 32))     # where the group stopped
    # a segment behind the restart point is removed
    append_segments(records(spark, 32, 38), path, 3)
    gone = [r for r in Log(path).segments()[1] if r["base"] >= 26][0]
    os.remove(Log(path).local(gone["file"]))
    with pytest.raises(Exception, match="no longer stored"):
        run(spark, path, out, ckpt, group="alpha")
    lost = {i for i in range(gone["first"], gone["end"]) if i % 3 == 1}
    assert run(spark, path, scratch_dir(spark, "t-out4"), scratch_dir(spark, "t-ck4"), strict=False) == [i for i in range(38) if i not in lost]
    with pytest.raises(Exception, match="no longer stored"):
        read_bounded(spark, SourceSpec(format="segments", path=path, fail_on_data_loss=True)).count()


def test_latest_start_sees_only_what_follows(spark):
    path, out, ckpt = stored_log(spark, (0, 9)), scratch_dir(spark, "t-out"), scratch_dir(spark, "t-ck")
    register(spark)
    spec = SourceSpec(format="segments", path=path)         # latest, as for a topic
    stream = read_stream(spark, spec).select("offset")
    q = stream.writeStream.format("parquet").option("checkpointLocation", ckpt).trigger(processingTime="1 second").start(out)
    try:
        q.processAllAvailable()
        append_segments(records(spark, 9, 15), path, 1)
        q.processAllAvailable()
    finally:
        q.stop()
    assert offsets(spark.read.schema("offset long").parquet(out)) == list(range(9, 15))
    assert records(spark, 0, 3).where(F.col("offset") < 0).count() == 0

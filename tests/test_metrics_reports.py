"""Progress listener and JSON report export."""

import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from sensorlake.plans.report import write_json
from sensorlake.session import scratch_dir
from sensorlake.streaming.metrics import ProgressLog, batch_drops, dropped_by_watermark, performance, state_snapshot
from sensorlake.streaming.queries import _cores, parsed_stream, stage
from sensorlake.streaming.runner import run_to_end
from sensorlake.streaming.windowed import start_windowed


def test_progress_listener_and_metrics(spark):
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        staged = stage(spark, SF_SMALL, late=True)
        q = run_to_end(start_windowed(parsed_stream(spark, staged), scratch_dir(spark, "t-w"),
                                      scratch_dir(spark, "t-wc"), name="t_windowed", state_partitions=_cores(spark)))
        deadline = time.time() + 60
        while str(q.id) not in log.terminated and time.time() < deadline:   # listener events are asynchronous
            time.sleep(0.5)
        prog = log.to_df(spark).where(F.col("name") == "t_windowed")
        assert prog.where("numInputRows > 0").count() == 10          # one batch per staged file
        per_batch = batch_drops(prog).agg(F.sum("dropped")).first()[0]
        total = dropped_by_watermark(prog).first()["dropped_by_watermark"]
        assert per_batch == total and total > 0
        assert state_snapshot(prog).count() == 3                     # aggregate state + both dedup states
        assert performance(prog).first()["rows"] > 0
    finally:
        spark.streams.removeListener(log)


def test_write_json_reports(spark):
    out = scratch_dir(spark, "t-reports")
    frames = {"status": spark.createDataFrame([("active", 3), (None, 1)], "status string, n long")}
    write_json(frames, out)
    back = spark.read.json(f"{out}/status")
    assert {(r.status, r.n) for r in back.collect()} == {("active", 3), (None, 1)}

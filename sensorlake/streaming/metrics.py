"""Query progress as DataFrames: rates, durations, state operators, watermark drops.

Progress comes from a ``ProgressLog`` listener registered on ``spark.streams``, which
gets every trigger's record. Records wait in a short list and are appended to a
table in a given folder, so a stream of any length keeps all of its batches.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from sensorlake.functions.parse import event_time_expr

PROGRESS_SCHEMA = (
    "name string, timestamp string, batchId bigint, inputRowsPerSecond double, processedRowsPerSecond double, "
    "numInputRows bigint, durationMs map<string,bigint>, "
    "stateOperators array<struct<operatorName:string, numRowsTotal:bigint, numRowsUpdated:bigint, "
    "memoryUsedBytes:bigint, numRowsDroppedByWatermark:bigint>>"
)


def _record(p: dict, name: str | None = None) -> dict:
    return {
        "name": name or p.get("name"),
        "timestamp": p.get("timestamp"),
        "batchId": p.get("batchId"),
        "inputRowsPerSecond": float(p.get("inputRowsPerSecond") or 0.0),
        "processedRowsPerSecond": float(p.get("processedRowsPerSecond") or 0.0),
        "numInputRows": p.get("numInputRows"),
        "durationMs": {k: int(v) for k, v in (p.get("durationMs") or {}).items()},
        "stateOperators": [
            {
                "operatorName": so.get("operatorName"),
                "numRowsTotal": so.get("numRowsTotal"),
                "numRowsUpdated": so.get("numRowsUpdated"),
                "memoryUsedBytes": so.get("memoryUsedBytes"),
                "numRowsDroppedByWatermark": so.get("numRowsDroppedByWatermark"),
            }
            for so in (p.get("stateOperators") or [])
        ],
    }


class ProgressLog(StreamingQueryListener):
    """Listener keeping one record per progress event, per query name, in a table in ``folder``.

    At most ``waiting`` records are held; ``to_df`` writes what is left and reads
    the table. Without a folder (short runs) all records stay in the list.
    """

    def __init__(self, spark: SparkSession | None = None, folder: str | None = None, waiting: int = 200) -> None:
        self._lock = threading.Lock()
        self.spark, self.folder, self.waiting = spark, folder, waiting
        self.records: list[dict] = []
        self.terminated: set[str] = set()

    def flush(self) -> None:
        if self.folder is None:
            return
        with self._lock:
            rows, self.records = self.records, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)

    def follow(self, *queries: StreamingQuery, poll_s: float = 0.1) -> None:
        """Wait until the queries have ended and their last events (which come later) are here."""
        for q in queries:
            q.awaitTermination()
        while not {str(q.id) for q in queries} <= self.terminated:
            time.sleep(poll_s)

    def onQueryStarted(self, event) -> None:  # noqa: N802 - listener API
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        rec = _record(json.loads(event.progress.json))
        with self._lock:
            self.records.append(rec)
            full = len(self.records) >= self.waiting
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._lock:
            self.terminated.add(str(event.id))

    def to_df(self, spark: SparkSession | None = None) -> DataFrame:
        spark = spark or self.spark
        self.flush()
        with self._lock:
            waiting = spark.createDataFrame(list(self.records), PROGRESS_SCHEMA)
        return waiting if self.folder is None else waiting.unionAll(spark.read.schema(PROGRESS_SCHEMA).parquet(self.folder))


@contextmanager
def recorded(spark: SparkSession, folder: str) -> Iterator[ProgressLog]:
    """A ``ProgressLog`` that listens inside the block."""
    log = ProgressLog(spark, folder)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)


def dropped_by_watermark(progress: DataFrame) -> DataFrame:
    """Rows discarded by the watermark, per query, summed over batches and state operators."""
    ops = progress.select("name", F.explode_outer("stateOperators").alias("op"))
    return ops.groupBy("name").agg(
        F.coalesce(F.sum("op.numRowsDroppedByWatermark"), F.lit(0)).cast("long").alias("dropped_by_watermark"))


def batch_drops(progress: DataFrame) -> DataFrame:
    """Per query and batch: input rows and rows dropped by the watermark."""
    ops = progress.select("name", "batchId", "numInputRows", F.explode_outer("stateOperators").alias("op"))
    return ops.groupBy("name", "batchId").agg(
        F.max("numInputRows").cast("long").alias("input_rows"),
        F.coalesce(F.sum("op.numRowsDroppedByWatermark"), F.lit(0)).cast("long").alias("dropped"))


def state_snapshot(progress: DataFrame) -> DataFrame:
    """Last state snapshot of every stateful operator of every query (newest batch wins)."""
    ops = progress.select("name", "batchId", F.posexplode("stateOperators").alias("op_index", "op"))
    return ops.groupBy("name", "op_index").agg(F.max_by("op", "batchId").alias("op")).select(
        "name", "op_index", "op.operatorName", "op.numRowsTotal", "op.numRowsUpdated", "op.memoryUsedBytes",
        "op.numRowsDroppedByWatermark")


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(operator_id, operator, store) of a stopped or running query, from its checkpoint."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        F.col("operatorId").alias("operator_id"), F.col("operatorName").alias("operator"), F.col("stateStoreName").alias("store")).distinct()


def state_rows(spark: SparkSession, checkpoint: str, operator_id: int, store: str = "default") -> DataFrame:
    """The keyed rows that one stateful operator holds after the last batch: key, value, partition_id, read from the checkpoint."""
    return spark.read.format("statestore").option("operatorId", int(operator_id)).option("storeName", store).load(checkpoint)


def windowed_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What the windowed query remembers: operator (window, dedup, salted_dedup), sensor_id, at, total, n.

    Open windows with their running sum and count (``at``: window start), and the keys that a repeat would
    still be recognised by (``at``: text time of the key); a key that several salts hold is one row.
    """
    out = None
    for op in state_operators(spark, checkpoint).orderBy("operator_id").take(64):     # one row a stateful operator of the plan
        rows = state_rows(spark, checkpoint, op["operator_id"], op["store"])
        if op["operator"] == "stateStoreSave":
            value = F.col("value").cast("struct<total:double,n:bigint,rows:bigint>")      # by position: two fields share a name
            part = rows.withColumn("v", value).select(F.lit("window").alias("operator"), "key.sensor_id", F.col("key.window.start").alias("at"),
                                                      "v.total", F.col("v.rows").alias("n"))
        else:
            salted = "_salt" in rows.schema["key"].dataType.names
            part = rows.select(F.lit("salted_dedup" if salted else "dedup").alias("operator"), "key.sensor_id", event_time_expr(F.col("key.timestamp")).alias("at"),
                               F.lit(None).cast("double").alias("total"), F.lit(1).cast("long").alias("n")).distinct()
        out = part if out is None else out.unionByName(part)
    return out


def performance(progress: DataFrame) -> DataFrame:
    """Per query: batches, rows, median/min/max processed rate and trigger time, over every batch."""
    p = progress.withColumn("trigger_ms", F.col("durationMs")["triggerExecution"])
    return p.groupBy("name").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("numInputRows").alias("rows"),
        F.median("processedRowsPerSecond").alias("median_rows_per_s"),
        F.min("processedRowsPerSecond").alias("min_rows_per_s"),
        F.max("processedRowsPerSecond").alias("max_rows_per_s"),
        F.median("trigger_ms").alias("median_trigger_ms"),
        F.median(F.col("durationMs")["addBatch"]).alias("median_add_batch_ms"),
    )

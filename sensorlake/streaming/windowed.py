"""The windowed query: validity filters -> watermark -> dedup within watermark -> tumbling average.

Update output needs an upsert sink; file sinks only append. Each micro-batch's
updated (window, sensor) rows are written to the tail of an ``UpsertLog`` (a replayed batch
replaces its own rows); every ``every`` batches the current windows are stored as a snapshot, so reading
them opens one snapshot and the few batches after it, however long the stream has run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorlake.operators.windows import SALTS, dedup_watermark, eligible, tumbling_avg, watermarked
from sensorlake.schema import WATERMARK_DELAY, WINDOW_WIDTH
from sensorlake.sources.log import SinkSpec
from sensorlake.streaming.folders import UpsertLog
from sensorlake.streaming.runner import start


def windowed_plan(parsed_stream: DataFrame, width: str = WINDOW_WIDTH, delay: str = WATERMARK_DELAY, salts: int = SALTS) -> DataFrame:
    """The stateful plan (shuffles by salted dedup key, dedup key, window; partial aggregation before the last)."""
    return tumbling_avg(dedup_watermark(watermarked(eligible(parsed_stream), delay), salts=salts), width)


def windows_log(path: str, every: int = 16) -> UpsertLog:
    return UpsertLog(path, "window_start timestamp, window_end timestamp, sensor_id string, avg_temperature double, record_count long",
                     ("window_start", "window_end", "sensor_id"), every=every)


def upsert_log_writer(path: str, every: int = 16):
    """foreachBatch function: write the batch's updated windows, after a snapshot of the earlier ones where it is due."""
    log = windows_log(path, every)

    def write(batch: DataFrame, batch_id: int) -> None:
        log.compact(batch.sparkSession, batch_id)
        log.write(batch.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                               "sensor_id", "avg_temperature", "record_count"), batch_id)

    return write


def start_windowed(parsed_stream: DataFrame, path: str, checkpoint: str, name: str = "windowed_query",
                   mode: str = "update", processing_time: str | None = None,
                   width: str = WINDOW_WIDTH, delay: str = WATERMARK_DELAY,
                   state_partitions: int | None = None, salts: int = SALTS, every: int = 16) -> StreamingQuery:
    """Start the windowed query writing an upsert log to ``path``."""
    sink = SinkSpec(name=name, checkpoint=checkpoint, mode=mode, format="foreachBatch",
                    processing_time=processing_time)
    return start(windowed_plan(parsed_stream, width, delay, salts), sink, upsert_log_writer(path, every), state_partitions)


def current_windows(spark: SparkSession, path: str) -> DataFrame:
    """Latest value per (window, sensor): one snapshot and the batches after it."""
    return windows_log(path).current(spark)

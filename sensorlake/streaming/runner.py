"""Starting streaming queries from a ``SinkSpec`` and reading their progress."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from sensorlake.sources.log import SinkSpec


_STARTING = threading.Lock()


def start(df: DataFrame, sink: SinkSpec, batch_fn: Callable[[DataFrame, int], None] | None = None,
          state_partitions: int | None = None) -> StreamingQuery:
    """Start ``df`` as a named query with its own checkpoint.

    ``sink.format == "foreachBatch"`` hands every micro-batch to ``batch_fn``
    (which must be idempotent per batch id). ``processing_time=None`` runs
    everything available now and stops. ``state_partitions`` sets the number of
    shuffle/state-store partitions of a new query (Spark fixes it in the
    checkpoint at the first start); ``None`` keeps the session's value.
    """
    spark = df.sparkSession
    if state_partitions is None:
        return _start(df, sink, batch_fn)
    key = "spark.sql.shuffle.partitions"
    with _STARTING:   # two threads that start streams don't see each other's setting
        before = spark.conf.get(key)
        spark.conf.set(key, str(int(state_partitions)))
        try:
            return _start(df, sink, batch_fn)   # the stream snapshots the session conf when it starts
        finally:
            spark.conf.set(key, before)


def _start(df: DataFrame, sink: SinkSpec, batch_fn) -> StreamingQuery:
    w = df.writeStream.queryName(sink.name).outputMode(sink.mode).option("checkpointLocation", sink.checkpoint)
    for k, v in sink.options.items():
        w = w.option(k, str(v))
    w = w.trigger(processingTime=sink.processing_time) if sink.processing_time else w.trigger(availableNow=True)
    if sink.format == "foreachBatch":
        if batch_fn is None:
            raise ValueError("foreachBatch sink needs batch_fn")
        return w.foreachBatch(batch_fn).start()
    if sink.format == "console":
        return w.format("console").option("truncate", "false").start()
    if sink.format == "memory":
        return w.format("memory").start()
    return w.format(sink.format).start(sink.path)


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an availableNow query to finish; re-raise its failure. ``timeout_s`` (default none) stops a longer run."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream {query.name} did not finish within {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query

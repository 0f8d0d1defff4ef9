"""Several independent queries over one source (reader groups).

Each query has its own checkpoint, so each keeps its own offsets and receives
every record, like two consumer groups on one topic.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from sensorlake.sources.log import SinkSpec
from sensorlake.streaming.runner import start


def fan_out(stream: DataFrame, sinks: Mapping[str, SinkSpec]) -> dict[str, StreamingQuery]:
    """Start one query per sink over the same streaming DataFrame; names must differ."""
    names = [s.name for s in sinks.values()]
    if len(set(names)) != len(names):
        raise ValueError("each reader group needs its own query name")
    checkpoints = [s.checkpoint for s in sinks.values()]
    if len(set(checkpoints)) != len(checkpoints):
        raise ValueError("each reader group needs its own checkpoint")
    return {group: start(stream, sink) for group, sink in sinks.items()}

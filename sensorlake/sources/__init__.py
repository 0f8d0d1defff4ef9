"""Sources and sinks: the log envelope, bounded/streaming reads, planted fixtures."""

from sensorlake.sources.fixtures import plant_faults, planted_readings, stage_files  # noqa: F401
from sensorlake.sources.log import (  # noqa: F401
    SinkSpec,
    SourceSpec,
    decode_envelope,
    read_bounded,
    read_partitions,
    read_stream,
    source_options,
    to_envelope,
    write_log,
)

"""The readings log: encode rows as keyed records, read them back bounded or as a stream.

A Kafka topic is the production source. The Kafka connector is optional at
runtime, so the same ``SourceSpec`` can also name a folder of JSON-lines or
Parquet envelope files (what tests and the bench use).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.functions.parse import event_time_expr, parse_readings
from sensorlake.operators.partitions import partition_sql
from sensorlake.schema import ENVELOPE_FILE, LOG_PARTITIONS, READING, READING_FIELDS, TIMESTAMP_PATTERN


@dataclass(frozen=True)
class SourceSpec:
    """Where readings come from. ``format`` is ``kafka``, ``segments`` (a stored partitioned log), ``json`` or ``parquet``."""

    format: str = "kafka"
    topic: str | None = None
    bootstrap_servers: str | None = None
    path: str | None = None
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False
    max_files_per_trigger: int | None = None
    partitions: tuple[int, ...] | None = None      # read only these log partitions
    options: dict = field(default_factory=dict)


@dataclass(frozen=True)
class SinkSpec:
    """How a streaming query is started."""

    name: str
    checkpoint: str
    mode: str = "append"                 # append | update | complete
    format: str = "memory"              # memory | console | parquet | json | foreachBatch
    path: str | None = None
    processing_time: str | None = None  # e.g. "15 seconds"; None -> availableNow
    options: dict = field(default_factory=dict)


def source_options(spec: SourceSpec, bounded: bool = False) -> dict[str, str]:
    """Reader options for a spec (the Kafka mapping is checkable without the connector)."""
    opts: dict[str, str] = {}
    if spec.format == "kafka":
        opts["kafka.bootstrap.servers"] = spec.bootstrap_servers or "localhost:9092"
        if spec.partitions is not None:
            parts = ",".join(str(p) for p in spec.partitions)
            opts["assign"] = f'{{"{spec.topic}":[{parts}]}}'
        else:
            opts["subscribe"] = spec.topic or ""
        opts["startingOffsets"] = "earliest" if bounded else spec.starting_offsets
        if bounded:
            opts["endingOffsets"] = "latest"
        opts["failOnDataLoss"] = str(spec.fail_on_data_loss).lower()
    elif spec.format == "segments":
        opts["path"] = spec.path or ""
        if spec.partitions is not None:
            opts["partitions"] = ",".join(str(p) for p in spec.partitions)
        # bounded reads start at the beginning unless offsets are named
        opts["startingOffsets"] = "earliest" if bounded and spec.starting_offsets == "latest" else spec.starting_offsets
        opts["failOnDataLoss"] = str(spec.fail_on_data_loss).lower()
    elif spec.max_files_per_trigger is not None and not bounded:
        opts["maxFilesPerTrigger"] = str(spec.max_files_per_trigger)
    opts.update({k: str(v) for k, v in spec.options.items()})
    return opts


def _file_envelope(df: DataFrame) -> DataFrame:
    """Envelope files keep key/value as text; restore the binary envelope shape."""
    return df.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def _segments(spark: SparkSession, reader) -> DataFrame:
    from sensorlake.sources.segments import FORMAT, register   # imports this package's operators

    register(spark)
    return reader.format(FORMAT).load()


def read_stream(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Streaming DataFrame with the log envelope columns."""
    reader = spark.readStream.options(**source_options(spec))
    if spec.format == "segments":
        return _segments(spark, reader)
    if spec.format == "kafka":
        return reader.format("kafka").load()
    df = reader.schema(ENVELOPE_FILE).format(spec.format).load(spec.path)
    df = _file_envelope(df)
    return read_partitions(df, spec.partitions) if spec.partitions is not None else df


def read_bounded(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Everything in the log from the earliest record to the current end (batch)."""
    reader = spark.read.options(**source_options(spec, bounded=True))
    if spec.format == "segments":
        return _segments(spark, reader)
    if spec.format == "kafka":
        return reader.format("kafka").load()
    df = _file_envelope(reader.schema(ENVELOPE_FILE).format(spec.format).load(spec.path))
    return read_partitions(df, spec.partitions) if spec.partitions is not None else df


def read_partitions(df: DataFrame, partitions: Sequence[int]) -> DataFrame:
    """Only the records of the given log partitions; an empty list reads nothing."""
    parts = [int(p) for p in partitions]
    if not parts:
        return df.where(F.lit(False))
    return df.where(F.col("partition").isin(parts))


def to_envelope(df: DataFrame, key: str = "sensor_id", topic: str = "readings",
                n_partitions: int = LOG_PARTITIONS, offset_col: str | None = "event_id",
                fields: Sequence[str] = READING_FIELDS) -> DataFrame:
    """Rows -> keyed log records.

    ``key`` is the UTF-8 text of the key column (NULL or empty -> NULL), ``value``
    is JSON with every field written, NULLs included. ``partition`` is a stable
    hash of the key so one sensor's records stay in one partition, in order.
    ``offset`` is the arrival id (monotone within a partition).
    """
    fields_sql = ", ".join(f"`{c}`" for c in fields)
    offset = f"CAST(`{offset_col}` AS BIGINT)" if offset_col else "CAST(NULL AS BIGINT)"
    return df.selectExpr(
        f"CAST(nullif(CAST(`{key}` AS STRING), '') AS BINARY) AS key",
        f"CAST(to_json(struct({fields_sql}), map('ignoreNullFields', 'false')) AS BINARY) AS value",
        f"'{topic}' AS topic",
        f"{partition_sql(f'`{key}`', n_partitions, f'`{offset_col}`' if offset_col else None)} AS partition",
        f"{offset} AS offset",
        f"try_to_timestamp(`timestamp`, '{TIMESTAMP_PATTERN}') AS `timestamp`",
    )

def decode_envelope(env: DataFrame, keep: Sequence[str] = ("partition", "offset")) -> DataFrame:
    """Envelope -> readings with ``event_time`` (parse once, expand once)."""
    parsed = parse_readings(env, READING, "value", keep=keep)
    return parsed.withColumn("event_time", event_time_expr("timestamp"))


def write_log(env: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite",
              partition_by: Sequence[str] = ()) -> None:
    """Persist an envelope frame as log files (binary columns as text).

    With ``partition_by=("partition",)`` each log partition is its own folder,
    so reading chosen partitions prunes folders instead of filtering rows.
    """
    out = env.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )
    writer = out.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)

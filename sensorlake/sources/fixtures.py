"""Planted readings over the ``events`` table, and staged stream files.

The reference's producer draws faults at random per record. Here the fault of
a row is fixed by ``event_id % 100`` so that Spark and a SQL oracle build the
very same input from the same table.

Planting rules (FIXTURES.md F8):

* arrival order = ``event_id``; ``batch_id = event_id div batch_rows``
* sensor ``sensor_<user_id % 10 + 1>``, temperature ``value / 5``,
  humidity ``props.k``, status ``event_type``, timestamp ``ts`` as whole-second text
* bucket 0-2: temperature NULL; 3-4: an out-of-range value picked by ``event_id % 4``
* bucket 5-6: timestamp ``NOT_A_TIMESTAMP``
* bucket 20, 40, 60: time moved back ``6 + batch_id % 10`` minutes (late row;
  ``late_unit="days"`` for staged stream files, where one file spans days)
* bucket 10, 11: a copy of the reading in bucket 9 just before
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.operators.partitions import partition_sql
from sensorlake.schema import BAD_TIMESTAMP_TEXT, LOG_PARTITIONS, NUM_SENSORS, OUT_OF_RANGE_VALUES, READING_FIELDS

TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def plant_faults(events: DataFrame, batch_rows: int = 20, late: bool = True,
                 n_partitions: int = LOG_PARTITIONS, late_unit: str = "minutes") -> DataFrame:
    """events -> readings with planted faults, in arrival order ``event_id``.

    Columns: event_id, batch_id, sensor_id, timestamp, temperature, humidity,
    status, partition. Copies come from a window over blocks of 100 ids (no global lag).
    """
    # column logic as SQL expressions: one JVM call per expression when the plan is built
    back = "pmod(batch_id, 10) + 6"
    shift = f"make_dt_interval(0, 0, {back}, 0)" if late_unit == "minutes" else f"make_dt_interval({back}, 0, 0, 0)"
    late_case = f"WHEN bucket IN (20, 40, 60) THEN date_format(ts - {shift}, '{TEXT_FORMAT}')" if late else ""
    bad_values = ", ".join(f"CAST({v!r} AS DOUBLE)" for v in OUT_OF_RANGE_VALUES)
    base = events.selectExpr(
        "event_id",
        f"event_id div {int(batch_rows)} AS batch_id",
        "pmod(event_id, 100) AS bucket",
        "ts",
        f"concat('sensor_', CAST(pmod(user_id, {NUM_SENSORS}) + 1 AS STRING)) AS sensor_id",
        "value / 5 AS temperature0",
        "CAST(get_json_object(props, '$.k') AS DOUBLE) AS humidity",
        "event_type AS status",
    )
    faulted = base.selectExpr(
        "event_id", "batch_id", "bucket", "sensor_id",
        f"CASE WHEN bucket IN (5, 6) THEN '{BAD_TIMESTAMP_TEXT}' {late_case} "
        f"ELSE date_format(ts, '{TEXT_FORMAT}') END AS `timestamp`",
        "CASE WHEN bucket IN (0, 1, 2) THEN CAST(NULL AS DOUBLE) "
        f"WHEN bucket IN (3, 4) THEN element_at(array({bad_values}), CAST(pmod(event_id, 4) + 1 AS INT)) "
        "ELSE temperature0 END AS temperature",
        "humidity", "status",
    )
    # bucket 10/11 copy the reading of bucket 9 of the same hundred ids: a window over groups of at
    # most 100 consecutive ids (bounded group size, one pass, no self-join)
    fields = ", ".join(f"`{c}`" for c in READING_FIELDS)
    rows = (
        faulted.selectExpr(
            "*",
            f"CASE WHEN bucket IN (10, 11) THEN first(CASE WHEN bucket = 9 THEN struct({fields}) END, true) "
            "OVER (PARTITION BY event_id div 100) END AS _src")
        .where("bucket NOT IN (10, 11) OR _src IS NOT NULL")
        .selectExpr(
            "event_id", "batch_id",
            *[f"CASE WHEN bucket IN (10, 11) THEN _src.`{c}` ELSE `{c}` END AS `{c}`" for c in READING_FIELDS])
        .selectExpr("*", f"{partition_sql('sensor_id', n_partitions, 'event_id')} AS partition")
    )
    return rows


def planted_readings(spark: SparkSession, sf_dir: str, batch_rows: int = 20, late: bool = True,
                     late_unit: str = "minutes") -> DataFrame:
    """Planted readings built from ``{sf_dir}/events.parquet``."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return plant_faults(events, batch_rows=batch_rows, late=late, late_unit=late_unit)


def stage_files(env: DataFrame, path: str, group_col: str, n_groups: int, files_per_group: int = 1,
                fmt: str = "json") -> None:
    """Write envelope rows as ``n_groups`` successive sets of ``files_per_group`` log files.

    The rows are stored once, by group; then each group is written from its own
    folder after the group before, so file modification times follow group order and a
    file stream with ``maxFilesPerTrigger = files_per_group`` reads exactly one
    group per micro-batch. This is a test/bench fixture for stream runs.
    """
    from sensorlake.session import scratch_dir
    from sensorlake.sources.log import write_log

    spark, held = env.sparkSession, scratch_dir(env.sparkSession, "groups")
    env.write.partitionBy(group_col).parquet(held)
    for g in range(n_groups):
        rows = spark.read.schema(env.schema).parquet(held).where(F.col(group_col) == g).drop(group_col)
        write_log(rows.repartition(files_per_group), path, fmt=fmt, mode="append")

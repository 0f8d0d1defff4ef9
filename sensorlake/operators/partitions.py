"""Log partition placement and partition-load reports.

The partition of a record is a stable hash of its key, so one sensor's
records stay together and in arrival order. Kafka's own client hash is not a
Spark function; ``md5`` prefix modulo ``n`` is used instead (a SQL engine can
compute it too), so per-partition counts differ from a real broker's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.functions.scalar import safe_rate
from sensorlake.schema import LOG_PARTITIONS, READER_COUNTS


def partition_sql(key: str, n: int = LOG_PARTITIONS, fallback: str | None = None) -> str:
    """SQL: partition number in [0, n) of a key; NULL keys spread by ``fallback`` (arrival id)."""
    h = f"pmod(CAST(conv(substring(md5(CAST({key} AS STRING)), 1, 8), 16, 10) AS BIGINT), {int(n)})"
    other = f"pmod(CAST({fallback} AS BIGINT), {int(n)})" if fallback else "0"
    return f"CAST(coalesce({h}, {other}) AS INT)"


def counts(df: DataFrame, n: int = LOG_PARTITIONS, partition_col: str = "partition") -> DataFrame:
    """Records per log partition: every partition that has records, and the known ``0..n-1`` with 0 if they have none.

    The grouped count is pre-aggregated per task; the known ids are bounded by
    configuration, so adding them is cheap at any data size.
    """
    known = df.sparkSession.range(n).select(F.col("id").cast("int").alias("partition"), F.lit(0).cast("long").alias("n"))
    per = df.groupBy(F.col(partition_col).cast("int").alias("partition")).agg(F.count(F.lit(1)).alias("n"))
    return known.unionByName(per).groupBy("partition").agg(F.sum("n").cast("long").alias("n"))


def reader_load(partition_counts: DataFrame, n: int = LOG_PARTITIONS,
                readers: Sequence[int] = READER_COUNTS) -> DataFrame:
    """Per-reader load when ``r`` readers share the counted partitions (and the known ``0..n-1``) round-robin.

    Partition ``p`` goes to reader ``p % r``; surplus readers are listed idle
    with 0 records. Output: readers, reader, partitions (text, in ascending order of number), n.
    """
    spark = partition_counts.sparkSession
    rs = spark.createDataFrame([(int(r),) for r in readers], "readers int")
    slots = rs.select("readers", F.explode(F.sequence(F.lit(0), F.col("readers") - 1)).alias("reader"))
    # every partition of every configuration: readers x partitions rows
    known = spark.range(n).select(F.col("id").cast("int").alias("partition"), F.lit(0).cast("long").alias("n"))
    every = partition_counts.select("partition", "n").unionByName(known).groupBy("partition").agg(F.sum("n").alias("n"))
    share = every.select("partition", "n", F.explode(F.array(*[F.lit(int(r)) for r in readers])).alias("readers"))
    load = share.groupBy("readers", F.pmod(F.col("partition"), F.col("readers")).alias("reader")).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("partition")), lambda p: p.cast("string"))).alias("partitions"),
        F.sum("n").cast("long").alias("n"))
    return slots.join(load, ["readers", "reader"], "left").select(
        F.col("readers").cast("int").alias("readers"),
        F.col("reader").cast("int").alias("reader"),
        F.coalesce("partitions", F.lit("")).alias("partitions"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def skew(partition_counts: DataFrame) -> DataFrame:
    """One row: partitions, total, largest partition, its share, empty partitions."""
    return partition_counts.agg(
        F.count(F.lit(1)).cast("long").alias("n_partitions"),
        F.sum("n").cast("long").alias("total"),
        F.max("n").cast("long").alias("max_n"),
        F.count_if(F.col("n") == 0).cast("long").alias("empty_partitions"),
    ).withColumn("max_share", safe_rate("max_n", "total"))


def delivery_check(produced: DataFrame, consumed: DataFrame) -> DataFrame:
    """One row: produced and consumed record counts and whether they agree."""
    consumed_n = consumed.agg(F.count(F.lit(1)).cast("long")).scalar()
    return produced.agg(F.count(F.lit(1)).cast("long").alias("produced")).select(
        "produced", consumed_n.alias("consumed"), (F.col("produced") == consumed_n).alias("delivered"))

"""Folders of a shared store: existence and listing through Hadoop, and a keyed table kept as snapshot and tail."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.session import remove_folder


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001 - Hadoop FileSystem, works for any shared store
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p  # noqa: SLF001


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def numbered(spark: SparkSession, path: str, name: str) -> list[int]:
    """The values of the partition folders ``name=<number>`` directly below ``path``, ascending."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    return sorted(int(x.partition("=")[2]) for x in names if x.startswith(f"{name}="))


@dataclass(frozen=True)
class UpsertLog:
    """A keyed table that batches update: whole new rows of the keys a batch touched, the newest batch's row counts.

    ``tail/batch_id=N`` holds what batch N wrote (a replay replaces it). Every ``every`` batches the current
    rows are stored as ``snapshot/upto=M``; M is the high-water mark, so reading opens one
    snapshot and the batches after it. With ``history`` batches that a snapshot covers are kept
    (``changes`` reads them all), else those behind the snapshot before the last one are deleted.
    """

    path: str
    schema: str
    keys: tuple[str, ...]
    every: int = 16
    history: bool = False

    @property
    def columns(self) -> list[str]:
        return [c.split()[0] for c in self.schema.split(", ")]

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.select(*self.columns).write.mode("overwrite").parquet(f"{self.path}/tail/batch_id={int(batch_id)}")

    def snapshots(self, spark: SparkSession) -> list[int]:
        """High-water marks of the snapshots that are complete."""
        return [m for m in numbered(spark, f"{self.path}/snapshot", "upto") if exists(spark, f"{self.path}/snapshot/upto={m}/_SUCCESS")]

    def _parts(self, spark: SparkSession, upto: int | None) -> tuple[int | None, list[int]]:
        marks = [m for m in self.snapshots(spark) if upto is None or m <= upto]
        mark = marks[-1] if marks else None
        tail = [b for b in numbered(spark, f"{self.path}/tail", "batch_id") if (mark is None or b > mark) and (upto is None or b <= upto)]
        return mark, tail

    def changes(self, spark: SparkSession, batches: list[int] | None = None) -> DataFrame:
        """Rows with the batch_id that wrote them, of the given batches (default: all that are there)."""
        batches = numbered(spark, f"{self.path}/tail", "batch_id") if batches is None else batches
        schema = f"{self.schema}, batch_id long"
        if not batches:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", f"{self.path}/tail").parquet(*[f"{self.path}/tail/batch_id={b}" for b in batches])

    def current(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """Newest row of every key, of batches up to ``upto``: one snapshot and the batches after it."""
        mark, tail = self._parts(spark, upto)
        rows = self.changes(spark, tail)
        if mark is not None:
            kept = spark.read.schema(self.schema).parquet(f"{self.path}/snapshot/upto={mark}").withColumn("batch_id", F.lit(mark).cast("long"))
            rows = rows.unionByName(kept)
        values = [c for c in self.columns if c not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v"))
        return newest.select(*[F.col(c) if c in self.keys else F.col(f"_v.{c}").alias(c) for c in self.columns])

    def compact(self, spark: SparkSession, before: int) -> None:
        """Store a snapshot once ``every`` batches, all older than ``before``, wait for one. Call it before batch ``before`` writes."""
        mark, tail = self._parts(spark, before - 1)
        if len(tail) < self.every:
            return
        self.current(spark, tail[-1]).write.mode("overwrite").parquet(f"{self.path}/snapshot/upto={tail[-1]}")
        if mark is None:
            return
        for m in self.snapshots(spark):
            if m < mark:
                remove_folder(spark, f"{self.path}/snapshot/upto={m}")
        if not self.history:     # the snapshot before stays readable with the batches after it
            for b in numbered(spark, f"{self.path}/tail", "batch_id"):
                if b <= mark:
                    remove_folder(spark, f"{self.path}/tail/batch_id={b}")

"""The keys a stream has seen, by event day, in levels of merged runs with bitmaps.

A batch adds its new keys as one run a day to level 0. Once a day has ``fan`` runs on a level, they
are merged to one run on the next, so a day has at most ``fan`` runs on each of log(batches) levels
and listing stays bounded. A merged run carries a bitmap of its key hashes (Spark's bitmap aggregates);
a batch opens it only if one of its own keys has its bit set there. Runs of level 0 are few and always read.

A key that stands in two runs (a merge that was interrupted before its inputs were deleted) does no harm: the
ledger is a set. Only level 0 can hold keys of a batch that is replayed, so readers give the batch id.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.session import remove_folder
from sensorlake.streaming.folders import exists, numbered

DAY, RUN = "event_day", "run"


@dataclass(frozen=True)
class KeyLedger:
    root: str
    keys: tuple[str, ...]
    fan: int = 8
    bits: int = 20          # bitmap positions of a run: 2 ** bits
    most_levels: int = 12

    @property
    def schema(self) -> str:
        return ", ".join(f"`{k}` string" for k in self.keys)

    def _level(self, kind: str, level: int) -> str:
        return f"{self.root}/{kind}{level}"

    def _hash(self) -> str:
        return f"pmod(xxhash64({', '.join(f'`{k}`' for k in self.keys)}), {1 << self.bits}) + 1"

    def days(self, spark: SparkSession) -> list[int]:
        found = {d for level in range(self.most_levels) for d in numbered(spark, self._level("keys", level), DAY)}
        return sorted(found)

    def runs(self, spark: SparkSession, days: Sequence[int], before: int) -> dict[tuple[int, int], list[int]]:
        """(level, day) -> runs; of level 0 only batches older than ``before``."""
        levels = [level for level in range(self.most_levels) if exists(spark, self._level("keys", level))]
        found = {(level, d): numbered(spark, f"{self._level('keys', level)}/{DAY}={d}", RUN) for level in levels for d in days}
        return {(level, d): [r for r in runs if level or r < before] for (level, d), runs in found.items() if runs}

    def add(self, keys: DataFrame, batch_id: int) -> None:
        """Keys (with their day) that batch ``batch_id`` saw first; a replay replaces them."""
        rows = keys.select(*self.keys, DAY, F.lit(int(batch_id)).cast("long").alias(RUN)).hint("rebalance", DAY)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, RUN).parquet(self._level("keys", 0))

    def _read(self, spark: SparkSession, kind: str, schema: str, picked: dict[tuple[int, int], list[int]]) -> DataFrame | None:
        out = None
        for level in sorted({level for level, _ in picked}):
            base = self._level(kind, level)
            paths = [f"{base}/{DAY}={d}/{RUN}={r}" for (at, d), runs in picked.items() if at == level for r in runs]
            if not paths:
                continue
            part = spark.read.schema(f"{schema}, {DAY} int, {RUN} long").option("basePath", base).parquet(*paths).withColumn("level", F.lit(level))
            out = part if out is None else out.unionByName(part)
        return out

    def merge(self, spark: SparkSession, days: Sequence[int], before: int) -> dict[tuple[int, int], list[int]]:
        """Merge what is due on the given days, level by level; returns the runs that are left."""
        found, level = self.runs(spark, days, before), 0
        while level + 1 < self.most_levels:
            due = {(at, d): runs for (at, d), runs in found.items() if at == level and len(runs) >= self.fan}
            if not due:
                if not any(at > level for at, _ in found):
                    break
                level += 1
                continue
            name = {d: max(runs) for (_, d), runs in due.items()}
            number = F.element_at(F.create_map(*[F.lit(x) for pair in name.items() for x in pair]), F.col(DAY)).cast("long")
            keys = self._read(spark, "keys", self.schema, due).select(*self.keys, DAY, number.alias(RUN))
            maps = keys.selectExpr(DAY, RUN, f"{self._hash()} AS h").groupBy(DAY, RUN, F.expr("bitmap_bucket_number(h)").alias("bucket")).agg(
                F.expr("bitmap_construct_agg(bitmap_bit_position(h))").alias("bits"))
            # bitmaps first: a run without one is always opened
            for kind, rows in (("bits", maps.hint("rebalance", DAY)), ("keys", keys.repartitionByRange(DAY, *reversed(self.keys)))):
                rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, RUN).parquet(self._level(kind, level + 1))
            for (at, d), runs in due.items():
                for r in runs:
                    remove_folder(spark, f"{self._level('keys', at)}/{DAY}={d}/{RUN}={r}")
                    if at:
                        remove_folder(spark, f"{self._level('bits', at)}/{DAY}={d}/{RUN}={r}")
            found, level = self.runs(spark, days, before), level + 1
        return found

    def candidates(self, spark: SparkSession, rows: DataFrame, day: Column, found: dict[tuple[int, int], list[int]]) -> dict[tuple[int, int], list[int]]:
        """Of the given runs those that may hold a key of ``rows``: level 0, and merged ones whose bitmap has a key's bit."""
        merged = {at: runs for at, runs in found.items() if at[0]}
        picked = {at: runs for at, runs in found.items() if not at[0]}
        mapped = {(level, d): [r for r in runs if exists(spark, f"{self._level('bits', level)}/{DAY}={d}/{RUN}={r}")] for (level, d), runs in merged.items()}
        for at, runs in merged.items():
            picked[at] = [r for r in runs if r not in mapped[at]]
        maps = self._read(spark, "bits", "bucket long, bits binary", mapped)
        if maps is None:
            return picked
        mine = rows.select(day.alias(DAY), F.expr(self._hash()).alias("h")).distinct().selectExpr(
            DAY, "bitmap_bucket_number(h) AS bucket", "bitmap_bit_position(h) AS at")
        is_set = "getbit(CAST(conv(hex(substring(bits, CAST(at DIV 8 AS INT) + 1, 1)), 16, 10) AS INT), CAST(at % 8 AS INT)) = 1"
        hits = mine.join(maps, [DAY, "bucket"]).where(is_set).select("level", DAY, RUN).distinct()
        for r in hits.take(sum(map(len, mapped.values()))):     # at most every run
            picked[(r["level"], r[DAY])] = [*picked[(r["level"], r[DAY])], r[RUN]]
        return picked

    def read(self, spark: SparkSession, picked: dict[tuple[int, int], list[int]]) -> DataFrame | None:
        """Keys of the given runs, with their day."""
        rows = self._read(spark, "keys", self.schema, {at: runs for at, runs in picked.items() if runs})
        return None if rows is None else rows.select(*self.keys, DAY)

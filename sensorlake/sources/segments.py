"""A partitioned log in shared storage as a Spark data source, for batch and streaming reads.

Layout: ``append=N/partition=P/*.parquet`` holds the records of one append, sorted by offset; each
file is a segment. ``_segments/append=N`` lists them (partition, base, end, first, rows, file) and is written last, so it
commits the append. The segments of a partition tile its offsets: base is the end of the one before, and
a gap in the tiling, or a segment whose file is gone, is lost data, not an offset that was never used.

Streaming offsets are the next offset of every partition. A micro-batch is planned as ranges of segments, one task
each, so a long partition is read in parallel. Options: ``path``; ``startingOffsets`` (``earliest``, ``latest``, ``group``
or JSON, as {"0": 17}); ``partitions`` ("0,2"); ``failOnDataLoss`` (default true); ``group``, under whose name the offsets of finished
batches are stored, for other readers and for ``startingOffsets=group`` (never ahead of the work: the last batch of a run counts once
the next is planned, or ``commit_ended`` is called).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from sensorlake.operators.prefix import exclusive_prefix
from sensorlake.schema import ENVELOPE
from sensorlake.session import workers_find_package

FORMAT = "sensorlog"
ENVELOPE_SQL = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
ARROW = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()),
                   ("timestamp", pa.timestamp("us", "UTC"))])
SEGMENT_SQL = "partition int, base long, `end` long, first long, rows long, file string"


# --- writing --------------------------------------------------------------------------------------

def append_segments(env: DataFrame, path: str, number: int) -> None:
    """Append records to the log as append ``number`` (0, 1, ...); offsets lie behind those of earlier appends of the partition.

    Ranges of (partition, offset) become files, so a hot partition is written by many tasks. An append that
    failed is not in the listing and is replaced when it is repeated.
    """
    spark, folder = env.sparkSession, f"{path}/append={int(number)}"
    env.select(*ENVELOPE.fieldNames()).repartitionByRange("partition", "offset").sortWithinPartitions("partition", "offset").write.mode(
        "overwrite").partitionBy("partition").parquet(folder)
    stored = spark.read.schema(ENVELOPE_SQL).parquet(folder).select("partition", "offset", F.col("_metadata.file_path").alias("file"))
    files = stored.groupBy("partition", "file").agg(F.min("offset").alias("first"), (F.max("offset") + 1).alias("end"), F.count(F.lit(1)).alias("rows"))
    ranked = files.withColumn("_at", F.expr("row_number() OVER (PARTITION BY partition ORDER BY first) - 1"))       # one row a file
    tiled = exclusive_prefix(ranked, "_at", {"end": "max"}, group_cols=["partition"])
    ends = spark.createDataFrame([(p, e) for p, (_, e) in Log(path).bounds(before=number).items()], "partition int, log_end long")
    rows = tiled.join(ends, "partition", "left").selectExpr("partition", "coalesce(prev_end, log_end, 0L) AS base", "`end`", "first", "rows", "file")
    rows.coalesce(1).write.mode("overwrite").json(f"{path}/_segments/append={int(number)}")


# --- the log as the driver and the tasks see it ------------------------------------------------------

class Log:
    """Segments of a log, read through Arrow's file systems (local, HDFS, object stores)."""

    def __init__(self, path: str):
        self.fs, self.root = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
        self.known: dict[str, list[dict]] = {}      # appends that were listed before do not change

    def segments(self, before: int | None = None) -> dict[int, list[dict]]:
        """partition -> segments in order of offset, of all committed appends (or those before a number)."""
        out: dict[int, list[dict]] = {}
        top = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/_segments", allow_not_found=True))
        for folder in sorted((x for x in top if x.base_name.startswith("append=")), key=lambda x: int(x.base_name.partition("=")[2])):
            if before is not None and int(folder.base_name.partition("=")[2]) >= before:
                continue
            if folder.path not in self.known:
                files = self.fs.get_file_info(pafs.FileSelector(folder.path))
                if not any(f.base_name == "_SUCCESS" for f in files):
                    continue
                rows = []
                for f in files:
                    if f.base_name.endswith(".json"):
                        with self.fs.open_input_stream(f.path) as s:
                            rows += [json.loads(line) for line in s.read().decode().splitlines()]
                self.known[folder.path] = rows
            for r in self.known[folder.path]:
                out.setdefault(r["partition"], []).append(r)
        return {p: sorted(rows, key=lambda r: r["base"]) for p, rows in sorted(out.items())}

    def local(self, file: str) -> str:
        return pafs.FileSystem.from_uri(file)[1] if ":" in file.split("/")[0] else file

    def there(self, rows: list[dict]) -> list[dict]:
        """The segments whose files are still stored."""
        if not rows:
            return []
        info = self.fs.get_file_info([self.local(r["file"]) for r in rows])
        return [r for r, i in zip(rows, info, strict=True) if i.type == pafs.FileType.File]

    def bounds(self, before: int | None = None) -> dict[int, tuple[int, int]]:
        """partition -> (first offset that is still stored, next offset)."""
        out = {}
        for p, rows in self.segments(before).items():
            left = self.there(rows)
            out[p] = (left[0]["base"] if left else rows[-1]["end"], rows[-1]["end"])
        return out

    def _group(self, group: str) -> str:
        return f"{self.root}/_groups/{group}.json"

    def group_offsets(self, group: str) -> dict[int, int]:
        if self.fs.get_file_info(self._group(group)).type != pafs.FileType.File:
            return {}
        with self.fs.open_input_stream(self._group(group)) as s:
            return {int(p): o for p, o in json.loads(s.read()).items()}

    def commit_group(self, group: str, offsets: dict[int, int]) -> None:
        self.fs.create_dir(f"{self.root}/_groups", recursive=True)
        with self.fs.open_output_stream(self._group(group)) as s:
            s.write(json.dumps(offsets).encode())


def group_offsets(path: str, group: str) -> dict[int, int]:
    """Next offset of every partition that a group has committed."""
    return Log(path).group_offsets(group)


def commit_ended(query: StreamingQuery, path: str, group: str) -> None:
    """Store the last offsets of a query that has ended well: Spark tells the source about a batch only when it plans the next one."""
    for source in json.loads(query.lastProgress.json)["sources"] if query.lastProgress else []:
        end = source["endOffset"]
        if end is not None:
            Log(path).commit_group(group, {int(p): o for p, o in (json.loads(end) if isinstance(end, str) else end).items()})


@dataclass
class Range(InputPartition):
    file: str
    lo: int
    hi: int
    partition: int


class _Reading:
    """What batch and streaming reads share."""

    def __init__(self, options: dict[str, str]):
        self.path, self.group = options["path"], options.get("group")
        self.start, self.strict = options.get("startingoffsets", "earliest"), options.get("failondataloss", "true").lower() != "false"
        chosen = options.get("partitions")
        self.chosen = None if chosen is None else {int(p) for p in chosen.split(",") if p.strip()}
        self._log: Log | None = None

    @property
    def log(self) -> Log:
        if self._log is None:
            self._log = Log(self.path)
        return self._log

    def __getstate__(self):
        return {**self.__dict__, "_log": None}      # tasks open their own

    def mine(self, by_partition: dict) -> dict:
        return {p: v for p, v in by_partition.items() if self.chosen is None or p in self.chosen}

    def first(self) -> dict[int, int]:
        bounds = self.mine(self.log.bounds())
        if self.start == "latest":
            return {p: end for p, (_, end) in bounds.items()}
        begin = {p: base for p, (base, _) in bounds.items()}
        if self.start == "earliest":
            return begin
        given = self.log.group_offsets(self.group) if self.start == "group" else {int(p): int(o) for p, o in json.loads(self.start).items()}
        return {p: given.get(p, base) for p, base in begin.items()}

    def latest(self) -> dict[int, int]:
        return {p: end for p, (_, end) in self.mine(self.log.bounds()).items()}

    def ranges(self, start: dict[int, int], end: dict[int, int]) -> list[Range]:
        """Segments with offsets in [start, end) of every partition; what is lost is an error or left out."""
        out = []
        for p, rows in self.mine(self.log.segments()).items():
            lo, hi = start.get(p, 0), end.get(p, 0)
            wanted = [r for r in rows if r["base"] < hi and r["end"] > lo]
            left = self.there_or_fail(p, wanted)
            out += [Range(r["file"], max(lo, r["base"]), min(hi, r["end"]), p) for r in left]
        return out

    def there_or_fail(self, partition: int, wanted: list[dict]) -> list[dict]:
        left = self.log.there(wanted)
        if self.strict and len(left) < len(wanted):
            gone = next(r for r in wanted if r not in left)
            raise RuntimeError(f"partition {partition}: offsets {gone['base']} to {gone['end'] - 1} are no longer stored (failOnDataLoss=false reads on)")
        return left

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        if partition is None:       # nothing to read
            return
        log = Log(self.path)
        try:
            source = log.fs.open_input_file(log.local(partition.file))
        except FileNotFoundError:
            if self.strict:
                raise
            return
        with source:
            names = [n for n in ARROW.names if n != "partition"]
            for batch in pq.ParquetFile(source).iter_batches(columns=names):
                rows = pa.Table.from_batches([batch])
                offset = rows.column("offset")
                rows = rows.filter(pc.and_(pc.greater_equal(offset, partition.lo), pc.less(offset, partition.hi)))
                rows = rows.append_column("partition", pa.array([partition.partition] * rows.num_rows, pa.int32())).select(ARROW.names)
                yield from rows.cast(ARROW).combine_chunks().to_batches()


class SegmentStream(_Reading, DataSourceStreamReader):
    def initialOffset(self) -> dict:  # noqa: N802 - data source API
        return {str(p): o for p, o in self.first().items()}

    def latestOffset(self) -> dict:  # noqa: N802
        return {str(p): o for p, o in self.latest().items()}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return self.ranges({int(p): o for p, o in start.items()}, {int(p): o for p, o in end.items()})

    def commit(self, end: dict) -> None:
        if self.group:
            self.log.commit_group(self.group, {int(p): o for p, o in end.items()})


class SegmentBatch(_Reading, DataSourceReader):
    def partitions(self) -> list[Range]:
        return self.ranges(self.first(), self.latest())


class SegmentLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ENVELOPE_SQL

    def reader(self, schema) -> SegmentBatch:
        return SegmentBatch(self._lower())

    def streamReader(self, schema) -> SegmentStream:  # noqa: N802
        return SegmentStream(self._lower())

    def _lower(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}


def register(spark: SparkSession) -> SparkSession:
    """Make ``format("sensorlog")`` known to the session."""
    workers_find_package(spark).dataSource.register(SegmentLog)
    return spark

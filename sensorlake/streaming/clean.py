"""The cleaning query as a stream: one DataFrame plan per micro-batch, state in tables.

Per batch ``N`` (inside ``foreachBatch``):

1. one pass over the batch gives the event days it touches that have stored rows, and
   the days in which rows without a temperature need history;
2. first arrival per (sensor_id, timestamp) inside the batch, then a NULL-safe
   match against the key ledger: runs of those days whose bitmaps admit one of the batch's keys;
3. the trailing-mean history is the batch itself plus the rows of the cleaned table in the (sensor, time
   bucket) pairs that the rows to be filled reach, read from the days of these buckets only;
4. late class against the greatest kept event time of batches < N, which the log row of batch N-1 carries;
5. the annotated rows are stored once, and all counters of the batch are observed while they are written;
6. writes side by side - cleaned rows, new ledger keys, running analytics (the state of each sensor and status that the
   batch touched, merged from what earlier batches left) - each in folders of ``batch_id`` that a replay replaces;
7. the log row comes last. It commits the batch: readers see batches that have one.

A batch without rows writes its log row too, so the log has every batch.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorlake.functions.features import add_time_features
from sensorlake.operators.prefix import inclusive_prefix
from sensorlake.operators.quality import DEDUP_KEYS, first_flags, late_sql
from sensorlake.plans.cleaning import CLEAN_COLUMNS, fill, outcome_counts
from sensorlake.schema import HISTORY_SECONDS, KEPT, LATE_ACCEPTED, TOO_LATE
from sensorlake.session import remove_folder, scratch_dir
from sensorlake.sources.log import SinkSpec
from sensorlake.streaming.folders import UpsertLog, exists, numbered
from sensorlake.streaming.ledger import KeyLedger
from sensorlake.streaming.runner import start

#: ledger day of keys whose time does not parse: before any day that does
NO_DAY = -10_000_000

COUNTERS = ("raw_rows", "cleaned_rows", "missing_corrected", "duplicates_removed", "invalid_removed",
            "dropped_insufficient_history", "late_accepted")
LOG_SCHEMA = ", ".join([*[f"{c} long" for c in COUNTERS], "max_event_time timestamp, running_max timestamp, duration_ms long, batch_id long"])


def _day(col):
    """Days since 1970-01-01 of a timestamp (the partition value), NO_DAY when NULL."""
    return F.coalesce(F.unix_date(F.to_date(col)), F.lit(NO_DAY))


def replace_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Write ``df`` and replace only the partitions it has rows for, whatever the session's overwrite mode is."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def sensor_state(root: str) -> UpsertLog:
    """Running statistics of each sensor; every batch's rows are kept for the snapshots of earlier batches."""
    return UpsertLog(f"{root}/sensor_state", "sensor_id string, total double, readings long, max_temperature double, last_event_time timestamp",
                     ("sensor_id",), history=True)


def status_state(root: str) -> UpsertLog:
    return UpsertLog(f"{root}/status_state", "status string, n long", ("status",), history=True)


def merged(state: UpsertLog, delta: DataFrame, n: int, combine: dict[str, str]) -> DataFrame:
    """The state of the keys in ``delta`` after batch n: earlier state and the batch's own, combined column by column."""
    spark = delta.sparkSession
    before = state.current(spark, n - 1).select(*[F.col(c).alias(f"_b_{c}") for c in state.columns])
    on = [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in state.keys]
    ways = {"sum": "coalesce(`_b_{0}`, 0) + `{0}`", "max": "greatest(`_b_{0}`, `{0}`)"}
    return delta.join(before, on, "left").selectExpr(
        *[f"{ways[combine[c]].format(c)} AS `{c}`" if c in combine else f"`{c}`" for c in state.columns])


@dataclass
class CleanStream:
    """foreachBatch state holder: folder layout and parameters (no row state in Python).

    With ``feedback`` filled values of earlier rows are history too. ``drop_too_late``
    writes no rows that are later than accepted. ``dedup_days`` lets a key come back
    after so many days of event time (default: never), which bounds the ledger that is read.
    """

    root: str
    width_seconds: float = HISTORY_SECONDS
    order: str = "event_id"
    feedback: bool = False
    drop_too_late: bool = False
    dedup_days: int | None = None

    @property
    def cleaned_path(self) -> str:
        return f"{self.root}/cleaned"

    @property
    def log_path(self) -> str:
        return f"{self.root}/batch_log"

    @property
    def ledger(self) -> KeyLedger:
        return KeyLedger(f"{self.root}/ledger", DEDUP_KEYS)

    def touched(self, rows: DataFrame, ledger_days: list[int], cleaned_days: list[int]) -> dict[tuple[int, int], dict]:
        """(kind, day) -> range of timestamp texts, for stored days that the batch touches.

        Kind 0: days of its keys that the ledger has; kind 1: days of the cleaned table that rows without a temperature reach back to.
        """
        spark = rows.sparkSession
        stored = [(0, d) for d in ledger_days] + [(1, d) for d in cleaned_days]
        if not stored:
            return {}
        back = f"event_time - make_dt_interval(0, 0, 0, {float(self.width_seconds)!r})"
        day = f"coalesce(unix_date(to_date(event_time)), {NO_DAY})"
        need = "event_time IS NOT NULL AND temperature IS NULL"
        days = rows.selectExpr("timestamp", f"explode(concat(array(struct(0 AS kind, {day} AS day)), CASE WHEN {need} THEN "
                               f"transform(sequence(unix_date(to_date({back})), unix_date(to_date(event_time))), d -> struct(1 AS kind, d AS day)) "
                               "ELSE array() END)) AS _d").selectExpr("timestamp", "_d.kind", "_d.day")
        per = days.groupBy("kind", "day").agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"))
        have = spark.createDataFrame(stored, "kind int, day int")
        return {(r["kind"], r["day"]): r.asDict() for r in per.join(have, ["kind", "day"]).take(len(stored))}

    def seen(self, rows: DataFrame, days: dict[int, dict], n: int) -> DataFrame | None:
        """Ledger keys that rows of the batch may repeat."""
        spark = rows.sparkSession
        if self.dedup_days is not None and any(d != NO_DAY for d in days):
            latest = rows.agg(F.max(F.unix_date(F.to_date("event_time"))).alias("d")).first()["d"]
            days = {d: v for d, v in days.items() if d == NO_DAY or d >= latest - self.dedup_days}
        if not days:
            return None
        found = self.ledger.merge(spark, sorted(days), n)
        got = self.ledger.read(spark, self.ledger.candidates(spark, rows, _day(F.col("event_time")), found))
        if got is None:
            return None
        if len(days) <= 64:      # ranges that reach the Parquet scan; with very many days the folders prune enough
            ranges = F.lit(False)
            for d, v in days.items():
                within = F.col("timestamp").between(F.lit(v["lo"]), F.lit(v["hi"])) if v["lo"] is not None else F.lit(False)
                ranges = ranges | ((F.col("event_day") == d) & (within | F.col("timestamp").isNull()))
            got = got.where(ranges)
        return got.select(*DEDUP_KEYS).distinct()

    def history(self, rows: DataFrame, days: list[int], n: int) -> DataFrame | None:
        """Cleaned rows of earlier batches that the means of the batch's missing values may use: by need, not by span.

        The rows to be filled name the (sensor, time bucket) pairs they reach; only days of such buckets are opened and only rows in them kept.
        """
        if not days:
            return None
        spark, width = rows.sparkSession, int(round(self.width_seconds * 1_000_000))
        order = [c for c in ("partition", self.order) if c in rows.columns]
        kinds = dict(rows.dtypes)
        schema = ", ".join(["sensor_id string, event_time timestamp, temperature double, temp_corrected boolean",
                            *[f"`{c}` {kinds[c]}" for c in order], "event_day int, batch_id long"])
        past = spark.read.schema(schema).option("basePath", self.cleaned_path).parquet(
            *[f"{self.cleaned_path}/event_day={d}" for d in days]).where(F.col("batch_id") < n)
        if not self.feedback:
            past = past.where(~F.col("temp_corrected"))      # observed readings only, never earlier fills
        t = "unix_micros(event_time)"
        bucket = f"({{}} - pmod({{}}, {width})) div {width}"
        wanted = rows.where("event_time IS NOT NULL AND temperature IS NULL").selectExpr(
            "sensor_id AS _s", f"explode(sequence({bucket.format(f'({t} - {width})', f'({t} - {width})')}, {bucket.format(t, t)})) AS _w").distinct()
        past = past.selectExpr("sensor_id", "event_time", "temperature", *[f"`{c}`" for c in order], f"{bucket.format(t, t)} AS _p")
        return past.join(wanted, F.col("sensor_id").eqNullSafe(F.col("_s")) & (F.col("_p") == F.col("_w")), "left_semi").drop("_p")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, began, n = batch.sparkSession, time.monotonic(), int(batch_id)
        rows = batch.withColumn("batch_id", F.lit(n).cast("long"))
        running = self._running_max(spark, n)
        sensors, statuses = sensor_state(self.root), status_state(self.root)
        touched = self.touched(rows, self.ledger.days(spark), numbered(spark, self.cleaned_path, "event_day")) if n else {}

        # dedup: in-batch first arrival, then not seen in any earlier batch
        flagged = first_flags(rows, DEDUP_KEYS, self.order, "is_first")
        seen = self.seen(rows, {d: v for (kind, d), v in touched.items() if not kind}, n)
        if seen is not None:
            seen = seen.select(*[F.col(k).alias(f"_seen_{k}") for k in DEDUP_KEYS]).withColumn("_seen", F.lit(True))
            cond = [F.col(k).eqNullSafe(F.col(f"_seen_{k}")) for k in DEDUP_KEYS]
            flagged = flagged.join(seen, cond, "left").withColumn("is_first", F.expr("is_first AND _seen IS NULL")).select(*flagged.columns)

        # imputation over the batch plus the history rows of the cleaned table
        current = flagged.withColumn("_hist", F.lit(False))
        past = self.history(rows, [d for kind, d in touched if kind], n)
        if past is not None:
            current = current.unionByName(past.select(
                *[(F.col(c) if c in past.columns else F.lit(None)).cast(current.schema[c].dataType).alias(c) for c in flagged.columns],
                F.lit(True).alias("_hist")))
        filled = fill(current, self.width_seconds, self.order, feedback=self.feedback, history="_hist")
        filled = filled.where(~F.col("_hist")).drop("_hist", "raw_temperature", "imputed")

        # late class against the greatest event time of earlier batches, then one write that also counts
        delay, late_class = late_sql("event_time", "_prev")
        before = F.timestamp_micros(F.lit(running).cast("long"))
        classed = filled.withColumn("_prev", before).selectExpr("*", f"{delay} AS delay_s", f"{late_class} AS late_class").drop("_prev")
        kept = F.col("outcome") == KEPT
        counts = Observation(f"batch-{n}")
        folder = scratch_dir(spark, "batch")
        classed.observe(
            counts, F.count(F.lit(1)).alias("raw_rows"), *outcome_counts(),
            F.count_if(kept & (F.col("late_class") == LATE_ACCEPTED)).alias("late_accepted"),
            F.count_if(kept & (F.col("late_class") == TOO_LATE)).alias("too_late"),
            F.max(F.when(kept, F.unix_micros("event_time"))).alias("newest")).write.parquet(folder)
        seen_counts = counts.get
        annotated = spark.read.schema(classed.schema).parquet(folder)
        good = annotated.where(kept)
        if self.drop_too_late:
            good = good.where(F.col("late_class") != TOO_LATE)
            seen_counts["cleaned_rows"] -= seen_counts["too_late"]

        def write_cleaned() -> None:
            columns = [*CLEAN_COLUMNS, *(["partition"] if "partition" in annotated.columns else [])]
            replace_partitions(add_time_features(good).select(*columns).withColumn("event_day", _day(F.col("event_time"))).hint("rebalance", "event_day"),
                               self.cleaned_path, "event_day", "batch_id")

        def write_ledger() -> None:
            self.ledger.add(annotated.where(F.col("is_first")).select(*DEDUP_KEYS, _day(F.col("event_time")).alias("event_day")), n)

        def write_sensors() -> None:
            sensors.compact(spark, n)
            delta = good.groupBy("sensor_id").agg(F.sum("temperature").alias("total"), F.count(F.lit(1)).alias("readings"),
                                                  F.max("temperature").alias("max_temperature"), F.max("event_time").alias("last_event_time"))
            sensors.write(merged(sensors, delta, n, {"total": "sum", "readings": "sum", "max_temperature": "max", "last_event_time": "max"}), n)

        def write_statuses() -> None:
            statuses.compact(spark, n)
            statuses.write(merged(statuses, good.groupBy("status").agg(F.count(F.lit(1)).alias("n")), n, {"n": "sum"}), n)

        if seen_counts["raw_rows"]:
            with ThreadPoolExecutor(4) as pool:     # independent folders: the jobs share the cluster
                for done in [pool.submit(f) for f in (write_cleaned, write_ledger, write_sensors, write_statuses)]:
                    done.result()
        self._write_log(spark, seen_counts, n, running, began)
        remove_folder(spark, folder)

    def _running_max(self, spark: SparkSession, n: int) -> int | None:
        """Greatest kept event time (microseconds) of batches before n: one value, from the log row of the batch before."""
        before = f"{self.log_path}/batch_id={n - 1}"
        if n and exists(spark, before):
            return spark.read.schema("running_max timestamp").parquet(before).select(F.unix_micros("running_max")).first()[0]
        return None

    def _write_log(self, spark: SparkSession, counts: dict, n: int, running: int | None, began: float) -> None:
        newest = max((x for x in (counts["newest"], running) if x is not None), default=None)
        row = [*[int(counts[c]) for c in COUNTERS], counts["newest"], newest, int(1000 * (time.monotonic() - began)), n]
        raw = spark.createDataFrame([row], LOG_SCHEMA.replace(" timestamp", " long"))
        times = {c: F.timestamp_micros(c) for c in ("max_event_time", "running_max")}
        replace_partitions(raw.withColumns(times).coalesce(1), self.log_path, "batch_id")


def start_clean_stream(parsed_stream: DataFrame, root: str, checkpoint: str, name: str = "cleaning_query",
                       processing_time: str | None = None, width_seconds: float = HISTORY_SECONDS, **options) -> StreamingQuery:
    """Start the cleaning stream; its tables live under ``root``; ``options`` are ``CleanStream`` fields."""
    sink = SinkSpec(name=name, checkpoint=checkpoint, mode="append", format="foreachBatch",
                    processing_time=processing_time)
    return start(parsed_stream, sink, CleanStream(root, width_seconds, **options))


def committed(spark: SparkSession, root: str) -> DataFrame:
    """The batch log: one row a batch, written when everything else of the batch is."""
    path = f"{root}/batch_log"
    return spark.read.schema(LOG_SCHEMA).parquet(path) if exists(spark, path) else spark.createDataFrame([], LOG_SCHEMA)


def cleaned_table(spark: SparkSession, root: str) -> DataFrame:
    """Cleaned rows of committed batches; what a failed batch left behind is not seen."""
    rows = spark.read.parquet(f"{root}/cleaned")
    return rows.join(committed(spark, root).select("batch_id"), "batch_id", "left_semi").select(*CLEAN_COLUMNS)


def batch_log_table(spark: SparkSession, root: str) -> DataFrame:
    """Per-batch counters with running totals (blocked prefix sums over batch ids)."""
    log = committed(spark, root).drop("running_max", "duration_ms")
    counters = ["missing_corrected", "duplicates_removed", "invalid_removed", "dropped_insufficient_history",
                "late_accepted"]
    return inclusive_prefix(log, "batch_id", {c: "sum" for c in counters}, prefix="total_")


def batch_durations(spark: SparkSession, root: str) -> DataFrame:
    """(batch_id, duration_ms): how long each batch's cleaning took, empty batches included."""
    return committed(spark, root).select("batch_id", "duration_ms")


def _as_of_batches(spark: SparkSession, root: str, state: UpsertLog) -> DataFrame:
    """The state of every key after every committed batch: a row of batch b holds until the key's next one."""
    log = committed(spark, root)
    last = log.agg(F.max("batch_id")).scalar()
    key = ", ".join(f"`{k}`" for k in state.keys)
    rows = state.changes(spark).join(log.select("batch_id"), "batch_id", "left_semi")
    until = rows.withColumn("_last", last).selectExpr("*", f"coalesce(lead(batch_id) OVER (PARTITION BY {key} ORDER BY batch_id) - 1, _last) AS _until")
    held = until.selectExpr(*[f"`{c}`" for c in state.columns], "explode(sequence(batch_id, _until)) AS batch_id")
    return held.join(log.select("batch_id", "running_max"), "batch_id")


def sensor_snapshots(spark: SparkSession, root: str, within_seconds: float = HISTORY_SECONDS) -> DataFrame:
    """Running statistics after every batch: batch_id, sensor_id, average, maximum, readings, last_event_time, active.

    A sensor is active when its newest reading is within ``within_seconds`` of the newest of all.
    """
    late_by = "(unix_micros(running_max) - unix_micros(last_event_time)) / 1e6"
    return _as_of_batches(spark, root, sensor_state(root)).selectExpr(
        "batch_id", "sensor_id", "total / readings AS avg_temperature", "max_temperature", "readings", "last_event_time",
        f"{late_by} <= {float(within_seconds)!r} AS active")


def status_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Running status distribution after every batch: batch_id, status, n."""
    return _as_of_batches(spark, root, status_state(root)).select("batch_id", "status", "n")


def active_report(snapshots: DataFrame) -> DataFrame:
    """One row a batch: number of active sensors and their sorted list (as long as there are active sensors)."""
    active = F.expr("sort_array(collect_list(CASE WHEN active THEN coalesce(sensor_id, '') END))")
    return snapshots.groupBy("batch_id").agg(F.count_if("active").alias("n_active"), active.alias("active_sensors"))

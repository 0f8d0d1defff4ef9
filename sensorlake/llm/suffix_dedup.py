"""Removal of byte strings of ``length`` that start more than once in the corpus, by suffix arrays of shards.

1. Every window of ``length`` bytes has an anchor: the least hash of its grams of
   ``gram`` bytes, the first one at ties. Equal windows have equal anchors, so windows can be compared anchor by
   anchor. Windows that share an anchor in place form a segment (their bytes
   overlap); its row has the anchor's hash, a hash of its bytes, and its places in the text.
2. Anchors that occur once in the corpus are dropped by a count. Equal segments
   are one string with a weight, however many copies there are. An anchor with one string only needs no sorting.
3. The strings of the other anchors are dealt by anchor into shards and suffix-sorted
   by external induced sorting (see ``induced``); suffixes with ``length`` bytes in common are
   one group, repeated if its strings' weights add up to two or more.
4. Repeated windows go back to the texts, whose covered bytes are removed.

Shards stay near ``shard_bytes``. An anchor whose strings exceed ``anchor_bytes`` (very many
texts that differ around one place) would not fit a shard: its windows are counted by their
content, one row each. Queues beyond ``queue_entries`` go to files in the shared folder.

Rows: a null or empty text has no bytes; texts shorter than ``length`` lose nothing;
equal rows are separate documents, so each loses what it shares with the other; null and
repeated doc_ids are allowed (rows are told apart by doc_id and text); an empty table
gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.induced import sorted_runs
from sensorlake.llm.tables import stored
from sensorlake.llm.text import BASE, mix, powers, slices, utf8
from sensorlake.session import scratch_dir

PLACE_BITS = 28  # a slice has fewer bytes than 2**28
PLACE = np.uint64((1 << PLACE_BITS) - 1)


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """min of x[i: i + width] for every i that has a whole window."""
    n = len(x)
    pad = -n % width
    blocks = np.concatenate((x, np.full(pad, np.uint64(0xFFFFFFFFFFFFFFFF)))).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)[:n]
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)[:n]
    return np.minimum(back[: n - width + 1], ahead[width - 1:])


def segments(b: np.ndarray, starts: np.ndarray, length: int, gram: int):
    """(row, first window, windows, anchor hash, string hash) of the texts that begin at ``starts`` (and an end) in ``b``."""
    none = np.zeros(0, np.int64)
    if len(b) < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    h, size = mix(b.astype(np.uint64) + np.uint64(1)), 1  # a random value for each byte, then doubled grams
    base = BASE
    while size < gram:
        h = h[:-size] * base + h[size:]
        base = np.uint64(int(base) ** 2 % (1 << 64))
        size *= 2
    h = mix(h)
    least = sliding_least((h >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    anchor = (least & PLACE).astype(np.int64)
    row = np.searchsorted(starts, np.arange(len(anchor)), "right") - 1
    ok = np.arange(len(anchor)) + length <= starts[row + 1]  # the window lies in one text
    first = ok.copy()
    first[1:] &= ~ok[:-1] | (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    f = np.flatnonzero(first)
    if not len(f):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    n = np.add.reduceat(ok.astype(np.int64), f)
    up, down = powers(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(mix(b.astype(np.uint64) + np.uint64(0xABCD)) * up[:-1], out=total[1:])
    string = mix((total[f + n - 1 + length] - total[f]) * down[f] + n.astype(np.uint64))
    return row[f], f, n, h[anchor[f]], string


def _segment_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = utf8(b.column(1))
            rid, out = b.column(0).to_numpy(zero_copy_only=False), []
            for i, j in slices(at):
                lo = int(at[i])
                row, f, n, anchor, string = segments(data[lo: int(at[j])], at[i: j + 1] - lo, length, gram)
                # a text that repeats itself has a segment many times: one row with all its places
                by = np.lexsort((f, string, row))
                row, f, n, anchor, string = row[by], f[by], n[by], anchor[by], string[by]
                first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (string[1:] != string[:-1]) | (anchor[1:] != anchor[:-1])))) if len(f) else f
                times = np.diff(np.append(first, len(f)))
                out.append((rid[row + i][first], (f - (at[row + i] - lo)).astype(np.int32), n[first], anchor[first], string[first], times))
            if not out:
                continue
            ids, places, n, anchor, string, times = (np.concatenate([x[c] for x in out]) for c in range(6))
            offsets = pa.array(np.concatenate(([0], np.cumsum(times))).astype(np.int32))
            yield pa.record_batch([pa.array(ids.astype(np.int64)), pa.ListArray.from_arrays(offsets, pa.array(places)), pa.array(n.astype(np.int32)),
                                   pa.array(anchor.view(np.int64)), pa.array(string.view(np.int64))], names=["rid", "f", "n", "anchor", "string"])

    return docs.select("rid", "text").mapInArrow(run, "rid long, f array<int>, n int, anchor long, string long")


def repeated_windows(parts: list[bytes], weights: np.ndarray, length: int, folder: str | None = None,
                     queue_entries: int = 1 << 22) -> list[np.ndarray]:
    """For each part the starts of its ``length``-byte strings whose occurrences, weighted, are two or more."""
    begin = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts])))
    found: list[np.ndarray] = []
    open_: list[np.ndarray] = []  # the group that the next run may continue

    def close(groups: np.ndarray, cut: np.ndarray) -> None:
        part = np.searchsorted(begin, groups, "right") - 1
        weight = np.add.reduceat(weights[part], cut)
        keep = np.repeat(weight >= 2, np.diff(np.append(cut, len(groups))))
        found.append(groups[keep])

    for at, low in sorted_runs(parts, length, folder, queue_entries):
        joined = low >= length
        cut = np.flatnonzero(~joined)
        if not len(cut):
            open_.append(at)
            continue
        if open_:
            whole = np.concatenate([*open_, at[: cut[0]]])
            close(whole, np.array([0]))
        rest = at[cut[0]: cut[-1]]
        if len(rest):
            close(rest, cut[:-1] - cut[0])
        open_ = [at[cut[-1]:]]
    if open_:
        close(np.concatenate(open_), np.array([0]))
    hits = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
    # a group of one suffix of weight two may be shorter than a window: only whole windows count
    part = np.searchsorted(begin, hits, "right") - 1
    inside = hits + length <= begin[part + 1] - 1
    hits, part = hits[inside], part[inside]
    edge = np.searchsorted(part, np.arange(len(parts) + 1))
    return [hits[edge[k]: edge[k + 1]] - begin[k] for k in range(len(parts))]


def _count_windows(strings: DataFrame, length: int) -> DataFrame:
    """(anchor, string, runs) for anchors with very many strings: every window is a row (128-bit hash of its bytes, weight),
    so that no task holds the strings of an anchor; windows whose weights add up to two or more are repeated."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 512):
                some = b.slice(i, 512)
                out = [(k, j, hashlib.blake2b(part[j: j + length], digest_size=16).digest())
                       for k, part in enumerate(some.column(3).to_pylist()) for j in range(len(part) - length + 1)]
                row = pa.array([x[0] for x in out], pa.int64())
                yield pa.record_batch([*[some.column(c).take(row) for c in range(3)], pa.array([x[1] for x in out], pa.int32()),
                                       pa.array([x[2] for x in out], pa.binary())], names=["anchor", "string", "weight", "at", "w"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), b.column(1), pa.array([_as_runs(np.array(x)) for x in b.column(2).to_pylist()], pa.binary())],
                                  names=["anchor", "string", "runs"])

    rows = stored(strings.select("anchor", "string", "weight", "part").mapInArrow(
        windows, "anchor long, string long, weight long, at int, w binary"), "windows")
    again = rows.groupBy("w").agg(F.sum("weight").alias("total")).filter("total > 1").select("w")
    return rows.join(again, "w").groupBy("anchor", "string").agg(F.sort_array(F.collect_list("at")).alias("at")).mapInArrow(
        runs, "anchor long, string long, runs binary")


def _as_runs(starts: np.ndarray) -> bytes:
    """Ascending starts as (start, count) pairs of 16-bit numbers."""
    if not len(starts):
        return b""
    first = np.flatnonzero(np.concatenate(([True], np.diff(starts) != 1)))
    return np.stack((starts[first], np.diff(np.append(first, len(starts)))), axis=1).astype("<u2").tobytes()


def remove_repeats(docs: DataFrame, length: int = 200, gram: int = 64, shard_bytes: int = 1 << 20,
                   anchor_bytes: int = 16 << 20, queue_entries: int = 1 << 22, with_kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256; ``with_kept`` adds the kept bytes."""
    if gram & (gram - 1) or not gram < length < 1 << 15:
        raise ValueError("gram must be a power of two below length, length below 32768")
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn(
        "rid", F.xxhash64("doc_id", "text"))
    rows = stored(_segment_rows(docs.filter("text IS NOT NULL"), length, gram), "segments")
    often = rows.groupBy("anchor").agg(F.sum(F.size("f")).alias("total")).filter("total > 1").select("anchor")
    rows = stored(rows.join(often, "anchor"), "repeated")
    strings = rows.groupBy("anchor", "string", "n").agg(F.sum(F.size("f")).alias("weight"), F.min(F.struct("rid", F.expr("f[0] AS f"))).alias("at"))
    variants = strings.groupBy("anchor").agg(F.count(F.lit(1)).alias("variants"))
    strings = stored(strings.join(variants, "anchor"), "strings")
    # bytes of the strings to sort, from one text that has each
    many = strings.filter("variants > 1")
    wanted = many.groupBy("at.rid").agg(F.collect_list(F.struct("anchor", "string", "weight", "at.f", "n")).alias("w"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = utf8(b.column(0))
            lists = b.column(1)
            of = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            w = lists.flatten()
            f, n = w.field("f").to_numpy(), w.field("n").to_numpy()
            begin = at[of] + f
            parts = [data[x:y].tobytes() for x, y in zip(begin, begin + n - 1 + length, strict=True)]
            yield pa.record_batch([w.field("anchor"), w.field("string"), w.field("weight"), pa.array(parts, pa.binary())],
                                  names=["anchor", "string", "weight", "part"])

    # equal rows give a string twice: one is enough
    texts = docs.select("rid", "text").join(wanted.hint("shuffle_hash"), "rid").select("text", "w").mapInArrow(
        cut, "anchor long, string long, weight long, part binary").groupBy("anchor", "string", "weight").agg(F.any_value("part").alias("part"))
    # anchors whose strings are too many for a shard: their windows are counted by content instead
    hot = stored(many.groupBy("anchor").agg(F.sum(F.col("n") + length).alias("b")).filter(f"b > {int(anchor_bytes)}").select("anchor"), "hot")
    crowded = None
    if not hot.isEmpty():
        texts = stored(texts, "texts")
        crowded = _count_windows(texts.join(hot, "anchor", "left_semi"), length)
        texts = texts.join(hot, "anchor", "left_anti")
    folder = scratch_dir(spark, "induced")
    size = many.agg(F.coalesce(F.sum(F.col("n") + length), F.lit(0))).first()[0]
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_bytes))

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = [b for b in batches if b.num_rows]
        if not shard:
            return
        table = pa.Table.from_batches(shard).combine_chunks()
        found = repeated_windows(table.column("part").to_pylist(), table.column("weight").to_numpy(), length, folder, queue_entries)
        yield pa.table({"anchor": table.column("anchor"), "string": table.column("string"),
                        "runs": pa.array([_as_runs(x) for x in found], pa.binary())}).combine_chunks().to_batches()[0]

    sorted_ = texts.repartition(shards, "anchor").mapInArrow(sort, "anchor long, string long, runs binary")
    whole = strings.filter("variants = 1 AND weight > 1").select("anchor", "string", F.lit(None).cast("binary").alias("runs"))
    if crowded is not None:
        whole = whole.unionAll(crowded)
    verdicts = stored(sorted_.filter("octet_length(runs) > 0").unionAll(whole), "verdicts")
    hits = rows.join(verdicts, ["anchor", "string"]).select("rid", "f", "n", "runs").distinct()
    per_row = hits.groupBy("rid").agg(F.collect_list(F.struct("f", "n", "runs")).alias("hits"))

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = utf8(b.column(1))
            lists = b.column(2)
            offsets, w = lists.offsets.to_numpy(), lists.values
            f, n, runs = w.field("f"), w.field("n").to_numpy(), w.field("runs")
            places, at_places = f.values.to_numpy(), f.offsets.to_numpy()
            times, whole = np.diff(at_places), runs.is_null().to_numpy(zero_copy_only=False)
            out = []
            for k in range(b.num_rows):
                text = data[at[k]: at[k + 1]]
                edge = np.zeros(len(text) + 1, np.int32)
                lo, hi = (int(offsets[k]), int(offsets[k + 1])) if lists[k].is_valid else (0, 0)
                if lo < hi:
                    all_of = np.repeat(whole[lo:hi], times[lo:hi])
                    starts = places[at_places[lo]: at_places[hi]][all_of]
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + np.repeat(n[lo:hi], times[lo:hi])[all_of] - 1 + length, -1)
                for x in lo + np.flatnonzero(~whole[lo:hi]):
                    starts = places[at_places[x]: at_places[x + 1]]
                    for s, m in np.frombuffer(runs[int(x)].as_py(), "<u2").reshape(-1, 2).astype(int):
                        np.add.at(edge, starts + s, 1)
                        np.add.at(edge, starts + (s + m - 1 + length), -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = text[~gone].tobytes()
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
                out.append((len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
            cols = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string()),
                                              *([pa.array(cols[4], pa.binary())] if with_kept else [])],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_kept else [])])

    return docs.join(per_row.hint("shuffle_hash"), "rid", "left").select("doc_id", "text", "hits").mapInArrow(
        drop, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_kept else ""))

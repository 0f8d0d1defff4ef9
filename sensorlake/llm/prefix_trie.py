"""Prefix trie of conversations: shared prefixes, their members, and the text that sharing saves.

Conversations are first rebuilt (the opening turns of a base conversation, then their own), and
every prefix becomes a pair of 64-bit polynomial hashes of its turns' md5 values. Turns are sorted once, by
range, and positions, prefix hashes and cumulated bytes run inside each range; a conversation that spans
ranges is continued from a table of range totals. The rest works on these hashes, the texts are not moved.

Nodes with the same members form a chain (one smallest member, one number of members), so the trie that
is left has at most two chains for each distinct conversation. It is cut into shards by members: band j holds the chains of
more than S R^(j-1) and up to S R^j members, a shard the chains of a band below one topmost chain. Each
shard is a balanced-parentheses sequence: findclose over range min-max blocks delimits a subtree, ranks of leaf pairs
count its leaves, a cumulative array over opening order gives its savings. The chains above, shared by
the shards, are the shards of the next band, where all shards that hang on one chain are merged to one
weighted leaf below it.

Defined results: turns are ordered by turn (null first), equal ones by the md5 of role length, role and text, so
repeated rows are repeated turns. A null role or text is empty. Rows without conv_id belong to no conversation. An empty table
gives no nodes. A very long conversation, or one with very many turns, is spread over ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.parens import Parentheses, forest
from sensorlake.llm.tables import key_groups, spread_join, stored

SHARD = 2048            # members of the largest subtree of the first band
RATIO = 16              # growth of that bound from band to band
PIECE = 1000            # ids joined to one piece of text before they are digested
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03))     # odd
TURNS_TAKEN = 9         # a conversation opens with 0 to 8 turns of its base
GROUP = 5               # conversations a base opens

KEYS = ("k1", "k2")


def power(base: np.uint64, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo 2**64 (negative exponents: of the inverse)."""
    out, e = np.ones(len(exponents), np.uint64), np.abs(exponents).astype(np.uint64)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    b = np.where(exponents < 0, inverse, base)
    while e.any():
        odd = (e & np.uint64(1)).astype(bool)
        out[odd] *= b[odd]
        b, e = b * b, e >> np.uint64(1)
    return out


def _u(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)


def _i(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(a.astype(np.uint64, copy=False).view(np.int64))


# --- positions and prefix hashes of the given conversations --------------------------------------

RUN = "conv_id long, part long, i long, a1 long, a2 long, b1 long, b2 long, bytes long, run_bytes long"


def ranged_turns(conversations: DataFrame) -> DataFrame:
    """Each turn in its range: number i, hashes through it (a) and before it (b), bytes so far, all from the range's start of that conversation."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).filter("conv_id IS NOT NULL")
    turns = rows.selectExpr("conv_id", "turn", "unhex(md5(concat(CAST(octet_length(role) AS STRING), ':', role, text))) AS h",
                            "CAST(octet_length(text) AS LONG) AS bytes", "monotonically_increasing_id() AS at")
    order = ["conv_id", "turn", "h", "at"]      # the last one only splits equal turns over ranges

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, carry = TaskContext.get().partitionId(), None, np.zeros(4, np.uint64)     # turns, two hashes, bytes
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            conv, size = _i(b, "conv_id"), _u(b, "bytes")
            h = np.frombuffer(b"".join(b.column(2).to_pylist()), ">u8").astype(np.uint64).reshape(n, 2)
            begins = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
            segment = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, n)))
            if conv[0] != last:
                carry = np.zeros(4, np.uint64)
            start = np.zeros((len(begins), 4), np.uint64)
            start[0] = carry
            i = (np.arange(n) - begins[segment] + 1).astype(np.uint64) + start[segment, 0]

            def running(x: np.ndarray, k: int, begins=begins, segment=segment, start=start) -> np.ndarray:
                total = np.cumsum(x, dtype=np.uint64)
                return total - (total[begins] - x[begins])[segment] + start[segment, k]

            terms = [h[:, k] * power(BASES[k], i.astype(np.int64)) for k in (0, 1)]
            a1, a2, so_far = running(terms[0], 1), running(terms[1], 2), running(size, 3)
            last, carry = conv[-1], np.array([i[-1], a1[-1], a2[-1], so_far[-1]], np.uint64)
            yield pa.record_batch([pa.array(conv), pa.array(np.full(n, part)), _long(i), _long(a1), _long(a2), _long(a1 - terms[0]),
                                   _long(a2 - terms[1]), _long(size), _long(so_far)], names=[c.split()[0] for c in RUN.split(", ")])

    return turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "h", "bytes").mapInArrow(run, RUN)


def run_totals(turns: DataFrame) -> DataFrame:
    """(conv_id, part) with what comes before the range (o turns, p1, p2, ob bytes) and after it (n, t1, t2, nb)."""
    runs = turns.groupBy("conv_id", "part").agg(F.max("i").alias("i"), F.max_by("a1", "i").alias("a1"), F.max_by("a2", "i").alias("a2"),
                                                F.max("run_bytes").alias("run_bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carry = None, [0, 0, 0, 0]
        for b in batches:
            out = []
            for conv, part, i, a1, a2, size in zip(*[b.column(k).to_pylist() for k in range(6)], strict=True):
                if conv != last:
                    last, carry = conv, [0, 0, 0, 0]
                mask = (1 << 64) - 1
                after = [carry[0] + i, *[(carry[k + 1] + (a & mask) * pow(int(BASES[k]), carry[0], 1 << 64)) & mask for k, a in enumerate((a1, a2))], carry[3] + size]
                out.append((conv, part, *carry, *after))
                carry = after
            cols = list(zip(*out, strict=True)) if out else [()] * 10
            yield pa.record_batch([pa.array(np.array(c, np.uint64).view(np.int64)) if k > 1 else pa.array(c, pa.int64()) for k, c in enumerate(cols)],
                                  names=["conv_id", "part", "o", "p1", "p2", "ob", "n", "t1", "t2", "nb"])

    return runs.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(
        run, "conv_id long, part long, o long, p1 long, p2 long, ob long, n long, t1 long, t2 long, nb long")


def shifted(rows: DataFrame) -> DataFrame:
    """Prefixes continued after others: k = p + B^e a and its parent q = p + B^e b, for the columns e, p1, p2 of each row."""
    keep = [c for c in rows.columns if c not in ("a1", "a2", "b1", "b2", "p1", "p2", "e")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            e = _i(b, "e")
            out = []
            for name in ("a", "b"):
                out += [_long(_u(b, f"p{k + 1}") + power(BASES[k], e) * _u(b, f"{name}{k + 1}")) for k in (0, 1)]
            yield pa.record_batch([*[b.column(b.schema.get_field_index(c)) for c in keep], *out], names=[*keep, "k1", "k2", "q1", "q2"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join([*[f"{c} {kinds[c]}" for c in keep], "k1 long, k2 long, q1 long, q2 long"]))


def _minus(a: str, b: str) -> str:
    """SQL: a - b modulo 2**64."""
    return f"CAST(pmod(CAST({a} AS DECIMAL(38,0)) - {b} + 9223372036854775808BD, 18446744073709551616BD) - 9223372036854775808BD AS LONG)"


# --- rebuilt conversations ------------------------------------------------------------------------

def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(prefixes, ends): every prefix of every rebuilt conversation, the empty one included, and each one's whole."""
    turns = stored(ranged_turns(conversations), "turns")
    totals = stored(run_totals(turns), "totals")
    # a range's borders cut one conversation each, so at most one row a range is left here
    wide = totals.filter("o > 0")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("o", "p1", "p2", "ob")]
    placed = turns.join(F.broadcast(wide.select("conv_id", "part", "o", "p1", "p2", "ob")), ["conv_id", "part"], "left").select(
        "conv_id", "i", "a1", "a2", "b1", "b2", "bytes", "run_bytes", *zero).selectExpr(
        "conv_id", "i + o AS pos", "bytes", "run_bytes + ob AS so_far", "a1", "a2", "b1", "b2", "p1", "p2", "o AS e")
    own = stored(shifted(placed), "prefixes")                                   # conv_id, pos, bytes, so_far, k1, k2, q1, q2
    convs = totals.groupBy("conv_id").agg(F.max("n").alias("n"), F.max_by("t1", "n").alias("t1"), F.max_by("t2", "n").alias("t2")).selectExpr(
        "*", f"conv_id - conv_id % {GROUP} AS base", f"CAST(crc32(CAST(conv_id AS STRING)) % {TURNS_TAKEN} AS LONG) AS h")
    opening = own.filter(F.col("pos") < TURNS_TAKEN)
    # what each conversation other than a base takes over: its base's first turns, and what its own first turns add up to
    others = convs.filter("base != conv_id")
    heads = others.select("conv_id", "base", "h").join(opening.withColumnRenamed("conv_id", "base"), "base").filter("pos <= h")
    taken = heads.groupBy("conv_id").agg(F.max("pos").alias("k"), F.max_by("k1", "pos").alias("p1"), F.max_by("k2", "pos").alias("p2"),
                                         F.max("so_far").alias("p_bytes"))
    left_out = opening.select("conv_id", F.col("pos").alias("h"), F.col("k1").alias("d1"), F.col("k2").alias("d2"), F.col("so_far").alias("d_bytes"))
    names = ("k", "p1", "p2", "p_bytes", "d1", "d2", "d_bytes")
    carry = stored(others.join(taken, "conv_id", "left").join(left_out, ["conv_id", "h"], "left").select(
        "conv_id", "n", "h", "t1", "t2", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names]), "carry")
    # conversations that span ranges are few (one a border) but long: theirs is broadcast
    tails = spread_join(own.filter(f"conv_id % {GROUP} != 0 AND pos > crc32(CAST(conv_id AS STRING)) % {TURNS_TAKEN}"),
                        carry.join(wide.select("conv_id", F.lit(True).alias("is_wide")).distinct(), "conv_id", "left").fillna(False, ["is_wide"]),
                        ["conv_id"], F.col("is_wide"))
    less = [f"{_minus(x, d)} AS {y}" for x, d, y in (("k1", "d1", "a1"), ("k2", "d2", "a2"), ("q1", "d1", "b1"), ("q2", "d2", "b2"))]
    tails = shifted(tails.selectExpr("conv_id", "pos - h + k AS pos", "bytes", "so_far - d_bytes + p_bytes AS so_far", *less, "p1", "p2", "k - h AS e"))
    columns = ["conv_id", "pos", "bytes", "so_far", "k1", "k2", "q1", "q2"]
    root = convs.selectExpr("conv_id", *[f"0L AS {c}" for c in columns[1:]])
    prefixes = root.union(own.filter(f"conv_id % {GROUP} = 0").select(*columns)).union(heads.select(*columns)).union(tails.select(*columns))
    rest = shifted(carry.filter("n > h").selectExpr("conv_id", f"{_minus('t1', 'd1')} AS a1", f"{_minus('t2', 'd2')} AS a2", "0L AS b1", "0L AS b2",
                                                    "p1", "p2", "k - h AS e")).select("conv_id", *KEYS)
    ends = convs.filter("base = conv_id").selectExpr("conv_id", "t1 AS k1", "t2 AS k2").union(rest).union(
        carry.filter("n <= h").selectExpr("conv_id", "p1 AS k1", "p2 AS k2"))
    return stored(prefixes, "rebuilt"), ends


def end_digests(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256): SHA-256 of the ids that end at a node, ascending and comma-joined.

    Ids are sorted and joined to pieces in ranges, which split a node that very many share; the pieces of a
    node are then hashed one after another, of which a task holds one batch.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        for b in batches:
            out = []
            for k1, k2, c in zip(*[b.column(i).to_pylist() for i in range(3)], strict=True):
                if ids and ((k1, k2) != key or len(ids) == PIECE):
                    out.append((*key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = (k1, k2)
                ids.append(c)
            yield batch_of(out)
        yield batch_of([(*key, ids[0], ",".join(map(str, ids)))] if ids else [])

    def batch_of(rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) if rows else [()] * 4
        return pa.record_batch([*[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())], names=["k1", "k2", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for b in batches:
            out = []
            for k1, k2, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
                if (k1, k2) != key:
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (k1, k2), hashlib.sha256(ids.encode())
                else:
                    sha.update(("," + ids).encode())
            yield rows_of(out)
        yield rows_of([(*key, sha.hexdigest())] if key is not None else [])

    def rows_of(rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) if rows else [()] * 3
        return pa.record_batch([*[pa.array(c, pa.int64()) for c in cols[:2]], pa.array(cols[2], pa.string())], names=["k1", "k2", "ends_sha256"])

    order = [*KEYS, "conv_id"]
    joined = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pieces, "k1 long, k2 long, first long, ids string")
    return joined.repartition(*KEYS).sortWithinPartitions(*KEYS, "first").mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


# --- subtree sums ---------------------------------------------------------------------------------

def subtree_sums(table: pa.Table) -> pa.RecordBatch:
    """Leaves and savings below every chain of some shards (conv_id, n_convs, parent_id, parent_n, gain, more_leaves, more_saved)."""
    conv, n, parent, parent_n, gain, more, more_saved = (
        table.column(c).to_numpy() for c in ("conv_id", "n_convs", "parent_id", "parent_n", "gain", "more_leaves", "more_saved"))
    rows = len(conv)
    order = np.lexsort((n, conv))
    want = np.rec.fromarrays([parent, parent_n], names="a,b")
    have = np.rec.fromarrays([conv[order], n[order]], names="a,b")
    at = np.minimum(np.searchsorted(have, want), rows - 1)
    up = np.where(have[at] == want, order[at], -1)
    stubs = np.flatnonzero(more > 0)                         # one more leaf below a chain: all merged shards that hang on it
    bits, opened = forest(np.concatenate((up, stubs)))
    tree, starts = Parentheses(bits), np.flatnonzero(bits)
    stops = tree.find_close(starts)
    leaf = np.concatenate((np.ones(rows, np.int64), more[stubs]))[opened]
    saved = np.concatenate((gain, more_saved[stubs]))[opened]
    is_leaf = stops == starts + 1
    by_pair = np.concatenate(([0], np.cumsum(leaf[is_leaf])))                # weights of leaf pairs in order
    by_open = np.concatenate(([0], np.cumsum(saved)))
    leaves = by_pair[tree.pairs[stops]] - by_pair[tree.pairs[starts]]
    total = by_open[tree.opens[stops]] - by_open[tree.opens[starts]]
    own = opened < rows
    out_leaves, out_saved = np.empty(rows, np.int64), np.empty(rows, np.int64)
    out_leaves[opened[own]], out_saved[opened[own]] = leaves[own], total[own]
    return pa.record_batch([pa.array(conv), pa.array(n), pa.array(parent), pa.array(parent_n), pa.array(up < 0), pa.array(out_leaves), pa.array(out_saved)],
                           names=["conv_id", "n_convs", "parent_id", "parent_n", "is_top", "n_leaves", "saved"])


def chain_sums(chains: DataFrame, members: DataFrame, bounds: list[int]) -> DataFrame:
    """(conv_id, n_convs, n_leaves, saved) of all chains, band by band; ``members``: (conv_id, band, root_id, root_n)."""
    kinds = "conv_id long, n_convs long, parent_id long, parent_n long, is_top boolean, n_leaves long, saved long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in key_groups(batches, "shard"):
            yield subtree_sums(table)

    done = None
    for band in range(len(bounds)):
        mine = chains.filter(F.col("band") == band).join(members.filter(F.col("band") == band).drop("band"), "conv_id")
        if done is None:
            mine = mine.withColumns({"more_leaves": F.lit(0), "more_saved": F.lit(0)})
        else:
            hang = done.filter("is_top").groupBy(F.col("parent_id").alias("conv_id"), F.col("parent_n").alias("n_convs")).agg(
                F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
            mine = mine.join(hang, ["conv_id", "n_convs"], "left").fillna(0, ["more_leaves", "more_saved"])
        dealt = mine.selectExpr("xxhash64(root_id, root_n) AS shard", "conv_id", "n_convs", "coalesce(parent_id, 0L) AS parent_id",
                                "coalesce(parent_n, -1L) AS parent_n", "gain", "CAST(more_leaves AS LONG) AS more_leaves", "CAST(more_saved AS LONG) AS more_saved")
        sums = stored(dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, kinds), "sums")
        done = sums if done is None else done.unionAll(sums)
    return done.select("conv_id", "n_convs", "n_leaves", "saved")


def _band(bounds: list[int]) -> Column:
    expr = F.lit(len(bounds) - 1)
    for i in range(len(bounds) - 2, -1, -1):
        expr = F.when(F.col("n_convs") <= bounds[i], i).otherwise(expr)
    return expr


def prefix_trie(conversations: DataFrame, shard: int = SHARD, ratio: int = RATIO) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    prefixes, ends = rebuilt(conversations)
    nodes = stored(prefixes.groupBy(*KEYS).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("pos").alias("depth"), F.max("q1").alias("q1"), F.max("q2").alias("q2"),
        F.max("bytes").alias("bytes"), F.max("so_far").alias("so_far")), "nodes")
    total, n_nodes = nodes.agg(F.max("n_convs"), F.count(F.lit(1))).first()
    total = total or 0
    # a parent of very many nodes, or a node of very many members, is one row of a broadcast table of at most 1,000 a depth
    hot = F.col("n_convs") > max(1000, total // 1000)
    above = nodes.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_id"), F.col("n_convs").alias("parent_n"))
    linked = stored(spread_join(nodes.filter("depth > 0"), above, ["q1", "q2"], F.col("parent_n") > max(1000, total // 1000)).select(
        *KEYS, "conv_id", "n_convs", "depth", "bytes", "so_far", "parent_id", "parent_n").unionByName(
        nodes.filter("depth = 0").select(*KEYS, "conv_id", "n_convs", "depth", "bytes", "so_far", F.lit(None).cast("long").alias("parent_id"),
                                         F.lit(None).cast("long").alias("parent_n"))), "linked")
    bounds = [shard]
    while bounds[-1] < total:
        bounds.append(bounds[-1] * ratio)
    first = F.expr("parent_id IS NULL OR parent_id != conv_id OR parent_n != n_convs")
    chains = linked.withColumn("first", first).groupBy("conv_id", "n_convs").agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.max("so_far").alias("end_bytes"), F.min(F.expr("so_far - bytes")).alias("start_bytes"),
        F.max(F.expr("CASE WHEN first THEN parent_id END")).alias("parent_id"), F.max(F.expr("CASE WHEN first THEN parent_n END")).alias("parent_n"))
    chains = stored(chains.selectExpr("*", "(n_convs - 1) * (end_bytes - start_bytes) AS gain").withColumn("band", _band(bounds)), "chains")
    # on the path of a conversation, the chain with the most members of a band is the top of its shard there
    tops = linked.filter(first).select(*KEYS, F.col("conv_id").alias("chain_id"), "n_convs")
    members = stored(spread_join(prefixes.select("conv_id", *KEYS), tops, list(KEYS), hot).withColumn("band", _band(bounds)).groupBy("conv_id", "band").agg(
        F.min("chain_id").alias("root_id"), F.max("n_convs").alias("root_n")), "members")
    sums = chain_sums(chains, members, bounds)
    children = chains.filter("parent_id IS NOT NULL").groupBy(F.col("parent_id").alias("conv_id"), F.col("parent_n").alias("n_convs")).agg(
        F.count(F.lit(1)).alias("n_children"))
    whole = stored(chains.select("conv_id", "n_convs", "top", "bottom", "start_bytes").join(sums, ["conv_id", "n_convs"]).join(
        children, ["conv_id", "n_convs"], "left").fillna(0, ["n_children"]), "whole")
    rows = spread_join(linked, whole, ["conv_id", "n_convs"], F.expr(f"bottom - top > {max(1000, n_nodes // 1000)}"))
    nothing = hashlib.sha256(b"").hexdigest()
    return rows.join(end_digests(ends), list(KEYS), "left").selectExpr(
        "conv_id", "depth", "parent_id AS parent_conv_id", "n_convs", "CASE WHEN depth < bottom THEN 1L ELSE n_children END AS n_children", "n_leaves",
        "saved - (n_convs - 1) * (so_far - bytes - start_bytes) AS saved_tokens", f"coalesce(ends_sha256, '{nothing}') AS ends_sha256")

"""Near-duplicate documents by a chosen-path set similarity join on word shingles.

1. Each text becomes its set of distinct k-word shingles (64-bit hashes), a
   128-bit set key and a 64-coordinate minwise signature. Equal sets are one
   vertex from here on, so copies cost one row each, however many there are.
2. ``trees`` independent trees branch the vertices: a node picks coordinates of the signature by its own hash, and
   a vertex goes to the children named by its minwise tokens there. A root picks ``picks`` coordinates, every
   further node one, and half of them a second: texts alike but below the threshold thin out from level to level.
   Nodes of one vertex end. A node of up to ``task_vertices`` vertices goes on inside one task, down to nodes of up to ``leaf``
   vertices, which are compared exhaustively on signatures; a node whose vertices are in one component already ends. Only larger
   nodes branch on Spark, unless half of their vertices are alike to the first: such a dense node is linked to its first
   vertex as a whole (a superset of its similar pairs, one link per vertex). Branching ends by size; a node still large at ``depth`` is linked as a whole too.
   A pair of similarity s is lost by a tree with q = ((1-s) + s*r)**picks, where r = (i + i*i) / 2, i = (1-s) + s*r
   for any number of further levels: 0.04 at 0.8 and two picks if roots end at leaves, 0.25 at most; all trees lose it with q**trees.
3. The connected components of those candidate links are closed sets that
   hold every similar pair. Each is confirmed on full shingle sets: components that fit one task
   in one pass, larger ones against their most typical vertex first, then the rest
   in pairs of blocks. Only vertices not linked to that vertex meet the others.
4. Confirmed links give the final components.

Rows: null or empty text and text of white space only have the empty set: they
link with nothing. Equal rows and repeated doc_ids are separate documents of one
vertex; a null doc_id counts for no smallest id, but its text links like any other.
An empty table gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.graph import components
from sensorlake.llm.tables import Union, key_groups, matrix, stored
from sensorlake.llm.text import mix, shingles, slices, utf8, words

COORDS = 64
#: standard deviations below the threshold at which signatures still count as alike: 34 of 64 at 0.8, missed with 3.3e-7
DEVIATIONS = 5.5
#: odd multipliers and offsets of the minwise functions, from one seed
_RNG = np.random.default_rng(20240607)
MULTIPLY = (_RNG.integers(0, 1 << 31, COORDS, np.uint32) << np.uint32(1)) | np.uint32(1)
ADD = _RNG.integers(0, 1 << 32, COORDS, np.uint32)
KEYS = (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))


def sets_of(text: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per slice of rows: (first row, end row, shingle hashes in text order, bounds per row)."""
    data, at = utf8(text)
    for i, j in slices(at):
        _, _, row, h = words(data, at, i, j)
        sh, r = shingles(h, row, j - i, i, k)
        yield i, j, sh, np.searchsorted(r, np.arange(i, j + 1))


def set_key(u: np.ndarray) -> bytes:
    """128-bit key of a sorted distinct set."""
    return np.array([mix(u ^ key).sum(dtype=np.uint64) for key in KEYS], "<u8").tobytes()


def features(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, key (hash of doc_id and text), n_shingles, sid (128-bit set key; null for the empty set), sig (minwise signature)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = np.zeros(b.num_rows, np.int64)
            sig, keys = np.zeros((b.num_rows, COORDS), np.uint32), [None] * b.num_rows
            for i, j, sh, at in sets_of(b.column(1), k):
                full = np.flatnonzero(at[1:] > at[:-1])
                if not len(full):
                    continue
                low = (sh >> np.uint64(32)).astype(np.uint32)
                for c in range(COORDS):
                    sig[i + full, c] = np.minimum.reduceat(low * MULTIPLY[c] + ADD[c], at[full])
                for r in full:
                    u = np.unique(sh[at[r]: at[r + 1]])
                    n[i + r] = len(u)
                    keys[i + r] = set_key(u)
            empty = n == 0
            sigs = [None if e else s for e, s in zip(empty, map(np.ndarray.tobytes, sig), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())],
                                             names=["doc_id", "key", "n_shingles", "sid", "sig"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("doc_id", "text").alias("key")).mapInArrow(
        run, "doc_id long, key long, n_shingles long, sid binary, sig binary")


def _child(node: str, coord: str) -> str:
    return f"xxhash64({node}, {coord}, substring(sig, CAST(4 * {coord} + 1 AS INT), 4))"


def _branched(rows: DataFrame) -> DataFrame:
    """(node, sid, sig) -> (node, sid): one child for the node's coordinate, and for half of the nodes one for a second."""
    first = f"pmod(xxhash64(node, 17), {COORDS})"
    second = f"pmod({first} + 1 + pmod(xxhash64(node, 29), {COORDS - 1}), {COORDS})"
    one, two = _child("node", first), _child("node", second)
    return rows.selectExpr("sid", f"CASE WHEN xxhash64(node, 31) % 2 = 0 THEN array({one}) ELSE array({one}, {two}) END AS nodes").selectExpr(
        "sid", "explode(nodes) AS node")


def node_links(sig: np.ndarray, size: np.ndarray, threshold: float, slack: float, leaf: int, seed: int) -> np.ndarray:
    """First vertex of each vertex's component among the similar pairs that branching below one node finds.

    Rows of ``sig`` are the vertices' signatures, ``size`` their set sizes. Memory is a few times the node.
    """
    labels, rng = np.arange(len(sig)), np.random.default_rng(seed)

    def link(at: np.ndarray) -> None:
        old = np.unique(labels[at])
        if len(old) > 1:
            labels[np.isin(labels, old)] = old[0]

    def alike(x: int, others: np.ndarray) -> np.ndarray:
        near = (sig[others] == sig[x]).mean(axis=1) >= slack
        return others[near & (np.minimum(size[others], size[x]) >= (threshold - 1e-9) * np.maximum(size[others], size[x]))]

    todo = [np.arange(len(sig))]
    while todo:
        at = todo.pop()
        for x in range(len(at) - 1 if len(at) <= leaf else 1):
            if (labels[at] == labels[at[0]]).all():
                break
            near = alike(at[x], at[x + 1:])
            if len(near):
                link(np.append(near, at[x]))
        if len(at) <= leaf or (labels[at] == labels[at[0]]).all():
            continue
        for c in rng.choice(COORDS, int(rng.integers(1, 3)), replace=False):
            order = at[np.argsort(sig[at, c], kind="stable")]
            parts = np.split(order, np.flatnonzero(np.diff(sig[order, c])) + 1)
            todo += [p for p in parts if len(p) > 1]
    return labels


def candidate_links(vertices: DataFrame, threshold: float, trees: int, picks: int, leaf: int, depth: int, task_vertices: int) -> DataFrame:
    """Edges (u, v) whose components hold every pair of similarity ``threshold`` that a tree kept together."""
    slack = threshold - DEVIATIONS * (threshold * (1 - threshold) / COORDS) ** 0.5
    # an odd stride: the roots' coordinates differ while there are enough
    roots = ", ".join(_child(f"{t + 1}L", str((t * picks + p) * 37 % COORDS)) for t in range(trees) for p in range(picks))
    rows = stored(vertices.selectExpr("sid", f"array({roots}) AS nodes").selectExpr("sid", "explode(nodes) AS node"), "paths")
    fitting, links = [], []

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                near = (matrix(b.column(0), "<u4", COORDS) == matrix(b.column(1), "<u4", COORDS)).mean(axis=1) >= slack
                yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], pa.array(near)], names=["sig", "node", "sid", "near"])

    for level in range(depth):
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("sid")).alias("one"),
                                         F.bit_xor(F.xxhash64("sid", F.lit(7))).alias("two")).filter("m > 1")
        sizes = stored(sizes, "sizes")
        # most small nodes of near-copies hold the same vertices in many trees: each such set is compared once
        once = sizes.filter(F.col("m") <= leaf).groupBy("m", "one", "two").agg(F.min("node").alias("node")).select("node")
        inside = once.unionAll(sizes.filter(F.col("m").between(leaf + 1, task_vertices)).select("node"))
        fitting.append(rows.join(inside, "node", "left_semi").select("node", "sid"))
        over = sizes.filter(F.col("m") > task_vertices)
        if over.isEmpty():
            break
        large = rows.join(over.select("node"), "node", "left_semi")
        if level == depth - 1:
            first = large.groupBy("node").agg(F.min("sid").alias("v"))
            links.append(large.join(first, "node").selectExpr("sid AS u", "v"))
        else:
            full = large.select("node", "sid").join(vertices.select("sid", "sig"), "sid")
            firsts = full.groupBy("node").agg(F.min_by("sig", "sid").alias("first_sig"))
            marked = stored(full.join(firsts, "node").select("sig", "first_sig", "node", "sid").mapInArrow(
                agree, "sig binary, node long, sid binary, near boolean"), "marked")
            dense = marked.groupBy("node").agg(F.avg(F.col("near").cast("int")).alias("share"), F.min("sid").alias("v")).filter("share >= 0.5")
            links.append(marked.join(dense, "node").selectExpr("sid AS u", "v"))
            rows = stored(_branched(marked.join(dense, "node", "left_anti")), "paths")
    small = fitting[0]
    for more in fitting[1:]:
        small = small.unionAll(more)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in key_groups(batches, "node"):
            sid, n, node = table.column("sid").to_pylist(), table.column("n").to_numpy(), table.column("node").to_numpy()
            sig, out = matrix(table.column("sig"), "<u4", COORDS), []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                labels = node_links(sig[lo:hi], n[lo:hi], threshold, slack, leaf, int(node[lo]) % (1 << 63))
                out += [(sid[lo + x], sid[lo + r]) for x, r in enumerate(labels.tolist()) if x != r]
            yield _pairs(out)

    found = small.join(vertices.selectExpr("sid", "n_shingles AS n", "sig"), "sid").repartition("node").sortWithinPartitions(
        "node", "sid").select("node", "sid", "n", "sig").mapInArrow(compare, "u binary, v binary")
    for more in links:
        found = found.unionAll(more)
    return found


def _stars(sid: list[bytes], sets: Union) -> list[tuple[bytes, bytes]]:
    """(vertex, its set's first vertex) for every vertex that is not the first."""
    return [(sid[x], sid[r]) for x in range(len(sid)) if (r := sets.find(x)) != x]


def _pairs(out: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.binary()), pa.array([b for _, b in out], pa.binary())], names=["u", "v"])


def _linked(inter: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * inter >= percent * (a + b - inter)


def link_sets(sets: list[np.ndarray], percent: int, left: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that span the components of ``sets``; with ``left`` (mask) only left rows are compared with others.

    Exact: a pair is skipped only when both are already in one component.
    """
    m, n = len(sets), np.array([len(s) for s in sets], np.int64)
    tokens, flat = np.unique(np.concatenate(sets), return_inverse=True)
    at = np.concatenate(([0], np.cumsum(n)))
    by = np.argsort(flat, kind="stable")
    owner = np.repeat(np.arange(m), n)[by]
    begin = np.concatenate(([0], np.cumsum(np.bincount(flat, minlength=len(tokens)))))
    seen, out, parts = Union(m), [], m
    for x in range(m):
        if left is not None and not left[x]:
            continue
        if parts == 1:
            break
        t = flat[at[x]: at[x + 1]]
        size = begin[t + 1] - begin[t]
        where = np.repeat(begin[t] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum()))
        inter = np.bincount(owner[where], minlength=m)
        for y in np.flatnonzero(_linked(inter, n, n[x], percent)):
            if seen.join(x, int(y)):
                out.append((x, int(y)))
                parts -= 1
    return out


def _with_sets(members: DataFrame, docs: DataFrame, k: int, extra: str) -> DataFrame:
    """members (key, sid, more) -> sid, more and ``set``, the sorted distinct shingles as bytes.

    ``key`` is the hash of doc_id and text of one row of the vertex; of the texts with that hash only those
    whose set has the member's key are taken.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, sid, keep = [], b.column(1).to_pylist(), []
            for i, j, sh, at in sets_of(b.column(0), k):
                for r in range(j - i):
                    u = np.unique(sh[at[r]: at[r + 1]])
                    if len(u) and set_key(u) == sid[i + r]:
                        out.append(u.tobytes())
                        keep.append(i + r)
            rest = b.select(b.schema.names[1:]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(out, pa.binary())], names=[*rest.schema.names, "set"])

    names = [c.split()[0] for c in extra.split(", ")]
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias("key"))
    # without an id all copies of a text have one key: one row of each map task is dealt
    nameless = rows.filter("doc_id IS NULL").groupBy("key", "text").agg(F.count(F.lit(1)).alias("n"))
    text = rows.filter("doc_id IS NOT NULL").select("key", "text").unionAll(nameless.select("key", "text"))
    # the same plan at every size: texts are dealt by key, the narrow members are the hashed side
    return text.join(members.hint("shuffle_hash"), "key").select("text", *names).mapInArrow(run, f"{extra}, set binary")


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u8") for x in column.to_pylist()]


def confirmed_components(clusters: DataFrame, vertices: DataFrame, docs: DataFrame, k: int, percent: int,
                         task_shingles: int) -> DataFrame:
    """clusters (sid, c) -> (u, v): every vertex of a true component that is not its first, with the first.

    A cluster that fits a task is solved there; the links of larger ones are joined into components.
    """
    sized = clusters.join(vertices.select("sid", "n_shingles", "key"), "sid")
    weights = sized.groupBy("c").agg(F.sum("n_shingles").alias("w"))
    sized = stored(sized.join(weights, "c"), "clusters")
    small = sized.filter(F.col("w") <= task_shingles).withColumn("c", F.xxhash64("c"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in key_groups(batches, "c"):
            sid, sets, out = table.column("sid").to_pylist(), _arrays(table.column("set")), []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                seen = Union(int(hi - lo))
                for x, y in link_sets(sets[lo:hi], percent):
                    seen.join(x, y)
                out += _stars(sid[lo:hi], seen)
            yield _pairs(out)

    found = _with_sets(small, docs, k, "sid binary, c long").repartition("c").sortWithinPartitions("c").mapInArrow(
        confirm, "u binary, v binary")
    big = sized.filter(F.col("w") > task_shingles)
    if not big.isEmpty():
        found = found.unionAll(components(_large_links(big, vertices, docs, k, percent, task_shingles)))
    # a vertex may come from several equal rows
    return stored(found.filter("u != v").distinct(), "components")


def _large_links(big: DataFrame, vertices: DataFrame, docs: DataFrame, k: int, percent: int, task_shingles: int) -> DataFrame:
    """Clusters too large for a task: against the most typical vertex, then the unlinked ones in pairs of blocks."""
    coords = "array(" + ",".join(f"struct({c} AS i, substring(sig, {4 * c + 1}, 4) AS x)" for c in range(0, COORDS, 4)) + ")"
    seen = big.join(vertices.select("sid", "sig"), "sid").selectExpr("c", "sid", f"inline({coords})")
    votes = seen.groupBy("c", "i", "x").agg(F.count(F.lit(1)).alias("n"))
    hubs = seen.join(votes, ["c", "i", "x"]).groupBy("c", "sid").agg(F.sum("n").alias("n")).groupBy("c").agg(
        F.max_by("sid", F.struct("n", "sid")).alias("hub"))
    sets = stored(_with_sets(big, docs, k, "sid binary, c binary, w long"), "sets")
    against = sets.join(hubs, "c").join(sets.selectExpr("sid AS hub", "`set` AS hub_set"), "hub")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, h = _arrays(b.column(0)), _arrays(b.column(1))
            hit = [bool(_linked(np.array(len(np.intersect1d(x, y, assume_unique=True))), len(x), len(y), percent)) for x, y in zip(a, h, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[2:], pa.array(hit)], names=[*b.schema.names[2:], "hit"])

    tried = stored(against.select("set", "hub_set", "sid", "c", "w", "hub").mapInArrow(
        check, "sid binary, c binary, w long, hub binary, hit boolean"), "tried")
    found = tried.filter("hit AND sid != hub").selectExpr("sid AS u", "hub AS v")
    left = tried.filter("NOT hit").select("sid", "c", "w")
    counts = left.join(sets.selectExpr("sid", "octet_length(`set`) div 8 AS n"), "sid").groupBy("c").agg(
        F.sum("n").alias("lw"))
    blocks = sets.join(counts, "c").join(left.selectExpr("sid", "true AS is_left"), "sid", "left").selectExpr(
        "sid", "c", "`set`", "coalesce(is_left, false) AS is_left",
        f"CAST(ceil(2.0 * lw / {task_shingles}) AS INT) AS gl", f"CAST(ceil(2.0 * w / {task_shingles}) AS INT) AS gr",
        "xxhash64(sid) AS h")
    dealt = blocks.filter("is_left").selectExpr(
        "c", "sid", "`set`", "true AS is_left", "pmod(h, gl) AS i", "explode(sequence(0, gr - 1)) AS j").unionAll(
        blocks.selectExpr("c", "sid", "`set`", "false AS is_left", "explode(sequence(0, gl - 1)) AS i", "pmod(h, gr) AS j"))
    dealt = dealt.selectExpr("xxhash64(c, CAST(i AS LONG), CAST(j AS LONG)) AS task", "sid", "`set`", "is_left")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in key_groups(batches, "task"):
            sid, sets_, mask, out = table.column("sid").to_pylist(), _arrays(table.column("set")), table.column("is_left").to_numpy(), []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                out += [(sid[lo + x], sid[lo + y]) for x, y in link_sets(sets_[lo:hi], percent, mask[lo:hi])]
            yield _pairs(out)

    return found.unionAll(dealt.repartition("task").sortWithinPartitions("task").mapInArrow(confirm, "u binary, v binary"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, trees: int = 8, picks: int = 2, leaf: int = 64,
                    depth: int = 40, task_vertices: int = 8192, task_shingles: int = 1_000_000, with_key: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable), kept (doc_id = component_id).

    ``with_key`` adds key (hash of doc_id and text) and root (one value for each component, also for rows
    whose doc_id is null), which tell rows with a null or repeated doc_id apart.
    ``task_vertices`` bounds the signatures that one comparing task holds for a node (256 bytes each).
    ``percent``: sets link when 100 * intersection >= percent * union. ``task_shingles`` bounds the
    shingles that one confirming task holds.
    """
    feats = stored(features(docs, k), "features")
    vertices = stored(feats.filter("sid IS NOT NULL").groupBy("sid").agg(
        F.min("doc_id").alias("doc_id"), F.coalesce(F.min_by("key", "doc_id"), F.min("key")).alias("key"), F.max("n_shingles").alias("n_shingles"), F.any_value("sig").alias("sig")), "vertices")
    near = components(candidate_links(vertices, percent / 100, trees, picks, leaf, depth, task_vertices))
    clusters = near.selectExpr("u AS sid", "v AS c").unionAll(near.select(F.col("v").alias("sid"), F.col("v").alias("c")).distinct())
    links = confirmed_components(clusters, vertices, docs, k, percent, task_shingles)
    roots = feats.select("doc_id", "key", "n_shingles", "sid").join(links.selectExpr("u AS sid", "v AS root"), "sid", "left").withColumn(
        "root", F.expr("coalesce(root, sid, to_binary(CAST(key AS STRING), 'utf-8'))"))
    smallest = vertices.select("sid", F.col("doc_id").alias("least")).join(links.selectExpr("u AS sid", "v AS root"), "sid", "left").groupBy(
        F.coalesce("root", "sid").alias("root")).agg(F.min("least").alias("component_id"))
    return roots.join(smallest, "root", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), *(["key", "root"] if with_key else [])).withColumn(
        "kept", F.expr("doc_id <=> component_id"))

"""SimHash near-duplicates by anchor-point covering.

A fingerprint has a bit for each of 64 positions that is set in over half of the XXH64 values of the
text's word shingles. Fingerprints link at ``threshold`` or fewer differing bits.

Anchors. The 64 bits are split into two blocks of 37 and 27 bits. Of four differing bits the first block
holds at most two or the second at most one, so links are sought block by block with these smaller
thresholds. The code words of a covering code of the block are its anchors: the binary Golay code of 23 bits
(covering radius 3) and the Hamming code of 7 bits (radius 1) leave each value within the radius of exactly one word;
single bits are their own code. A fingerprint is copied to every anchor within covering radius plus
threshold. If x and y differ in few enough bits of a block, the anchor nearest to x has y within that reach, so
comparing those nearest to an anchor with all others there finds every link, none by chance.

Comparison is an equi-join on the anchor with the number of differing bits as a further condition, so
Spark splits the join of a crowded anchor, and no set of fingerprints has to fit a task. Distinct
fingerprints are compared, copies never are. Links leave a task as a forest: at most one for each fingerprint it met.

Defined results: a null text counts as empty; texts without words have fingerprint zero and link like any
other. Texts with fewer than ``k`` words are one shingle. Repeated rows each get a row. A null doc_id keeps its
row and is no candidate for the smallest id; a group without any id has a null component_id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.graph import components
from sensorlake.llm.tables import spread_join, stored

K = 4
THRESHOLD = 4
HASHES = 1 << 16        # hashes whose bits are counted at a time

# Generator polynomial of the binary Golay code, seed of the hash.
GOLAY = 0b110001110101
SEED = 42


# --- fingerprints ---------------------------------------------------------------------------------

def fingerprint(text: str | None, k: int = K) -> int:
    """SimHash of the k-word shingles, repeats included; 0 without words."""
    import xxhash

    words = (text or "").encode().lower().split()      # bytes: only A-Z change, and only 0x20 and 0x09-0x0D separate
    if not words:
        return 0
    data, size = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    n = max(1, len(words) - k + 1)
    last = ends[min(k, len(words)) - 1:]
    total, h = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, n, HASHES):
        j = min(n, i + HASHES)
        hashes = np.fromiter((h(data[a:b], SEED) for a, b in zip(starts[i:j].tolist(), last[i:j].tolist(), strict=True)), np.uint64, j - i)
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((2 * total > n).astype(np.uint64) @ (np.uint64(1) << np.arange(64, dtype=np.uint64)))


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, fp): fingerprints as signed longs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), k) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.record_batch([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


# --- anchors --------------------------------------------------------------------------------------

class Code:
    """A perfect code of ``bits`` bits and covering radius ``radius``; a syndrome names the coset of a value."""

    def __init__(self, bits: int, radius: int, checks: list[int], reach: int):
        self.bits, self.radius, n = bits, radius, bits
        self.low = np.zeros(1 << 12, np.int64)          # syndromes of the low 12 bits and of the others
        self.high = np.zeros(1 << max(0, n - 12), np.int64)
        for table, first in ((self.low, 0), (self.high, 12)):
            for v in range(1, len(table)):
                bit = (v & -v).bit_length() - 1
                table[v] = table[v & (v - 1)] ^ (checks[first + bit] if first + bit < n else 0)
        # by excess over the radius and syndrome: the patterns that lead to a word, padded with -1
        self.patterns: list[np.ndarray] = []
        for excess in range(reach + 1):
            weights = range(radius + 1) if excess == 0 else (radius + excess,)
            found: dict[int, list[int]] = {}
            for w in weights:
                for at in combinations(range(n), w) if w <= n else ():
                    s = 0
                    for i in at:
                        s ^= checks[i]
                    found.setdefault(s, []).append(sum(1 << i for i in at))
            table = np.full((1 << max(checks).bit_length(), max(map(len, found.values()), default=1)), -1, np.int64)
            for s, p in found.items():
                table[s, :len(p)] = p
            self.patterns.append(table)

    def words(self, values: np.ndarray, excess: int) -> np.ndarray:
        """(values, some) code words at exactly this excess over the radius (0: within it); -1 pads."""
        p = self.patterns[excess][self.low[values & 4095] ^ self.high[values >> 12]]
        return np.where(p < 0, -1, values[:, None] ^ p)


def golay_checks() -> list[int]:
    """Remainders of x**i by the generator polynomial, for i < 23."""
    out, r = [], 1
    for _ in range(23):
        out.append(r)
        r <<= 1
        if r >> 11:
            r ^= GOLAY
    return out


@lru_cache
def code(bits: int, reach: int) -> Code:
    """The Golay code of 23 bits, a Hamming code of 2**m - 1 bits, or all values of any other number."""
    if bits == 23:
        return Code(23, 3, golay_checks(), reach)
    if bits & (bits + 1) == 0 and bits > 1:
        return Code(bits, 1, list(range(1, bits + 1)), reach)
    return Code(bits, 0, [0] * bits, reach)


#: lowest bit, widths of the codes of the block, threshold of the block
BLOCKS = ((0, (23, 7, 7), 2), (37, (23, 4), 1))


def anchors(fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(rows, anchor, near) for every anchor within covering radius plus threshold; near: within the radius."""
    for number, (first, widths, threshold) in enumerate(BLOCKS):
        parts, at = [], first
        for w in widths:
            parts.append(((fp >> np.uint64(at)) & np.uint64((1 << w) - 1)).astype(np.int64))
            at += w

        def spread(i: int, left: int, rows: np.ndarray, anchor: np.ndarray, used: int, parts=parts, widths=widths):
            if i == len(widths):
                yield rows, anchor, used == 0
                return
            for excess in range(left + 1):
                words = code(widths[i], threshold).words(parts[i][rows], excess)
                r, c = np.nonzero(words >= 0)
                if len(r):
                    yield from spread(i + 1, left - excess, rows[r], (anchor[r] << widths[i]) | words[r, c], used + excess)

        start = np.full(len(fp), number, np.int64)
        yield from spread(0, threshold, np.arange(len(fp)), start, 0)


def anchored(fps: DataFrame) -> DataFrame:
    """(anchor, fp, near) of distinct fingerprints."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every = b.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(every), 4096):
                fp = every[i:i + 4096]
                for rows, anchor, near in anchors(fp.view(np.uint64)):
                    yield pa.record_batch([pa.array(anchor), pa.array(fp[rows]), pa.array(np.full(len(rows), near))], names=["anchor", "fp", "near"])

    return fps.select("fp").mapInArrow(run, "anchor long, fp long, near boolean")


# --- links and components -------------------------------------------------------------------------

def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the links of a task, those that join what no earlier one joined."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for b in batches:
        out = []
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            a, c = find(u), find(v)
            if a != c:
                parent[max(a, c)] = min(a, c)
                out.append((u, v))
        yield pa.record_batch([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["u", "v"])


def links(fps: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(u, v): links between distinct fingerprints that hold every group together."""
    if sum(t + 1 for _, _, t in BLOCKS) <= threshold:
        raise ValueError("the thresholds of the blocks do not cover this one")
    rows = stored(anchored(fps), "anchored")
    near = rows.filter("near").select("anchor", F.col("fp").alias("u"))
    found = near.join(rows.select("anchor", F.col("fp").alias("v")), "anchor").filter(f"u != v AND bit_count(u ^ v) <= {int(threshold)}")
    return found.select("u", "v").mapInArrow(_forest, "u long, v long")


def simhash_groups(docs: DataFrame, threshold: int = THRESHOLD, k: int = K) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    rows = stored(fingerprints(docs, k), "fingerprints")
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "distinct")
    roots = components(links(fps, threshold)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    placed = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members"))
    n_fps, n_docs = fps.agg(F.count(F.lit(1)), F.sum("n")).first()
    # groups, and fingerprints, of over a thousandth of all rows are at most a thousand rows
    group = stored(spread_join(placed.select("fp", "n", "root"), least, ["root"], F.col("members") > max(1000, n_fps // 1000)).select(
        "fp", "n", "component_id"), "groups")
    return spread_join(rows, group, ["fp"], F.col("n") > max(1000, (n_docs or 0) // 1000)).select(
        "doc_id", F.expr("lower(lpad(hex(fp), 16, '0'))").alias("fingerprint"), "component_id")

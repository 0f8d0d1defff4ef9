"""Length buckets with least padding, and token-budget batches inside them.

The histogram of all lengths is aggregated by Spark (lengths up to 2048 exactly, longer ones in
1024 cells per power of two, so its size is bounded whatever the
data); dynamic programming over it finds the ``buckets`` boundaries of least total padding
among the greatest lengths of the cells, which are lengths that occur.
Every document is padded to its bucket's boundary, and batches take consecutive
documents of a bucket, by doc_id, as many as fit the token budget. Ranks come
from a range partitioning with per-range offsets, so a bucket with most of the
rows is spread over tasks.

Rows: a null or empty text is one token (the end mark); a document longer than
the budget is a batch of its own; a null doc_id sorts first; equal rows and repeated
ids are separate documents, ordered by text hash and row number, which splits any number of equal rows; an empty table gives an empty
result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.tables import stored
from sensorlake.operators.prefix import exclusive_prefix

EXACT, STEPS = 2048, 1024
#: histogram rows are at most EXACT + STEPS for each power of two up to 2**63
MOST_BINS = EXACT + 52 * STEPS


def boundaries(hist: list[tuple[int, int, int]], buckets: int) -> list[int]:
    """Bucket lengths of least padding for (length, documents, tokens), ascending by length.

    best[k][j] = min over i of best[k-1][i] + length_j * (documents i..j) - (tokens i..j): for fixed k the
    candidates are lines in length_j, so a hull of lines answers each row in one pass.
    """
    n = len(hist)
    if not n:
        return []
    length = [0] + [h[0] for h in hist]
    docs, tokens = [0], [0]
    for _, d, t in hist:
        docs.append(docs[-1] + d)
        tokens.append(tokens[-1] + t)
    best = [0] + [None] * n
    came = []
    for _ in range(min(buckets, n)):
        lines: deque = deque()  # (slope, intercept, i), slopes fall
        row, back = [None] * (n + 1), [0] * (n + 1)
        for j in range(1, n + 1):
            if best[j - 1] is not None:
                new = (-docs[j - 1], best[j - 1] + tokens[j - 1], j - 1)
                while len(lines) > 1 and (new[1] - lines[-2][1]) * (lines[-2][0] - lines[-1][0]) <= (lines[-1][1] - lines[-2][1]) * (lines[-2][0] - new[0]):
                    lines.pop()
                lines.append(new)
            if not lines:
                continue
            x = length[j]
            while len(lines) > 1 and lines[1][0] * x + lines[1][1] <= lines[0][0] * x + lines[0][1]:
                lines.popleft()
            row[j], back[j] = x * docs[j] - tokens[j] + lines[0][0] * x + lines[0][1], lines[0][2]
        came.append((row[n], back))
        best = row
    k = min((cost, k) for k, (cost, _) in enumerate(came) if cost is not None)[1]
    out, j = [], n
    while j and k >= 0:
        out.append(length[j])
        j, k = came[k][1][j], k - 1
    return out[::-1]


def pack(docs: DataFrame, buckets: int = 16, budget: int = 8192) -> DataFrame:
    """doc_id, n_tokens (words and an end mark), bucket, bucket_len, batch (within the bucket), slot, padding."""
    words = r"regexp_count(text, '[^\\x20\\x09-\\x0D]+')"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).selectExpr(
        "doc_id", f"CAST(coalesce({words}, 0) + 1 AS LONG) AS n_tokens", "xxhash64(text) AS h", "monotonically_increasing_id() AS nth")
    rows = stored(rows, "lengths")
    step = f"CAST(shiftleft(1L, CAST(floor(log2(n_tokens)) AS INT) - {STEPS.bit_length() - 1}) AS LONG)"
    grid = f"CASE WHEN n_tokens <= {EXACT} THEN n_tokens ELSE CAST(ceil(n_tokens / {step}) AS LONG) * {step} END"
    hist = rows.groupBy(F.expr(grid).alias("cell")).agg(F.max("n_tokens").alias("length"), F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens"))
    bounds = boundaries(sorted((r["length"], r["docs"], r["tokens"]) for r in hist.take(MOST_BINS + 1)), buckets)
    if not bounds:
        return rows.selectExpr("doc_id", "n_tokens", "0 AS bucket", "0L AS bucket_len", "0L AS batch", "0 AS slot", "0L AS padding")
    case = " ".join(f"WHEN n_tokens <= {b} THEN {i}" for i, b in enumerate(bounds))
    lens = ", ".join(f"{b}L" for b in bounds)
    dealt = rows.selectExpr("doc_id", "n_tokens", "h", "nth", f"CASE {case} END AS bucket").repartitionByRange(
        "bucket", "doc_id", "h", "nth").sortWithinPartitions("bucket", "doc_id", "h", "nth").selectExpr(
        "doc_id", "n_tokens", "bucket", "CAST(spark_partition_id() AS LONG) AS part", "monotonically_increasing_id() & 8589934591 AS at")
    dealt = stored(dealt, "dealt")
    ranges = dealt.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    offsets = exclusive_prefix(ranges, "part", {"n": "sum"}, group_cols=["bucket"]).selectExpr(
        "bucket", "part", "coalesce(prev_n, 0) - first AS shift")
    return dealt.join(offsets, ["bucket", "part"]).selectExpr(
        "doc_id", "n_tokens", "bucket", f"element_at(array({lens}), bucket + 1) AS bucket_len", "at + shift AS rank").selectExpr(
        "doc_id", "n_tokens", "bucket", "bucket_len", f"rank div greatest(1, {int(budget)} div bucket_len) AS batch",
        f"CAST(rank % greatest(1, {int(budget)} div bucket_len) AS INT) AS slot", "bucket_len - n_tokens AS padding")

"""Conversation trie against a dictionary of prefixes; balanced parentheses against a stack; skew, nulls, ties, empty tables."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlake.llm.parens import Parentheses, forest
from sensorlake.llm.prefix_trie import prefix_trie

TABLE = "conv_id long, turn long, role string, text string"


def brute(rows):
    turns = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns.setdefault(c, []).append((t is not None, t or 0, tie, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in turns.items()}
    nodes, ends = {}, {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 9, c - (abs(c) % 5) * (1 if c > 0 else -1)
        whole = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(whole) + 1):
            nodes.setdefault(whole[:d], []).append(c)
        ends.setdefault(whole, []).append(c)
    leaves, saved, children = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    for p, who in nodes.items():
        gain = (len(who) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += gain
            leaves[p[:d]] += not children[p]
    return sorted((min(w), len(p), min(nodes[p[:-1]]) if p else None, len(w), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, w in nodes.items())


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def run(spark, rows, parts=5, **kw):
    df = spark.createDataFrame(rows, TABLE).repartition(parts).withColumn("n_convs", F.lit("clash")).withColumn("k1", F.lit(0))
    return sorted(tuple(r[c] for c in COLUMNS) for r in prefix_trie(df, **kw).collect())


def sample(seed, convs, turns, texts):
    rng = np.random.default_rng(seed)
    return [(int(c), t, ["user", "assistant"][t % 2], f"té{rng.integers(texts)}") for c in range(convs) for t in range(int(rng.integers(0, turns)))]


@pytest.mark.parametrize("shard,ratio", [(2, 2), (2048, 16)])
def test_against_dictionary(spark, shard, ratio):
    rows = sample(1, 120, 14, 2) + [(500 + i, 0, "user", "same") for i in range(40)] + [(600, i, "user", f"long {i}") for i in range(200)]
    assert run(spark, rows, shard=shard, ratio=ratio) == brute(rows)


def test_nulls_ties_copies(spark):
    rows = sample(2, 20, 9, 3) + [(None, 0, "user", "none"), (7, None, "user", "first"), (7, None, None, "first too"), (8, 3, "user", None),
                                  (8, 3, "user", ""), (9, 1, "a", "x"), (9, 1, "a", "x"), (9, 1, "a", "y"), (-3, 0, "user", "neg"), (11, 0, "", "x" * 100_000)]
    assert run(spark, rows) == brute(rows)


def test_turnless_and_empty(spark):
    assert run(spark, []) == [] and run(spark, [(None, 1, "user", "x")]) == []
    short = [c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2][:3]
    rows = [(c, 0, "user", "gone") for c in short]     # their own turn is replaced by turns of a base that is not there
    assert run(spark, rows) == brute(rows) and len(brute(rows)) == 1


def test_conversation_longer_than_a_range(spark):
    rows = [(13, i, "user", f"t{i % 7}") for i in range(150)] + [(10, i, "user", f"t{i % 7}") for i in range(4)] + sample(3, 30, 6, 2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert run(spark, rows, shard=4, ratio=2) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_find_close():
    rng = np.random.default_rng(5)
    for n in (1, 2, 70, 1000):
        for depth in (1, 3, n):
            parent = np.array([-1 if i == 0 else int(rng.integers(max(-1, i - depth), i)) for i in range(n)])
            bits, opened = forest(parent)
            stack, want = [], {}
            for i, b in enumerate(bits):
                if b:
                    stack.append(i)
                else:
                    want[stack.pop()] = i
            starts = np.flatnonzero(bits)
            assert sorted(opened.tolist()) == list(range(n))
            assert dict(zip(starts.tolist(), Parentheses(bits).find_close(starts).tolist(), strict=True)) == want


def test_registered_query_and_sql(spark):
    from conftest import SF_SMALL
    from sensorlake.llm.queries import LLM_ORACLE_SQL, LLM_QUERIES

    got = sorted(tuple(r[c] for c in COLUMNS) for r in LLM_QUERIES["op12_prefix_trie"](spark, SF_SMALL).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF_SMALL}/conversations.parquet')")
    rel = con.sql(LLM_ORACLE_SQL["op12_prefix_trie"])
    at = [rel.columns.index(c) for c in COLUMNS]
    rows = con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert got == brute(rows) == sorted(tuple(r[i] for i in at) for r in rel.fetchall())

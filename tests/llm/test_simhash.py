"""SimHash groups against all pairs; the covering property; nulls, copies, empty tables, long texts."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sensorlake.llm.simhash import BLOCKS, anchors, code, fingerprint, simhash_groups


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    sh = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows, fp=brute_fingerprint):
    prints = [fp(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, f"{prints[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumn("fp", F.lit("clash")).withColumn("root", F.lit(1))
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash_groups(df).collect()), key=str)


def test_fingerprint_against_plain_code():
    rng = np.random.default_rng(1)
    texts = [None, "", " \t\n", "One", "one TWO", "a b c d", "É A b\x0bc\x1cd e", "x " * 5000]
    texts += [" ".join(rng.choice(["Alpha", "béta", "g", "d d", "e"], rng.integers(1, 60))) for _ in range(200)]
    for t in texts:
        assert fingerprint(t) == brute_fingerprint(t)


@pytest.mark.parametrize("bits", [23, 7, 15, 4])
def test_codes_cover(bits):
    rng = np.random.default_rng(2)
    c = code(bits, 2)
    v = rng.integers(0, 1 << bits, 300)
    nearest = c.words(v, 0)
    assert ((nearest >= 0).sum(axis=1) == 1).all()             # perfect: one word within the radius
    for excess in (0, 1, 2):
        words = c.words(v, excess)
        for x, row in zip(v.tolist(), words.tolist(), strict=True):
            for w in (w for w in row if w >= 0):
                d = (x ^ w).bit_count()
                assert d <= c.radius if excess == 0 else d == c.radius + excess
                assert c.words(np.array([w]), 0).max() == w    # a word is its own nearest


def test_every_pair_within_four_bits_meets():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 64, 400, dtype=np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            y[i] ^= np.uint64(1) << np.uint64(bit)
    seen = [{True: set(), False: set()} for _ in range(800)]
    for rows, anchor, near in anchors(np.concatenate((x, y))):
        for r, a in zip(rows.tolist(), anchor.tolist(), strict=True):
            seen[r][near].add(a)
    for i in range(400):
        assert len(seen[i][True]) == len(BLOCKS)
        assert seen[i][True] & (seen[400 + i][True] | seen[400 + i][False])


def near_texts(seed, n):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(500)]
    out = []
    for g in range(n):
        base = rng.choice(words, 200).tolist()
        for _ in range(8):
            t = list(base)
            for _ in range(int(rng.integers(0, 4))):
                t[int(rng.integers(200))] = str(rng.choice(words))
            out.append(" ".join(t))
    return out


def test_groups_against_all_pairs(spark):
    texts = near_texts(4, 25) + ["", None, "a", "b c", "B C", "x " * 3000]
    rows = [(i * 3 % 997, t) for i, t in enumerate(texts)] + [(1000 + i, texts[9]) for i in range(50)] + [(None, texts[9]), (None, "alone"), (5, "twice"), (5, "twice")]
    got = run(spark, rows)
    assert got == brute(rows)
    assert len({c for *_, c in got}) > 25 and any(d != c for d, _, c in got)


def test_crowd_of_close_fingerprints(spark, monkeypatch):
    """Many fingerprints within a few bits of each other, in chains."""
    from sensorlake.llm import simhash

    rng = np.random.default_rng(6)
    fps, x = [], 0x0123456789ABCDEF
    for _ in range(300):
        for bit in rng.choice(64, 3, replace=False):
            x ^= 1 << int(bit)
        fps.append(x)
    rows = [(i, str(f)) for i, f in enumerate(fps)]
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, k: docs.selectExpr(
        "doc_id", "CAST(CASE WHEN CAST(text AS DECIMAL(38,0)) > 9223372036854775807BD THEN CAST(text AS DECIMAL(38,0)) - 18446744073709551616BD "
        "ELSE CAST(text AS DECIMAL(38,0)) END AS LONG) AS fp"))
    assert run(spark, rows) == brute(rows, lambda t: int(t))


def test_empty_table(spark):
    assert run(spark, []) == []


def test_registered_query(spark):
    from conftest import SF_SMALL
    from sensorlake.llm.queries import LLM_QUERIES

    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in LLM_QUERIES["op13_simhash"](spark, SF_SMALL).collect()), key=str)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert got == brute(rows)

import hashlib
import random
from collections import Counter

import numpy as np

from sensorlake.llm import suffix_dedup as sd


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(rows, texts, strict=True):
        edge = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                edge[i] += 1
                edge[i + length] -= 1
        gone = np.cumsum(edge[:-1]) > 0
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = sum(bool(g) and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, rid int")
    return sorted([tuple(r) for r in sd.remove_repeats(df.repartition(3), **kw).collect()], key=str)


def corpus(seed, n=60, length=20):
    rng = random.Random(seed)
    say = lambda k: "".join(rng.choice("abcdé ") for _ in range(k))
    shared = [say(rng.randrange(length, 6 * length)) for _ in range(5)]
    rows = []
    for d in range(n):
        t = say(rng.randrange(0, 200))
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            cut = rng.randrange(len(s))
            t += rng.choice((s, s[cut:], s[:cut], s[:cut] + "#" + s[cut + 1:])) + say(rng.randrange(0, 60))
        rows.append((d, t))
    return rows


def test_random_corpora(spark):
    for seed in range(3):
        rows = corpus(seed)
        rows += [(100, rows[3][1]), (101, rows[3][1]), (3, rows[3][1])]
        want = brute(rows, 20)
        assert any(r[2] for r in want) and run(spark, rows, length=20, gram=8) == want
    assert run(spark, rows, length=20, gram=8, shard_bytes=500, queue_entries=16) == want
    # anchors with more than a few strings are counted window by window
    for anchor_bytes in (0, 60, 200):
        assert run(spark, rows, length=20, gram=8, anchor_bytes=anchor_bytes) == want


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, "short"), (4, "x" * 300), (5, "ab" * 400), (6, "q" * 199), (7, "the long passage é " * 3000), (None, "n" * 250),
            (None, "n" * 250), (8, " ".join(f"w{i}" for i in range(9000))), (9, " ".join(f"w{i}" for i in range(9000))), (9, "short")]
    assert run(spark, rows) == brute(rows, 200)
    assert run(spark, []) == []


def test_segments_cover_every_window_once():
    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 99 if k % 2 else 120, n).astype(np.uint8) for k, n in enumerate((0, 5, 40, 41, 300, 39, 2000))]
    b, starts = np.concatenate(texts), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    row, f, n, anchor, string = sd.segments(b, starts, 40, 8)
    windows = sorted(int(x) for a, m in zip(f, n, strict=True) for x in range(a, a + m))
    assert windows == sorted(s + i for s, t in zip(starts, texts, strict=False) for i in range(len(t) - 39))
    by = {}
    for a, m, h in zip(f, n, anchor, strict=True):
        for x in range(a, a + m):
            by.setdefault(b[x:x + 40].tobytes(), set()).add(int(h))
    assert all(len(v) == 1 for v in by.values())


def test_query_on_documents(spark):
    from sensorlake.llm.queries import op6_suffix_dedup

    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(rows, 200)
    assert any(r[2] for r in want)
    assert sorted([tuple(r) for r in op6_suffix_dedup(spark, sf).collect()], key=str) == want

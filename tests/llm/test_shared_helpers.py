import random
import re

import numpy as np
import pyarrow as pa

from sensorlake.llm import text as tx
from sensorlake.llm.graph import components
from sensorlake.llm.tables import Union, key_groups

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_words_and_shingles_match_regex():
    rng = random.Random(2)
    texts = ["", None, " ", "One two\tTHREE\x0bfour\x1cfive", "é ÉÉ x \U0001f600", "a" * 3000, "x y z " * 50]
    texts += ["".join(rng.choice("abAB é\n\t.") for _ in range(rng.randrange(60))) for _ in range(200)]
    for column in (pa.array(texts), pa.array([None, *texts], pa.large_string()).slice(1)):
        data, at = tx.utf8(column)
        seen = {}
        for limit in (1, 64, 1 << 18):
            got = [[] for _ in texts]
            grams = [[] for _ in texts]
            for i, j in tx.slices(at, limit):
                _, _, row, h = tx.words(data, at, i, j)
                for r, x in zip(row, h, strict=True):
                    got[r].append(int(x))
                s, r = tx.shingles(h, row, j - i, i, 3)
                for a, b in zip(r, s, strict=True):
                    grams[a].append(int(b))
            for t, hashes, g in zip(texts, got, grams, strict=True):
                w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
                assert len(hashes) == len(w)
                for a, b in zip(w, hashes, strict=True):
                    assert seen.setdefault(a, b) == b
                want = [tuple(w)] if 0 < len(w) < 3 else [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
                assert len(g) == len(want)
                for a, b in zip(want, g, strict=True):
                    assert seen.setdefault(a, b) == b
        assert len(set(seen.values())) == len(seen)


def test_components_match_disjoint_sets(spark):
    rng = random.Random(4)
    n = 400
    pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [(700, 700 + i) for i in range(50)]
    sets = Union(1000)
    for a, b in pairs:
        sets.join(a, b)
    df = spark.createDataFrame([(f"{a:04d}".encode(), f"{b:04d}".encode()) for a, b in pairs], "u binary, v binary")
    got = {int(bytes(r["u"])): int(bytes(r["v"])) for r in components(df).collect()}
    assert got == {x: sets.find(x) for x in range(1000) if sets.find(x) != x}
    assert components(df.limit(0)).collect() == []


def test_key_groups_stay_whole_across_batches():
    rng = np.random.default_rng(0)
    keys = np.sort(rng.integers(0, 30, 500))
    for size in (1, 7, 100, 500):
        batches = [pa.record_batch([pa.array(keys[i: i + size]), pa.array(np.arange(i, min(i + size, 500)))], names=["k", "v"]) for i in range(0, 500, size)]
        seen = []
        for table, bounds in key_groups(iter(batches), "k"):
            k, v = table.column("k").to_numpy(), table.column("v").to_numpy()
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                assert len(set(k[lo:hi])) == 1
                seen.append((int(k[lo]), v[lo:hi].tolist()))
        assert [k for k, _ in seen] == sorted(set(keys.tolist())) and sum((v for _, v in seen), []) == list(range(500))

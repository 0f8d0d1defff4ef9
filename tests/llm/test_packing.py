import itertools
import random
import re

import pytest

from sensorlake.llm import packing as pk


def padding(hist, bounds):
    return sum(min(b for b in bounds if b >= n) * d - t for n, d, t in hist)


@pytest.mark.parametrize("seed", range(12))
def test_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(1, 60), rng.randrange(1, 9)))
    hist = [(n, d := rng.randrange(1, 20), n * d) for n in lengths]
    for k in range(1, 6):
        best = min(padding(hist, (*c, lengths[-1])) for r in range(k) for c in itertools.combinations(lengths[:-1], min(r, len(lengths) - 1)))
        got = pk.boundaries(hist, k)
        assert len(got) <= k and got == sorted(set(got)) and got[-1] == lengths[-1] and padding(hist, got) == best


def check(rows, got, buckets, budget):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in got), key=str) == sorted(((i, count(t)) for i, t in rows), key=str)
    batches = {}
    for r in got:
        assert r["padding"] == r["bucket_len"] - r["n_tokens"] >= 0
        batches.setdefault((r["bucket"], r["batch"]), []).append(r)
    for (bucket, b), members in batches.items():
        size = max(1, budget // members[0]["bucket_len"])
        assert sorted(r["slot"] for r in members) == list(range(len(members))) and len(members) <= size
        assert len(members) == size or (bucket, b + 1) not in batches
    order = sorted(got, key=lambda r: (r["bucket"], r["batch"], r["slot"]))
    for a, b in itertools.pairwise(order):
        if a["bucket"] == b["bucket"]:
            assert a["doc_id"] is None or a["doc_id"] <= b["doc_id"]


def run(spark, rows, buckets=3, budget=64):
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, bucket int")
    got = pk.pack(df.repartition(3), buckets, budget).collect()
    check(rows, got, buckets, budget)
    return got


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b"), (4, "w " * 30000), (5, "w " * 5000), (5, "w " * 5000), (6, "x " * 2049), (7, "one")]
    got = run(spark, rows)
    assert len(got) == len(rows) and run(spark, []) == []


def test_many_rows_in_one_bucket(spark):
    rng = random.Random(4)
    rows = [(i, "a b c") for i in range(900)] + [(1000 + i, "w " * rng.randrange(1, 90)) for i in range(300)]
    run(spark, rows)


def test_boundaries_of_long_documents_are_lengths_that_occur(spark):
    sizes = [2300, 2301, 5003, 70_001, 70_013, 70_013]
    got = run(spark, [(i, "w " * (n - 1)) for i, n in enumerate(sizes)], buckets=4)
    assert sorted(r["bucket_len"] for r in got) == [2300, 2301, 5003, 70_013, 70_013, 70_013]


def test_equal_rows_are_spread(spark):
    rows = [(None, "a b c")] * 4000 + [(7, "a b c")] * 4000
    got = run(spark, rows, buckets=2, budget=16)
    assert len({(r["bucket"], r["batch"], r["slot"]) for r in got}) == len(rows)


def test_query_on_documents(spark):
    from sensorlake.llm.queries import op7_packing

    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = op7_packing(spark, sf).collect()
    check(rows, got, 16, 8192)
    lengths = sorted(r["n_tokens"] for r in got)
    hist = [(n, d := lengths.count(n), n * d) for n in sorted(set(lengths))]
    assert {r["bucket_len"] for r in got} <= set(lengths)
    assert max(lengths) > pk.EXACT or sum(r["padding"] for r in got) == padding(hist, pk.boundaries(hist, 16))

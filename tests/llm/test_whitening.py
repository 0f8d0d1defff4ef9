"""Whitening against a direct float64 solution; refinement on clustered eigenvalues; nulls, copies, ties, empty tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlake.llm.whitening import Centre, refined_eigen, whiten

TABLE = "vec_id long, embedding array<float>"


def brute(rows, k=16):
    """rows: (id, vector) -> n, {id: deviation}, centred x by id, eigenvalues and vectors of the distinct vectors."""
    good = {}
    for i, v in rows:
        if v and all(c is not None and math.isfinite(c) for c in v):
            good.setdefault(i, []).append(tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v))
    fit = sorted({x for xs in good.values() for x in xs})
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = np.array([[c - t / n for c, t in zip(x, s, strict=True)] for x in fit])
    values, axes = np.linalg.eigh(y.T @ y / n)
    dev = {i: sorted(sum((n * c - t) ** 2 for c, t in zip(x, s, strict=True)) for x in xs) for i, xs in good.items()}
    return n, s, dev, good, values[::-1], axes[:, ::-1]


def check(got, rows, k):
    n, s, dev, good, values, axes = brute(rows)
    assert {r.n for r in got} == {n} and len(got) == k * sum(len(x) for x in good.values())
    assert {r.component for r in got} == set(range(1, k + 1))
    for i, d in dev.items():
        assert sorted(r.deviation for r in got if r.vec_id == i and r.component == 1) == d
    for r in got:
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-6)
        assert 0 <= r.identity_error <= 1e-9
    for c in range(1, k + 1):
        a = axes[:, c - 1]
        want = {i: sorted(abs(float(np.dot([u - t / n for u, t in zip(x, s, strict=True)], a))) / math.sqrt(values[c - 1]) for x in xs) for i, xs in good.items()}
        for i in want:
            have = sorted(abs(r.whitened) for r in got if r.vec_id == i and r.component == c)
            assert have == pytest.approx(want[i], abs=1e-7)


def test_against_direct_solution(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(300, 20)) * np.linspace(0.1, 2, 20)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(900, rows[3][1]), (901, rows[3][1]), (3, rows[3][1]), (902, None), (903, rows[5][1][:19] + [None]),
             (904, rows[5][1][:19] + [float("nan")]), (905, rows[5][1][:19] + [float("inf")]), (906, [1.0]), (907, [])]
    usable = [(i, v) for i, v in rows if v and len(v) == 20]
    df = spark.createDataFrame(rows, TABLE).repartition(7).withColumn("n", F.lit("clash")).withColumn("x", F.lit(0))
    check(whiten(df).collect(), usable, 16)


def test_fewer_dimensions_than_components_and_constant_ones(spark):
    rows = [(i, [float(i % 5), 3.0, float((i * 7) % 11)]) for i in range(60)]
    got = whiten(spark.createDataFrame(rows, TABLE)).collect()
    check(got, rows, 2)   # the constant dimension has no variance


def test_tables_without_variance_or_rows(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])]):
        assert whiten(spark.createDataFrame(rows, TABLE)).collect() == []
    got = whiten(spark.createDataFrame([(None, [1.0, 0.0]), (2, [0.0, 1.0])], TABLE)).collect()
    assert {r.vec_id for r in got} == {None, 2} and all(r.component == 1 for r in got)


def test_huge_entries(spark):
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [5.0, 2.0])]
    got = whiten(spark.createDataFrame(rows, TABLE)).collect()
    assert all(r.deviation is None for r in got if r.vec_id != 3)


def test_exact_deviation_past_double_precision():
    x = np.array([[10**9 + 7, -(10**9)], [3, 10**8 + 1], [-5, 1]], np.int64)
    sums = [sum(c) for c in x.tolist()] and [int(c) for c in x.sum(axis=0)]
    want = [sum((3 * a - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x.tolist()]
    assert Centre(3, sums).deviation(x) == [w if w < 1 << 63 else None for w in want]


@pytest.mark.parametrize("values", [
    np.linspace(1, 5, 30),
    np.concatenate((np.full(10, 2.0), 2.0 + 1e-9 * np.arange(10), np.linspace(3, 4, 10))),     # a multiple and a tight cluster
    np.concatenate((1e-6 * np.arange(1, 20), [1e6])),
])
def test_refinement_solves_clusters(values):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0].astype(np.longdouble)
    for _ in range(3):   # orthogonal in extended precision
        q = q @ (1.5 * np.eye(len(values)) - 0.5 * (q.T @ q))
    a = (q * values) @ q.T
    got, x = refined_eigen(a)
    want = np.sort(values)[::-1]
    assert np.abs(got - want).max() <= 1e-17 * len(values) * np.abs(want).max()
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-16
    assert np.abs(a @ x - x * got).max() <= 1e-17 * len(values) * np.abs(want).max()


def test_registered_query(spark):
    from conftest import SF_SMALL
    from sensorlake.llm.queries import LLM_QUERIES

    got = LLM_QUERIES["op11_whitening"](spark, SF_SMALL).collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    check(got, rows, 16)

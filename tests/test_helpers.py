"""Distributed helpers against brute force on small inputs."""

import random

import numpy as np
from pyspark.sql import functions as F

from sensorlake.operators.impute import trailing_mean, trailing_mean_feedback
from sensorlake.operators.prefix import exclusive_prefix, inclusive_prefix
from sensorlake.operators.quantile import exact_median


def test_exclusive_prefix_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = [(g, i, rnd.randint(-50, 50)) for g in ("a", "b") for i in range(0, 300, rnd.choice([1, 2]))]
    df = spark.createDataFrame(rows, "g string, o long, v long")
    # tiny fanout so three levels and cross-block carries are exercised
    got = {(r.g, r.o): (r.prev_v, r.prev_w) for r in exclusive_prefix(
        df.withColumn("w", F.col("v")), "o", {"v": "max", "w": "sum"}, ["g"], fanout=4, levels=3).collect()}
    for g in ("a", "b"):
        seq = sorted((o, v) for gg, o, v in rows if gg == g)
        for k, (o, _) in enumerate(seq):
            prev = [v for _, v in seq[:k]]
            assert got[(g, o)] == ((max(prev), sum(prev)) if prev else (None, None))


def test_inclusive_prefix_sum(spark):
    df = spark.createDataFrame([(i, i) for i in range(50)], "o long, v long")
    got = {r.o: r.cum_v for r in inclusive_prefix(df, "o", {"v": "sum"}, fanout=3, levels=2).collect()}
    assert all(got[i] == i * (i + 1) // 2 for i in range(50))


def _series(rnd, n=400):
    t, rows = 1_700_000_000, []
    for i in range(n):
        t += rnd.choice([1, 5, 30, 60, 200, 400])
        val = None if rnd.random() < 0.25 else round(rnd.uniform(0, 40), 2)
        rows.append((i, rnd.choice(["k1", "k2"]), t, val))
    return rows


def test_trailing_mean_bucketed_equals_brute_force(spark):
    rnd = random.Random(3)
    rows = _series(rnd)
    df = spark.createDataFrame(rows, "event_id long, sensor_id string, ts long, temperature double").withColumn(
        "event_time", F.timestamp_seconds("ts"))
    for bucket in (None, 120.0, 7.0):      # 7 s bucket < 300 s width: rows copied into many buckets
        got = {r.event_id: r.imputed for r in trailing_mean(df, 300, bucket_seconds=bucket).collect()}
        for i, k, t, v in rows:
            if v is not None:
                assert got[i] is None
                continue
            hist = [vv for _, kk, tt, vv in rows if kk == k and vv is not None and t - 300 <= tt <= t]
            exp = sum(hist) / len(hist) if hist else None
            assert (got[i] is None and exp is None) or abs(got[i] - exp) < 1e-9


def test_feedback_equals_sequential(spark):
    rnd = random.Random(11)
    rows = _series(rnd, 300)
    df = spark.createDataFrame(rows, "event_id long, sensor_id string, ts long, temperature double").withColumn(
        "event_time", F.timestamp_seconds("ts"))
    got = {r.event_id: r.imputed for r in trailing_mean_feedback(df, 300, bucket_seconds=100).collect()}
    filled = {}
    for k in ("k1", "k2"):
        hist = []
        for i, kk, t, v in sorted((r for r in rows if r[1] == k), key=lambda r: r[2]):
            window = [x for tt, x in hist if t - 300 <= tt < t]
            if v is None:
                filled[i] = sum(window) / len(window) if window else None
                if filled[i] is not None:
                    hist.append((t, filled[i]))
            else:
                hist.append((t, v))
    for i, val in filled.items():
        assert (got[i] is None and val is None) or abs(got[i] - val) < 1e-9


def test_exact_median(spark):
    rnd = np.random.default_rng(5)
    data = {"a": rnd.normal(size=1001), "b": np.round(rnd.uniform(0, 3, size=800), 1),
            "c": np.array([5.0] * 10), "d": np.concatenate([rnd.normal(size=50) * 1e-9, [1e12, -1e12]])}
    rows = [(g, float(x)) for g, xs in data.items() for x in xs]
    df = spark.createDataFrame(rows, "g string, v double")
    for bins, rounds in ((65536, 4), (4, 2)):
        got = {r.g: r.median for r in exact_median(df, "g", "v", bins=bins, rounds=rounds).collect()}
        for g, xs in data.items():
            assert abs(got[g] - float(np.median(xs))) < 1e-12

import re
from collections import Counter

import pytest

from sensorlake.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + d for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for d in range(3)}
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


EDGE = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a a", "x y z x y z y z x y", "l\nl\nl \n\n \nl", "é ü ## $|<>",
        "w " * 3000, "\x0b one\x0ctwo\x1cthree four \U0001f600 five", "line one\r\nline one\r\nline two", "q" * 50000,
        " ".join(f"w{i}" for i in range(50)), " ".join(f"w{i}" for i in range(49)), " ".join(f"w{i % 40}" for i in range(60))]


def stats(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumnRenamed("zz", "zz")
    rows = qr.quality(df, spark.createDataFrame([], "doc_id long, quality long, toxic long")).collect()
    return [tuple(r[c] for c in (*qr.STATS, "base_failed")) for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_statistics_match_brute_force(spark):
    assert stats(spark, EDGE) == [brute(t) for t in EDGE]
    assert stats(spark, []) == []


def test_statistics_on_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()
    assert stats(spark, [r["text"] for r in rows]) == [brute(r["text"]) for r in rows]


def test_learned_list_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rules = qr.fit(docs, labels)
    assert rules
    got = {r["doc_id"]: r for r in qr.judged(docs, rules).collect()}
    pairs = [(got[r["doc_id"]]["q_kept"], r["quality"]) for r in labels.collect() if r["doc_id"] in got]
    good = [k for k, q in pairs if q == 1]
    bad = [k for k, q in pairs if q == 0]
    assert sum(good) / len(good) > 0.95 and sum(bad) / len(bad) < 0.2, (sum(good), len(good), sum(bad), len(bad))


def test_covering_finds_a_planted_conjunction():
    import random

    rng = random.Random(1)
    rows = []
    for i in range(600):
        r = {f: rng.random() for f in qr.FEATURES}
        rows.append(r | {"bad": int(r["mean_word"] > 0.6 and r["upper_share"] <= 0.4), "fold": i % 3})
    rules = qr.learn_rules(rows)
    wrong = sum(any(x.covers(r) for x in rules) != bool(r["bad"]) for r in rows)
    assert wrong <= 12


@pytest.mark.parametrize("labels", [[], [(1, None, 0)], [(99, 0, 0)], [(1, 7, 0), (None, 0, 0)]])
def test_useless_labels(spark, labels):
    docs = spark.createDataFrame([(1, "w " * 10), (2, " ".join(f"a{i}" for i in range(80)))], "doc_id long, text string")
    out = qr.quality(docs, spark.createDataFrame(labels, "doc_id long, quality long, toxic long")).collect()
    assert [(r["doc_id"], r["kept"], r["rule"]) for r in sorted(out)] == [(1, False, 0), (2, True, 0)]


def test_clashing_columns_pass_through(spark):
    docs = spark.createDataFrame([(1, " ".join(f"a{i}" for i in range(80)), "mine", 5)], "doc_id long, text string, kept string, n_words long")
    row = qr.judged(docs, []).first()
    assert row["kept"] == "mine" and row["n_words"] == 5 and row["q_kept"] and row["q_n_words"] == 80

import zlib

import numpy as np

from sensorlake.llm import langid as li


def test_held_out_accuracy_and_calibration(spark):
    from sensorlake.llm.queries import op2_langid

    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op2_langid(spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    right = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]
    assert np.mean(right) > 0.97
    assert abs(np.mean(right) - np.mean([r["score"] for r in held])) < 0.05


def test_awkward_rows(spark):
    rows = [(i, "the quick house and the river" if i % 2 else "der schnelle Fluß und das Haus", "en" if i % 2 else "de", "s") for i in range(60)]
    rows += [(100, None, "en", "s"), (101, "", "en", "s"), (102, "12 34 !!", "de", "s"), (103, "und das Haus", None, "s"), (None, "the river", "en", "s"),
             (103, "und das Haus", None, "s"), (104, "the house " * 50000, None, "s"), (105, "é", None, "s"), (106, "퟿\U0001f600 the", None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = li.identify(df.repartition(3)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert [by[i][0]["lang_pred"] for i in (100, 101, 102)] == ["und"] * 3 and by[100][0]["score"] == 0
    assert [r["lang_pred"] for r in by[103]] == ["de", "de"] and by[104][0]["lang_pred"] == "en" and by[None][0]["lang_pred"] == "en"
    assert by[None][0]["held_out"] is False
    assert li.identify(df.limit(0)).collect() == []


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r["lang_pred"], r["score"]) for r in li.identify(df).collect()] == [("und", 0.0)]


def test_document_frequencies_are_whole(spark):
    texts = [f"text number {i} of many" for i in range(200)]
    df, n = li.frequencies(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5))
    want = sum((np.bincount(li.columns_of(t), minlength=li.WIDTH) > 0).astype(int) for t in texts)
    assert n == 200 and (df == want).all()
    df, n = li.frequencies(spark.createDataFrame([], "text string"))
    assert n == 0 and not df.any()


def test_ftrl_is_sparse_and_temperature_calibrates():
    rng = np.random.default_rng(0)
    rows = []
    for k in range(400):
        y = k % 3
        at = np.sort(np.concatenate(([y], rng.choice(np.arange(10, 400), 12, replace=False))))
        rows.append((at, np.full(13, 13**-0.5), y))
    w, bias = li.ftrl(rows, 3)
    assert all(int(np.argmax(x @ w[at] + bias)) == y for at, x, y in rows)
    assert (w[400:] == 0).all() and np.abs(w[:3]).min() > 10 * np.abs(w[10:400]).mean()
    logits = rng.normal(size=(4000, 3)) * 2
    y = np.array([rng.choice(3, p=li.softmax(x)) for x in logits])
    assert abs(li.temperature(logits * 3, y) - 3) < 0.4 and li.temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


def test_languages_in_several_blocks(spark):
    rng = np.random.default_rng(3)
    langs = [f"l{k:02}" for k in range(12)]
    rows = []
    for k, lang in enumerate(langs):  # an alphabet of its own for each
        letters = [chr(0x4E00 + 40 * k + c) for c in range(12)]
        rows += [(len(rows) + i, " ".join("".join(rng.choice(letters, 4)) for _ in range(12)), lang) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = li.fit(df, max_langs=5)
    assert len(model["blocks"]) == 3 and all(m["other"] for m in model["blocks"])
    assert sorted(x for m in model["blocks"] for x in m["langs"]) == langs
    want = {i: lang for i, _, lang in rows}
    for size in (5, 256):
        got = li.identify(df, max_langs=size).collect()
        held = [r["lang_pred"] == want[r["doc_id"]] for r in got if r["held_out"]]
        assert np.mean(held) > 0.95 and all(0 <= r["score"] <= 1 for r in got)


def test_repeated_rows_do_not_crowd_the_sample(spark):
    rows = [(3, "der schnelle Haus", "de")] * 3000 + [(i, f"the quick house {i}", "en") for i in range(10, 60)]
    got = li.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_lang=20).collect()
    assert {r["lang_pred"] for r in got if r["doc_id"] == 3} <= {"de", "en"} and len(got) == len(rows)

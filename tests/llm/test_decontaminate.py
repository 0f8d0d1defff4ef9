import random
import re

import numpy as np

from sensorlake.llm import decontaminate as dc

WORD = re.compile(r"[^\x20\x09-\x0D!-/:-@\[-`{-~]+")


def words(t):
    return WORD.findall((t or "").lower())


def grams(w):
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(docs, items):
    """Pairs by full containment over the whole text (passages are only a way to find them)."""
    out = set()
    for item, t in items:
        parts = dc.SENTENCE.split((t or "").strip())
        q = words(" ".join(parts[:-1]))
        qs, ans = (grams(q), set(words(parts[-1]))) if len(q) >= 5 else (grams(words(t)), set())
        if not qs:
            continue
        for d, text in docs:
            w = words(text)
            have = grams(w) | ({tuple(w[i:i + n]) for n in range(1, 5) for i in range(len(w) - n + 1)} if len(qs) == 1 else set())
            if sum(x in have for x in qs) >= 0.8 * len(qs) and (not ans or sum(x in w for x in ans) >= 0.5 * len(ans)):
                out.add((d, item))
    return out


def run(spark, docs, items, **kw):
    a = spark.createDataFrame([(i, t, 1.0) for i, t in docs], "doc_id long, text string, score double")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = dc.contaminated(a.repartition(2), b, **kw).collect()
    assert len({(r["doc_id"], r["item_id"]) for r in got}) == len(got)
    return {(r["doc_id"], r["item_id"]) for r in got}


def corpus(seed, n=120, vocabulary=400):
    rng = random.Random(seed)
    say = lambda k: " ".join(f"w{min(int(rng.expovariate(0.01)), vocabulary)}" for _ in range(k))
    items = [(i, f"{say(rng.randrange(8, 40))}. {say(rng.randrange(3, 9))}.") for i in range(90)]
    docs = []
    for d in range(n):
        t = say(rng.randrange(0, 200))
        if d % 3 == 0:
            item = rng.choice(items)[1].split()
            for _ in range(rng.randrange(2)):
                item[rng.randrange(len(item))] = "edited"
            t = t + " " + " ".join(item).upper() + "### " + say(rng.randrange(0, 200))
        docs.append((d, t))
    return docs, items


def test_finds_all_contained_items(spark):
    docs, items = corpus(1)
    want = brute(docs, items)
    assert len(want) >= 30
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, chunk_items=20) == want
    assert run(spark, docs, items, max_broadcast=300_000) == want  # halved chunks, several passes


def test_large_chunks_are_halved_and_grouped():
    _, items = corpus(3)
    ids, texts = [i for i, _ in items], [t for _, t in items]
    whole = len(dc.pickle.dumps(dc.Index(ids, texts, 0.5)))
    parts = list(dc.parts_of(ids, texts, 0.5, whole - 1))
    assert len(parts) == 2 and sorted(i for p in parts for i in dc.pickle.loads(p).ids) == ids
    assert len(list(dc.parts_of(ids, texts, 0.5, 1))) == len(ids)  # an item of any size is searched
    assert list(dc.groups_of(iter([b"aa", b"b", b"cccc", b"d"]), 3)) == [[b"aa", b"b"], [b"cccc"], [b"d"]]
    assert list(dc.groups_of(iter([]), 3)) == []


def test_wand_equals_full_scoring():
    docs, items = corpus(2)
    index = dc.Index([i for i, _ in items], [t for _, t in items], 0.3)
    for _, t in docs[:40]:
        terms = np.unique(index.lookup(dc._of(t)))
        terms = terms[terms >= 0]
        full = np.zeros(len(index.ids))
        for x in terms:
            full[index.item[index.begin[x]: index.begin[x + 1]]] += index.impact[index.begin[x]: index.begin[x + 1]]
        got = sorted(i for b in range(len(index.block_theta)) for i, _ in index.wand(terms, b))
        assert got == np.flatnonzero(full >= index.theta * (1 - 1e-9)).tolist()


def test_edge_rows(spark):
    long = " ".join(f"z{i}" for i in range(30000))
    items = [(1, "alpha beta gamma delta epsilon zeta. eta theta."), (2, None), (3, ""), (4, "..."), (5, "short one"), (6, "alpha beta gamma delta epsilon zeta. eta theta."), (None, "omega psi chi phi upsilon tau"),
             (7, "Été âge forêt île cœur noël")]
    docs = [(1, None), (2, ""), (3, "Alpha, beta gamma delta epsilon zeta eta theta"), (3, "Alpha, beta gamma delta epsilon zeta eta theta"),
            (4, long + " alpha beta gamma delta epsilon zeta eta theta " + long), (5, "a Short one here"), (6, "alpha beta gamma delta epsilon zeta"),
            (11, "ÉTÉ ÂGE FORÊT ÎLE CŒUR NOËL"), (None, "x alpha beta gamma delta epsilon zeta eta theta"), (8, "omega psi chi phi upsilon tau"), (9, "#" * 9000)]
    assert run(spark, docs, items) == {(d, i) for d, i in brute(docs, items)}
    assert run(spark, [], items) == set() and run(spark, docs, []) == set()


def test_query_on_documents(spark):
    from sensorlake.llm.queries import op10_decontaminate

    sf = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = brute(docs, items)
    assert len(want) > 20
    assert {(r["doc_id"], r["item_id"]) for r in op10_decontaminate(spark, sf).collect()} == want

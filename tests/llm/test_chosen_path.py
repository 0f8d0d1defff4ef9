import random
import re

import numpy as np

from sensorlake.llm import chosen_path as cp

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, k):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute(rows, k, percent=80):
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    posts = {}
    for i, s in enumerate(sets):
        for x in s:
            posts.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        shared = {}
        for x in s:
            for j in posts[x]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i), d)) for i, (d, _) in enumerate(rows)), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, b"x") for i, t in rows], "doc_id long, text string, sid binary")
    got = cp.near_duplicates(df.repartition(3), **kw).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    return sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got], key=str)


def near_copies(rng, n, words=60):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randrange(3)):
            t[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(t))
    return out


def test_edge_rows(spark):
    rows = [(3, None), (4, ""), (5, " \n\t "), (6, "one two"), (7, "ONE  Two"), (8, "one two three"), (9, "a " * 5000),
            (10, "a a a a a a"), (11, "É a b c d e"), (12, "é a b c d e"), (None, "no id here at all words"), (13, "no id here at all words"),
            (14, "repeated id one text of words"), (14, "repeated id another text with other words"), (14, "repeated id one text of words")]
    assert run(spark, rows, k=4) == brute(rows, 4)
    assert run(spark, []) == []


def test_random_near_copies_small_leaves_and_blocks(spark):
    rng = random.Random(5)
    texts = [t for n in (2, 3, 5, 40, 120) for t in near_copies(rng, n)]
    texts += [" ".join(f"v{rng.randrange(10**6)}" for _ in range(50)) for _ in range(60)]
    line = "a very common line of words that many texts share today"
    texts += [line + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(30)) for _ in range(150)]
    rng.shuffle(texts)
    rows = list(enumerate(texts, 10))
    want = brute(rows, 5)
    assert run(spark, rows) == want
    # tiny limits: deep branching, hub pass and block pairs all run
    assert run(spark, rows, leaf=4, depth=2, task_vertices=8, task_shingles=400) == want
    assert run(spark, rows, leaf=4, task_vertices=8) == want


def signatures(sets):
    low = [np.array([hash((x, 5)) & 0xFFFFFFFF for x in s], np.uint32) for s in sets]
    return np.array([[(h * m + a).min() for m, a in zip(cp.MULTIPLY, cp.ADD, strict=True)] for h in low])


def crowd(rng, n, shared, own):
    """Sets that share ``shared`` members and have ``own`` of their own."""
    return [[f"s{i}" for i in range(shared)] + [f"o{j}-{rng.randrange(10**9)}" for _ in range(own)] for j in range(n)]


def test_branching_inside_a_task_finds_planted_pairs_in_a_crowd():
    rng = random.Random(7)
    lost = 0
    for seed in range(20):
        sets = crowd(rng, 400, 60, 90)  # similarity 0.25: the crowd stays apart
        twin = list(sets[17])
        twin[-8:] = [f"t{i}" for i in range(8)]  # similarity 0.9
        sets.append(twin)
        labels = cp.node_links(signatures(sets), np.full(401, 150), 0.8, 0.525, 16, seed)
        lost += labels[17] != labels[400]
        assert np.all(labels <= np.arange(401)) and np.sum(labels != np.arange(401)) < 40
    assert lost <= 10  # one node; trees and the root's second pick repeat it


def test_rows_of_levels_do_not_grow_with_a_crowd(spark):
    """Texts alike but below the threshold: rows of each further level stay in proportion to the crowd."""
    rng = random.Random(3)
    per_vertex = []
    for n in (400, 1600):
        sets = crowd(rng, n, 100, 50)  # similarity 0.5
        sigs = signatures(sets)
        rows = [(bytes([1]) * 8 + int(i).to_bytes(8, "big"), sigs[i].tobytes()) for i in range(n)]
        level = spark.createDataFrame(rows, "sid binary, sig binary").selectExpr("sid", "sig", "5L AS node")
        counts = []
        for _ in range(4):
            paths = cp._branched(level)
            big = paths.groupBy("node").count().filter("count > 64")
            level = paths.join(big.select("node"), "node").join(level.select("sid", "sig").distinct(), "sid").select("sid", "sig", "node")
            counts.append(level.count() / n)
        per_vertex.append(max(counts))
    assert per_vertex[1] < 2 * max(1, per_vertex[0]) and per_vertex[1] <= 4


def test_recall_on_near_copies(spark):
    """Links of a tenth of the texts against all, in a crowd that branches on Spark, by brute force."""
    rng = random.Random(21)
    shared = " ".join(f"c{i}" for i in range(30))
    texts = []
    for _ in range(60):
        own = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        for _ in range(3):
            t = list(own)
            t[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
            texts.append(shared + " " + " ".join(t))
    rows = list(enumerate(texts))
    assert run(spark, rows, k=4, leaf=8, task_vertices=32) == brute(rows, 4)


def test_equal_rows_inside_a_group(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join([*words[:i], f"x{i}", *words[i + 1:]]) if i else " ".join(words) for i in (5, 0, 40)]
    rows = [(7, texts[0]), (7, texts[0]), (7, texts[0]), (3, texts[1]), (3, texts[1]), (9, texts[2]), (9, texts[2])]
    got = run(spark, rows)
    assert got == brute(rows, 5) and len(got) == 7 and {c for _, _, c in got} == {3}


def test_hot_group_of_copies(spark):
    rows = [(i, "the same words in every copy of this text") for i in range(400)] + [(1000 + i, f"text {i} apart from all the others {i * 7}") for i in range(50)]
    assert run(spark, rows) == brute(rows, 5)


def test_link_sets_is_exact():
    rng = np.random.default_rng(3)
    for _ in range(30):
        sets = [np.unique(rng.integers(0, 14, rng.integers(1, 14))).astype("<u8") for _ in range(12)]
        u = cp.Union(12)
        for x, y in cp.link_sets(sets, 60):
            u.join(x, y)
        v = cp.Union(12)
        for x in range(12):
            for y in range(x):
                n = len(np.intersect1d(sets[x], sets[y]))
                if 100 * n >= 60 * (len(sets[x]) + len(sets[y]) - n):
                    v.join(x, y)
        assert [u.find(x) for x in range(12)] == [v.find(x) for x in range(12)]


def test_query_on_documents(spark):
    from sensorlake.llm.queries import op9_near_duplicates

    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
        got = sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in op9_near_duplicates(spark, sf).collect()], key=str)
        assert got == brute(rows, 4)


def test_rows_without_id_link_and_lead(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    change = lambda *at: " ".join(f"x{i}" if i in at else w for i, w in enumerate(words))
    # the texts at the ends are only alike to the bridge, which no row with an id has
    ends = [change(4, 5, 6), change(40, 41, 42)]
    rows = [(30, ends[0]), (None, " ".join(words)), (None, " ".join(words)), (20, ends[1])]
    want = brute(rows, 3)
    assert {c for _, _, c in want} == {20}
    assert run(spark, rows, k=3) == want
    # the most typical text of a cluster too large for a task has no id
    words = [f"v{i}" for i in range(60)]
    large = [(None, " ".join(words))] * 3 + [(100 + i, change(i)) for i in range(0, 60, 2)]
    large += [(500 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(50))) for i in range(20)]
    want = brute(large, 5)
    assert sum(c == 100 for _, _, c in want) == 33
    assert run(spark, large, task_shingles=200) == want

import math
import re
import zlib
from collections import Counter

import numpy as np

from sensorlake.llm import gru_lm as lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def toks(t):
    return [*WORD.findall((t or "").translate(LOWER)), None]


def check(rows, got):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    counts = Counter(w for i, t in rows if i is not None and not held[i] for w in toks(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted(((i, held[i], len(toks(t)), sum(counts[w] > 0 for w in toks(t)), n,
                    round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in toks(t)), 6)) for i, t in rows), key=str)
    have = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got), key=str)
    for a, b in zip(have, want, strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) <= 1e-6 * abs(b[5]) + 2e-6
    assert all(r["score"] < 0 for r in got)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = lm.Network(np.array([0, 1, 3, 8]), hidden=4, seed=3)
    net.p = {k: v.astype(np.float64) + rng.normal(size=v.shape) * 0.3 for k, v in net.p.items()}
    x, y = rng.integers(0, 8, (5, 3)), rng.integers(0, 8, (5, 3))
    reset, h = x == 0, rng.normal(size=(3, 4))
    _, grads, _ = net.window(x, y, reset, h)
    for name, v in net.p.items():
        for _ in range(12):
            at = tuple(rng.integers(0, s) for s in v.shape)
            old, e = v[at], 1e-5
            v[at] = old + e
            a = net.window(x, y, reset, h)[0]
            v[at] = old - e
            b = net.window(x, y, reset, h)[0]
            v[at] = old
            assert abs((a - b) / (2 * e) - grads[name][at]) < 1e-4, name


def test_probabilities_sum_to_one_and_lanes_agree():
    net = lm.Network(np.array([0, 1, 4, 9]), hidden=5)
    h = np.random.default_rng(1).normal(size=(1, 5)).astype(np.float32)
    total = sum(np.exp(net.log_probs(h, np.array([k]))[0][0]) for k in range(9))
    assert abs(total - 1) < 1e-5
    rng = np.random.default_rng(2)
    docs = [np.append(rng.integers(1, 9, n), 0) for n in (0, 3, 31, 32, 33, 64, 200, 5)]
    alone = [net.score([d])[0] for d in docs]
    assert np.allclose(net.score(docs, lanes=3), alone, atol=1e-4)
    # one step at a time
    s, h = 0.0, np.zeros((1, 5), np.float32)
    for a, b in zip([0, *docs[4][:-1]], docs[4], strict=True):
        h = net.step(net.p["x"][[a]], h, net.p["u"])[0]
        s += net.log_probs(h, np.array([b]))[0][0]
    assert abs(s - alone[4]) < 1e-3


def test_training_learns_order():
    rng = np.random.default_rng(5)
    docs = [np.append(np.tile([2, 3, 4, 5], rng.integers(3, 9)), 0) for _ in range(200)]
    net = lm.Network(np.array([0, 1, 2, 4, 6]), hidden=12)
    before = net.score(docs[:20]).sum()
    net.train(docs, epochs=12)
    assert net.score(docs[:20]).sum() > 0.35 * before


def test_awkward_rows(spark):
    rows = [(i, f"the common word and word{i} End") for i in range(60)] + [(100, None), (101, ""), (102, " \n"), (103, "W " * 20000), (None, "the common unseen"),
                                                                           (7, "again again"), (7, "again again"), (104, "É é ẞ")]
    df = spark.createDataFrame([(i, t, "w") for i, t in rows], "doc_id long, text string, word string")
    check(rows, lm.score_documents(df.repartition(3), frequent=20, vocabulary=5).collect())
    check(rows, lm.score_documents(df.repartition(3)).collect())
    assert lm.score_documents(df.limit(0)).collect() == []
    only = [(None, "no training text"), (2, "x")]
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    check([(None, "no training text"), (held, "x")], lm.score_documents(spark.createDataFrame([(None, "no training text"), (held, "x")], "doc_id long, text string")).collect())
    check(only, lm.score_documents(spark.createDataFrame(only, "doc_id long, text string")).collect())


def test_query_on_documents(spark):
    from sensorlake.llm.queries import op5_lm_score

    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = op5_lm_score(spark, sf).collect()
    check(rows, got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)  # better than unigrams on unseen texts


def test_every_training_text_reaches_the_network(spark):
    """One source of 40 texts among 3,000 has an order of its own, which only training on those texts can teach."""
    rng = np.random.default_rng(8)
    common = [(i, " ".join(f"c{k}" for k in rng.integers(0, 30, 12))) for i in range(3000)]
    rare = [(10**6 + i, " ".join(["ra rb rc rd re rf"] * 40)) for i in range(40)]
    df = spark.createDataFrame(common + rare, "doc_id long, text string").repartition(4)
    got = [r for r in lm.score_documents(df, shard_tokens=5000).collect() if r["held_out"] and r["doc_id"] >= 10**6]
    assert got and sum(r["score"] for r in got) > 0.6 * sum(r["base_score"] for r in got)


def test_vocabulary_and_changes(spark, monkeypatch):
    sizes, trained = [], []
    start, apply = lm.Network.start, lm.Network.apply

    def applied(self, sums):
        sums = list(sums)
        trained.extend(np.frombuffer(d)[-1] for b, d in sums if b < 0)
        return apply(self, sums)

    monkeypatch.setattr(lm.Network, "start", lambda self, mass: sizes.append(len(mass)) or start(self, mass))
    monkeypatch.setattr(lm.Network, "apply", applied)
    rows = [(i, "a b c d e f g h") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    train = sum(zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows)
    lm.score_documents(df, vocabulary=3, shard_tokens=1000).collect()
    assert sizes == [2 + 8]  # each word occurs ``often`` times or more
    assert sum(trained) >= 9 * train  # every token of every training text


def test_windows_reuse_memory_and_do_not_disturb_each_other():
    import tracemalloc

    rng = np.random.default_rng(4)
    net, fresh = (lm.Network(np.array([0, 1, *range(20, 401, 20)]), hidden=32) for _ in range(2))
    x, y = rng.integers(0, 400, (2, 16, 256))
    h = np.zeros((256, 32), np.float32)
    _, first, after = net.window(x, y, x == 0, h)
    held = after.copy()
    tracemalloc.start()
    loss, again, _ = net.window(y, x, y == 0, after)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3_500_000  # 4096 tokens: the states, gates and gradients of a window alone are 4.7 MB
    assert (after == held).all()
    want_loss, want, _ = fresh.window(y, x, y == 0, held)
    assert loss == want_loss and all((again[k] == want[k]).all() for k in want)
    assert any((first[k] != again[k]).any() for k in want)
    docs = [np.append(rng.integers(1, 400, n), 0) for n in (3, 50, 7, 64)]
    assert np.array_equal(net.score(docs), fresh.score(docs))


def test_texts_are_split_into_tokens_once(spark, monkeypatch):
    """Training and scoring read the stored tokens of whole texts, not the texts again."""
    kept, store = {}, lm.stored
    monkeypatch.setattr(lm, "stored", lambda df, name: kept.setdefault(name, store(df, name)))
    rows = [(i, "b a a  c\nA" if i % 2 else "a b rare%d" % i) for i in range(50)] + [(50, None), (51, " "), (None, "c z a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = lm.score_documents(df, vocabulary=3, often=10**9).collect()
    check(rows, got)
    token = {w: k for k, w in enumerate([None, ..., "a", "b", "c"])}
    want = sorted((str(i), [token.get(w, lm.OTHER) for w in toks(t)]) for i, t in rows)
    found = kept["tokens"].collect()
    assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u2").tolist()) for r in found) == want
    assert "text" not in kept["tokens"].columns and len({r["rid"] for r in found}) == len(rows)


def test_places_of_hashes():
    rng = np.random.default_rng(6)
    for n, most in ((0, 9), (1, 9), (2, 2**64 - 1), (700, 2**64 - 1), (700, 2**20)):  # the last: all begin with the same bits
        known = np.unique(np.append(rng.integers(0, most, n, np.uint64, endpoint=True), np.uint64([0, 2**64 - 1][:n])))
        h = np.concatenate([known, known + np.uint64(1), rng.integers(0, 2**64 - 1, 500, np.uint64, endpoint=True)])
        at = {int(x): k for k, x in enumerate(known)}
        assert lm.places(known, lm.starts(known), h).tolist() == [at.get(int(x), -1) for x in h]


def test_rows_are_added_up_by_token():
    rng = np.random.default_rng(7)
    at = np.sort(np.concatenate([rng.integers(0, 60, 90), np.full(40, 7), np.full(300, 61)]))
    rows, order = rng.normal(size=(2 * len(at), 5)), rng.permutation(len(at))[:, None] * 2 + [1, 0]
    want = np.zeros((62, 10))
    np.add.at(want, at, rows[order].reshape(len(at), -1))
    tokens, sums = lm.add_up_rows(at, rows, order)
    assert (tokens == np.unique(at)).all() and np.allclose(sums, want[tokens])


def test_logits_far_from_zero_and_split_classes(monkeypatch):
    rng = np.random.default_rng(9)
    net = lm.Network(np.array([0, 1, 3, 8]), hidden=4)
    h, y = rng.uniform(-1, 1, (40, 4)).astype(np.float32), rng.integers(0, 8, 40)
    for size in (1, 300):  # beyond 88, exponentials of the type are infinite
        net.p = {k: (v + rng.normal(size=v.shape) * size).astype(np.float32) for k, v in net.p.items()}
        wide = {k: v.astype(float) for k, v in net.p.items()}
        logits = [h @ wide["c"] + wide["cb"], h @ wide["w"].T + wide["wb"]]
        logits[1] = np.where(net.cls[None, :] == net.cls[y][:, None], logits[1], -np.inf)
        want = sum(x[np.arange(40), at] - np.logaddexp.reduce(x, axis=1) for x, at in zip(logits, (net.cls[y], y), strict=True))
        found = []
        for cells in (1 << 19, 7):  # all rows of a class at once, and one or a few
            monkeypatch.setattr(lm, "CELLS", cells)
            grads = {k: np.zeros_like(v) for k, v in net.p.items()}
            out, dh = net.log_probs(h, y, grads)
            assert np.allclose(out, want, rtol=1e-4, atol=1e-3)
            found.append([dh.copy(), *grads.values()])
        for a, b in zip(*found, strict=True):
            assert np.isfinite(a).all() and np.allclose(a, b, rtol=1e-4, atol=1e-3 * size)

"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the character bigrams and trigrams of the whole lower-cased text,
hashed into a fixed number of columns. Document frequencies are counted over all
training texts. The classifier is fitted with follow-the-regularised-leader
(per-coordinate rates, L1 and L2 penalties) on a bounded sample: about ``per_lang`` different texts of
each language. Languages are dealt by hash to blocks of about ``max_langs``; each block is one model, fitted in a task of its own, in
which texts of other blocks are one further class, and the likeliest language of all blocks is predicted (a single block has no such class). A part of
the sample that the fit does not see sets the temperature of a block's softmax.

Training uses texts whose crc32(doc_id as text) mod 3 is not 1, with a language.
Only the text is an input of a prediction.

Rows: a null text, or one without a letter, is ``und`` with score 0; so is every text if nothing could be learned.
A null doc_id is neither trained on nor held out. Equal rows and repeated ids get equal rows; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.tables import key_groups, stored

BITS = 15
WIDTH = 1 << BITS
CHUNK = 512  # columns per partial sum of document frequencies
UNDETERMINED = "und"


def columns_of(text: str) -> np.ndarray:
    """Feature column of every character bigram and trigram of a text, its ends marked."""
    x = np.frombuffer(f"\0{text.lower()}\0".encode("utf-32-le", "replace"), np.uint32)
    two = x[:-1] * np.uint32(0x01000193) + x[1:]
    three = two[:-1] * np.uint32(0x85EBCA6B) + x[2:] + np.uint32(0x27D4EB2F)
    return ((np.concatenate((two, three)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64)


def frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """(documents with each column, documents) over all training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(WIDTH, np.int64), 0
        for b in batches:
            for text in b.column(0):
                df += np.bincount(columns_of(text.as_py()), minlength=WIDTH) > 0
                n += 1
        if n:
            yield pa.record_batch([pa.array(np.arange(WIDTH // CHUNK)), pa.array([n] * (WIDTH // CHUNK)),
                                   pa.array([df[i: i + CHUNK].tobytes() for i in range(0, WIDTH, CHUNK)], pa.binary())], names=["chunk", "n", "df"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in key_groups(batches, "chunk"):
            rows = np.stack([np.frombuffer(x, np.int64) for x in table.column("df").to_pylist()])
            n, lo = table.column("n").to_numpy(), bounds[:-1]
            sums = np.add.reduceat(rows, lo, axis=0)
            yield pa.record_batch([table.column("chunk").combine_chunks().take(pa.array(lo)), pa.array(np.add.reduceat(n, lo)),
                                   pa.array([x.tobytes() for x in sums], pa.binary())], names=["chunk", "n", "df"])

    form = "chunk long, n long, df binary"
    rows = train.select("text").mapInArrow(count, form).repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, form).take(WIDTH // CHUNK)
    df, n = np.zeros(WIDTH, np.int64), 0
    for r in rows:
        df[r["chunk"] * CHUNK: (r["chunk"] + 1) * CHUNK] = np.frombuffer(r["df"], np.int64)
        n = r["n"]
    return df, n


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0,
         l1: float = 0.002, l2: float = 0.001, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) of the multinomial model after ``epochs`` passes over (columns, values, class)."""
    z, n = np.zeros((WIDTH, classes)), np.zeros((WIDTH, classes))
    bias, bias_n = np.zeros(classes), np.zeros(classes)

    def weights(z, n):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            at, x, y = rows[k]
            w = weights(z[at], n[at])
            p = softmax(x @ w + bias)
            p[y] -= 1
            g = x[:, None] * p
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * w
            n[at] = grown
            bias_n += p * p
            bias -= alpha / (beta + np.sqrt(bias_n)) * p
    return weights(z, n), bias


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The softmax temperature of least log loss (golden section over its logarithm)."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        return -np.log(softmax(logits / np.exp(t))[np.arange(len(y)), y] + 1e-12).mean()

    a, b, r = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(60):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit(docs: DataFrame, per_lang: int = 600, max_langs: int = 256) -> dict | None:
    """{idf, blocks: [{langs, other, at, w, bias, t}]}; None if no row can teach.

    ``w`` holds the rows of the columns ``at`` that have a weight, IDF included; with ``other``, class 0 is "none of this block".
    """
    train = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")).filter(
        "text IS NOT NULL AND lang IS NOT NULL AND crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 != 1")
    key = "xxhash64(doc_id, text)"
    langs = stored(train.groupBy("lang").agg(F.expr(f"approx_count_distinct({key})").alias("n")), "langs")
    n_langs = langs.count()
    if not n_langs:
        return None
    df, n = frequencies(train)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    blocks = -(-n_langs // max_langs)
    dealt = langs.selectExpr("lang", f"least(1000000, greatest(1, {1_000_000 * per_lang} div n)) AS share", f"pmod(xxhash64(lang), {blocks}) AS block")
    # equal rows of an id are one
    some = train.join(dealt, "lang").filter(f"pmod({key}, 1000000) < share").dropDuplicates(["doc_id", "text", "lang"])
    # a block also sees about four languages' worth of the other blocks' texts
    others = min(1_000_000, 4_000_000 // n_langs)
    some = some.selectExpr("lang", "text", "doc_id", "block AS own", f"explode(filter(sequence(0L, {blocks - 1}L), b -> b = block "
                           f"OR pmod(xxhash64(doc_id, text, b), 1000000) < {others})) AS block").selectExpr(
        "block", "CASE WHEN own = block THEN lang END AS lang", "text", "doc_id")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in key_groups(batches, "block"):
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                yield pa.record_batch([pa.array([one(table.slice(int(lo), int(hi - lo)))], pa.binary())], names=["model"])

    def one(table: pa.Table) -> bytes:
        seen = []
        for text, lang, i in zip(table.column("text"), table.column("lang").to_pylist(), table.column("doc_id").to_pylist(), strict=True):
            at, x = features(text.as_py(), idf)
            seen.append((i, lang, at.astype(np.int32), x.astype(np.float32)))
        seen.sort(key=lambda r: (r[0], r[1] or "", len(r[2])))
        other = any(r[1] is None for r in seen)
        names = sorted({r[1] for r in seen if r[1] is not None})
        number = {None: 0} | {lang: k + other for k, lang in enumerate(names)}
        rows = [(at, x, number[lang]) for _, lang, at, x in seen]
        held = [r for k, r in enumerate(rows) if k % 5 == 4]
        w, bias = ftrl([r for k, r in enumerate(rows) if k % 5 != 4], len(names) + other)
        logits = np.array([x @ w[at] + bias for at, x, _ in held])
        t = temperature(logits, np.array([y for _, _, y in held], int))
        at = np.flatnonzero(w.any(axis=1))
        out = io.BytesIO()
        np.savez(out, names=np.array(names, str), other=other, at=at, w=w[at].astype(np.float32), bias=bias, t=t)
        return out.getvalue()

    rows = some.repartition("block").sortWithinPartitions("block").mapInArrow(learn, "model binary").take(blocks)
    got = [np.load(io.BytesIO(bytes(r["model"]))) for r in rows]
    models = [{"langs": g["names"].tolist(), "other": bool(g["other"]), "at": g["at"], "w": g["w"], "bias": g["bias"], "t": float(g["t"])} for g in got]
    models = [m for m in models if m["langs"]]
    return {"idf": idf, "blocks": models} if models else None


class Block:
    """One block's classes, ready to score."""

    def __init__(self, model: dict):
        self.langs, self.skip, self.bias, self.t = model["langs"], int(model["other"]), model["bias"], model["t"]
        self.place = np.full(WIDTH, len(model["at"]))
        self.place[model["at"]] = np.arange(len(model["at"]))
        self.w = np.concatenate((model["w"], np.zeros((1, len(self.bias)), np.float32)))

    def best(self, at: np.ndarray, x: np.ndarray) -> tuple[float, str]:
        p = softmax((x @ self.w[self.place[at]] + self.bias) / self.t)[self.skip:]
        k = int(p.argmax())
        return float(p[k]), self.langs[k]


def features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sparse TF-IDF vector of a text: the share of each column among its n-grams, times IDF, scaled to length one."""
    counts = np.bincount(columns_of(text), minlength=WIDTH)
    at = np.flatnonzero(counts)
    x = counts[at] * idf[at]
    return at, x / np.sqrt(x @ x)


def identify(docs: DataFrame, per_lang: int = 600, max_langs: int = 256) -> DataFrame:
    """doc_id, held_out, lang_pred, score (calibrated probability of that language)."""
    model = fit(docs, per_lang, max_langs)
    spark = docs.sparkSession
    idf = model["idf"] if model else None
    held = [spark.sparkContext.broadcast(m) for m in model["blocks"]] if model else []  # each WIDTH x (about max_langs) floats at most

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [Block(h.value) for h in held]
        for b in batches:
            langs, scores = [UNDETERMINED] * b.num_rows, [0.0] * b.num_rows
            for k, cell in enumerate(b.column(1)) if blocks else ():
                text = cell.as_py()
                if text is None or not any(map(str.isalpha, text)):
                    continue
                at, x = features(text, idf)
                scores[k], langs[k] = max(block.best(at, x) for block in blocks)
            yield pa.record_batch([b.column(0), b.column(2), pa.array(langs, pa.string()), pa.array(scores)],
                                  names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.expr(
        "coalesce(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1, false)").alias("held_out")).mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double")

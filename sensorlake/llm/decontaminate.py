"""Benchmark decontamination: BM25 inverted index of test items, searched with block-max WAND.

Test items are indexed in chunks of bounded size; each chunk is one small index
(postings with BM25 impacts, per-block maxima); a chunk whose index is larger than the bound is halved
until its parts fit or hold one item. Indexes are broadcast in groups of bounded size, and a group is searched
in one pass over the documents. Every text is cut into passages of two adjacent windows, each as
long as the chunk's longest item, so an item that occurs lies whole inside one.
Block maxima summed over a passage's distinct terms bound its score in a block
of items; where the bound reaches the block's lowest threshold, WAND walks
the postings and returns every item that scores at least ``share`` of its own
self-score. A hit counts if the passage holds ``overlap`` of the item's question
shingles (five words) and half of its answer's words.

An item's answer is its last sentence, its question all before; where that would leave a question of
fewer than five words, the whole item is the question. Words are runs without white space and ASCII
punctuation of the lower-cased text. A question of fewer than five words is one shingle.

Rows: null or empty texts and items match nothing; equal rows and repeated ids
are searched each, and a pair (doc_id, item_id) is returned once with its best
passage; rows with a null id keep it; empty tables give an empty result. Columns other than the id and
the text are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm import text as tx

K1, B = 1.2, 0.75
SHINGLE = 5
BLOCK = 4
PUNCT = tx.SPACE.copy()
PUNCT[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
SENTENCE = re.compile(r"(?<=[.!?\n])\s+")


def word_hashes(data: np.ndarray, at: np.ndarray, i: int, j: int):
    """(hash of each word, its row) for rows [i, j)."""
    _, _, row, h = tx.words(data, at, i, j, PUNCT)
    return h, row


def _of(text: str) -> np.ndarray:
    data, at = tx.utf8(pa.array([text]))
    return word_hashes(data, at, 0, 1)[0]


def _grams(h: np.ndarray) -> np.ndarray:
    return np.unique(tx.shingles(h, np.zeros(len(h), np.int64), 1, 0, SHINGLE)[0]) if len(h) else h


class Index:
    """BM25 impacts of one chunk of items: postings by term, block maxima, thresholds."""

    def __init__(self, ids: list, texts: list[str], share: float):
        hashes = [_of(t) for t in texts]
        # items of like length, and so of like thresholds, share a block
        order = sorted((k for k in range(len(ids)) if len(hashes[k])), key=lambda k: (len(np.unique(hashes[k])), k))
        self.ids = [ids[k] for k in order]
        hashes, texts = [hashes[k] for k in order], [texts[k] for k in order]
        self.window = max(map(len, hashes), default=1)
        n = len(order)
        self.terms = np.unique(np.concatenate(hashes)) if n else np.zeros(0, np.uint64)
        pairs = [np.unique(np.searchsorted(self.terms, h), return_counts=True) for h in hashes]
        df = np.zeros(len(self.terms))
        for t, _ in pairs:
            df[t] += 1
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        length = np.array([len(h) for h in hashes], float)
        mean = length.mean() if n else 1.0
        item = np.concatenate([np.full(len(t), k) for k, (t, _) in enumerate(pairs)]) if n else np.zeros(0, int)
        term = np.concatenate([t for t, _ in pairs]) if n else np.zeros(0, int)
        tf = np.concatenate([c for _, c in pairs]).astype(float) if n else np.zeros(0)
        impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[item] / mean))
        own = np.bincount(item, impact, minlength=n)
        self.theta = share * own
        by = np.lexsort((item, term))
        self.item, self.impact = item[by], impact[by]
        self.begin = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=len(self.terms)))))
        blocks = -(-n // BLOCK)
        self.block_max = np.zeros((len(self.terms), blocks), np.float32)
        np.maximum.at(self.block_max, (term, item // BLOCK), np.nextafter(impact.astype(np.float32), np.float32(np.inf)))
        self.block_theta = np.array([self.theta[b * BLOCK: (b + 1) * BLOCK].min() for b in range(blocks)])
        self.seen = np.zeros(1 << 18, bool)
        self.seen[self.terms >> np.uint64(46)] = True
        parts = [SENTENCE.split(t.strip()) for t in texts]
        asked = [_of(" ".join(p[:-1])) for p in parts]
        split = [len(q) >= SHINGLE for q in asked]
        self.question = [_grams(q if two else _of(t)) for q, two, t in zip(asked, split, texts, strict=True)]
        self.answer = [np.unique(_of(p[-1])) if two else np.zeros(0, np.uint64) for p, two in zip(parts, split, strict=True)]

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Term numbers of word hashes, -1 for words in no item."""
        out = np.full(len(h), -1, np.int64)
        may = np.flatnonzero(self.seen[h >> np.uint64(46)])
        if len(may) and len(self.terms):
            at = np.minimum(np.searchsorted(self.terms, h[may]), len(self.terms) - 1)
            same = self.terms[at] == h[may]
            out[may[same]] = at[same]
        return out

    def wand(self, terms: np.ndarray, block: int) -> list[tuple[int, float]]:
        """Items of a block whose score for the distinct ``terms`` reaches their threshold."""
        low, high, theta = block * BLOCK, (block + 1) * BLOCK, float(self.block_theta[block])
        lists = []
        for t in terms[self.block_max[terms, block] > 0]:
            a, b = int(self.begin[t]), int(self.begin[t + 1])
            items = self.item[a:b]
            x, y = np.searchsorted(items, (low, high))
            if x < y:
                lists.append([items[x:y].tolist(), self.impact[a + x: a + y].tolist(), 0, float(self.block_max[t, block])])
        out = []
        while lists:
            lists.sort(key=lambda p: p[0][p[2]])
            bound, pivot = 0.0, None
            for p in lists:
                bound += p[3]
                if bound >= theta:
                    pivot = p[0][p[2]]
                    break
            if pivot is None:
                break
            if lists[0][0][lists[0][2]] == pivot:
                score = 0.0
                for p in lists:
                    if p[0][p[2]] == pivot:
                        score += p[1][p[2]]
                        p[2] += 1
                if score >= self.theta[pivot] * (1 - 1e-9):
                    out.append((pivot, score))
            else:
                for p in lists:
                    if p[0][p[2]] >= pivot:
                        break
                    while p[2] < len(p[0]) and p[0][p[2]] < pivot:
                        p[2] += 1
            lists = [p for p in lists if p[2] < len(p[0])]
        return out

    def search(self, h: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int, float, float, float]]:
        """(row, item, score, question overlap, answer overlap) for the words of some rows, in text order."""
        if not len(h) or not len(self.ids):
            return
        first = np.searchsorted(row, row, "left")
        seg = np.cumsum(np.concatenate(([0], (row[1:] != row[:-1]) | ((np.arange(1, len(row)) - first[1:]) % self.window == 0))))
        term = self.lookup(h)
        known = term >= 0
        if not known.any():
            return
        begin = np.concatenate((np.searchsorted(seg, np.arange(int(seg[-1]) + 2)), [len(seg)]))
        seg_row = row[begin[:-2]]
        follows = np.concatenate((seg_row[1:] == seg_row[:-1], [False]))
        # passage p is window p and, in the same row, window p + 1: its distinct terms
        own, t = seg[known], term[known]
        back = (own > 0) & follows[own - 1]
        key = np.unique(np.concatenate((own, own[back] - 1)) * len(self.terms) + np.concatenate((t, t[back])))
        s, t = key // len(self.terms), key % len(self.terms)
        starts = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        total = np.add.reduceat(self.block_max[t], starts, axis=0)
        for g, block in zip(*np.nonzero(total * np.float32(1.0001) >= self.block_theta), strict=True):
            p = int(s[starts[g]])
            lo, hi = begin[p], begin[p + 2] if follows[p] else begin[p + 1]
            grams = words = None
            for item, score in self.wand(t[starts[g]: starts[g + 1] if g + 1 < len(starts) else len(t)], int(block)):
                if grams is None:
                    words, grams = h[lo:hi], _grams(h[lo:hi])
                q, a = self.question[item], self.answer[item]
                if len(q) == 1:  # may be a short whole question: look for its words in a row
                    grams_q = np.union1d(grams, self._short(words, item))
                else:
                    grams_q = grams
                yield (int(seg_row[p]), item, score, float(np.isin(q, grams_q).mean()),
                       float(np.isin(a, words).mean()) if len(a) else 1.0)

    def _short(self, words: np.ndarray, item: int) -> np.ndarray:
        """Hashes of runs of 1 to 4 words, made as a short question's only shingle is."""
        out = []
        for n in range(1, SHINGLE):
            m = len(words) - n + 1
            if m > 0:
                g = words[:m].copy()
                for d in range(1, n):
                    g = g * tx.BASE + words[d: m + d]
                out.append(tx.mix(g * tx.BASE + np.uint64(n)))
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def parts_of(ids: list, texts: list[str], share: float, most: int) -> Iterator[bytes]:
    """Pickled indexes of at most ``most`` bytes each, or of one item."""
    todo = [(ids, texts)]
    while todo:
        ids, texts = todo.pop()
        blob = pickle.dumps(Index(ids, texts, share))
        if len(blob) <= most or len(ids) < 2:
            yield blob
            continue
        half = len(ids) // 2
        todo += [(ids[half:], texts[half:]), (ids[:half], texts[:half])]


def build_indexes(items: DataFrame, id_col: str, share: float, chunk_items: int, chunk_words: int, most: int) -> Iterator[bytes]:
    """Pickled indexes, chunk by chunk; a chunk's items and words are bounded by the parameters on average."""
    rows = items.select(F.col(id_col).alias("id"), F.lower(F.col("text").cast("string")).alias("text")).filter("text IS NOT NULL").withColumn(
        "n", F.size(F.split("text", r"\s+")))
    # items of like length share a chunk, so that one long item doesn't widen the passages of all
    rows = rows.withColumn("class", F.expr("CASE WHEN n <= 512 THEN 0 ELSE CAST(log2(n) AS INT) END"))
    sizes = rows.groupBy("class").agg(F.count(F.lit(1)).alias("items"), F.sum("n").alias("words")).take(64)
    for size in sorted(sizes):
        chunks = max(1, -(-size["items"] // chunk_items), -(-size["words"] // chunk_words))

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, texts = [], []
            for b in batches:
                ids += b.column(0).to_pylist()
                texts += b.column(1).to_pylist()
            if ids:
                for blob in parts_of(ids, texts, share, most):
                    yield pa.record_batch([pa.array([blob], pa.binary())], names=["index"])

        for c in range(chunks):
            some = rows.filter(F.col("class") == size["class"]).filter(F.expr(f"pmod(xxhash64(id, text), {chunks}) = {c}"))
            # a part holds at least one item
            for row in some.select("id", "text").repartition(1).mapInArrow(build, "index binary").take(size["items"]):
                yield bytes(row["index"])


def groups_of(blobs: Iterator[bytes], most: int) -> Iterator[list[bytes]]:
    """Runs of blobs that take at most ``most`` bytes together, or of one."""
    held, total = [], 0
    for blob in blobs:
        if held and total + len(blob) > most:
            yield held
            held, total = [], 0
        held.append(blob)
        total += len(blob)
    if held:
        yield held


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "item_id", share: float = 0.5, overlap: float = 0.8,
                 answer_overlap: float = 0.5, chunk_items: int = 1000, chunk_words: int = 100_000,
                 max_broadcast: int = 64 << 20) -> DataFrame:
    """doc_id, item_id, score (BM25), question_overlap, answer_overlap: every verified pair, once.

    An index takes at most ``max_broadcast`` bytes (or holds one item); as many as fit twice that share a pass over ``docs``.
    """
    spark, hits = docs.sparkSession, None
    kind = dict(items.dtypes)[id_col]
    for blobs in groups_of(build_indexes(items, id_col, share, chunk_items, chunk_words, max_broadcast), 2 * max_broadcast):
        held = [spark.sparkContext.broadcast(blob) for blob in blobs]

        def search(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            indexes = [pickle.loads(h.value) for h in held]
            for b in batches:
                data, at = tx.utf8(b.column(1))
                found = []
                for i, j in tx.slices(at):
                    h, row = word_hashes(data, at, i, j)
                    for index in indexes:
                        found += [(x[0], index.ids[x[1]], *x[2:]) for x in index.search(h, row) if x[3] >= overlap and x[4] >= answer_overlap]
                if found:
                    yield pa.RecordBatch.from_arrays([
                        b.column(0).take(pa.array([x[0] for x in found], pa.int64())), pa.array([x[1] for x in found]),
                        *[pa.array([float(x[c]) for x in found]) for c in (2, 3, 4)]],
                        names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        part = docs.select(F.col("doc_id").cast("long"), F.lower(F.col("text").cast("string")).alias("text")).mapInArrow(
            search, f"doc_id long, item_id {kind}, score double, question_overlap double, answer_overlap double")
        hits = part if hits is None else hits.unionAll(part)
    if hits is None:
        return spark.createDataFrame([], f"doc_id long, item_id {kind}, score double, question_overlap double, answer_overlap double")
    best = F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("best")
    return hits.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")

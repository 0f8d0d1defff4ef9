"""Token-ID store: texts as token ids in binary shard files, readable by document.

Shard file (little-endian):

    magic ``TOKSHRD1`` | dictionary sha256 (32 bytes) | id width (1 byte)
    one zstandard frame per document (its ids, compressed with the shared dictionary)
    index: per document  doc_id i64, null flag u8, offset u64, size u32, n_tokens u32
    footer: index offset u64, documents u64

One zstandard dictionary, trained on serialised id arrays of a bounded sample,
is shared by all shards; every document is its own frame, so one document is
read with one seek. Shards are written by tasks under attempt-unique names in
the shared folder; only the manifest (a table committed by Spark) says which
ones count, so a lost executor or a repeated task leaves at most an unused file.

Rows: a null or empty text is a document with the end id only; a null doc_id
sorts first; repeated doc_ids and equal rows are kept, ordered by text hash;
an empty table gives an empty manifest; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.operators.prefix import exclusive_prefix
from sensorlake.session import scratch_dir

MAGIC = b"TOKSHRD1"
HEAD = len(MAGIC) + 32 + 1
ENTRY = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("size", "<u4"), ("n", "<u4")])
FOOTER = "<QQ"
MANIFEST = "part long, path string, n_docs long, n_tokens long, bytes long, min_id long, max_id long"
#: a word of Latin letters with marks after it: word-level tokenizers encode the two parts apart
LETTERS_MARKS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-;=?@\[-`{}~]*)")


def byte_letters() -> dict[int, str]:
    """Code point -> the letters that byte-level models use for its UTF-8 bytes (Latin range).

    A byte that prints stands for itself; the others take the code points from 256 on, in byte order.
    """
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(prints)]
    letter = {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class WordEncoder:
    """ids of a text, word by word, for tokenizers that never join or see across white space.

    Each distinct word is tokenized once; words of letters and marks share the
    ids of their parts if the tokenizer keeps those apart (tried on a probe when it is loaded). A full table of ``keep`` known
    words becomes the older one, from which words that come again are taken over, so memory stays bounded and frequent words stay known.
    """

    def __init__(self, path: str, end_id: int, keep: int = 250_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        self.keep = keep
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}
        self.letters = byte_letters()
        probes = ("Thing", ""), ("thing", ","), ("Één", "##&"), ("großÜber", "!!"), ("a", ".")
        self.by_parts = all(self._plain(a + b) == self._letters(a.lower()) + self._plain(b) for a, b in probes)

    def _plain(self, word: str) -> bytes:
        return array(self.code, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: str) -> bytes:
        if not word.isascii():
            word = word.translate(self.letters)
        return array(self.code, [t.id for t in self.tokenizer.model.tokenize(word)]).tobytes()

    def _word(self, word: str) -> bytes:
        m = self.by_parts and LETTERS_MARKS.fullmatch(word)
        if not m:
            return self._plain(word)
        letters, marks = m[1].lower(), m[2]
        a = self.parts.get(letters)
        if a is None:
            a = self.parts[letters] = self._letters(letters)
        b = self.parts.get(marks)
        if b is None:
            b = self.parts[marks] = self._plain(marks)
        return a + b

    def encode(self, text: str | None) -> bytes:
        if not text:
            return self.end
        if len(self.known) > self.keep:
            self.older, self.known = self.known, {"": b""}
        if len(self.parts) > self.keep:
            self.parts.clear()
            self.parts[""] = b""
        known, words = self.known, text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        ids = list(map(known.get, words))
        if None in ids:
            for i, x in enumerate(ids):
                if x is None:
                    w = words[i]
                    if w not in known:
                        x = self.older.get(w)
                        known[w] = self._word(w) if x is None else x
                    ids[i] = known[w]
        ids.append(self.end)
        return b"".join(ids)


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> WordEncoder:
    """One per process: workers are reused by many tasks."""
    return WordEncoder(path, end_id)


@dataclass(frozen=True)
class TokenStore:
    """Where a store lives: its manifest table, its dictionary, its id width."""

    root: str
    dictionary: bytes
    width: int

    def manifest(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest")


def _at(path: str):
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def remove_file(path: str) -> None:
    fs, inner = _at(path)
    fs.delete_file(inner)


def open_file(path: str, mode: str):
    fs, inner = _at(path)
    if mode == "w":
        fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        return fs.open_output_stream(inner)
    return fs.open_input_file(inner)


def train_dictionary(docs: DataFrame, tokenizer_path: str, end_id: int, sample_docs: int, dict_bytes: int) -> bytes:
    """A dictionary from the id arrays of about ``sample_docs`` documents (chosen by a hash of doc_id and text, so that
    rows without an id, or with one id, are sampled like all others).

    The sample is bounded (at most twice ``sample_docs`` rows) and read in one task; too few samples give an empty dictionary.
    """
    n = docs.count()
    share = 1.0 if n <= sample_docs else sample_docs / n
    some = docs.filter(F.expr(f"pmod(xxhash64(doc_id, text), 1000000) < {int(share * 1_000_000) or 1}")).select("text").limit(2 * sample_docs)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        enc, arrays, left = encoder(tokenizer_path, end_id), [], 64 * dict_bytes
        for b in batches:
            for text in b.column(0):
                arrays.append(enc.encode(text.as_py())[:dict_bytes])
                left -= len(arrays[-1])
                if left < 0:
                    break
        try:
            data = zstandard.train_dictionary(dict_bytes, arrays).as_bytes() if len(arrays) >= 16 else b""
        except zstandard.ZstdError:  # samples too few or too alike for the trainer: no dictionary
            data = b""
        yield pa.record_batch([pa.array([data], pa.binary())], names=["data"])

    row = some.repartition(1).mapInArrow(train, "data binary").first()
    return bytes(row["data"]) if row else b""


def write_store(docs: DataFrame, tokenizer_path: str, end_id: int, root: str | None = None,
                sample_docs: int = 2000, dict_bytes: int = 64 << 10, level: int = 3) -> TokenStore:
    """Encode ``docs`` (doc_id, text) into shards ordered by doc_id; returns the store.

    The order is a range partitioning on (doc_id, text hash, row number), so one hot id, and
    very many equal rows, are split too; each range becomes one shard.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    root = root or scratch_dir(spark, "tokens")
    dictionary = train_dictionary(docs, tokenizer_path, end_id, sample_docs, dict_bytes)
    digest = hashlib.sha256(dictionary).digest()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        enc = encoder(tokenizer_path, end_id)
        packer = zstandard.ZstdCompressor(
            level=level, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        part, out, index, at, path = TaskContext.get().partitionId(), None, [], HEAD, ""
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                path = f"{root}/shards/part-{part:06d}-{uuid.uuid4().hex}.tok"
                out = open_file(path, "w")
                out.write(MAGIC + digest + bytes([enc.dtype.itemsize]))
            for i, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                raw = enc.encode(text.as_py())
                frame = packer.compress(raw)
                out.write(frame)
                index.append((i or 0, i is None, at, len(frame), len(raw) // enc.dtype.itemsize))
                at += len(frame)
        if out is None:
            return
        table = np.array(index, ENTRY)
        out.write(table.tobytes())
        out.write(struct.pack(FOOTER, at, len(table)))
        out.close()
        real = [x for x in index if not x[1]]
        yield pa.RecordBatch.from_pylist([{
            "part": part, "path": path, "n_docs": len(table), "n_tokens": int(table["n"].sum(dtype=np.int64)),
            "bytes": at, "min_id": real[0][0] if real else None, "max_id": real[-1][0] if real else None}],
            schema=pa.schema([("part", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
                              ("bytes", pa.int64()), ("min_id", pa.int64()), ("max_id", pa.int64())]))

    keyed = docs.withColumns({"h": F.xxhash64("text"), "at": F.monotonically_increasing_id()})
    (keyed.repartitionByRange("doc_id", "h", "at").sortWithinPartitions("doc_id", "h", "at").select("doc_id", "text")
     .mapInArrow(write, MANIFEST).write.parquet(f"{root}/manifest"))
    width = encoder(tokenizer_path, end_id).dtype.itemsize
    return TokenStore(root, dictionary, width)


def read_index(path: str, dictionary: bytes):
    """(open file, index array, id width) of a shard whose dictionary hash matches."""
    f = open_file(path, "r")
    head = f.read_at(HEAD, 0)
    if head[:8] != MAGIC or head[8:40] != hashlib.sha256(dictionary).digest():
        raise ValueError(f"{path}: not a shard of this store (magic or dictionary hash differs)")
    at, n = struct.unpack(FOOTER, f.read_at(16, f.size() - 16))
    return f, np.frombuffer(f.read_at(n * ENTRY.itemsize, at), ENTRY), head[40]


def _unpacker(dictionary: bytes):
    import zstandard

    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def scan_store(spark: SparkSession, store: TokenStore) -> DataFrame:
    """Read every shard back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    shards = exclusive_prefix(store.manifest(spark), "part", {"n_tokens": "sum"})
    shards = shards.select("path", F.coalesce("prev_n_tokens", F.lit(0)).cast("long").alias("start"))
    dictionary, tasks = store.dictionary, max(1, spark.sparkContext.defaultParallelism)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = _unpacker(dictionary)
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                f, index, width = read_index(path, dictionary)
                for k in range(0, len(index), 512):
                    some = index[k: k + 512]
                    lo = int(some["offset"][0])
                    block = f.read_at(int(some["offset"][-1]) + int(some["size"][-1]) - lo, lo)
                    crc = [zlib.crc32(np.frombuffer(unpack.decompress(block[int(o) - lo: int(o) - lo + int(s)]), f"<u{width}")
                                      .astype("<u4").tobytes()) for o, s in zip(some["offset"], some["size"], strict=True)]
                    n = some["n"].astype(np.int64)
                    begin = start + np.cumsum(n) - n
                    start += int(n.sum())
                    yield pa.record_batch([pa.array(some["doc_id"], mask=some["null"].astype(bool)), pa.array(begin),
                                           pa.array(n), pa.array(np.array(crc, np.int64))],
                                          names=["doc_id", "start", "n_tokens", "ids_crc32"])
                f.close()

    # every shard is one range of a partition: hash its path over the tasks
    return shards.repartition(4 * tasks, "path").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch(spark: SparkSession, store: TokenStore, wanted: DataFrame) -> DataFrame:
    """ids of the wanted doc_ids (one column doc_id): only their shards' indexes and frames are read."""
    near = store.manifest(spark).join(wanted.select(F.col("doc_id").cast("long")).distinct(),
                                      F.expr("doc_id BETWEEN min_id AND max_id")).groupBy("path").agg(
        F.collect_list("doc_id").alias("ids"))
    dictionary = store.dictionary

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = _unpacker(dictionary)
        for b in batches:
            for path, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                f, index, width = read_index(path, dictionary)
                for e in index[np.isin(index["doc_id"], ids) & (index["null"] == 0)]:
                    raw = unpack.decompress(f.read_at(int(e["size"]), int(e["offset"])))
                    yield pa.record_batch([pa.array([int(e["doc_id"])]), pa.array(
                        [np.frombuffer(raw, f"<u{width}").astype(np.int64)], pa.list_(pa.int64()))], names=["doc_id", "ids"])
                f.close()

    return near.mapInArrow(read, "doc_id long, ids array<long>")

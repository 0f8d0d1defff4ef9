import zlib

import numpy as np
import public_tokenizers
import pytest

from sensorlake.llm import token_store as ts

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute(rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATH)
    start, out = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def check(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, path string")
    store = ts.write_store(df.repartition(3), PATH, 1, **kw)
    got = sorted([tuple(r) for r in ts.scan_store(spark, store).collect()], key=lambda r: r[1])
    assert got == brute(rows)
    return store


def test_edge_rows(spark):
    rows = [(5, None), (1, ""), (2, "a  b\tc\r\nd\x0be\x0cf\x1cg h i\u0085j"), (3, "<|endoftext|>x<|startoftext|> y"),
            (9, "É́ ́a ΑΣ Σ it's I'LL don't 12 3,4!!! \x00"), (7, "word " * 20000), (8, "x" * 5000), (None, "no id")]
    store = check(spark, rows, sample_docs=4)
    assert store.dictionary == b""
    ids = {r["doc_id"]: r["ids"] for r in ts.fetch(spark, store, spark.createDataFrame([(7,), (1,), (77,)], "doc_id long")).collect()}
    assert set(ids) == {1, 7} and ids[1] == [1] and len(ids[7]) == 20001


def test_repeated_rows_and_empty_table(spark):
    check(spark, [(4, "same text")] * 5 + [(1, "other")])
    check(spark, [])


def test_shared_dictionary_and_hash(spark):
    rows = [(i, f"some words of document {i} that repeat in every short document {i % 7}") for i in range(300)]
    store = check(spark, rows, dict_bytes=4096)
    assert store.dictionary
    path = store.manifest(spark).first()["path"]
    with pytest.raises(ValueError):
        ts.read_index(path, b"another dictionary")


def test_rows_without_ids_are_sampled_too(spark):
    df = spark.createDataFrame([(None, f"some words of document {i} that repeat in every short document {i % 7}") for i in range(300)], "doc_id long, text string")
    store = ts.write_store(df, PATH, 1, dict_bytes=4096)
    assert store.dictionary and ts.scan_store(spark, store).count() == 300


def test_words_taken_over_from_the_older_table():
    enc, plain = ts.WordEncoder(PATH, 1, keep=5), ts.WordEncoder(PATH, 1)
    for i in range(60):
        text = " ".join(f"word{(i * j) % 11}" + "abcdefghijk"[j] for j in range(8)) + f" only{i}\tthis"
        assert enc.encode(text) == plain.encode(text)
    assert len(enc.known) <= 20 and enc.older


def test_query_on_documents(spark):
    from sensorlake.llm.queries import op1_token_store

    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted([tuple(r) for r in op1_token_store(spark, sf).collect()]) == sorted(brute(rows))

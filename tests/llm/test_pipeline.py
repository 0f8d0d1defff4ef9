import re

import corpus_pipeline as cp
import test_chosen_path as near
import test_decontaminate as bench
import test_pii as private
import test_quality_rules as quality

from sensorlake.llm import pii
from sensorlake.llm import quality_rules as qr

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def features(text):
    n, word_chars, symbols, dup, repeat, failed = quality.brute(text)
    w = quality.WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if quality.WORD.search(x)]
    count = lambda p: len(re.findall(p, text or ""))
    d, chars, k = max(n, 1), max(word_chars, 1), max(len(lines), 1)
    return failed, {"mean_word": word_chars / d, "symbols_per_word": symbols / d, "dup_line_share": dup / k, "repeat_share": repeat / d,
                    "upper_share": count("[A-Z]") / chars, "digit_share": count("[0-9]") / chars, "distinct_share": len(set(w)) / d,
                    "words_per_line": n / k, "stop_marks": count("[.!?]") / d, "n_words": float(n)}


def masked(text):
    spans = sorted((s, -e, k) for k, group in enumerate(private.brute(text)) for s, e in group)
    out, at = "", 0
    for s, e, k in spans:
        if s >= at:
            out += text[at:s] + f"[{pii.KINDS[k].upper()}]"
        at = max(at, -e)
    return text if not spans else out + text[at:]


def test_run_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rules = qr.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    kept = []
    for i, t in rows:
        failed, f = features(t)
        if not failed and not any(x.covers(f) for x in rules):
            kept.append((i, t))
    assert 0 < len(kept) < len(rows)
    first = {d for d, _, c in near.brute(kept, 5) if d == c}
    kept = [r for r in kept if r[0] in first]
    hit = {d for d, _ in bench.brute(kept, [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])}
    assert hit
    kept = [r for r in kept if r[0] not in hit]
    want = sorted((i, len(re.findall(r"[^\x20\x09-\x0D]+", masked(t))) + 1) for i, t in kept)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in cp.run(spark, sf).collect()) == want


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


def test_stages_on_awkward_rows(spark):
    sf = "/root/testdata/sf0.001"
    text = " ".join(f"word{i}" for i in range(80))
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first()["text"]
    rows = [(1, text), (1, text), (2, text), (None, text), (None, "alone " + text[::-1]), (None, "alone " + text[::-1]), (3, None), (4, ""), (4, ""),
            (5, "mail a@b.cd"), (5, "other " * 9), (None, item + " more")]
    stages = dict(cp.STAGES)
    docs = frame(spark, rows)
    for name, f in cp.STAGES[:-1]:
        assert f(spark, docs, sf).columns == COLUMNS, name
        assert f(spark, frame(spark, []), sf).collect() == [], name
    assert cp.STAGES[-1][1](spark, frame(spark, []), sf).collect() == []
    near_kept = [(r["doc_id"], r["text"]) for r in stages["near_duplicates"](spark, docs, sf).collect()]
    assert sorted(near_kept, key=str) == sorted([(1, text), (None, "alone " + text[::-1]), (3, None), (4, ""), (5, "mail a@b.cd"), (5, "other " * 9), (None, item + " more")], key=str)
    clean = [(r["doc_id"], r["text"]) for r in stages["decontamination"](spark, docs, sf).collect()]
    assert sorted(clean, key=str) == sorted(rows[:-1], key=str)
    out = {r["text"]: r["n_chars"] for r in stages["pii"](spark, docs, sf).collect()}
    assert out["mail [EMAIL]"] == 12 and None in out and "mail a@b.cd" not in out
    kept = [r["text"] for r in stages["quality_rules"](spark, docs, sf).collect()]
    assert kept.count(text) == 4 and "" not in kept and None not in kept


def test_stage_names_and_oracle():
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "pii", "packing"] and cp.ORACLE_SQL is None


def test_clashing_columns_stay_as_they_are(spark):
    """Columns named like the stages' own helpers pass through, and none of them brings text back."""
    from pyspark.sql import functions as F

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = ["p_text", "P_spans", "p_cands", "_key", "_q_n_words", "q_n_words", "key", "root", "n"]
    more = docs.withColumns({c: F.lit(f"own {c}") for c in names})
    mail = docs.limit(1).withColumns({"text": F.lit("write to some.body@example.org now"), "doc_id": F.lit(10**9).cast("long")})
    plain = {}
    for table, extra in ((docs.unionByName(mail), []), (more.unionByName(mail, allowMissingColumns=True), names)):
        for stage, run in cp.STAGES[:-1]:
            out = run(spark, table, sf)
            assert out.columns == table.columns
            rows = out.collect()
            got = sorted(((r.doc_id, r.text) for r in rows), key=str)
            assert plain.setdefault(stage, got) == got
            assert all(r[c] in (f"own {c}", None) for r in rows for c in extra)
    assert (10**9, "write to [EMAIL] now") in plain["pii"]

import hashlib
import re

import pytest

from sensorlake.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        s += x - 9 * (x > 9)
    return s % 10 == 0


def brute(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    return [
        [m.span() for m in EMAIL.finditer(text)],
        [m.span() for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))],
        [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
        [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15],
    ]


EDGE = [
    None, "", "no data here", "a@b.c", "x a.b+c%d@e-f.g.h. y", "a@b.cd_e@f.g", "a@b.c..d@e.f", "@b.c a@ a@b", "é user@mäil.com u@mail.com\U0001f600 z@q.r",
    "1.2.3.4.5.6.7.8", "999.1.1.1 1.1.1.1", "0001.0255.3.4", "256.1.1.1.1.1", "1.2.3", "12345678901234567890.1.2.3 x",
    "4111 1111 1111 1111", "4111-1111-1111-1111, 4111  1111 1111 1111", "4111111111111112", "4111111111111111 4111111111111111", "0" * 13, "0" * 20,
    "+1 (743) 555-3824", "+1 (743) 555-3824 +44.20.7946.0958", "+ 1 2", "+1", "+12", "+123456789", "++123456789+987654321", "+1234567890123456 x", "call +1 (743) 555-3824%%% now",
    "+4111111111111111 and 10.0.0.1 +5", "743 555 3824 or (743) 555-3824", "joe (at) mail (dot) com", "1-2-3-4-5-6-7-8-9-0-1-2-3-4",
    "7" * 30000, "a" * 60000 + "@b.c", "+ " * 5000, "1 " * 20000, "a.a@" * 5000, "x@y" + ".z" * 20000, ("9" * 16 + " ") * 300,
]


def rows_of(spark, texts, model=None):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in pii.find(df).collect()}


def check(got, texts):
    for i, t in enumerate(texts):
        want, r = brute(t), got[i]
        joined = ",".join(f"{k}:{s}:{e}" for k, spans in zip(pii.KINDS, want, strict=True) for s, e in spans)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [len(x) for x in want], (t or "")[:60]
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), (t or "")[:60]
        assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))


def test_base_spans_match_brute_force(spark):
    check(rows_of(spark, EDGE), EDGE)
    assert rows_of(spark, []) == {}


def test_on_documents_and_clean_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()
    got = rows_of(spark, [r["text"] for r in docs])
    check(got, [r["text"] for r in docs])
    clean = [i for i, r in enumerate(docs) if not re.search("[0-9@]", r["text"])]
    assert clean and all(got[i]["spans"] == "" for i in clean)


def test_trees_and_threshold():
    blank = dict.fromkeys(pii.BINS, 0)
    rows = [(blank | {"digits": d, "before": b}, int(d > 10 and b == 1), 20) for d in range(20) for b in range(4)]
    trees = pii.Trees(rounds=40).fit(rows)
    assert all((trees.score(x) > 0) == bool(y) for x, y, _ in rows)
    assert pii.threshold([(3.0, 1, 9), (2.0, 1, 1), (1.0, 0, 5)], 0.98) == 2.0
    assert pii.threshold([(3.0, 0, 9)], 0.98) is None


def test_model_expression_equals_the_trees(spark):
    blank = dict.fromkeys(pii.BINS, 0)
    rows = [(blank | {"digits": d, "spaces": s}, int(d == 10 and s > 0), 20) for d in range(20) for s in range(4)]
    trees = pii.Trees().fit(rows)
    df = spark.createDataFrame([(1, "call 743 555 3824 or 743-555-3824 now, mail a@b.cd")], "doc_id long, text string")
    r = pii.with_spans(df, {"phone": pii.Scorer(trees, 0.0)}).first()
    assert [(x["k"], x["s"], x["e"]) for x in r["p_spans"]] == [(0, 44, 50), (3, 5, 17)]


@pytest.mark.parametrize(("text", "want"), [
    ("mail a@b.cd, ip 1.2.3.4!", "mail [EMAIL], ip [IP]!"), ("é +1 (743) 555-3824 ü", "é [PHONE] ü"), ("none", "none"), (None, None), ("", ""),
    ("+4111111111111111", "[CARD]"), ("4111111111111111", "[CARD]")])
def test_redact(spark, text, want):
    out = pii.redact(spark.createDataFrame([(1, text, "k")], "doc_id long, text string, spans string")).first()
    assert out["spans"] == "k"
    if text == "+4111111111111111":  # 16 digits: no phone; the card lies inside
        want = "+[CARD]"
    assert out["text"] == want


def test_training_ignores_proposals_over_base_spans(spark):
    card, bad = "4111111111111111", "4111111111111112"
    rows = [(i, f"pay {card} now" if i % 2 else f"id {bad}x") for i in range(200)]
    model = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    assert set(model) == {"card"}  # valid and failing matches tell apart by what follows
    out = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all((r["spans"] != "") == (r["doc_id"] % 2 == 1) for r in out)


def test_masked_emails_local_phones_and_dotted_cards_are_added(spark):
    rows = []
    for i in range(240):
        rows.append((i, [
            f"write to u{i}x@mail.com or u{i}x (at) mail (dot) com. Then wait",
            f"call +1 (743) 555-3{i:03} or 743 555 3{i:03} today",
            f"order 48213{i} of version 1.{i}.3 costs 12.50 at 3 (at) 4.50 each",
            "pay 4111111111111111 or 4111.1111.1111.1111 but not 4111.1111.1111.1112 here",
            "ring 743 555 9123 now, not 012 555 9123 or 48213",
        ][i % 5]))
    out = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {0: ["u{i}x@mail.com", "u{i}x (at) mail (dot) com"], 1: ["+1 (743) 555-3{i:03}", "743 555 3{i:03}"], 2: [],
            3: ["4111111111111111", "4111.1111.1111.1111"], 4: ["743 555 9123"]}
    texts = dict(rows)
    for r in out:
        i = r["doc_id"]
        got = [texts[i][int(s): int(e)] for _, s, e in (x.split(":") for x in r["spans"].split(",") if x)]
        assert sorted(got) == sorted(w.format(i=i) for w in want[i % 5])


def luhn_number(n, good):
    """16 digits beginning with ``n`` that pass the check digit, or miss it by one."""
    for d in range(10):
        if luhn(f"4{n:014}{d}"):
            return f"4{n:014}{d if good else (d + 1) % 10}"


def dotted(number):
    return ".".join(number[i: i + 4] for i in range(0, 16, 4))


def test_the_check_is_no_feature_and_context_refuses_valid_numbers(spark):
    assert not any("c.ok" in e or "c.base" in e or "c.wide" in e for e, _ in pii.FEATURES.values())
    rows = []
    for i in range(600):  # one order number in ten passes the check digit by chance
        rows.append((i, f"pay with card {dotted(luhn_number(i, True))} today" if i % 3 == 0 else f"order number {dotted(luhn_number(i, i % 30 == 1))} shipped"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(df)
    assert set(model["card"].words) >= {"card", "number"} and model["card"].words["card"] > 0 > model["card"].words["order"]
    assert {f for f, _, _ in model["card"].trees.trees} & {"cue"}
    got = {r["doc_id"]: r["spans"] for r in pii.find(df).collect()}
    assert all((got[i] != "") == (i % 3 == 0) for i in got)


def test_trees_use_format_and_context_where_both_tell():
    blank = dict.fromkeys(pii.BINS, 0)
    rows = [(blank | {"digits": 16, "cue": 8, "after": 1}, 1, 50), (blank | {"digits": 8, "cue": 0, "after": 2}, 0, 50)]
    used = {f for f, _, _ in pii.Trees().fit(rows).trees}
    assert {"digits", "cue"} <= used


def test_masked_emails_and_marked_addresses_without_anything_wrong(spark):
    rows = [(i, f"write to ann{i}@mail.com" if i % 2 else f"or to ann{i} (at) mail (dot) com, host 10.0.0.{i}, then 10[.]1[.]2[.]{i}") for i in range(120)]
    got = {r["doc_id"]: r["spans"].split(",") for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        found = [text[int(s): int(e)] for _, s, e in (x.split(":") for x in got[i])]
        assert found == ([f"ann{i}@mail.com"] if i % 2 else [f"ann{i} (at) mail (dot) com", f"10.0.0.{i}", f"10[.]1[.]2[.]{i}"])


def test_handles_and_marked_numbers_above_255_stay(spark):
    rows = [(i, ["mail a@b.cd or ask @joe and joe@home", "see 10[.]0[.]0[.]300 and 1[.]2[.]3", "ip 10.0.0.1 x"][i % 3]) for i in range(90)]
    got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == ["email:5:11", "", "ip:3:11"][i % 3] for i in got)


def test_null_ids_teach_too(spark):
    rows = [(None, f"write to ann{i}@mail.com or ann{i} [at] mail [dot] com") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert "email" in pii.fit(df, sample_docs=100)
    assert all(r["spans"].count("email") == 2 for r in pii.find(df, sample_docs=100).collect())


def test_every_text_teaches(spark):
    """Masked e-mails that a sample of 20,000 texts by that hash would not meet are learned and found."""
    n, some = 30_000, "concat('write to ann', id, '@mail.com or ann', id, ' (at) mail (dot) com')"
    outside = f"pmod(xxhash64(id, {some}), 1000000) >= {1_000_000 * 20_000 // n} AND id % 40 = 0"
    df = spark.range(n).selectExpr("id AS doc_id", f"CASE WHEN {outside} THEN {some} ELSE 'nothing here' END AS text")
    got = pii.find(df).filter("spans != ''").collect()
    assert len(got) > 150 and all(r["spans"].count("email") == 2 for r in got)


def test_trees_from_sums_equal_those_from_rows(spark):
    told = [({f: (i * (j + 3) + i // 7) % b for j, (f, b) in enumerate(pii.BINS.items())}, int(i * 13 % 50 < 20 + i % 24), 1 + i % 3) for i in range(400)]
    names = ", ".join(pii.BINS)
    flat = spark.createDataFrame([("card", bool(y), 4 * n, *x.values()) for x, y, n in told],
                                 "kind string, ok boolean, w long, " + ", ".join(f"{f} int" for f in pii.BINS))
    got = pii.fit_trees(flat.selectExpr("kind", "ok", f"struct({names}) AS f", "w"))
    want = pii.Trees().fit(told)
    assert set(got) == {"card"} and len(want.trees) > 10
    assert all(abs(got["card"].score(x) - want.score(x)) < 1e-4 for x, _, _ in told)


def test_repeated_candidates_and_many_forms_all_count(spark, monkeypatch):
    """Every candidate counts once, however often its features or its number occur."""
    seen = []
    trees = pii.fit_trees
    monkeypatch.setattr(pii, "fit_trees", lambda v: seen.append(v.selectExpr("sum(w) / 4").first()[0]) or trees(v))
    rows = [(i, f"ip 10.0.0.{i % 250} x") for i in range(400)] + [(7, "call +1 743 555 3824 or 743 555 3824")] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string")
    pii.fit(df)
    held = {r["n"]: r["k"] for r in df.selectExpr("pmod(xxhash64(coalesce(doc_id, -1), text, 5), 4) = 0 AS h", "text").groupBy("h").agg(
        pii.F.expr("struct(count_if(text LIKE 'ip%') AS a, count_if(text LIKE 'call%') AS b)").alias("k")).selectExpr("h AS n", "k").collect()}
    assert seen == [1.25 * (held[False]["a"] + 2 * held[False]["b"])]

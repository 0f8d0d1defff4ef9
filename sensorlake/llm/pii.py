"""Personal data spans: high-recall candidates, boosted trees, calibrated thresholds; native expressions only.

Base spans (e-mail, IP, card, phone) come from fixed patterns with their checks
and always stay. Wider generators propose more, overlapping spans; boosted
trees, trained on the candidates of all texts, score them by format and context, and
those above a threshold that holds ``precision`` on the calibration part are added if they are valid in plain form.
Labels come from what the features do not show. Valid for training are base spans and proposals whose plain form passes its check: an
e-mail with (at) and (dot) undone whose last label is a word, an address with its marks undone, a card with its check digit, a phone
equal to the national part of a valid one. Wrong are those that fail the checks, names with @ but no domain, and plain or dotted numbers;
other local phones are not trained on. The check itself is no feature: a number that passes it by chance among others
of its format and context that fail is refused. Context are the characters beside a candidate and its cue: the summed log odds
of up to four words between the last digit and it, learned from the candidates.
A kind of which the texts hold nothing wrong has a model without splits, which admits what is valid in plain form.

Training counts all candidates by their (binned) features. In each round Spark adds up the gradients by every two
features; the driver sees these sums, whose number the bins bound, and picks the splits. Thresholds come from counts by score,
on a grid. The model becomes a sum of CASE expressions.

Patterns use possessive loops, which match the same spans as the plain form
here and neither recurse nor backtrack on very long texts. Numbers are looked for only in
maximal runs of digits and the marks that may join them.

Rows: a null or empty text has no spans; equal rows and repeated doc_ids give equal
rows; an empty table gives an empty result and no model. Columns that clash with the
results are not read by ``find``; ``redact`` keeps every other column as it is.
"""

from __future__ import annotations

import math
from itertools import combinations
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.tables import free_prefix, stored

KINDS = ("email", "ip", "card", "phone")
#: fixed by the query's contract (possessive forms)
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: runs that can hold any of the last three
RUN = r"\+?[0-9][\x20().+0-9-]{6,}"
#: wider generators
MASKED = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:(?:\x20?(?:\(dot\)|\[dot\])\x20?|\.)[A-Za-z0-9-]++)++"
LOCAL_PHONE = r"(?<![0-9+])[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
#: numbers that are mostly something else: the trees learn from them what sets the others apart
NUMBER = r"(?<![0-9])[0-9]{4,12}(?![0-9])"
HANDLE = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?!\.[A-Za-z0-9-])"
DOTTED = r"(?<![0-9.])[0-9]++\.[0-9]++(?:\.[0-9]++)?+(?![0-9.])"
LOOSE_CARD = r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){12,18}(?![0-9])"
#: an IP address whose dots are marked
MARKED_IP = r"(?<![0-9.])[0-9]{1,3}+(?:(?:\[\.\]|\(\.\)|\x20?\(dot\)\x20?|\x20?\[dot\]\x20?|\.)[0-9]{1,3}+){3}(?![0-9])"

SPAN = "ARRAY<STRUCT<s: INT, e: INT, m: STRING>>"
#: a masked e-mail in plain form, and area and exchange of a local phone
PLAIN_EMAIL = r"^[A-Za-z0-9._%+-]*[A-Za-z][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"
PLAIN_PHONE = r"^[2-9][0-9]{2}[2-9][0-9]{6}$"
#: name -> (expression over candidate ``c``, number of bins); all expressions give 0 .. bins - 1
FEATURES = {
    "digits": ("CAST(least(length(regexp_replace(c.m, '[^0-9]', '')), 23) AS INT)", 24),
    "groups": ("CAST(least(size(split(c.m, '[^0-9A-Za-z]+')), 7) AS INT)", 8),
    "spaces": ("CAST(least(length(c.m) - length(replace(c.m, ' ', '')), 3) AS INT)", 4),
    "before": ("CASE WHEN c.b = '' THEN 0 WHEN c.b RLIKE '[\\\\x20\\\\x09-\\\\x0D]' THEN 1 WHEN c.b RLIKE '[A-Za-z0-9]' THEN 2 ELSE 3 END", 4),
    "after": ("CASE WHEN c.a = '' THEN 0 WHEN c.a RLIKE '[\\\\x20\\\\x09-\\\\x0D]' THEN 1 WHEN c.a RLIKE '[A-Za-z0-9]' THEN 2 ELSE 3 END", 4),
    "first": ("CASE WHEN left(c.m, 1) RLIKE '[0-9]' THEN CAST(left(c.m, 1) AS INT) WHEN left(c.m, 1) = '+' THEN 10 ELSE 11 END", 12),
    "dots": ("CAST(least(length(c.m) - length(replace(c.m, '.', '')), 4) AS INT)", 5),
}
#: code points of context before a candidate, words of it, and the bins of their summed log odds
CONTEXT, WORDS, CUES = 40, 4, 9
#: points of the grid of scores, -30 to 30 in thousandths
GRID = 60_001
BINS = {f: bins for f, (_, bins) in FEATURES.items()} | {"cue": CUES}


def _lit(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\") + "'"


def _spans(text: str, pattern: str, base: str = "0") -> str:
    """SQL: all matches with code point positions, from the pieces between them."""
    pieces = (f"zip_with(split({text}, {_lit(pattern)}, -1), regexp_extract_all({text}, {_lit(pattern)}, 0), "
              "(g, m) -> struct(g AS g, m AS m))")
    return (f"aggregate({pieces}, struct(CAST({base} AS INT) AS at, CAST(array() AS {SPAN}) AS out), (a, z) -> "
            "CASE WHEN z.m IS NULL THEN a ELSE struct(a.at + length(z.g) + length(z.m) AS at, "
            "concat(a.out, array(struct(a.at + length(z.g) AS s, a.at + length(z.g) + length(z.m) AS e, z.m AS m))) AS out) END, a -> a.out)")


def _digits(m: str) -> str:
    return f"length(regexp_replace({m}, '[^0-9]', ''))"


def _luhn(m: str) -> str:
    d = f"reverse(regexp_replace({m}, '[^0-9]', ''))"
    x = "CAST(y AS INT)"
    return (f"aggregate(split({d}, ''), struct(0 AS sum, 0 AS i), (a, y) -> CASE WHEN y = '' THEN a ELSE struct("
            f"a.sum + CASE WHEN a.i % 2 = 0 THEN {x} ELSE 2 * {x} - CASE WHEN {x} > 4 THEN 9 ELSE 0 END END AS sum, a.i + 1 AS i) END, a -> a.sum % 10 = 0)")


CHECKS = {
    "email": "true",
    "ip": "forall(split(x.m, '[.]'), p -> length(trim(LEADING '0' FROM p)) <= 3 AND coalesce(try_cast(trim(LEADING '0' FROM p) AS INT), 0) <= 255)",
    "card": f"{_digits('x.m')} BETWEEN 13 AND 19 AND {_luhn('x.m')}",
    "phone": f"{_digits('x.m')} BETWEEN 9 AND 15",
    "masked": f"regexp_replace(regexp_replace(regexp_replace(x.m, '[(\\\\[]at[)\\\\]]', '@'), '[(\\\\[]dot[)\\\\]]', '.'), ' ', '') RLIKE {_lit(PLAIN_EMAIL)}",
    "marked": "forall(split(regexp_replace(x.m, '[^0-9]+', '.'), '[.]'), p -> CAST(p AS INT) <= 255)",
    "local": f"regexp_replace(x.m, '[^0-9]', '') RLIKE {_lit(PLAIN_PHONE)}",
}


def with_candidates(docs: DataFrame, text: str = "text", prefix: str = "p_") -> DataFrame:
    """Adds ``<prefix>cands``: struct(kind, s, e, m, b, a, l, base, wide, ok) for every match.

    ``b`` and ``a`` are the characters beside it, ``l`` the text before it; ``base`` marks valid base spans, ``wide`` the generator of a proposal (or ''), ``ok`` what passes the check in plain form.
    """
    p = prefix
    keep = [F.col(f"`{c}`") for c in docs.columns]
    df = docs.withColumn(f"{p}text", F.expr(f"coalesce(CAST(`{text}` AS STRING), '')"))
    df = df.withColumn(f"{p}runs", F.expr(f"CASE WHEN {p}text RLIKE {_lit(RUN)} THEN {_spans(p + 'text', RUN)} ELSE CAST(array() AS {SPAN}) END"))

    def tagged(spans: str, kind: str, check: str, wide: str = "") -> str:
        base = "false" if wide else check
        return (f"transform({spans}, x -> struct('{kind}' AS kind, x.s AS s, x.e AS e, x.m AS m, {base} AS base, '{wide}' AS wide, "
                f"{check} AS ok))")

    def in_runs(pattern: str, kind: str, check: str, wide: str = "") -> str:
        return tagged(f"flatten(transform({p}runs, r -> {_spans('r.m', pattern, 'r.s')}))", kind, check, wide)

    parts = [
        f"CASE WHEN instr({p}text, '@') > 0 THEN {tagged(_spans(p + 'text', EMAIL), 'email', 'true')} END",
        f"CASE WHEN instr({p}text, '(at)') > 0 OR instr({p}text, '[at]') > 0 THEN {tagged(_spans(p + 'text', MASKED), 'email', CHECKS['masked'], 'masked')} END",
        f"CASE WHEN instr({p}text, '@') > 0 THEN {tagged(_spans(p + 'text', HANDLE), 'email', 'false', 'handle')} END",
        f"CASE WHEN {p}text RLIKE '[0-9](\\\\[\\\\.|\\\\(\\\\.| ?[(\\\\[]dot)' THEN {tagged(_spans(p + 'text', MARKED_IP), 'ip', CHECKS['marked'], 'marked')} END",
        *[f"CASE WHEN {p}text RLIKE {_lit(pattern)} THEN {tagged(_spans(p + 'text', pattern), kind, 'false', 'number')} END"
          for pattern, kind in ((NUMBER, "card"), (DOTTED, "ip"))],
        *[f"CASE WHEN size({p}runs) > 0 THEN {in_runs(*how)} END" for how in (
            (IP, "ip", CHECKS["ip"]), (CARD, "card", CHECKS["card"]), (LOOSE_CARD, "card", CHECKS["card"], "loose"),
            (PHONE, "phone", CHECKS["phone"]), (LOCAL_PHONE, "phone", CHECKS["local"], "local"))],
    ]
    df = df.withColumn(f"{p}found", F.expr(f"flatten(filter(array({', '.join(parts)}), x -> x IS NOT NULL))"))
    left = f"least(x.s, {CONTEXT})"
    # one walk through the text for a candidate's surroundings, which hold the rest
    near = (f"transform({p}found, x -> struct(x.kind AS kind, x.s AS s, x.e AS e, x.m AS m, x.base AS base, x.wide AS wide, x.ok AS ok, "
            f"substring({p}text, x.s - {left} + 1, {left} + x.e - x.s + 1) AS near))")
    cands = (f"transform({near}, x -> struct(x.kind AS kind, x.s AS s, x.e AS e, x.m AS m, CASE WHEN x.s > 0 THEN substring(x.near, {left}, 1) ELSE '' END AS b, "
             f"substring(x.near, {left} + x.e - x.s + 1, 1) AS a, substring(x.near, 1, {left}) AS l, x.base AS base, x.wide AS wide, x.ok AS ok))")
    # a generator: later filters are not pushed below it, which would repeat the matching
    return df.select(*keep, F.expr(f"inline(array(struct({cands} AS {p}cands)))"))


# --- boosted trees over a table of feature counts -----------------------------------------------------------------


class Trees:
    """Depth-2 trees on binned features, fitted to counts of (features, label) by logistic loss.

    Every round leaves out a third of the features in turn, so that several that tell the same all have a say.
    A round needs its gradients only as sums by the bins of every two features.
    """

    def __init__(self, rounds: int = 30, rate: float = 0.3, least: float = 5.0):
        self.rounds, self.rate, self.least = rounds, rate, least
        self.bias, self.trees = 0.0, []

    @staticmethod
    def used(r: int) -> list[str]:
        """The features of round ``r``; of several that split alike the first is taken, so they take turns."""
        names = list(BINS)
        return [names[i % len(names)] for i in range(r, r + len(names)) if (i % len(names) + r) % 3]

    def start(self, pos: float, neg: float) -> Trees:
        self.bias = math.log((pos + 1) / (neg + 1))
        return self

    def fit(self, rows: list[tuple[dict, int, int]]) -> Trees:
        """Fits to rows at hand: (features, label, count)."""
        x = {f: np.array([row[f] for row, _, _ in rows], int) for f in BINS}
        y, n = (np.array([row[i] for row in rows], float) for i in (1, 2))
        self.start(n[y == 1].sum(), n[y == 0].sum())
        for r in range(self.rounds):
            p = 1 / (1 + np.exp(-np.clip([self.score(row) for row, _, _ in rows], -30, 30)))
            sums = {}
            for a, b in combinations(self.used(r), 2):
                sums[a, b] = np.zeros((BINS[a], BINS[b], 3))
                np.add.at(sums[a, b], (x[a], x[b]), np.stack([n * np.round(y - p, 6), n * np.round(p * (1 - p), 6), n], axis=1))
            self.grow(r, sums)
        return self

    def grow(self, r: int, sums: dict[tuple[str, str], np.ndarray]) -> bool:
        """Adds the tree of round ``r``, if there is a split, from (gradient, curvature, count) by the bins of every two features."""
        use = self.used(r)
        pair = lambda a, b: sums[a, b] if (a, b) in sums else sums[b, a].swapaxes(0, 1)
        alone = {f: pair(f, next(o for o in use if o != f)).sum(axis=1) for f in use}
        top = self._split(alone)
        if top is None:
            return False
        f, t = top
        tree = (f, t, [])
        for side in (np.arange(BINS[f]) <= t, np.arange(BINS[f]) > t):
            part = {o: alone[f] * side[:, None] if o == f else pair(f, o)[side].sum(axis=0) for o in use}
            low = self._split(part)
            leaves = [part[f].sum(axis=0)] if low is None else [part[low[0]][:low[1] + 1].sum(axis=0), part[low[0]][low[1] + 1:].sum(axis=0)]
            tree[2].append((low, [float(self.rate * g / (h + 1.0)) for g, h, _ in leaves]))
        self.trees.append(tree)
        return True

    def _split(self, sums: dict[str, np.ndarray]) -> tuple[str, int] | None:
        best, at = 1e-6, None
        for f, by_bin in sums.items():
            low = by_bin.cumsum(axis=0)
            g, h, n = low[-1]
            a, b, k = low[:-1].T
            gain = a * a / (b + 1) + (g - a) ** 2 / (h - b + 1) - g ** 2 / (h + 1)
            gain[(k < self.least) | (n - k < self.least)] = 0
            t = int(gain.argmax())
            if gain[t] > best:
                best, at = gain[t], (f, t)
        return at

    def score(self, row: dict) -> float:
        s = self.bias
        for f, t, sides in self.trees:
            low, values = sides[row[f] > t]
            s += values[0] if low is None else values[row[low[0]] > low[1]]
        return s

    def sum_sql(self) -> str:
        """SQL: the sum of the trees for features ``f``."""
        out = [f"{self.bias!r}D"]
        for f, t, sides in self.trees:
            leaf = [f"{v[0]!r}D" if low is None else f"CASE WHEN f.{low[0]} <= {low[1]} THEN {v[0]!r}D ELSE {v[1]!r}D END" for low, v in sides]
            out.append(f"CASE WHEN f.{f} <= {t} THEN {leaf[0]} ELSE {leaf[1]} END")
        return " + ".join(out)

    def sql(self) -> str:
        """SQL: that sum on a grid, so that there are as many scores as grid points at most."""
        return f"round(greatest(-30D, least(30D, {self.sum_sql()})), 3) + 0D"  # one zero: -0.0 becomes 0.0


class Scorer(NamedTuple):
    """Trees of one kind, the least score of an added span, and the log odds of context words."""

    trees: Trees
    level: float
    words: dict[str, float] = {}  # noqa: RUF012 - never changed


def _words(left: str) -> str:
    """SQL: the words between the last digit before a candidate and it, the nearest first."""
    return f"slice(reverse(regexp_extract_all(regexp_extract(lower({left}), '([^0-9]*)$', 1), '\\\\p{{L}}{{2,}}+', 0)), 1, {WORDS})"


def _cue(kind: str, words: str, odds: dict[str, dict[str, float]]) -> str:
    """SQL: bin of the summed log odds of ``words``, by kind."""
    cases = [f"WHEN '{k}' THEN aggregate({words}, 0D, (t, w) -> t + coalesce(try_element_at(map({', '.join(f'{chr(39)}{w}{chr(39)}, {v!r}D' for w, v in of.items())}), w), 0D))"
             for k, of in odds.items() if of]
    total = f"CASE {kind} {' '.join(cases)} ELSE 0D END" if cases else "0D"
    return f"CAST(greatest(0, least({CUES - 1}, round({total}) + {CUES // 2})) AS INT)"


def log_odds(counts: list[tuple[str, int, int]]) -> dict[str, float]:
    """word -> log odds of a valid candidate after it, at most 3; the word '' counts all candidates."""
    all_ok, all_bad = next(((ok, bad) for w, ok, bad in counts if w == ""), (0, 0))
    if not all_ok or not all_bad:
        return {}
    odds = {w: math.log((ok + 0.5) / (all_ok + 1)) - math.log((bad + 0.5) / (all_bad + 1)) for w, ok, bad in counts if w}
    return {w: round(max(-3.0, min(3.0, v)), 3) for w, v in sorted(odds.items()) if abs(v) >= 0.2}


def _by_kind(kinds: dict[str, str], kind: str, features: str) -> str:
    """SQL: the expression over features ``f`` that ``kinds`` has for ``kind``; evaluated in place, as it differs by round."""
    cases = " ".join(f"WHEN '{k}' THEN {e}" for k, e in kinds.items())
    return f"aggregate(array({features}), CAST(NULL AS DOUBLE), (acc, f) -> CASE {kind} {cases} END)"


def fit_trees(vectors: DataFrame) -> dict[str, Trees]:
    """kind -> trees, from all of ``vectors`` (kind, ok, f: features, w: count in quarters): one aggregation a round for all kinds."""
    total = {(r["kind"], r["ok"]): r["w"] / 4 for r in vectors.groupBy("kind", "ok").agg(F.sum("w").alias("w")).take(2 * len(KINDS))}
    out = {k: Trees().start(total.get((k, True), 0), total.get((k, False), 0)) for k in KINDS if (k, True) in total or (k, False) in total}
    idle = 0
    for r in range(Trees().rounds):
        # three rounds without a split leave out each feature once: no later round has one
        if idle == 3 or not any(total.get((k, True), 0) + total.get((k, False), 0) >= 2 * t.least for k, t in out.items()):
            break
        pairs = list(combinations(Trees.used(r), 2))
        cells = ", ".join(f"struct({i} AS pair, f.{a} AS a, f.{b} AS b)" for i, (a, b) in enumerate(pairs))
        # gradients as whole numbers: their sums do not depend on the order
        p = "(1 / (1 + exp(-greatest(-30D, least(30D, s)))))"
        found = vectors.withColumn("s", F.expr(_by_kind({k: t.sum_sql() for k, t in out.items()}, "kind", "f"))).selectExpr(
            "kind", "w", f"w * CAST(round(1000000 * (CAST(ok AS INT) - {p})) AS LONG) AS g", f"w * CAST(round(1000000 * {p} * (1 - {p})) AS LONG) AS h",
            f"inline(array({cells}))").groupBy("kind", "pair", "a", "b").agg(*[F.sum(c).alias(c) for c in ("g", "h", "w")]).toArrow()
        kind, pair, a, b, g, h, w = (found.column(c).to_numpy() for c in ("kind", "pair", "a", "b", "g", "h", "w"))
        values, grown = np.stack([g / 4e6, h / 4e6, w / 4], axis=1), False
        for k, trees in out.items():
            sums = {}
            for i, names in enumerate(pairs):
                rows = (kind == k) & (pair == i)
                sums[names] = np.zeros((BINS[names[0]], BINS[names[1]], 3))
                sums[names][a[rows], b[rows]] = values[rows]
            grown |= trees.grow(r, sums)
        idle = 0 if grown else idle + 1
    return out


def fit(docs: DataFrame, sample_docs: int | None = None, precision: float = 0.98, max_words: int = 1000) -> dict[str, Scorer]:
    """kind -> scorer, from the candidates of all documents; with ``sample_docs`` from about so many, by a hash of doc_id and text.

    The rows that reach the driver are sums by the bins of two features, counts by score, and context words that
    precede five candidates or more: the model holds at most ``max_words`` of them, the most frequent ones.
    """
    some = docs.select("doc_id", "text")
    if sample_docs is not None:
        share = max(1, 1_000_000 * sample_docs // max(1, docs.count()))
        some = some.filter(F.expr(f"pmod(xxhash64(coalesce(doc_id, -1), text), 1000000) < {share}"))
    # a proposal over a valid base span says nothing, and a wrong one over a proposal that may be valid neither
    told = ("filter(p_cands, c -> c.base OR NOT exists(p_cands, y -> (y.base OR y.ok AND NOT c.ok) AND y.s < c.e AND c.s < y.e))")
    digits = "regexp_replace(c.m, '[^0-9]', '')"
    cands = with_candidates(some).selectExpr("pmod(xxhash64(coalesce(doc_id, -1), text, 5), 4) = 0 AS held", f"explode({told}) AS c").selectExpr(
        # a plain number is wrong as a phone too
        "held", "c", "explode(CASE WHEN c.wide = 'number' THEN array_distinct(array(c.kind, 'phone')) ELSE array(c.kind) END) AS kind").withColumn(
        "national", F.expr(f"CASE WHEN kind = 'phone' AND (c.ok OR c.wide = 'number') THEN right({digits}, 10) END"))
    keys = ["held", "kind", "base", "wide", "ok", "national", "words", *FEATURES]
    cands = stored(cands.selectExpr("held", "kind", "c.base AS base", "c.wide AS wide", "c.ok AS ok", "national", f"{_words('c.l')} AS words",
                                    *[f"{e} AS {f}" for f, (e, _) in FEATURES.items()]).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "pii_candidates")
    # local phones are told valid by the national parts of valid ones, of the same texts; a plain number equal to one is not told wrong
    asked = "kind = 'phone' AND (wide = 'number' OR wide = 'local' AND ok)"
    valid = cands.filter("base AND national IS NOT NULL").select("national", F.lit(True).alias("known")).distinct()
    looked = cands.filter(asked).join(valid, "national", "left").filter("(wide = 'local') = (known IS NOT NULL)")
    cands = cands.filter(f"NOT ({asked})").unionByName(looked.drop("known"))
    words = cands.filter("NOT held").selectExpr("kind", "ok", "n", "explode(concat(array(''), array_distinct(words))) AS word").groupBy("kind", "word").agg(
        F.expr("sum(n) FILTER (WHERE ok)").alias("good"), F.expr("sum(n) FILTER (WHERE NOT ok)").alias("bad")).fillna(0).filter(
        "good + bad >= 5").orderBy(F.expr("word != ''"), F.expr("good + bad").desc(), "kind", "word").take(max_words)
    odds = {kind: log_odds([(r["word"], r["good"], r["bad"]) for r in words if r["kind"] == kind]) for kind in KINDS}
    features = "struct(" + ", ".join(BINS) + ") AS f"
    counts = stored(cands.selectExpr("kind", "held", "ok", "wide IN ('masked', 'marked', 'loose', 'local') AS proposed", *FEATURES, f"{_cue('kind', 'words', odds)} AS cue", "n").groupBy(
        "kind", "held", "ok", "proposed", *BINS).agg(F.sum("n").alias("n")), "pii_counts")
    # a quarter again without context, so that words never met leave the verdict to the format
    trees = fit_trees(stored(counts.filter("NOT held").selectExpr("kind", "ok", *FEATURES, f"inline(array(struct(cue, 4 * n AS w), struct({CUES // 2} AS cue, n AS w)))").selectExpr(
        "kind", "ok", features, "w"), "pii_vectors"))
    if not trees:
        return {}
    level = _by_kind({k: t.sql() for k, t in trees.items()}, "kind", "f")
    checked = counts.filter("held").selectExpr("kind", "ok", "proposed", features, "n").selectExpr("kind", "ok", "proposed", f"{level} AS s", "n").filter(
        "s IS NOT NULL").groupBy("kind", "ok", "proposed", "s").agg(F.sum("n").alias("n")).take(4 * len(KINDS) * GRID)  # all: the grid bounds them
    out = {}
    for kind, of in trees.items():
        scored = [(r["s"], int(r["ok"]), r["n"], r["proposed"]) for r in checked if r["kind"] == kind]
        # proposals must hold the precision among themselves too: base spans alone do not vouch for them
        levels = [threshold([t[:3] for t in scored], precision)]
        if any(t[3] and t[1] for t in scored):
            levels.append(threshold([t[:3] for t in scored if t[3]], precision))
        if None not in levels:
            level = max(levels)  # half way to what is refused
            out[kind] = Scorer(of, (level + max((t[0] for t in scored if t[0] < level), default=level)) / 2, odds[kind])
    return out


def threshold(scored: list[tuple[float, int, int]], precision: float) -> float | None:
    """The least score at and above which at least ``precision`` of the held-out candidates are valid."""
    best, good, all_ = None, 0, 0
    scored = sorted(scored, reverse=True)
    for i, (s, y, n) in enumerate(scored):
        good, all_ = good + y * n, all_ + n
        last = i + 1 == len(scored) or scored[i + 1][0] < s
        if last and good and good >= precision * all_:
            best = s
    return best


def with_spans(docs: DataFrame, model: dict[str, Scorer], text: str = "text", prefix: str = "p_") -> DataFrame:
    """Adds ``<prefix>base`` (valid base spans) and ``<prefix>spans`` (those and the added ones), by kind, then start."""
    p = prefix
    rank = " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS))
    df = with_candidates(docs, text, prefix)
    df = df.withColumn(f"{p}base", F.expr(
        f"array_sort(transform(filter({p}cands, c -> c.base), c -> struct(CASE c.kind {rank} END AS k, c.s AS s, c.e AS e)))"))
    if model:
        # only what is valid in plain form is scored
        odds = {k: m.words for k, m in model.items()}
        feats = "named_struct(" + ", ".join(f"'{f}', {e}" for f, (e, _) in FEATURES.items()) + f", 'cue', {_cue('c.kind', _words('c.l'), odds)})"
        scores = " ".join(f"WHEN '{k}' THEN {m.trees.sql()} - ({m.level!r}D)" for k, m in model.items())
        extra = (f"filter(transform(transform(filter({p}cands, c -> c.ok AND NOT c.base), c -> struct(c.kind AS kind, c.s AS s, c.e AS e, {feats} AS f)), "
                 f"x -> struct(aggregate(array(x.f), CAST(NULL AS DOUBLE), (acc, f) -> CASE x.kind {scores} END) AS v, "
                 f"CASE x.kind {rank} END AS k, x.s AS s, x.e AS e)), x -> x.v >= 0)")
        df = df.withColumn(f"{p}extra", F.expr(f"CASE WHEN exists({p}cands, c -> c.ok AND NOT c.base) THEN {extra} ELSE CAST(array() AS ARRAY<STRUCT<v: DOUBLE, k: INT, s: INT, e: INT>>) END"))
        chosen = (f"filter({p}extra, x -> NOT exists({p}base, y -> y.s < x.e AND x.s < y.e) AND NOT exists({p}extra, y -> "
                  "y.s < x.e AND x.s < y.e AND (y.v > x.v OR y.v = x.v AND (y.s, y.e, y.k) < (x.s, x.e, x.k))))")
        df = df.withColumn(f"{p}spans", F.expr(
            f"array_sort(array_distinct(concat({p}base, transform({chosen}, x -> struct(x.k AS k, x.s AS s, x.e AS e)))))")).drop(f"{p}extra")
    else:
        df = df.withColumn(f"{p}spans", F.col(f"{p}base"))
    return df.drop(f"{p}cands")


def _joined(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, x -> concat(element_at(array({names}), x.k + 1), ':', x.s, ':', x.e)), ',')"


def find(docs: DataFrame, sample_docs: int | None = None, precision: float = 0.98) -> DataFrame:
    """doc_id, base counts by kind, base_sha256 of the base spans, all spans as text."""
    docs = docs.select("doc_id", "text")
    df = with_spans(docs, fit(docs, sample_docs, precision))
    return df.select("doc_id", *[F.expr(f"CAST(size(filter(p_base, x -> x.k = {i})) AS LONG)").alias(f"n_{k}") for i, k in enumerate(KINDS)],
                     F.expr(f"sha2(CAST({_joined('p_base')} AS BINARY), 256)").alias("base_sha256"),
                     F.expr(_joined("p_spans")).alias("spans"))


def redact(docs: DataFrame, sample_docs: int | None = None, precision: float = 0.98) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; overlapping spans become one mark."""
    p = free_prefix(docs, "p_")
    df = with_spans(docs, fit(docs.select("doc_id", "text"), sample_docs, precision), prefix=p)
    marks = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    by_start = f"array_sort(transform({p}spans, x -> struct(x.s AS s, -x.e AS e, x.k AS k)))"
    done = (f"aggregate({by_start}, struct(0 AS at, '' AS out), (a, x) -> CASE WHEN x.s < a.at THEN struct(greatest(a.at, -x.e) AS at, a.out AS out) "
            f"ELSE struct(-x.e AS at, concat(a.out, substring(text, a.at + 1, x.s - a.at), element_at(array({marks}), x.k + 1)) AS out) END, "
            "a -> concat(a.out, substring(text, a.at + 1)))")
    return df.withColumn("text", F.expr(f"CASE WHEN size({p}spans) > 0 THEN {done} ELSE text END")).select(
        *[F.col(f"`{c}`") for c in docs.columns])

"""Quality rules as a learned decision list, in DataFrame expressions only.

Statistics of every text are native columns. A bounded sample of labelled rows
(a documented parameter) teaches an ordered list of rules by sequential covering: a rule
grows as a conjunction of thresholds on one part of the sample, is pruned on
the other part, is kept if it still beats the rest of the sample there, and the
rows it covers leave the sample. The list becomes one ordered CASE expression.

Rows: a null or empty text has no words and fails the base rule; equal rows and
repeated doc_ids get equal rows; an empty table gives an empty result; labels
that are null, not 0/1 or for unknown doc_ids are not used, and without usable labels no rule is
learned (the base rule stands alone). Columns that clash with the statistics are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
#: fixed by the query's contract
SYMBOLS = r"[^#*$%&|<>]"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: what rules may test: ratios, so that they mean the same for long and short texts
FEATURES = {
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "stop_marks": "n_stops / greatest(n_words, 1)",
    "n_words": "CAST(n_words AS DOUBLE)",
}
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_statistics(docs: DataFrame, text: str = "text", prefix: str = "q_") -> DataFrame:
    """Adds ``<prefix>stat`` columns of the whole text; everything else passes through.

    n_repeat_words counts the words inside 3-word windows found twice or more:
    window hashes are sorted with their positions only where a text repeats one.
    """
    p = prefix
    df = docs.withColumn(f"{p}text", F.expr(f"coalesce(CAST(`{text}` AS STRING), '')"))
    df = df.withColumn(f"{p}words", F.expr(f"filter(split({p}text, '{_sql(SPACE)}'), w -> w != '')"))
    df = df.withColumn(f"{p}lines", F.expr(
        f"filter(split({p}text, '\\n'), l -> length(translate(l, ' \\t\\n\\r{chr(11)}{chr(12)}', '')) > 0)"))
    df = df.withColumn(f"{p}n_words", F.expr(f"CAST(size({p}words) AS LONG)"))
    df = df.withColumn(f"{p}windows", F.expr(
        f"CASE WHEN {p}n_words < 3 THEN CAST(array() AS ARRAY<BIGINT>) ELSE "
        f"transform(sequence(1, CAST({p}n_words - 2 AS INT)), i -> "
        f"xxhash64({p}words[i - 1], {p}words[i], {p}words[i + 1])) END"))
    df = df.withColumn(f"{p}repeats", F.expr(
        f"CASE WHEN size(array_distinct({p}windows)) < size({p}windows) THEN "
        f"sort_array(transform({p}windows, (h, i) -> struct(h AS h, i AS i))) END"))
    df = df.withColumn(f"{p}starts", F.expr(
        f"CASE WHEN {p}repeats IS NOT NULL THEN sort_array(transform(filter({p}repeats, (x, k) -> "
        f"x.h = get({p}repeats, k - 1).h OR x.h = get({p}repeats, k + 1).h), x -> x.i)) END"))
    stats = {
        f"{p}n_words": F.col(f"{p}n_words"),
        f"{p}word_chars": F.expr(f"CAST(length({p}text) - coalesce(length(regexp_replace({p}text, '[^\\\\x20\\\\x09-\\\\x0D]+', '')), 0) AS LONG)"),
        f"{p}n_symbols": F.expr(f"CAST(length(regexp_replace({p}text, '{SYMBOLS}+', '')) AS LONG)"),
        f"{p}n_upper": F.expr(f"CAST(length({p}text) - length(translate({p}text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS LONG)"),
        f"{p}n_digits": F.expr(f"CAST(length({p}text) - length(translate({p}text, '0123456789', '')) AS LONG)"),
        f"{p}n_stops": F.expr(f"CAST(length({p}text) - length(translate({p}text, '.!?', '')) AS LONG)"),
        f"{p}n_lines": F.expr(f"CAST(size({p}lines) AS LONG)"),
        f"{p}n_dup_lines": F.expr(f"CAST(size({p}lines) - size(array_distinct({p}lines)) AS LONG)"),
        f"{p}n_distinct": F.expr(f"CAST(size(array_distinct({p}words)) AS LONG)"),
        f"{p}n_repeat_words": F.expr(
            f"CASE WHEN {p}starts IS NULL THEN 0L ELSE CAST(aggregate({p}starts, "
            f"struct(CAST(-3 AS INT) AS last, 0 AS n), (a, s) -> struct(s AS last, a.n + least(3, s - a.last) AS n)).n AS LONG) END"),
    }
    # a generator: no later filter is pushed below it, which would repeat the whole calculation
    return df.select(*[F.col(f"`{c}`") for c in docs.columns], F.inline(F.array(F.struct(*[c.alias(n) for n, c in stats.items()]))))


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\")


def base_failed(prefix: str = "q_") -> Column:
    return F.expr(f"{prefix}n_words < {MIN_WORDS} OR 100 * {prefix}n_repeat_words > {MAX_REPEAT_PERCENT} * {prefix}n_words")


@dataclass(frozen=True)
class Rule:
    """Conjunction of (feature, '<=' or '>', threshold) that rejects a text."""

    tests: tuple[tuple[str, str, float], ...]

    def covers(self, row: dict) -> bool:
        return all(row[f] <= t if op == "<=" else row[f] > t for f, op, t in self.tests)

    def sql(self, prefix: str = "q_") -> str:
        return " AND ".join(f"({_prefixed(f, prefix)}) {op} {t!r}D" for f, op, t in self.tests)


def _prefixed(feature: str, prefix: str) -> str:
    sql = FEATURES[feature]
    for name in ("word_chars", "n_words", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_upper", "n_digits", "n_distinct", "n_stops"):
        sql = sql.replace(name, prefix + name)
    return sql


def _score(rows: list[dict], rule: Rule, weights: dict[int, float]) -> tuple[float, float]:
    bad = good = 0.0
    for r in rows:
        if rule.covers(r):
            if r["bad"]:
                bad += weights[1]
            else:
                good += weights[0]
    return bad, good


def _grow(rows: list[dict], grid: dict[str, list[float]], max_tests: int) -> Rule | None:
    """Add the test with the best information gain until no good row is covered."""
    tests: tuple = ()
    inside = rows
    while len(tests) < max_tests:
        p0, n0 = sum(r["bad"] for r in inside), sum(not r["bad"] for r in inside)
        if not p0 or not n0:
            break
        best, base = (1e-9, None, None), math.log2(p0 / (p0 + n0))
        for f, cuts in grid.items():
            ordered = sorted((r[f], r["bad"]) for r in inside)
            total_bad, k, bad = p0, 0, 0
            for t in cuts:
                while k < len(ordered) and ordered[k][0] <= t:
                    bad += ordered[k][1]
                    k += 1
                for op, p, m in (("<=", bad, k), (">", total_bad - bad, len(ordered) - k)):
                    if p and m and (gain := p * (math.log2(p / m) - base)) > best[0]:
                        best = (gain, (f, op, t), None)
        if best[1] is None:
            break
        tests = (*tests, best[1])
        inside = [r for r in inside if Rule(tests[-1:]).covers(r)]
    return Rule(tests) if tests else None


def _prune(rule: Rule, rows: list[dict], weights: dict[int, float]) -> Rule:
    """Drop final tests while the share (p - n) / (p + n) on the pruning rows does not fall."""
    def worth(r: Rule) -> float:
        p, n = _score(rows, r, weights)
        return (p - n) / (p + n) if p + n else -1.0

    best = rule
    for cut in range(len(rule.tests) - 1, 0, -1):
        shorter = Rule(rule.tests[:cut])
        if worth(shorter) >= worth(best):
            best = shorter
    return best


def learn_rules(rows: list[dict], max_rules: int = 12, max_tests: int = 4, cuts: int = 64, purity: float = 0.95,
                min_cover: int = 2) -> list[Rule]:
    """Sequential covering over bounded ``rows`` (features, bad 0/1, fold 0..2; fold 2 prunes)."""
    grid = {}
    for f in FEATURES:
        values = sorted({r[f] for r in rows})
        edges = [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)]
        grid[f] = edges if len(edges) <= cuts else [edges[i * len(edges) // cuts] for i in range(cuts)]
    weights = {0: 1.0, 1: 1.0}
    left, rules = list(rows), []
    while len(rules) < max_rules and any(r["bad"] for r in left):
        grow, prune = [r for r in left if r["fold"] < 2], [r for r in left if r["fold"] == 2]
        rule = _grow(grow, grid, max_tests)
        if rule is None:
            break
        rule = _prune(rule, prune, weights)
        bad, good = _score(left, rule, weights)
        pruned_bad, pruned_good = _score(prune, rule, weights)
        if bad < min_cover or bad < purity * (bad + good) or pruned_bad < purity * (pruned_bad + pruned_good):
            break
        rules.append(rule)
        left = [r for r in left if not rule.covers(r)]
    return rules


def labelled_sample(stats_of: DataFrame, labels: DataFrame, sample_rows: int) -> list[dict]:
    """At most ``sample_rows`` labelled documents that pass the base rule, chosen by a hash of doc_id."""
    usable = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("quality"))
    n = usable.count()
    if not n:
        return []
    share = max(1, min(1_000_000, 1_000_000 * sample_rows // n))
    some = usable.filter(f"pmod(xxhash64(doc_id), 1000000) < {share}")
    chosen = stats_of.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(some, "doc_id")
    rows = with_statistics(chosen).filter(~base_failed()).selectExpr(
        "quality", "doc_id", *[f"{_prefixed(f, 'q_')} AS {f}" for f in FEATURES]).take(2 * sample_rows)
    return [{f: float(r[f]) for f in FEATURES} | {"bad": int(r["quality"] == 0), "fold": r["doc_id"] * 2654435761 % 2**32 % 3} for r in rows]


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 4000) -> list[Rule]:
    return learn_rules(sorted(labelled_sample(docs, labels, sample_rows), key=lambda r: sorted(r.items())))


def verdict(rules: list[Rule], prefix: str = "q_") -> Column:
    """0 if no rule fires, else the 1-based number of the first rule that does."""
    if not rules:
        return F.lit(0)
    return F.expr("CASE " + " ".join(f"WHEN {r.sql(prefix)} THEN {i}" for i, r in enumerate(rules, 1)) + " ELSE 0 END")


def judged(docs: DataFrame, rules: list[Rule], prefix: str = "q_") -> DataFrame:
    """``docs`` with statistics, ``<prefix>base_failed``, ``<prefix>rule`` and ``<prefix>kept``."""
    return with_statistics(docs, prefix=prefix).withColumn(f"{prefix}base_failed", base_failed(prefix)).withColumn(
        f"{prefix}rule", verdict(rules, prefix)).withColumn(
        f"{prefix}kept", F.expr(f"NOT {prefix}base_failed AND {prefix}rule = 0"))


def quality(docs: DataFrame, labels: DataFrame, sample_rows: int = 4000) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept and the rule that rejected the text (0: none)."""
    out = judged(docs.select("doc_id", "text"), fit(docs, labels, sample_rows))
    return out.select("doc_id", *[F.col(f"q_{s}").alias(s) for s in STATS], F.col("q_base_failed").alias("base_failed"),
                      F.col("q_kept").alias("kept"), F.col("q_rule").cast("long").alias("rule"))

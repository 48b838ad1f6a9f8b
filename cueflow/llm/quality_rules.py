"""Quality rules as a learned decision list, native from end to end.

The features are DataFrame expressions over the whole text. Sequential covering
learns the list from labelled rows: a rule grows by the threshold condition with
most information gain on the growing rows until it covers no good document, is
pruned from its end on the pruning rows, is kept if it is precise there, and the
rows that it covers are taken away. The list becomes one chain of
``when`` expressions. A document that no rule calls bad is good.

Null text is empty text; it has no words and fails the base rule. Documents are
judged each by itself, so repeated rows get equal results. Without labelled
rows of both kinds the list is empty and the base rule alone decides. Texts of
any length are judged whole. An empty table gives an empty result. Extra columns
stay, also such with the result's names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, fresh, text_of

#: Fixed value: the white space that parts words.
SPACE = " \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Labelled rows that the list is learned from at most, those whose ids hash lowest.
LABELLED = 6000
MAX_RULES, MAX_CONDITIONS, CUTS = 12, 3, 24
#: Share of bad documents among those that a rule covers, at least; and bad documents that it covers, at least.
MIN_PRECISION, MIN_COVER = 0.97, 3

#: (feature, is at least, threshold)
Condition = tuple[str, bool, float]
Rule = tuple[Condition, ...]


def with_statistics(df: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """df with a struct of counts; only expressions, no shuffle.

    Repeated windows are found by sorting (hash of three words, position) within
    the text, and only where some hash occurs twice.
    """
    raw, rest, words, tri, sorted_, name = (fresh(df, x) for x in ("raw", "rest", "words", "tri", "sorted", "counts"))
    text = F.col(raw)
    out = df.withColumn(raw, text_of(text_col))
    # what is neither a lower-case ASCII letter nor a space: the characters that are counted, in a short string
    out = out.withColumn(rest, F.regexp_replace(text, "[a-z ]+", ""))
    trimmed = F.btrim(text, F.lit(SPACE))
    out = out.withColumn(words, F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t-\r]+")))
    w = F.col(words)
    hashed = F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))), F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))
    out = out.withColumn(tri, hashed)
    t = F.col(tri)
    twice = F.size(F.array_distinct(t)) < F.size(t)
    # a column of its own: inside a lambda an expression is evaluated for each element
    out = out.withColumn(sorted_, F.when(twice, F.sort_array(F.arrays_zip(t.alias("h"), F.sequence(F.lit(0), F.size(t) - 1).alias("i")))))
    pairs = F.col(sorted_)
    hits = F.filter(
        F.transform(pairs, lambda p, k: F.when((F.get(pairs, k - 1).h == p.h) | (F.get(pairs, k + 1).h == p.h), p.i)),
        lambda i: i.isNotNull(),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform(hits, lambda i: F.array(i, i + 1, i + 2)))))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    short = F.col(rest)
    count = lambda chars: F.octet_length(short) - F.octet_length(F.regexp_replace(short, f"[{chars}]+", ""))  # noqa: E731  (ASCII characters)
    counts = {
        "n_words": F.size(w),
        "word_chars": F.length(F.replace(text, F.lit(" "), F.lit(""))) - count(r"\t-\r"),
        "n_symbols": count("#*$%&|<>"),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.when(pairs.isNull(), F.lit(0)).otherwise(covered),
        "n_lines": F.size(lines),
        "n_upper": count("A-Z"),
        "n_marks": count("!?"),
        "n_bars": count("|"),
        "n_digits": count("0-9"),
        "n_stops": count("."),
        "n_distinct": F.size(F.array_distinct(w)),
    }
    struct = F.struct(*(c.cast("long").alias(k) for k, c in counts.items()))
    # one row from each: a filter on a generated column is not pushed into the expressions and evaluated in their lambdas
    return out.withColumn(name, F.explode(F.array(struct))).drop(raw, rest, words, tri, sorted_), name


#: Features by name, from the struct of counts.
_RATIOS = {
    "symbol_ratio": ("n_symbols", "word_chars"),
    "mark_ratio": ("n_marks", "word_chars"),
    "bar_ratio": ("n_bars", "n_words"),
    "upper_ratio": ("n_upper", "word_chars"),
    "digit_ratio": ("n_digits", "word_chars"),
    "stop_ratio": ("n_stops", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "repeat_ratio": ("n_repeat_words", "n_words"),
    "distinct_ratio": ("n_distinct", "n_words"),
    "word_length": ("word_chars", "n_words"),
}
FEATURES = (*_RATIOS, "n_words")


def feature(counts: str, name: str) -> Column:
    c = lambda k: F.col(f"`{counts}`.{k}").cast("double")
    if name in _RATIOS:
        a, b = _RATIOS[name]
        return c(a) / F.greatest(c(b), F.lit(1.0))
    return c(name)


def base_failed(counts: str) -> Column:
    n, r = F.col(f"`{counts}`.n_words"), F.col(f"`{counts}`.n_repeat_words")
    return (n < MIN_WORDS) | (100 * r > MAX_REPEAT_PERCENT * n)


@dataclass
class _Row:
    x: dict[str, float]
    bad: bool


def _meets(row: _Row, rule: Rule) -> bool:
    return all(row.x[f] >= t if ge else row.x[f] < t for f, ge, t in rule)


def _counts(rows: list[_Row]) -> tuple[int, int]:
    p = sum(r.bad for r in rows)
    return p, len(rows) - p


def _cuts(rows: list[_Row], f: str) -> list[float]:
    """Midpoints between neighbouring values at about even ranks, and where the label changes at the ends."""
    values = sorted({r.x[f] for r in rows})
    if len(values) < 2:
        return []
    step = max(1, len(values) // CUTS)
    picked = {*range(step, len(values), step), 1, len(values) - 1}
    for bad in (True, False):
        own = [r.x[f] for r in rows if r.bad == bad]
        if own:
            picked |= {values.index(min(own)), values.index(max(own)) + 1} & set(range(1, len(values)))
    return [(values[i - 1] + values[i]) / 2 for i in sorted(picked)]


def _grow(rows: list[_Row]) -> Rule:
    rule: Rule = ()
    inside = rows
    while len(rule) < MAX_CONDITIONS:
        p0, n0 = _counts(inside)
        if not p0 or not n0:
            break
        best: tuple[float, Condition, list[_Row]] | None = None
        for f in FEATURES:
            cuts = _cuts(inside, f)
            for t in cuts:
                for ge in (True, False):
                    covered = [r for r in inside if (r.x[f] >= t) == ge]
                    p, n = _counts(covered)
                    if p:
                        gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                        if best is None or gain > best[0] + 1e-12:
                            best = (gain, (f, ge, t), covered)
        if best is None or best[0] <= 0:
            break
        rule, inside = (*rule, best[1]), best[2]
    return rule


def _prune(rule: Rule, rows: list[_Row]) -> Rule:
    """The beginning of the rule with the highest (bad - good) / (bad + good) on the pruning rows; the longer one of equals."""

    def worth(r: Rule) -> float:
        p, n = _counts([x for x in rows if _meets(x, r)])
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), len(r)), default=())


def learn(rows: list[_Row]) -> list[Rule]:
    """The ordered rules; each calls a document bad. Every third row is for pruning."""
    rules: list[Rule] = []
    left = rows
    while len(rules) < MAX_RULES:
        grow, prune = [r for i, r in enumerate(left) if i % 3], [r for i, r in enumerate(left) if i % 3 == 0]
        rule = _grow(grow)
        if not rule:
            break
        rule = _prune(rule, prune)
        p, n = _counts([r for r in left if _meets(r, rule)])
        if p < MIN_COVER or p < MIN_PRECISION * (p + n):
            break
        rules.append(rule)
        left = [r for r in left if not _meets(r, rule)]
    return rules


def labelled_rows(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> list[_Row]:
    """Features of at most ``limit`` labelled documents, those whose ids hash lowest."""
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``limit`` rows are sent
    counted, name = with_statistics(met.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")))
    rows = counted.where(~base_failed(name)).select("doc_id", "label", *(feature(name, f).alias(f) for f in FEATURES)).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    return [_Row({f: float(r[f]) for f in FEATURES}, r["label"] == 0) for r in rows]


def verdict(rules: list[Rule], counts: str) -> Column:
    """Number of the first rule that a document meets (from 1); null if none."""
    out = F.lit(None).cast("int")
    for k in range(len(rules), 0, -1):
        met = F.lit(True)
        for f, ge, t in rules[k - 1]:
            met = met & (feature(counts, f) >= t if ge else feature(counts, f) < t)
        out = F.when(met, F.lit(k)).otherwise(out)
    return out


def judged(df: DataFrame, rules: list[Rule], text_col: str = "text") -> tuple[DataFrame, str, Column, Column]:
    """df with its counts; the counts' name, base_failed and the number of the rule that rejects (null: none)."""
    out, name = with_statistics(df, text_col)
    return out, name, base_failed(name), verdict(rules, name)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rules = learn(labelled_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    out, name, failed, rule = judged(docs, rules)
    c = lambda k: F.col(f"`{name}`.{k}").alias(k)
    return out.select(
        "doc_id", c("n_words"), c("word_chars"), c("n_symbols"), c("n_dup_lines"), c("n_repeat_words"),
        failed.alias("base_failed"), (~failed & rule.isNull()).alias("kept"), rule.alias("rule"),
    )

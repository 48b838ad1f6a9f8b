"""Secret scans: fixed patterns, and character Markov models compared by log-likelihood ratio.

Two first-order character models are trained from labelled samples, one of
random strings and one of ordinary identifiers. A stretch of key characters whose
mean log-likelihood ratio per character passes a threshold, learned on held-out
samples, is a secret of kind ``markov``; stretches are sought in what the fixed
patterns leave of each run. Spans of the fixed patterns always stay.

Null text is empty text (no spans). Very long texts are scanned whole. Repeated
rows each get their own result; an empty table gives an empty result; if the
table holds no ordinary words at all, the model is trained on its own words and
seeded samples alone. Extra columns stay, also such with the result's names.
"""

from __future__ import annotations

import hashlib
import random
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, fresh, small_batches, text_of

#: Kinds of spans in their order at equal starts.
KINDS = ("assign", "access", "hex", "markov")

# The contract's patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Words without which ASSIGN cannot match.
_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Characters of a stretch that the models judge, at least.
LEAST_RUN = 16
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
_LETTER = re.compile(r"[A-Za-z]")

#: Training: at most so many documents give ordinary words, and so many strings of each label are used.
SAMPLE_DOCS, SAMPLE_STRINGS = 400, 6000

#: Ordinary words of paths, code and configuration, which documents of prose lack.
COMMON = tuple(
    "user name value index count table column result version number request response server client error message file path source target main test java python org com net "
    "example package packages module modules node react core utils common config default local global static public private service manager handler controller factory "
    "account session payment order customer product invoice report project team system network connection pool size length width height maximum minimum limit exceeded "
    "internal external status code type class object method function string integer float boolean array list map queue stack tree graph image photo video audio document "
    "content format office open application event listener element parent child root branch commit merge pull push release build deploy docker cluster cloud region zone "
    "spark catalyst expression expressions numpy site library include share lib usr bin etc var log tmp home github workflows continuous integration locale messages utf "
    "this that with from they have will your what when make like time very long case line word many write would other about then them these some into more look way could "
    "call first water been find down day come made part over new sound take only little work know place year live back give most after thing good think great where help "
    "through much before right mean old any same tell follow came want show also around form three small set put end does another well large must big even such here why ask went "
    "camel snake identifier variable element elements benutzer konto verwaltung dienst "
    "january monday english german french transfer encoding authorization forwarded protocol animation frame callback window screen".split()
)

Span = tuple[int, int, str]


@dataclass(frozen=True)
class MarkovRatio:
    """log P(next | char, random) - log P(next | char, ordinary), and the threshold per character."""

    ratio: np.ndarray
    threshold: float

    def gains(self, s: str) -> np.ndarray:
        """Log-likelihood ratio of each character."""
        c = _codes(s)
        return self.ratio[np.concatenate([[0], c[:-1]]), c]

    def score(self, s: str) -> float:
        """Highest mean of a stretch of LEAST_RUN characters or more; above the threshold it is a secret."""
        gain = self.gains(s)
        if len(gain) < LEAST_RUN:
            return float(gain.sum() / max(1, len(gain)))
        total = np.concatenate([[0.0], np.cumsum(gain)])
        # a stretch of twice the length has a half that is no worse
        return float(max(((total[n:] - total[:-n]) / n).max() for n in range(LEAST_RUN, min(2 * LEAST_RUN, len(total)))))


def _codes(s: str) -> np.ndarray:
    """0 stands for the string's start and for what is not ASCII."""
    a = np.frombuffer(s.encode("latin-1", "replace"), np.uint8).astype(np.int64)
    return np.where(a < 128, a, 0)


def _log_model(samples: list[str]) -> np.ndarray:
    counts = np.full((128, 128), 0.05)
    for s in samples:
        c = _codes(s)
        np.add.at(counts, (np.concatenate([[0], c[:-1]]), c), 1)
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def train(labelled: list[tuple[str, int]]) -> MarkovRatio:
    """Fit both models on four fifths of the samples; the threshold comes from the rest.

    label 1: random, 0: ordinary. The threshold lies halfway between the
    held-out ordinary strings' highest scores and the random ones' lowest
    percent, and never below zero.
    """
    fit = [x for i, x in enumerate(labelled) if i % 5]
    held = [x for i, x in enumerate(labelled) if i % 5 == 0]
    ratio = _log_model([s for s, y in fit if y]) - _log_model([s for s, y in fit if not y])
    model = MarkovRatio(ratio, 0.0)
    ordinary = [model.score(s) for s, y in held if not y] or [0.0]
    secret = [model.score(s) for s, y in held if y] or [0.0]
    top, low = max(ordinary), float(np.quantile(secret, 0.01))
    return MarkovRatio(ratio, max(0.0, (top + low) / 2 if low > top else float(np.quantile(ordinary, 0.9999))))


def random_strings(n: int, seed: int = 11) -> list[str]:
    """Seeded strings as key generators make them; some in parts between dots."""
    rnd = random.Random(seed)
    digits, lower = "0123456789", "abcdefghijklmnopqrstuvwxyz"
    upper = lower.upper()
    kinds = (digits + "abcdef", digits + lower, digits + lower + upper, digits + lower + upper + "+/", digits + lower + upper + "-_", digits + "ABCDEF", lower + upper)
    out = []
    for i in range(n):
        letters = kinds[i % len(kinds)]
        if i % 16 == 15:
            out.append(".".join("".join(rnd.choices(digits + lower + upper + "-_", k=rnd.randint(8, 30))) for _ in range(3)))
        else:
            out.append("".join(rnd.choices(letters, k=rnd.randint(16, 64))))
    return out


def identifiers(words: list[str], n: int, seed: int = 12) -> list[str]:
    """Ordinary identifiers: words joined in the usual ways, some with a number. A third of the words are COMMON ones."""
    rnd = random.Random(seed)
    words = words or [*COMMON]
    out = []
    for i in range(n):
        w = [rnd.choice(COMMON) if rnd.random() < 1 / 3 else rnd.choice(words) for _ in range(rnd.randint(2, 4))]
        if i % 12 == 11:  # times and versions are ordinary, too
            y, m, d = rnd.randint(1990, 2039), rnd.randint(1, 12), rnd.randint(1, 28)
            sep = rnd.choice(("-", "/", "_"))
            stamp = f"{y}{sep}{m:02d}{sep}{d:02d}"
            out.append(rnd.choice((f"{stamp}T{rnd.randint(0, 23):02d}{sep}{rnd.randint(0, 59):02d}{sep}00Z", f"{w[0]}-{stamp}", f"{w[0]}-v{m}_{d}_{rnd.randint(0, 99)}", f"{w[0]}-{m}.{d}.{rnd.randint(0, 99)}")))
            continue
        camel = w[0] + "".join(x.capitalize() for x in w[1:])
        joined = ("_".join(w), "-".join(w), "/".join(w), camel, "".join(w), ".".join(w), "_".join(w).upper(), "/".join(w[:-1]) + "." + w[-1])[i % 8]
        out.append(joined + (str(rnd.randint(0, 2100)) if rnd.random() < 0.4 else ""))
    return out


def fit_on(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_docs: int = SAMPLE_DOCS) -> MarkovRatio:
    """Train on random strings and on identifiers of words from a bounded sample of documents.

    The sample is the ``n_docs`` rows whose ids hash lowest, whatever the size of the table.
    """
    # ids first: a row of the ranking is a few bytes, whatever the number of partitions; then the texts of at most n_docs ids
    ids = docs.select(F.col(id_col).alias("id")).where("id is not null").distinct().orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(n_docs)
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t")).join(F.broadcast(ids), "id").groupBy("id").agg(F.min("t").alias("t"))
    sample = (
        texts.select(F.explode(F.array_distinct(F.regexp_extract_all("t", F.lit(r"(?<![A-Za-z0-9+/_=-])([A-Za-z]{2,15})(?![A-Za-z0-9+/_=-])"), F.lit(1)))).alias("w"))
        .distinct()
        .orderBy(F.xxhash64("w"), "w")
        .limit(SAMPLE_STRINGS)
    )
    words = [r.w for r in sample.collect()]
    mixed = [x for pair in zip(random_strings(SAMPLE_STRINGS), identifiers(words, SAMPLE_STRINGS), strict=True) for x in zip(pair, (1, 0), strict=True)]
    return train(mixed)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns: (start, end, kind), code points, end exclusive."""
    out: list[Span] = []
    low = text.lower()
    if any(k in low for k in _KEYS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    for run in _RUN.finditer(text):  # every long match of the two other kinds lies inside one run
        at, s = run.start(), run[0]
        if len(s) >= LEAST["access"] and "AKIA" in s:
            out += [(at + m.start(), at + m.end(), "access") for m in ACCESS.finditer(s) if m.end() - m.start() >= LEAST["access"]]
        if len(s) >= LEAST["hex"]:
            out += [(at + m.start(), at + m.end(), "hex") for m in HEX.finditer(s) if m.end() - m.start() >= LEAST["hex"]]
    return out


def free_parts(s: int, e: int, base: list[Span]) -> list[tuple[int, int]]:
    """What base spans leave of [s, e)."""
    out, at = [], s
    for a, b, _ in sorted(x for x in base if x[0] < e and s < x[1]):
        if a > at:
            out.append((at, a))
        at = max(at, b)
    return [*out, (at, e)] if at < e else out


def stretches(s: str, model: MarkovRatio) -> list[tuple[int, int]]:
    """Stretches of at least LEAST_RUN characters, with a letter, whose mean is above the threshold: the one of largest sum, out to the next separators, then those beside it."""
    out, todo = [], [(0, model.gains(s))]
    while todo:
        at, gain = todo.pop()
        if len(gain) < LEAST_RUN:
            continue
        total = np.concatenate([[0.0], np.cumsum(gain - model.threshold)])
        least = np.minimum.accumulate(total[: len(total) - LEAST_RUN])
        end = int(np.argmax(total[LEAST_RUN:] - least))
        if total[LEAST_RUN + end] <= least[end]:
            continue
        begin, end = int(np.argmin(total[: end + 1])), end + LEAST_RUN
        while begin and s[at + begin - 1].isalnum():  # letters and digits at its edges are of the same key
            begin -= 1
        while end < len(gain) and s[at + end].isalnum():
            end += 1
        if _LETTER.search(s, at + begin, at + end):
            out.append((at + begin, at + end))
        todo += [(at, gain[:begin]), (at + end, gain[end:])]
    return sorted(out)


def markov_spans(text: str, model: MarkovRatio, base: list[Span]) -> list[Span]:
    """Stretches, in what base spans leave of the runs of key characters, that the models call random."""
    out: list[Span] = []
    for run in _RUN.finditer(text):
        for s, e in free_parts(run.start(), run.end(), base):
            if e - s >= LEAST_RUN and _LETTER.search(text, s, e):
                out += [(s + a, s + b, "markov") for a, b in stretches(text[s:e], model)]
    return out


def scan(text: str, model: MarkovRatio) -> tuple[list[Span], list[Span]]:
    """All spans and the base spans, each by start, then kind as listed."""
    key = lambda x: (x[0], KINDS.index(x[2]))
    base = base_spans(text)
    return sorted(base + markov_spans(text, model, base), key=key), sorted(base, key=key)


def shown(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def redact(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with each maximal stretch of spans replaced by the mark."""
    out, upto, last = [], 0, -1
    for a, b, _ in sorted(spans):
        if a >= upto or last < 0:
            out += [text[upto:a], mark]
            upto = b
        else:
            upto = max(upto, b)
        last = a
    return "".join([*out, text[upto:]])


def find_secrets(df: DataFrame, model: MarkovRatio, text_col: str = "text") -> tuple[DataFrame, str]:
    """df with a struct column (counts, spans, base digest, redacted text); its name is returned. No shuffle."""
    name = fresh(df, "secrets")

    @F.pandas_udf("n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string, redacted string")
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            spans, base = scan(t, model)
            kinds = [k for _, _, k in spans]
            rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(shown(base).encode()).hexdigest(), shown(spans), redact(t, spans) if spans else None))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_markov", "base_sha256", "spans", "redacted"])

    return df.withColumn(name, found(text_of(text_col))), name


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out, name = find_secrets(docs, fit_on(docs))
    return out.select("doc_id", *(F.col(f"`{name}`.{c}").alias(c) for c in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov")))

"""Quality classifier by co-training of two views.

The text view sees hashed byte trigrams of the whole text and how its words
repeat; the metadata view sees language, source, and the numbers of characters
and lines, and nothing of the words. Each is a logistic regression. Starting from labelled documents, both score a pool of unlabelled
ones in every round, and each hands its most confident pseudo-labels to the
*other* view's training set. At the end both are calibrated on held-out labelled
documents (Platt scaling), their calibrated log-odds are added, with the prior
odds, which both hold, counted once, and the threshold is set on the held-out
documents so that good ones stay: halfway between even odds and their least score.

Fitting uses bounded samples (LABELLED, POOL: the ids that hash lowest);
scoring covers every document and shuffles nothing.

Null text is empty text, null metadata empty strings. Without labelled rows of
both kinds every score is 0.5 and every document is kept. Repeated rows score
alike; an empty table gives an empty result. Extra columns stay, also such with
the result's names. Texts of any length are read whole.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, fresh, small_batches, text_of

#: Labelled documents and unlabelled pool documents that the fit uses at most.
LABELLED, POOL = 3000, 3000
ROUNDS, CONFIDENT = 4, 0.95
#: Pseudo-labels of each class that a view hands over in a round at most.
HANDED = 150
DIMS, HASHED = 1024, 16
#: Measures of repetition in the text view, and of size in the metadata view.
REPEATS, SIZES = 4, 5
#: Share of held-out good documents that the threshold keeps, at least.
KEEP_GOOD = 0.995


def text_view(text: str) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams, a vector of length one; then how words repeat."""
    raw = text.encode("utf-8", "surrogatepass")
    out = np.zeros(DIMS + REPEATS, np.float32)
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(b) >= 3:
        h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
        counts = np.bincount((h >> np.uint32(12)) % DIMS, minlength=DIMS)
        out[:DIMS] = np.sqrt(counts / counts.sum())
    words = raw.split()
    n = max(1, len(words))
    next_to = sum(map(eq, words, words[1:])) / n
    out[DIMS:] = [next_to**0.5, next_to, len(set(words)) / n, min(1.0, len(raw) / n / 20)]
    return out


def metadata_view(lang: str, source: str, chars: int, lines: int) -> np.ndarray:
    """Language and source (hashed), number and length of lines."""
    out = np.zeros(2 * HASHED + SIZES, np.float32)
    out[zlib.crc32(lang.encode()) % HASHED] = 1
    out[HASHED + zlib.crc32(source.encode()) % HASHED] = 1
    out[2 * HASHED :] = [np.log1p(chars) / 10, np.log1p(lines) / 5, np.log1p(chars / lines) / 8, float(chars < 200), float(chars < 1000)]
    return out


@dataclass(frozen=True)
class Linear:
    weights: np.ndarray
    bias: float

    def odds(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias


def fit_linear(x: np.ndarray, y: np.ndarray, steps: int = 250, ridge: float = 1e-4) -> Linear:
    """Logistic regression by accelerated gradient steps from zero; classes weigh alike."""
    x = x.astype(np.float64)
    share = np.where(y > 0.5, 0.5 / max(1e-9, y.mean()), 0.5 / max(1e-9, 1 - y.mean())) / len(y)
    rate = 4.0 / (np.einsum("ij,ij,i->", x, x, share) + 1.0 + 4 * ridge)
    w, b = np.zeros(x.shape[1]), 0.0
    vw, vb = w.copy(), 0.0
    for k in range(steps):
        g = (1 / (1 + np.exp(-(x @ vw + vb))) - y) * share
        nw, nb = vw - rate * (x.T @ g + ridge * vw), vb - rate * g.sum()
        m = k / (k + 3)
        vw, vb, w, b = nw + m * (nw - w), nb + m * (nb - b), nw, nb
    return Linear(w, float(b))


def platt(odds: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, shift) that make odds into calibrated log-odds; a few Newton steps with targets drawn in from 0 and 1."""
    up, down = y.sum(), len(y) - y.sum()
    if not up or not down:
        return 1.0, 0.0
    target = np.where(y > 0.5, (up + 1) / (up + 2), 1 / (down + 2))
    a, c = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * odds + c, -30, 30)))
        g = np.array([((p - target) * odds).sum() + 1e-3 * (a - 1), (p - target).sum()])
        v = p * (1 - p)
        h = np.array([[(v * odds * odds).sum() + 1e-3, (v * odds).sum()], [(v * odds).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, c = a - float(np.clip(step[0], -1, 1)), c - float(np.clip(step[1], -1, 1))
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 1e-3), c


@dataclass(frozen=True)
class CoTrained:
    text: Linear
    meta: Linear
    text_scale: tuple[float, float]
    meta_scale: tuple[float, float]
    prior: float
    threshold: float

    def scores(self, t: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Columns: calibrated text, metadata and combined probability of good quality."""
        a = self.text_scale[0] * self.text.odds(t) + self.text_scale[1]
        b = self.meta_scale[0] * self.meta.odds(m) + self.meta_scale[1]
        return 1 / (1 + np.exp(-np.clip(np.stack([a, b, a + b - self.prior], axis=1), -30, 30)))


def cotrain(text: np.ndarray, meta: np.ndarray, label: np.ndarray, rounds: int = ROUNDS) -> CoTrained | None:
    """label: 1 good, 0 bad, -1 unlabelled. Every fifth labelled row is held out for calibration and threshold."""
    known = np.flatnonzero(label >= 0)
    held, base = known[::5], known[np.arange(len(known)) % 5 > 0]
    pool = np.flatnonzero(label < 0)
    y = label.astype(np.float64)
    if len({*label[base].tolist()}) < 2:
        return None
    views, given = (text, meta), [{}, {}]  # row -> pseudo-label, by the view that learns from it
    models: list[Linear] = []
    for turn in range(rounds + 1):
        models = []
        for v in (0, 1):
            rows = np.concatenate([base, np.array([*given[v]], np.int64)])
            models.append(fit_linear(views[v][rows], np.concatenate([y[base], np.array([*given[v].values()], np.float64)])))
        if turn == rounds or not len(pool):
            break
        added = 0
        for v in (0, 1):
            p = 1 / (1 + np.exp(-models[v].odds(views[v][pool])))
            other = given[1 - v]
            for good, sure in ((1, p), (0, 1 - p)):
                best = [i for i in np.argsort(-sure, kind="stable")[: 4 * HANDED] if sure[i] >= CONFIDENT and int(pool[i]) not in other][:HANDED]
                other.update({int(pool[i]): good for i in best})
                added += len(best)
        if not added:
            break
    scale = [platt(models[v].odds(views[v][held]), y[held]) for v in (0, 1)]
    up = float(y[held].sum())
    prior = float(np.log((up + 1) / (len(held) - up + 1)))  # both views' log-odds hold it; it counts once
    model = CoTrained(models[0], models[1], scale[0], scale[1], prior, 0.5)
    good = model.scores(text[held], meta[held])[:, 2][y[held] > 0.5]
    cut = float(np.quantile(good, 1 - KEEP_GOOD)) if len(good) else 0.5
    if cut > 0.5:  # halfway, in log-odds, from even odds to the held-out good documents
        cut = 1 / (1 + (1 / cut - 1) ** 0.5)
    return CoTrained(models[0], models[1], scale[0], scale[1], prior, cut)


def _metadata(df: DataFrame) -> list:
    """Language, source, characters (n_chars where it is known, else counted) and lines; counted before Python."""
    named = [text_of(c) if c in df.columns else F.lit("") for c in ("lang", "source")]
    length = F.length(text_of()).cast("long")
    chars = F.greatest(F.lit(0), F.coalesce(F.col("n_chars").cast("long"), length)) if "n_chars" in df.columns else length
    return [*named, chars, (F.length(text_of()) - F.length(F.replace(text_of(), F.lit("\n"), F.lit(""))) + 1).cast("long")]


def fit_on(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL) -> CoTrained | None:
    """Fit on bounded samples: labelled documents, and a pool of others, each those whose ids hash lowest."""
    lowest = lambda df, seed: df.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id")
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("label"))
    chosen = lowest(known.join(ids, "doc_id", "left_semi"), 1).limit(labelled)  # of the documents that are there
    others = lowest(ids, 2).limit(pool).withColumn("label", F.lit(-1))
    chosen = chosen.unionByName(others).groupBy("doc_id").agg(F.max("label").alias("label"))

    @F.pandas_udf("text binary, meta binary")
    def views(texts: pd.Series, langs: pd.Series, sources: pd.Series, chars: pd.Series, lines: pd.Series) -> pd.DataFrame:
        rows = zip(texts, langs, sources, chars, lines, strict=True)
        return pd.DataFrame([(text_view(t).astype(np.float16).tobytes(), metadata_view(*m).tobytes()) for t, *m in rows], columns=["text", "meta"])

    met = docs.join(F.broadcast(chosen), "doc_id")  # at most labelled + pool rows are sent
    seen = met.select("doc_id", "label", views(text_of(), *_metadata(docs)).alias("v"))
    rows = seen.groupBy("doc_id").agg(F.first("label").alias("label"), F.min("v").alias("v")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    if not rows:
        return None
    text = np.stack([np.frombuffer(r.v.text, np.float16).astype(np.float32) for r in rows])
    meta = np.stack([np.frombuffer(r.v.meta, np.float32) for r in rows])
    return cotrain(text, meta, np.array([r.label for r in rows]))


def scored(docs: DataFrame, model: CoTrained | None) -> tuple[DataFrame, str]:
    """docs with struct(text_score, meta_score, score, kept); its name. No shuffle."""
    name = fresh(docs, "quality")

    @F.pandas_udf("text_score double, meta_score double, score double, kept boolean")
    def score(texts: pd.Series, langs: pd.Series, sources: pd.Series, chars: pd.Series, lines: pd.Series) -> pd.DataFrame:
        n = len(texts)
        if model is None or not n:
            return pd.DataFrame({"text_score": [0.5] * n, "meta_score": [0.5] * n, "score": [0.5] * n, "kept": [True] * n})
        t = np.stack([text_view(x) for x in texts])
        m = np.stack([metadata_view(*x) for x in zip(langs, sources, chars, lines, strict=True)])
        p = model.scores(t, m)
        return pd.DataFrame({"text_score": p[:, 0], "meta_score": p[:, 1], "score": p[:, 2], "kept": p[:, 2] >= model.threshold})

    return docs.withColumn(name, score(text_of(), *_metadata(docs))), name


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source", "n_chars")
    out, name = scored(docs, fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return out.select("doc_id", f"`{name}`.*")

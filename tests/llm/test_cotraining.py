"""Co-training on held-out labels, and the exchange of pseudo-labels on made-up views."""

from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
import pytest

from cueflow.llm import common, cotraining


def test_labels_that_the_fit_has_not_seen(spark, sf_dir, tmp_path):
    d = sf_dir.replace("0.001", "0.1")
    labels = pq.read_table(f"{d}/labels.parquet").to_pylist()
    held = {r["doc_id"]: r["quality"] for r in labels if r["doc_id"] % 5 == 0}
    seen = [(r["doc_id"], r["quality"]) for r in labels if r["doc_id"] % 5]
    docs = common.documents(spark, d)
    common.small_batches(spark)
    model = cotraining.fit_on(docs, spark.createDataFrame(seen, "doc_id long, quality int"))
    out, name = cotraining.scored(docs, model)
    got = {r.doc_id: r[name].kept for r in out.select("doc_id", name).collect()}
    good, bad = [i for i, q in held.items() if q], [i for i, q in held.items() if not q]
    assert len(good) > 50 and len(bad) >= 50
    assert sum(got[i] for i in good) >= 0.99 * len(good)
    assert sum(not got[i] for i in bad) >= 0.95 * len(bad)


def test_views_teach_each_other():
    """Few labels, two views that each tell the classes apart: pseudo-labels bring the weaker one up."""
    rng = np.random.default_rng(2)
    n = 1200
    y = rng.random(n) < 0.5
    text = rng.normal(size=(n, 12)).astype(np.float32)
    meta = rng.normal(size=(n, 12)).astype(np.float32)
    text[:, 0] += np.where(y, 3.0, -3.0)
    meta[:, :4] += np.where(y, 0.9, -0.9)[:, None]
    label = np.full(n, -1)
    label[:20] = y[:20]
    accuracy = lambda m: float(((m.meta.odds(meta[20:]) > 0) == y[20:]).mean())
    alone, taught = cotraining.cotrain(text, meta, label, rounds=0), cotraining.cotrain(text, meta, label)
    assert accuracy(taught) >= accuracy(alone) and accuracy(taught) > 0.93
    p = taught.scores(text[20:], meta[20:])
    assert ((p[:, 2] > 0.5) == y[20:]).mean() > 0.97
    assert p.min() >= 0 and p.max() <= 1


def test_metadata_view_reads_no_words():
    a = cotraining.metadata_view("en", "src1", 300, 4)
    assert a.shape == cotraining.metadata_view("", "", 0, 1).shape
    assert np.isfinite(cotraining.metadata_view("", "", 0, 1)).all()


@pytest.mark.parametrize("n_chars", [None, -5])
def test_awkward_metadata(spark, n_chars):
    common.small_batches(spark)
    df = spark.createDataFrame([(1, "a b\nc", None, None, n_chars), (2, None, "en", "s", n_chars)], "doc_id long, text string, lang string, source string, n_chars long")
    out, name = cotraining.scored(df, None)
    assert [r[name].kept for r in out.collect()] == [True, True]

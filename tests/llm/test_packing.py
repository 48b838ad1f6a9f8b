"""Packing: related documents meet in a shard, whatever the number of shards."""

from __future__ import annotations

from decimal import Decimal

import numpy as np

from cueflow.llm import packing


def brute(docs: list[np.ndarray], seed: int) -> np.ndarray:
    """BM25 of every document for all ids of the seed, term by term."""
    n, mean = len(docs), sum(map(len, docs)) / len(docs)
    out = np.zeros(n)
    for t in sorted({*docs[seed].tolist()}):
        df = sum(t in d for d in docs)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        for k, d in enumerate(docs):
            tf = int((d == t).sum())
            out[k] += idf * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(d) / mean)) if tf else 0.0
    return out


def test_scores_use_all_terms_and_all_documents():
    rng = np.random.default_rng(3)
    docs = [np.append(rng.zipf(1.3, int(rng.integers(1, 200))) % 500 + 2, 1).astype(np.uint16) for _ in range(60)]
    index = packing.Index(docs, packing.Stats.of(docs))
    for seed in (0, 7, 59):
        others = np.arange(60) != seed
        assert np.allclose(index.scores(np.unique(docs[seed]))[others], brute(docs, seed)[others])
    # a shard scores by the statistics of all documents, not by its own
    part = packing.Index(docs[:20], packing.Stats.of(docs))
    others = np.arange(20) != 7
    assert np.allclose(part.scores(np.unique(docs[7]))[others], brute(docs, 7)[:20][others])


def test_seed_with_many_ids_of_its_own_finds_its_relative():
    seed = np.arange(100, 160, dtype=np.uint16)  # most of its ids occur nowhere else
    other = [np.array([5, 6, 7, k + 1000], np.uint16) for k in range(40)]
    docs = [seed, np.append(seed[:3], np.arange(300, 340)).astype(np.uint16), *other]
    docs += [np.array([*seed[:3], 9], np.uint16)] * 2
    found = [*packing.Index(docs, packing.Stats.of(docs)).neighbours(np.unique(docs[0]), np.arange(len(docs)) > 0)]
    assert {*found[:3]} == {1, 42, 43}


def test_copies_and_relatives_share_a_shard(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_BYTES", 20_000)
    rng = np.random.default_rng(4)
    own = [["".join(rng.choice([*"abcdefghijklmnopqrstuvwxyz"], 6)) for _ in range(30)] for _ in range(200)]
    text = lambda k: " ".join(f"{w} of all" for w in rng.permutation(own[k]))
    rows = [(1000 * c + k, text(k)) for c in range(2) for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r.doc_id: r.sequence_id >> 40 for r in packing.packed(df).select("doc_id", "sequence_id").distinct().collect()}
    assert len({*got.values()}) > 5
    assert sum(got[k] == got[1000 + k] for k in range(200)) >= 180


def test_neighbours_are_in_brute_force_order():
    rng = np.random.default_rng(8)
    docs = [np.append(rng.zipf(1.4, int(rng.integers(1, 120))) % 400 + 2, 1).astype(np.uint16) for _ in range(150)]
    index = packing.Index(docs, packing.Stats.of(docs))
    for seed in (3, 77):
        unused = np.arange(150) % 5 > 0
        unused[seed] = False
        want, got = brute(docs, seed), [*index.neighbours(np.unique(docs[seed]), unused)]
        assert sorted(got) == np.flatnonzero(unused & (want > 0)).tolist()  # every one, not the first few
        assert all(want[a] >= want[b] - 1e-4 for a, b in zip(got, got[1:], strict=False))


def test_large_ranges_are_cut(spark, monkeypatch):
    """One range, several shards: sequences keep their own numbers and offsets."""
    monkeypatch.setattr(packing, "MAX_RANGES", 1)
    monkeypatch.setattr(packing, "SHARD_BYTES", 3000)
    rows = [(k, " ".join(f"w{(k * 7 + i) % 97}" for i in range(k % 90))) for k in range(300)]
    out = packing.packed(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by: dict = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= 2048 and at & (at - 1) == 0
    assert sum(r.length for r in out) == sum({r.doc_id: r.doc_tokens for r in out}.values())
    assert len({r.doc_id for r in out}) == 300 and sum(n & (n - 1) == 0 and n < 2048 for n in (sum(x for _, x in p) for p in by.values())) > 5


def test_ids_of_documents_keep_their_values(spark):
    """Nulls beside large numbers, and ids of other types."""
    for kind, ids in (("long", [None, 2**62 + 1, -(2**63), 7]), ("string", [None, "x", "", "é"]), ("decimal(30,2)", [None, *map(Decimal, ("1.25", "12345678901234567890.5", "0"))])):
        df = spark.createDataFrame([(i, "some words here") for i in ids], f"doc_id {kind}, text string")
        assert {r.doc_id for r in packing.packed(df).collect()} == {r.doc_id for r in df.collect()}

"""Fingerprints against a plain version, and next documents for all kinds of ids."""

from __future__ import annotations

import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from cueflow.llm import fingerprints as f


def _seeded(seed: int, text: str) -> int:
    """Spark's xxhash64(seed, text): the seed's hash is the seed of the text's hash."""
    first = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)
    return xxhash.xxh64_intdigest(text.encode(), first)


def brute(text: str) -> list[int]:
    lines = [p for p in text.split("\n") if p]
    sums = [sum(_seeded(s, p) for p in lines) % (1 << 62) for s in range(f.SEEDS)]
    pieces = [q for p in re.split(f.CUT, text) if p for q in re.findall(f"(?s).{{1,{f.PIECE_CHARS}}}", p)]
    lanes = [0] * f.LANES
    for p in pieces:
        h = _seeded(f.SEEDS, p)
        k = (h - (1 << 64) if h >> 63 else h) % (2 * f.LANES)
        lanes[k % f.LANES] += 1 if k < f.LANES else -1
    m = f.LANE_MASK
    return [*sums, len(pieces), *((lanes[i] & m) | (lanes[i + 21] & m) << 21 | (lanes[i + 42] & m) << 42 for i in range(21))]


def hexed(words: list[int]) -> str:
    return "".join(f"{w:016x}" for w in words)


def near(a: list[int], b: list[int]) -> float:
    if a == b:
        return 1.0
    d = 0
    for x, y in zip(a[5:], b[5:], strict=True):
        for k in range(3):
            v = ((x >> 21 * k & f.LANE_MASK) - (y >> 21 * k & f.LANE_MASK)) % (1 << 21)
            d += (v - (1 << 21) if v >= 1 << 20 else v) ** 2
    return max(0.0, 1 - d / max(1, a[4] + b[4]))


def check(rows: list[tuple], got: list, order) -> None:
    rows = sorted(((i, t or "") for i, t in rows), key=order)
    by: dict = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        n = len(t) // 4
        e = t[: len(t) - n] + nxt[:n]
        a, b = brute(t), brute(e)
        r = next(x for x in by[i] if x.fingerprint == hexed(a) and x.edited_sha256 == hashlib.sha256(e.encode()).hexdigest())
        assert (r.n_chars, r.edited_fingerprint) == (len(t), hexed(b))
        assert abs(r.near_edited - near(a, b)) < 1e-9 and abs(r.near_next - near(a, brute(nxt))) < 1e-9


TEXTS = ["one two. three\nfour five\n\nsix, seven eight nine", "", "a", "é漢字🙂 " * 40 + "x" * 300, "one two. three\nfour five", "\n\n", "words here and there, " * 30 + "\n" + "last line of it\n" * 9, None]


@pytest.mark.parametrize(
    "kind,ids",
    [
        ("bigint", [-(2**63), 2**63 - 1, 0, 5, -7, 10**17, 3, 4]),
        ("string", ["doc-1", "doc-10", "doc-9", "doc-é", "doc-", "doc-zz", "doc-1a", "doc-2"]),
        ("double", [0.5, -3.25, 1e300, 2.0, 7.5, -1e-9, 3.0, 9.0]),
    ],
)
def test_brute_force(spark, monkeypatch, kind, ids):
    rows = [(i, t) for i, t in zip(ids, TEXTS, strict=True)]
    key = lambda r: r[0].encode() if kind == "string" else r[0]
    df = spark.createDataFrame(rows, f"doc_id {kind}, text string")
    check(rows, f.fingerprint_report(df).collect(), key)
    monkeypatch.setattr(f, "RANGE_BYTES", 200)  # many ranges
    check(rows, f.fingerprint_report(df).collect(), key)


def test_awkward_rows(spark, awkward):
    got = f.fingerprint_report(awkward).collect()
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert len(got) == len(rows)
    known = [r for r in rows if r[0] is not None]
    once = [r for r in known if r[0] != 5]
    last = [r for r in rows if r[0] is None]
    by = {r.doc_id: r for r in got}
    assert all(by[i].fingerprint == hexed(brute(t or "")) for i, t in once)
    assert sorted(r.fingerprint for r in got if r.doc_id is None) == sorted(hexed(brute(t or "")) for _, t in last)


def test_long_text_and_outliers(spark, monkeypatch):
    many = "a\n" * 2_200_000
    rows = [(1, many), (2, "b")]
    got = {r.doc_id: r for r in f.fingerprint_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert int(got[1].fingerprint[64:80], 16) == 2_200_000
    assert got[1].n_chars == 4_400_000 and got[2].near_next == 0.0


def test_ranges_follow_sparse_null_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(f, "RANGE_BYTES", 20_000)
    ids = F.when(F.col("id") == 0, F.lit(10**17)).when(F.col("id") % 4 == 1, None).when(F.col("id") % 4 == 2, 777).otherwise(F.col("id"))
    df = spark.range(4000).select(ids.alias("doc_id"), F.lit("x" * 100).alias("text"), F.xxhash64("id").alias("key"))
    placed = df.withColumn("place", f._ranges(df, "doc_id", "key", F.lit(164).cast("long")))
    most = placed.groupBy("place").count().agg(F.max("count")).first()[0]
    assert most < 4 * 20_000 / 164
    order = placed.groupBy("place").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count_if(F.col("doc_id").isNull()).alias("nulls"), F.count("*").alias("n")).orderBy("place").collect()
    assert all(r.nulls in (0, r.n) for r in order)
    real = [r for r in order if not r.nulls]
    assert all(a.hi <= b.lo for a, b in zip(real, real[1:], strict=False))
    assert [r.nulls > 0 for r in order] == sorted((r.nulls > 0 for r in order), reverse=True)

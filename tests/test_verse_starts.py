"""Verse starts of chapters whose verses are not all found, and headers in fusion."""

from __future__ import annotations

from cueflow.operators import chapters as c
from cueflow.plans import chapters as plans

REF = "chapter long, verse int, pos int, word string, widx long"
LINE = "chapter long, widx long, text string, start double, end double, score double"
TEXT = [["alpha", "beta"], ["xyzzy"], ["delta", "omega", "kappa"], ["sigma", "lambda"]]


def reference_rows(chapter):
    flat = [(v, p, w) for v, ws in enumerate(TEXT, 1) for p, w in enumerate(ws)]
    return [(chapter, v, p, w, i) for i, (v, p, w) in enumerate(flat)]


def test_unanchored_verses_are_interpolated_by_words(spark):
    ref = spark.createDataFrame(reference_rows(1), REF)
    heard = [("alpha", 0.0), ("beta", 1.0), ("sigma", 9.0), ("lambda", 10.0)]
    asr = spark.createDataFrame([(1, i, w, s, s + 0.4, 0.9) for i, (w, s) in enumerate(heard)], LINE)
    words = c.aligned(ref, spark.createDataFrame([], LINE), asr)
    got = {r.verse: r.ts for r in c.verse_starts(words).collect()}
    # between 0 and 9 s stand one word of verse 2 and three of verse 3
    assert got == {0: 0.0, 1: 0.0, 2: 0.0, 3: 2.25, 4: 9.0}


def test_header_is_cut_from_the_first_word(spark):
    ref = spark.createDataFrame(reference_rows(1), REF)
    flat = [w for ws in TEXT for w in ws]
    ctc = spark.createDataFrame([(1, i, w, 0.0 if i == 0 else 4.0 + i, 4.5 + i, 0.9) for i, w in enumerate(flat)], LINE)
    heard = [("psalms", 0.0), ("chapter", 1.0), *((w, 4.0 + i) for i, w in enumerate(flat))]
    asr = spark.createDataFrame([(1, i, w, s, s + 0.4, 0.5) for i, (w, s) in enumerate(heard)], LINE)
    got = {r.widx: r.start for r in c.fused_words(ctc, asr, 0.3, ref).collect()}
    assert got[0] == 4.0 and got[1] == 5.0
    first = c.aligned(ref, ctc, asr).where("verse = 1 and pos = 0").first()
    assert first.start == 4.0


def test_every_chapter_that_can_be_aligned_has_starts(spark, sf_dir):
    kinds = {r.chapter: r.strategy for r in plans.chapter_strategies(spark, sf_dir).collect()}
    got = {r.chapter for r in plans.aligned_verses_all(spark, sf_dir).select("chapter").distinct().collect()}
    assert got == {k for k, s in kinds.items() if s != "error"}

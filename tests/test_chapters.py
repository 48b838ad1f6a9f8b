"""Whole chapters, end to end."""

from __future__ import annotations

from cueflow.operators import chapters as c

REF = "chapter long, verse int, pos int, word string, widx long"
LINE = "chapter long, widx long, text string, start double, end double, score double"


def test_strategies_and_results(spark):
    ref = [(k, 1 + i // 2, i % 2, w, i) for k in (1, 2, 3, 4) for i, w in enumerate(["alpha", "beta", "gamma", "delta"])]
    line = lambda k, score, shift=0.0: [(k, i, w, i + shift, i + shift + 0.4, score) for i, w in enumerate(["alpha", "beta", "gamma", "delta"])]
    r = spark.createDataFrame(ref, REF)
    ctc = spark.createDataFrame([*line(1, 0.2), *line(2, 0.9), *line(9, 0.9)], LINE)
    asr = spark.createDataFrame([*line(1, 0.8, 0.3), *line(3, 0.8)], LINE)
    assert {x.chapter: x.strategy for x in c.chapter_strategies(r, ctc, asr).collect()} == {1: "both", 2: "ctc", 3: "asr", 4: "error", 9: "error"}
    words = c.aligned(r, ctc, asr).cache()
    got = {(x.chapter, x.verse, x.pos): (x.start, x.source) for x in words.collect()}
    assert set(k for k, _, _ in got) == {1, 2, 3}
    assert got[1, 1, 0] == (0.3, "asr") and got[2, 2, 1] == (3.0, "ctc") and got[3, 2, 0] == (2.0, "asr")
    assert sorted((x.chapter, x.verse, x.ts) for x in c.verse_starts(words).where("chapter = 2").collect()) == [(2, 0, 0.0), (2, 1, 0.0), (2, 2, 2.0)]
    q = {x.chapter: x for x in c.chapter_quality(words).collect()}
    assert (q[1].from_asr, q[1].from_ctc, q[1].total_words) == (4, 0, 4) and q[2].from_ctc == 4 and q[3].low_quality_count == 0

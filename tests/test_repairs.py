"""Gap filling, drift, restarts and windows by hand-computed cases."""

from __future__ import annotations

from cueflow.operators import alignment as a
from cueflow.operators import chapters as c
from cueflow.session import ship


def fused(*words) -> list[a.Fused]:
    return [a.Fused(t, s, s + 0.3, score, "ctc", score, None) for t, s, score in words]


class Script:
    """Gives what is listed, in turn, and notes the windows."""

    def __init__(self, *answers):
        self.answers, self.asked = list(answers), []

    def align(self, chapter, lo, hi, words):
        self.asked.append((round(lo, 2), round(hi, 2), list(words)))
        got = self.answers.pop(0)
        if got is None:
            raise RuntimeError("too short")
        return [a.Word(w, s, s + 0.2, p) for w, s, p in got]


def test_a_gap_is_filled_and_the_next_try_ends_it():
    words = fused(("in", 0.0, 0.9), ("the", 6.0, 0.9), ("beginning", 6.4, 0.9), ("was", 12.0, 0.9))
    heard = [a.Word("title", 0.2, 0.9), a.Word("in", 5.6, 5.8)]
    s = Script([("in", 5.5, 0.8)], [("beginning", 3.0, 0.9)])
    out = a.gaps_filled(1, words, heard, s)
    assert s.asked == [(0.7, 7.0, ["in"]), (10.0, 13.0, ["beginning"])]
    assert [(w.start, w.source) for w in out] == [(5.5, "gap_fill"), (6.0, "ctc"), (6.4, "ctc"), (12.0, "ctc")]
    assert a.gaps_filled(1, words, [], Script(None)) == words


def test_drift_behind_a_gap_is_corrected_once():
    words = fused(("one", 1.0, 0.9), ("two", 9.0, 0.2), ("three", 9.5, 0.9), ("four", 20.0, 0.9), ("five", 30.0, 0.9))
    heard = [a.Word("one", 1.0, 1.2, 0.9), a.Word("two", 2.0, 2.2, 0.9), a.Word("five", 12.0, 12.5, 0.9)]
    s = Script([("one", 1.1, 0.95), ("two", 2.1, 0.7)])
    out = a.drift_corrected(1, words, heard, s)
    assert s.asked == [(0.5, 9.5, ["one", "two"])]
    assert (out[0].start, out[0].score, out[0].source) == (1.0, 0.95, "ctc")
    assert (out[1].start, out[1].source) == (2.1, "drift_fix") and out[2:] == words[2:]
    assert a.drift_corrected(1, words, heard[:1], Script()) == words  # nothing was heard earlier


def test_restart_after_a_collapse_is_stitched():
    verses = [["a", "b", "c"], ["d", "e", "f", "g"], ["h", "i"]]
    lost = [(w, k, 0.9 if k < 4 else 0.05) for k, w in enumerate("abcdefghi")]
    again = [(w, 20 + k, 0.8) for k, w in enumerate("defghi")]
    heard = [a.Word("x", 0, 1, 0.9)] * 3 + [a.Word("d", 19.5, 20, 0.9)]
    s = Script(lost, again)
    out = a.forced(1, verses, 60.0, s, heard)
    assert s.asked[1] == (19.5, 60.0, [*"defghi"])
    assert [w.text for w in out] == [*"abcdefghi"] and [w.start for w in out] == [0, 1, 2, 20, 21, 22, 23, 24, 25]
    assert a.collapsed_at([a.Word("w", 0, 0, 0.1)] * 4) is None


def test_clips_are_moved_back():
    clip = a.ClipAligner(lambda ch, lo, hi, words: [a.Word(w, 0.111, 0.222) for w in words])
    assert clip.align(1, 10.0, 12.0, ["x"]) == [a.Word("x", 10.11, 10.22)] and clip.align(1, 5, 5, ["x"]) == []


def even():
    """Words a second apart from the window's beginning; a class of its own, so that workers get it by value."""

    class Even:
        def align(self, chapter, lo, hi, words):
            from cueflow.operators.alignment import Word

            return [Word(w, lo + k, lo + k + 0.5, 0.9) for k, w in enumerate(words)]

    return Even


def test_verse_only_chapter(spark):
    ship(spark)
    Even = even()
    ref = spark.createDataFrame([(1, 1, 0, "a"), (1, 1, 1, "b"), (1, 3, 0, "c")], "chapter long, verse long, pos long, word string")
    lengths = spark.createDataFrame([(1, 30.0)], "chapter long, seconds double")
    got = c.verse_only(ref, lengths, Even).orderBy("verse", "pos").collect()
    assert [(r.start, r.score, r.source, r.ts) for r in got] == [(0.0, 0.9, "local", 0.0), (1.0, 0.9, "local", 0.0), (12.0, 0.9, "local", 12.0)]
    verses = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "chapter long, verse long")
    starts = c.verse_only_starts(c.verse_only(ref, lengths, Even), verses).orderBy("verse").collect()
    assert [(r.verse, r.ts) for r in starts] == [(0, 0.0), (1, 0.0), (2, 0.0), (3, 12.0)]
    stats = c.segment_stats(c.verse_only(ref, lengths, Even)).first()
    assert (stats.segments, stats.fallbacks, stats.avg_score) == (2, 0, 0.9)


def test_limits_rules_and_preserved_timings(spark):
    ship(spark)
    cols = "chapter long, widx long, text string, start double, end double, score double"
    ctc = spark.createDataFrame([(1, 0, "x", 0.0, 0.5, 0.2), (2, 0, "x", 0.0, 0.5, 0.2)], cols)
    asr = spark.createDataFrame([(1, 0, "x", 0.1, 0.6, 0.9), (2, 0, "x", 0.1, 0.6, 0.9)], cols)
    limits = spark.createDataFrame([(2, 0.01)], "chapter long, threshold double")
    got = {r.chapter: r.source for r in c.fused_words(ctc, asr, limits=limits).collect()}
    assert got == {1: "asr", 2: "ctc"}
    items = spark.createDataFrame([(1, True), (2, False)], "chapter long, preserve_existing_timing boolean")
    assert [r.chapter for r in c.without_preserved(ctc, items, ["chapter"]).collect()] == [2]

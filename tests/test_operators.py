"""Hand-checked micro-fixtures of the operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from cueflow.functions import similarity as sim
from cueflow.functions import text as x
from cueflow.operators import alignment as a
from cueflow.operators import planning as p
from cueflow.operators import sequence as seq
from cueflow.operators import timing as t


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_monotone_repair_restarts_after_null(spark):
    df = frame(spark, [(1, i, v) for i, v in enumerate([1.0, 0.5, None, 0.2, 0.1])], "c int, i int, t double")
    got = seq.monotone_repair(df, ["c"], ["i"], "t").orderBy("i").collect()
    assert [r.repaired for r in got] == [1.0, 1.0, None, 0.2, 0.2]


def test_collapse(spark):
    scores = [0.9, 0.1, 0.1, 0.1, 0.1, 0.2, 0.05, 0.1, 0.0, 0.1, 0.1]
    df = frame(spark, [(1, i, s) for i, s in enumerate(scores)], "c int, i int, s double")
    assert [r.first_index for r in seq.first_run(df, ["c"], "i", F.col("s") <= 0.1, 5).collect()] == [6]
    for tail, low in (([0.05, 0.9, 0.9, 0.9], 1), ([0.05, 0.1, 0.9, 0.9], 2)):
        half = frame(spark, [(1, i, s) for i, s in enumerate([0.9] * 4 + tail)], "c int, i int, s double")
        r = seq.second_half_share(half, ["c"], "i", F.col("s") <= 0.1).first()
        assert (r.n_half, r.n_low) == (4, low)


def test_defects_and_nulls(spark):
    df = frame(spark, [(1, v, s) for v, s in enumerate([0.0, 5.0, 5.0, 4.9, 4.95, 200.0], 1)], "c int, v int, s double")
    r = t.defects(df, ["c"], ["v"], "s").first()
    assert (r.n_dupes, r.n_backwards, r.n_tiny, r.n_gaps) == (1, 1, 1, 1)
    df = frame(spark, [(1, i, v) for i, v in enumerate([1.0, None, 1.0, 2.0])], "c int, i int, t double")
    r = t.null_and_repeat_counts(df, ["c"], ["i"], "t").first()
    assert (r.n_nulls, r.n_dupes, r.n_words) == (1, 1, 4)
    df = frame(spark, [(1, i, v) for i, v in enumerate([0.0, None, 9.0, 13.0, 20.0])], "c int, i int, t double")
    assert [(r.i, r.gap) for r in seq.first_gap(df, ["c"], "i", "t", 3).collect()] == [(2, 4.0)]


def test_pace_and_anchors(spark):
    df = frame(spark, [(1, i, w) for i, w in enumerate([2, 3, 5])], "c int, i int, w long")
    assert [r.expected for r in seq.pace(df, ["c"], ["i"], "w", F.lit(20)).orderBy("i").collect()] == [0, 4, 10]
    df = frame(spark, [(1, 1, 3, 0), (1, 2, 2, None), (1, 3, 4, None), (1, 4, 3, 18)], "c int, v int, w long, a long")
    assert [r.start for r in seq.anchor_interpolate(df, ["c"], "v", "w", "a").orderBy("v").collect()] == [0, 0, 6, 18]


def test_segments_and_end_stamps(spark):
    df = frame(spark, [(0, 4, ["a", "b"])], "s int, e int, w array<string>")
    assert [(r.word, r.word_start, r.word_end) for r in seq.per_segment_words(df, "s", "e", "w").collect()] == [("a", 0, 2), ("b", 2, 4)]
    df = frame(spark, [(1, 1, 4.0), (1, 2, 9.5), (1, 3, 12.0)], "c int, line int, e double")
    assert sorted((r.verse, r.start) for r in seq.end_to_start(df, ["c"], "line", "e").collect()) == [(0, 0.0), (1, 0.0), (2, 4.0), (3, 9.5), (4, 12.0)]


def test_preference(spark):
    df = frame(spark, [(1, "std", 0), (1, "drama", 1), (2, "drama", 1)], "c int, f string, d int")
    assert sorted((r.c, r.f) for r in seq.prefer(df, ["c"], F.col("d") == 0).collect()) == [(1, "std"), (2, "drama")]


def test_deltas(spark):
    df = frame(spark, [(1, 1, 0, 1), (1, 2, 10, 11), (1, 3, 20, 20)], "c int, verse int, downloaded long, pipeline long")
    r = t.delta_stats(df, ["c"], 1, 2).first()
    assert (r.n, r.sum_delta, r.max_delta, r.max_verse, r["class"]) == (3, 2, 1, 1, "GOOD")


def test_specs(spark):
    books = frame(spark, [("JHN", "NT", 21), ("GEN", "OT", 50), ("OBA", "OT", 1)], "book string, canon string, n_chapters int")
    specs = frame(spark, [(1, "JHN,GEN:1-3,17"), (2, "GEN:1-3,5-7"), (3, "ot"), (4, "XXX:1,2,GEN:9"), (5, "GEN:x")], "k int, s string")
    got: dict = {}
    for r in p.expand_spec(specs, "k", "s", books).collect():
        got.setdefault(r.k, {}).setdefault(r.book, set()).add(r.chapter)
    assert got[1] == {"JHN": set(range(1, 22)), "GEN": {1, 2, 3, 17}}
    assert got[2] == {"GEN": {1, 2, 3, 5, 6, 7}}
    assert got[3] == {"GEN": set(range(1, 51)), "OBA": {1}}
    assert got[4] == {"GEN": {9}} and 5 not in got
    df = frame(spark, [("GEN", c) for c in (1, 2, 3, 17)] + [("OBA", 1)], "book string, chapter int")
    assert {r.spec for r in p.format_full(df, books, "book", "chapter").collect()} == {"GEN:1-3,17", "OBA"}


def test_resolution(spark):
    df = frame(spark, [("XYZABC", "a:N2DA"), ("XYZABC", "A:QQQN1DA")], "iso string, raw string")
    assert [r.id for r in df.select(p.resolved_id("iso", "raw").alias("id")).collect()] == ["XYZABCN2DA", "QQQN1DA"]
    assert frame(spark, [("XYZABCN1DA-opus16",)], "f string").select(p.without_suffix("f").alias("f")).first().f == "XYZABCN1DA"
    c = frame(spark, [("xxx:ntp", 1)], "key string, entry int")
    assert p.with_partial(c, frame(spark, [("xxx:nt",)], "key string"), "key", "entry").first().entry == 1
    files = frame(spark, [(1, 5)], "k int, mtime int")
    assert p.stale(files, frame(spark, [(1, 4)], "k int, mtime int"), ["k"]).count() == 1
    assert p.stale(files, frame(spark, [(1, 6)], "k int, mtime int"), ["k"]).count() == 0
    cov = frame(spark, [("A", 1)], "u string, ch int")
    assert sorted((r.u, r.ch) for r in p.keep_unless_known(frame(spark, [("A", 1), ("A", 2), ("B", 2)], "u string, ch int"), cov, "u", ["ch"]).collect()) == [("A", 1), ("B", 2)]


def test_shards_and_chunks(spark):
    df = frame(spark, [(1, "A", 5), (1, "B", 4), (1, "C", 3), (1, "D", 3)], "g int, item string, size long")
    got: dict = {}
    for r in p.balanced_shards(df, ["g"], "size", "item", 2).collect():
        got.setdefault(r.shard, set()).add(r.item)
    assert sorted(map(sorted, got.values())) == [["A", "D"], ["B", "C"]]
    df = frame(spark, [([*range(n)],) for n in (0, 1, 16, 17, 28, 40, 41)], "v array<int>")
    df = df.withColumn("c", p.overlapping_chunks("v", 16, 4)).withColumn("back", p.stitched("c", 4))
    assert all(r.v == r.back for r in df.collect())


def test_text(spark):
    df = frame(spark, [("é, कि!",)], "t string")
    assert df.select(x.cleaned("t").alias("c")).first().c == "e क"
    assert frame(spark, [(3661500,)], "ms long").select(x.srt_time("ms").alias("s")).first().s == "01:01:01,500"
    assert [r.d for r in frame(spark, [(3725,), (65,), (9,)], "s long").select(x.duration("s").alias("d")).collect()] == ["1h 02m 05s", "1m 05s", "9s"]
    df = frame(spark, [("DAN", 2), ("DAN", 3)], "b string, c int").select(x.in_passages("b", "c", ["DAN 2:4-49"]).alias("i"))
    assert [r.i for r in df.collect()] == [True, False]
    md = "\n# 1. Title\n\n![a](b)\n\nOne.\n\n![c](d)\n\nTwo\nlines.\n\n![e](f)\n\n_A Bible story from: X_\n"
    assert frame(spark, [(md,)], "t string").select(x.story_segments("t").alias("s")).first().s == ["One.", "Two\nlines."]


def test_similarity():
    assert sim.ratio("abcd", "bcde") == 0.75
    assert sim.bag_similarity(["a", "b"], ["b", "a"]) == 1.0 and sim.bag_similarity([], ["a"]) == 0.0


def words(*spec):
    return [a.Word(w, s, s + 0.4, score) for w, s, score in spec]


def test_fusion():
    asr = words(("alpha", 1.0, 0.8))
    assert a.fuse(words(("alpha", 1.1, 0.2)), asr)[0].source == "asr"
    assert a.fuse(words(("alpha", 1.1, 0.2)), words(("alpha", 1.0, 0.1)))[0].source == "ctc"
    assert a.fuse(words(("alpha", 4.0, 0.2)), asr)[0].source == "ctc"
    assert a.fuse(words(("zzzz", 1.0, 0.2)), asr)[0].source == "ctc"
    assert a.fuse([a.Word("alpha", 1.0, 3.0, 0.9)], asr, header=2.0)[0].start == 2.0


def test_header():
    heard = words(("book", 0.0, 1), ("of", 0.5, 1), ("gen", 1.0, 1), ("one", 1.5, 1), ("in", 2.0, 1), ("the", 2.5, 1), ("beginning", 3.0, 1), ("god", 3.5, 1), ("created", 4.0, 1))
    assert a.header_boundary("In the beginning God created", heard) == (1.0, "book of")  # the first window with three of five words
    assert a.header_boundary("qqq www eee", words(("x", 0, 1), ("y", 9.0, 1))) is None
    assert a.header_boundary("qqq www eee", words(("x", 0, 1), ("y", 7.0, 1))) == (7.0, "x")


def test_anchors_and_stamps():
    verses = [["a1", "b2", "c3"], [], ["d4", "e5", "f6"]]
    assert a.verse_anchors(verses, ["a1", "b2", "c3", "d4", "e5", "f6"]) == [0, None, 3]
    asr = words(("hello", 0.0, 1), ("wor", 1.0, 1), ("ld", 1.5, 1), ("again", 2.0, 1))
    assert a.word_stamps(["hello", "...", "again"], asr, 0) == [(0.0, 0.4), None, (2.0, 2.4)]


def test_restart_and_windows():
    asr = words(("a", 1.0, 0.9), ("b", 2.0, 0.1), ("b", 3.0, 0.9))
    assert a.restart_time("b", asr, 0) == 3.0 and a.restart_time("zz", asr, 1) == 2.0 and a.restart_time("zz", asr, 9) is None

    class Silent:
        def align(self, chapter, lo, hi, words):
            return [a.Word(w, lo, lo + 0.1, 0.1) for w in words]

    got = a.windowed(1, [["x"] * 4, ["y"] * 6], 20.0, Silent())
    assert [(s.start, s.source) for s in got] == [(0.0, "fallback"), (8.0, "fallback")]
    got = a.windowed(1, [["x"] * 4, ["y"] * 6], 20.0, a.TableAligner([a.Word(str(i), i * 2.0, i * 2.0 + 1, 0.9) for i in range(10)]))
    assert all(s.source == "local" for s in got) and got[0].end <= got[1].start


def test_spec_round_trip(spark):
    books = frame(spark, [("GEN", "OT", 50)], "book string, canon string, n_chapters int")
    df = frame(spark, [("GEN", c) for c in (1, 2, 5, 6, 7, 9, 50)], "book string, chapter int")
    spec = p.format_full(df, books, "book", "chapter").withColumn("k", F.lit(1))
    assert sorted(r.chapter for r in p.expand_spec(spec, "k", "spec", books).collect()) == [1, 2, 5, 6, 7, 9, 50]


def test_not_done_is_idempotent(spark):
    work = frame(spark, [(1,), (2,)], "k int")
    todo = p.not_done(work, frame(spark, [(1,)], "k int"), ["k"])
    assert [r.k for r in todo.collect()] == [2] and p.not_done(work, work, ["k"]).count() == 0


def test_dimensions(spark):
    from cueflow.functions import reference_data as ref

    b = {r.canon: (r.n, r.k) for r in ref.books(spark).groupBy("canon").agg(F.count("*").alias("n"), F.sum("n_chapters").alias("k")).collect()}
    assert b == {"OT": (39, 929), "NT": (27, 260)}
    langs = {r.iso: r.asr_lang for r in ref.recogniser_languages(spark).collect()}
    assert len(langs) == 40 and langs["ibo"] is None and langs["yue"] == langs["cmn"] == "zh"
    df = frame(spark, [("GEN",), ("REV",), ("XXX",)], "b string")
    assert [r.c for r in df.select(ref.canon_of("b").alias("c")).collect()] == ["OT", "NT", "UNKNOWN"]
    assert ref.testaments("nt") == ["NT"] and ref.testaments(None) == ["NT", "OT"]
    specs = frame(spark, [(1, "OBA,JHN:3")], "k int, s string")
    assert sorted((r.book, r.chapter) for r in p.expand_spec(specs, "k", "s", ref.books(spark)).collect()) == [("JHN", 3), ("OBA", 1)]


def test_urls_and_versions(spark):
    from cueflow.operators import discovery as d

    df = frame(spark, [("http://b/", "A01", "Genesis", 7), ("http://b/", "A", "Psalm", 119)], "b string, c string, t string, n int")
    assert [r.u for r in df.select(d.audio_url("b", "c", "t", "n").alias("u")).collect()] == ["http://b/A0107-Genesis_Kapitel-007.mp3", "http://b/A0119-Psalm_Kapitel-119.mp3"]
    ids = frame(spark, [("fra", "FRALSN"), ("fra", "FRNTLS"), ("eng", "XYZ")], "iso string, id string")
    versions = frame(spark, [("TLS", 1), ("S", 2)], "version string, ordinal int")
    assert {r.id: r.version for r in d.version_ids(ids, versions).collect()} == {"FRALSN": "LSN", "FRNTLS": "TLS", "XYZ": "XYZ"}


def test_effective_threshold(spark):
    df = frame(spark, [("DAN", 3), ("DAN", 9)], "b string, c int")
    got = df.select(x.effective_threshold("b", "c", x.LanguageRules(passages=("DAN 3",))).alias("t")).collect()
    assert [r.t for r in got] == [0.01, 0.3]

"""File scans, sinks and the queue, on hand-made files."""

from __future__ import annotations

import json

import pytest

from cueflow.sources import files, sinks
from cueflow.streaming import queue


@pytest.fixture()
def root(tmp_path):
    d = tmp_path / "nt" / "deu" / "XYZ" / "GEN"
    d.mkdir(parents=True)
    return d


def test_word_timelines(spark, root):
    (root / "GEN_017_A_B_mms_words.json").write_text(json.dumps({"book": "GEN", "chapter": "017", "words": [{"text": "a", "start": 1.0}, {"text": "b", "start": 2.0, "end": 3.0, "score": 0.5}]}))
    (root / "GEN_018_A_mms_words.json").write_text("{broken")
    rows = files.word_timelines(spark, str(root), "ctc").orderBy("widx").collect()
    assert [(r.canon, r.iso, r.distinct_id, r.book, r.chapter, r.fileset, r.widx, r.end, r.score) for r in rows] == [("nt", "deu", "XYZ", "GEN", 17, "A_B", 0, 1.0, None), ("nt", "deu", "XYZ", "GEN", 17, "A_B", 1, 3.0, 0.5)]


def test_verse_timings_last_wins(spark, root):
    (root / "GEN_001_A_timing.json").write_text(json.dumps([{"book": "GEN", "chapter": "001", "verse_start": "1", "timestamp": 1.0}, {"verse_start": "1", "timestamp": 2.0}, {"verse_start": "0", "timestamp": 0}]))
    rows = files.verse_timings(spark, str(root)).orderBy("verse").collect()
    assert [(r.verse, r.ts) for r in rows] == [(0, 0.0), (1, 2.0)]


def test_quality_texts_inventory(spark, root):
    (root / "GEN_001_A_words_quality.json").write_text(json.dumps({"verses": {"2": [{"score": 0.5, "source": "ctc"}], "1": []}}))
    rows = files.word_quality(spark, str(root)).collect()
    assert [(r.verse, r.pos, r.score, r.source) for r in rows] == [(2, 0, 0.5, "ctc")]
    t = root / "t"
    (t / "GEN").mkdir(parents=True)
    (t / "GEN" / "GEN_002_X.txt").write_text("a\n\nb\n\n\n")
    assert [(r.verse, r.text) for r in files.reference_texts(spark, str(t)).orderBy("verse").collect()] == [(1, "a"), (2, ""), (3, "b")]
    assert files.inventory(spark, str(root), "*.json").count() == 1


def test_manifests_and_catalog(spark, tmp_path):
    for k, lang in (("a", "x"), ("b", "y")):
        (tmp_path / k).mkdir()
        (tmp_path / k / "m.json").write_text(json.dumps({"id": "m", "jobs": [{"iso": lang, "chapters": {"GEN": [1, 2]}}]}))
    rows = files.jobs(spark, [str(tmp_path / "a"), str(tmp_path / "b")]).collect()
    assert sorted((r.iso, r.book, r.chapter) for r in rows) == [("x", "GEN", 1), ("x", "GEN", 2)]
    (tmp_path / "c.json").write_text(json.dumps({"entries": {"deu:nt": {"D": [{"id": "a:N2DA", "fmt": ["json"]}]}}}))
    assert [(r.iso, r.canon, r.distinct_id, r.raw_id) for r in files.catalog(spark, str(tmp_path / "c.json")).collect()] == [("deu", "nt", "D", "a:N2DA")]
    (tmp_path / "s.json").write_text(json.dumps({"iso": "q", "stories": {"01": {"audio_url": "u", "segment_count": 3}}}))
    assert files.stories(spark, str(tmp_path / "s.json")).first().segment_count == 3
    (tmp_path / "v.json").write_text(json.dumps({"GEN": [1, 2]}))
    assert files.coverage(spark, str(tmp_path / "v.json"), "D").count() == 2
    (tmp_path / "ch.json").write_text(json.dumps({"chapter": {"number": 3, "content": [{"type": "heading", "content": ["h"]}, {"type": "verse", "number": 1, "content": ["a ", "b"]}]}}))
    assert [(r.chapter, r.verse, r.text) for r in files.chapter_json(spark, str(tmp_path / "ch.json")).collect()] == [(3, 1, "a b")]


def test_contributed_times(spark, tmp_path):
    (tmp_path / "t.csv").write_text("4.0\n\nx\n9.5\n12.0\n")
    assert [(r.line, r.end) for r in files.contributed_times(spark, str(tmp_path / "t.csv")).orderBy("line").collect()] == [(1, 4.0), (2, 9.5), (3, 12.0)]


def test_rules(tmp_path):
    p = tmp_path / "x.toml"
    p.write_text('strip_unicode_categories = ["Mn", "Mc"]\naramaic_passages = ["DAN 3"]\n[[strip_marker_rules]]\npattern = "x"\n')
    r = files.language_rules(str(p))
    assert r.strip_categories == ("Mn", "Mc") and r.passages == ("DAN 3",) and r.marker_rules == (("x", ""),)
    assert files.language_rules(str(tmp_path / "none.toml")).fallback_threshold == 0.3
    assert files.machine_options({"a": 2, "z": 1}, {"a": 1, "b": 3}) == {"a": 2, "b": 3}


def test_sinks(spark, tmp_path):
    v = spark.createDataFrame([("GEN", 1, 2, 5.0), ("GEN", 1, 1, 0.5), ("GEN", 1, 10, 9.0)], "book string, chapter int, verse int, ts double")
    got = json.loads(sinks.verse_timing_json(v, ["book", "chapter"]).first().json)
    assert [x["verse_start"] for x in got] == ["1", "2", "10"] and got[0]["chapter"] == "001"
    w = spark.createDataFrame([(1, 1, 1, None, None), (1, 1, 0, 0.5, 0.6)], "chapter int, verse int, pos int, start double, end double")
    assert json.loads(sinks.word_timing_json(w, ["chapter"]).first().json) == {"verses": {"1": [0.5, None]}, "verse_ends": {"1": [0.6, None]}}
    s = spark.createDataFrame([(1, 1, 0, 999, "a"), (1, 2, 1000, 2000, " "), (1, 3, 3661500, 3662000, "c")], "chapter int, ordinal int, start_ms long, end_ms long, text string")
    assert sinks.subtitles(s, ["chapter"]).first().srt == "1\n00:00:00,000 --> 00:00:00,999\na\n\n3\n01:01:01,500 --> 01:01:02,000\nc\n"
    bad = spark.createDataFrame([("GEN", 1)], "book string, chapter int")
    assert sinks.without_bad(v, bad, ["book", "chapter"]).count() == 3
    assert sinks.without_bad(v, bad, ["book", "chapter"], confirm=True).count() == 0
    assert sinks.import_new(v, bad, ["book", "chapter"]).count() == 0
    assert len(sinks.run_manifest(v, "b", "2020-01-01T00:00:00Z").first().results) == 3
    sinks.append_errors(bad.withColumn("chapter", bad.chapter + 1), str(tmp_path / "e"))
    sinks.append_errors(bad, str(tmp_path / "e"))
    assert len(sinks.error_log(spark.read.parquet(str(tmp_path / "e")), ["book"]).first().errors) == 2


def test_queue_is_idempotent(spark, tmp_path):
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "m.json").write_text(json.dumps({"id": "m", "jobs": [{"iso": "x", "canon": "nt", "distinct_id": "D", "chapters": {"GEN": [1, 2]}}]}))
    done = spark.createDataFrame([("x", "nt", "D", "GEN", 1)], "iso string, canon string, distinct_id string, book string, chapter int")
    seen = []
    q = queue.work_queue(spark, str(tmp_path / "q"), lambda: done, lambda df, epoch: seen.extend(r.chapter for r in df.collect()), str(tmp_path / "ck"))
    assert q.awaitTermination(60)
    assert seen == [2]


def test_contributions_and_languages(spark, tmp_path):
    assert files.contribution('canon = "nt"\n', "/x/deu_AB_ot") == {"canon": "nt", "distinct_id": "AB"}
    assert files.contribution("canon = nt\nnot toml", "/x/deu") == {"canon": "nt", "distinct_id": None}
    (tmp_path / "audio.json").write_text(json.dumps({"type": "t", "baseUrl": "u", "books": {"GEN": {"code": "A01", "title": "Genesis"}}}))
    assert [(r.book, r.code, r.base_url) for r in files.audio_books(spark, str(tmp_path / "audio.json")).collect()] == [("GEN", "A01", "u")]
    (tmp_path / "l.json").write_text(json.dumps({"languages": [{"iso": "deu", "language": "German", "tier": 1, "nt": {"syncable": ["X"], "with_timecode": ["Y", "Z"]}}]}))
    rows = files.priority_languages(spark, str(tmp_path / "l.json")).collect()
    assert sorted((r.iso, r.canon, r.category, r.fileset) for r in rows) == [("deu", "nt", "syncable", "X"), ("deu", "nt", "with_timecode", "Y"), ("deu", "nt", "with_timecode", "Z")]
    assert files.priority_languages(spark, str(tmp_path / "none.json")).count() == 0


def test_chapter_spec(spark):
    df = spark.createDataFrame([("GEN_017",), ("gen 17",), ("x",)], "s string")
    book, chapter = files.chapter_spec("s")
    assert [(r.b, r.c) for r in df.select(book.alias("b"), chapter.alias("c")).collect()] == [("GEN", 17), ("GEN", 17), (None, None)]

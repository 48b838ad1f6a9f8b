"""Chapter numbers of four digits in exports and paths."""

from __future__ import annotations

from cueflow.operators import discovery
from cueflow.sources import sinks


def test_long_chapters_are_not_cut(spark):
    df = spark.createDataFrame([("B", 7, 1, 5), ("B", 1234, 1, 6)], "book string, chapter long, verse long, ts long")
    got = {r.chapter: r.json for r in sinks.verse_timing_json(df, ["chapter", "book"]).collect()}
    assert '"chapter":"007"' in got[7] and '"chapter":"1234"' in got[1234]
    work = spark.createDataFrame([("nt", "deu", "D1", "PSA", 1234, "A")], "canon string, iso string, distinct_id string, book string, chapter int, audio_fileset string")
    assert discovery.work_items(work, "/out").first().timing_path == "/out/nt/deu/D1/PSA/PSA_1234_A_timing.json"

"""Equal texts stand together, also beside a very frequent one."""

from __future__ import annotations

from collections import defaultdict

from cueflow.llm import shards


def test_only_the_hot_text_is_subdivided(spark):
    rows = [(k, "the hot text") for k in range(3000)] + [(3000 + k, f"pair {k // 2}") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = shards.sharded(df, range_rows=300).collect()
    texts = dict(rows)
    by = defaultdict(set)
    for r in out:
        by[texts[r.doc_id]].add(r.shard)
    assert len(out) == 6000 and sum(len(x) > 1 for x in by.values()) <= 7
    total = sum(r["size"] for r in out)
    for s in range(8):
        own = [r for r in out if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 8) <= 13


def test_hot_stretches_are_bounded(spark):
    from pyspark.sql import functions as F

    df = spark.range(6000).select(F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).cast("long").alias("key"), F.xxhash64("id").alias("tie"), F.lit(0).alias("range"))
    out = shards.subdivided(df, 500).groupBy("seg", "part").agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy("seg", "part").collect()
    assert {(r.lo, r.hi) for r in out if r.seg == 1} == {(5, 5)} and all(r.n < 700 for r in out if r.seg == 1)
    ends = [(r.lo, r.hi) for r in out if r.seg != 1]
    assert ends == [(1, 3), (7, 5999)]

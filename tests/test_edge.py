"""Edge interfaces over fakes."""

from __future__ import annotations

import pandas as pd

from cueflow.sources import edge


def test_retry():
    calls, waits = [], []

    def get(url):
        calls.append(url)
        if len(calls) < 3:
            raise edge.Transient("time-out")
        return 200, "ok"

    assert edge.with_retry(get, "u", sleep=waits.append) == (200, "ok", None) and waits == [1.0, 2.0]

    def never(url):
        raise edge.Transient("gone")

    assert edge.with_retry(never, "u", sleep=lambda s: None) == (None, None, "gone")


def test_fetched_and_timelines(spark):
    urls = spark.createDataFrame([("a",), ("b",)], "url string")
    got = edge.fetched(urls, "url", lambda u: (200 if u == "a" else 404, u))
    assert sorted((r.url, r.status, r.body) for r in got.collect()) == [("a", 200, "a"), ("b", 404, "b")]

    class Fake:
        def words(self, chapter):
            return pd.DataFrame({"url": [chapter["url"]] * 2, "widx": [0, 1]})

    assert edge.timelines(urls, Fake, "url string, widx long").count() == 4


def test_mono(spark):
    df = spark.createDataFrame([([[1.0, 3.0], [3.0, 5.0]],)], "c array<array<double>>")
    assert df.select(edge.mono("c").alias("m")).first().m == [2.0, 4.0]

"""Interfaces to what lies outside of analytics: requests, recognition, alignment, decoded audio.

Nothing here runs a model or opens a connection by itself. A client or a
backend is passed in and runs inside ``mapInPandas``; the table-backed ones
serve tests and replays.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Transient(Exception):
    """A failure that is worth another try: a time-out or a broken connection."""


class TimelineSource(Protocol):
    """Words of a chapter's audio."""

    def words(self, chapter: pd.Series) -> pd.DataFrame: ...


def with_retry(get: Callable[[str], tuple[int, str]], url: str, tries: int = 3, wait_s: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> tuple[int | None, str | None, str | None]:
    """(status, body, error) of a request; transient failures are tried again with linearly growing waits."""
    for k in range(1, tries + 1):
        try:
            status, body = get(url)
            return status, body, None
        except Transient as e:
            last = str(e)
            if k < tries:
                sleep(wait_s * k)
    return None, None, last


def fetched(urls: DataFrame, column: str, get: Callable[[str], tuple[int, str]]) -> DataFrame:
    """urls with status, body and error of each request."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = pd.DataFrame([with_retry(get, u) for u in b[column]], columns=["status", "body", "error"])
            got["status"] = got["status"].astype("Int64")
            yield pd.concat([b.reset_index(drop=True), got], axis=1)

    return urls.mapInPandas(run, f"{fields}, status long, body string, error string")


def timelines(chapters: DataFrame, source: Callable[[], TimelineSource], schema: str) -> DataFrame:
    """Words of all chapters; the backend is made once in each task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend = source()
        for b in batches:
            for _, chapter in b.iterrows():
                yield backend.words(chapter)

    return chapters.mapInPandas(run, schema)


def mono(channels: str) -> Column:
    """Mean of the channels, sample by sample (array of equally long arrays)."""
    c = F.col(channels)
    return F.transform(F.get(c, F.lit(0)), lambda _, i: F.aggregate(c, F.lit(0.0), lambda s, ch: s + F.get(ch, i)) / F.size(c))


def resampled(samples: str, rate: int, to: int) -> Column:
    """Samples at another rate, by linear interpolation; the last value holds to the end."""
    x = F.transform(F.col(samples), lambda v: v.cast("double"))
    n = F.floor(F.size(x) * F.lit(to) / F.lit(rate)).cast("int")

    def at(i: Column) -> Column:
        place = i * F.lit(rate) / F.lit(to)
        low = F.floor(place).cast("int")
        a, b = F.get(x, low), F.get(x, F.least(low + 1, F.size(x) - 1))
        return a + (b - a) * (place - low)

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), at)).otherwise(F.array().cast("array<double>"))

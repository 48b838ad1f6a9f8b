"""Awkward tables that every corpus operator has to bear."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, spans string"


def words(n: int, k: int = 0) -> str:
    return " ".join(f"w{(i * 7 + k) % 997}" for i in range(n))


def awkward_rows() -> list[tuple]:
    long = words(40_000)
    texts = [None, "", " \n\t ", "a", "a b c", words(80), words(80), words(80) + " tail", long, long + " x", "é 漢字 🙂 <|endoftext|> x", "token = 'abc'", "token = abcdef123 AKIA" + "A1" * 10, "f" * 30, "line\nline\nother\nline", "#### $$$$ | | " * 40]
    rows = [(i, t, "en" if i % 2 else None, "src" if i % 3 else None, None, "k", "s") for i, t in enumerate(texts)]
    return [*rows, rows[5], (None, words(60), "en", "s", 1, None, None), (None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def awkward_dir(spark, awkward, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("awkward"))
    awkward.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(5, 1, 0), (7, 1, 0), (15, 0, 0), (None, 0, 1), (99, None, None), (5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, "http://h.example/1", "<html><body><article><p>a &amp; b</p></article></body></html>"), (2, None, None), (None, "", "")], "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    return d


@pytest.fixture(scope="session")
def empty_dir(spark, nothing, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    nothing.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    return d

"""Near-duplicate removal goes by rows, not by ids."""

from __future__ import annotations

from collections import Counter

import pytest

from cueflow.llm import near_dups

A = " ".join(f"a{i}" for i in range(80))
B = " ".join(f"b{i}" for i in range(80))
B2 = B + " end"
SCHEMA = "doc_id long, text string, __row long, extra string"


def kept(spark, rows):
    df = spark.createDataFrame([(i, t, k, f"x{k}") for k, (i, t) in enumerate(rows)], SCHEMA).repartition(3)
    out = near_dups.deduplicated(df)
    assert out.columns == df.columns
    return out.collect()


def test_null_and_repeated_ids(spark):
    rows = [(1, A), (7, A), (7, B), (None, A), (9, B2), (9, B2)]
    got = kept(spark, rows)
    assert sorted((r.doc_id, r.text) for r in got) == [(1, A), (7, B)]
    assert all(rows[r["__row"]] == (r.doc_id, r.text) and r.extra == f"x{r['__row']}" for r in got)


def test_groups_of_nulls_and_rows_without_words(spark):
    got = kept(spark, [(None, A), (None, A), (None, None), (3, ""), (3, ""), (None, B)])
    assert Counter((r.doc_id, r.text) for r in got) == Counter([(None, A), (None, None), (3, ""), (3, ""), (None, B)])


@pytest.mark.parametrize("n", [40])
def test_repeated_rows_of_one_id(spark, n):
    assert [(r.doc_id, r.text) for r in kept(spark, [(5, B)] * n)] == [(5, B)]

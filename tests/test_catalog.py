"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import pytest
from oracle import duck, duck_rows, spark_rows

from cueflow.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, sf_dir, name):
    df = catalog.queries()[name](spark, sf_dir)
    got = spark_rows(df)
    assert got
    sql = catalog.oracle_sql().get(name)
    if sql:
        want = duck_rows(duck(sf_dir), sql, df.columns)
        assert len(got) == len(want)
        diff = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
        assert not diff, diff[:3]

"""Plans: no nested-loop or cross joins, pruned scans, pushed filters."""

from __future__ import annotations

import pytest

from cueflow.plans import catalog


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_loops(spark, sf_dir, name):
    text = plan(catalog.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scans_are_pruned(spark, sf_dir):
    text = plan(catalog.queries()["delta_by_lang"](spark, sf_dir))
    assert "l_comment" not in text and "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_shipdate:timestamp_ntz>" in text


def test_filters_are_pushed(spark, sf_dir):
    text = plan(catalog.queries()["pipeline_only"](spark, sf_dir))
    assert "EqualTo(lang,en)" in text

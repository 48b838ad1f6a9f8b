"""Written intermediate tables."""

from __future__ import annotations

import os

from cueflow.llm import common


def test_stash_and_unstash(spark):
    before = common.stashed()
    df = common.stash(spark.range(10))
    new = [p for p in common.stashed() if p not in before]
    assert df.count() == 10 and len(new) == 1
    common.unstash(spark, new)
    assert common.stashed() == before and not os.path.exists(new[0].removeprefix("file:"))

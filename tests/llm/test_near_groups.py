"""Large groups: prefixes part documents that only share passages; blocks lose no link."""

from __future__ import annotations

import random

import numpy as np
import pytest

from cueflow.llm import near_dups
from test_contracts import brute_components


def shared_passages(n: int, seed: int = 5) -> list[tuple[int, str]]:
    """Documents of which half is one of two common passages; some have a near copy."""
    rnd = random.Random(seed)
    common = [" ".join(f"c{k}x{i}" for i in range(60)) for k in range(2)]
    rows = []
    for k in range(n):
        own = [f"u{k}x{i}" for i in range(60)]
        rows.append((2 * k, " ".join(own) + " " + common[k % 2]))
        if rnd.random() < 0.05:
            own[rnd.randrange(60)] = "edit"
            rows.append((2 * k + 1, " ".join(own) + " " + common[k % 2]))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [9, 60])
def test_prefixes_and_blocks_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_dups, "BLOCK", block)
    monkeypatch.setattr(near_dups, "COUNTERS", 1 << 10)
    rows = shared_passages(220)
    base = [f"w{i}" for i in range(120)]
    for k in range(40):  # a chain of near copies, too
        base[2 * k] = f"x{k}"
        rows.append((10_000 + k, " ".join(base)))
    want = brute_components(rows, 4)
    got = {r.doc_id: r.component_id for r in near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=4).collect()}
    assert got == {i: c for i, (_, c) in want.items()}


def test_rows_dealt_grow_in_proportion(spark, monkeypatch):
    """Unrelated documents with a common half: what is compared in blocks does not grow with their square."""
    monkeypatch.setattr(near_dups, "BLOCK", 50)
    dealt: list[int] = []
    plain = near_dups._in_blocks

    def counted(groups, schema, one, out):
        made = plain(groups, schema, one, out)
        sizes = [r["count"] for r in groups.groupBy("major").count().collect()]
        dealt.append(sum(n * -(-n // 50) for n in sizes))
        return made

    monkeypatch.setattr(near_dups, "_in_blocks", counted)
    per_row = []
    for n in (300, 1200):
        dealt.clear()
        rows = shared_passages(n)
        near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=4).collect()
        per_row.append(sum(dealt) / len(rows))
    assert per_row[1] < 1.5 * max(1.0, per_row[0])


def test_prefix_size():
    for n in range(1, 300):
        p = near_dups.prefix_size(n, 80)
        least = int(np.ceil(n * 0.8 - 1e-9))  # a partner at the threshold shares that many
        assert n - p < least <= n - p + 1

"""Verses are anchored by all of their words."""

from __future__ import annotations

import random
from difflib import SequenceMatcher

import pandas as pd

from cueflow.functions.similarity import bag_similarity
from cueflow.operators import alignment as a
from cueflow.plans import text, views


def plain_bag(ref, window):
    free, hits = list(range(len(window))), 0
    for word in ref:
        best, at = 0.0, None
        for j in free:
            r = SequenceMatcher(None, word, window[j]).ratio()
            if r > best:
                best, at = r, j
        if at is not None and best >= 0.6:
            free.remove(at)
            hits += 1
    return hits / len(ref) if ref and window else 0.0


def test_bag_similarity_is_exact():
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choices("abcde", k=rnd.randint(1, 6)))
    for _ in range(400):
        ref, window = [word() for _ in range(rnd.randint(1, 9))], [word() for _ in range(rnd.randint(1, 9))]
        want = plain_bag(ref, window)
        assert bag_similarity(ref, window) == want
        for least in (0.3, 0.5, 0.8):
            got = bag_similarity(ref, window, least)
            assert got == want if want >= least else got in (0.0, want)


def test_verse_anchor_uses_whole_verses(spark, sf_dir):
    got = {(r.chapter, r.verse): r.anchor for r in text.verse_anchor(spark, sf_dir).collect()}
    words = views.words(spark, sf_dir).toPandas().sort_values(["chapter", "widx"])
    assert words.groupby(["chapter", "verse"]).size().max() > 12
    for chapter, g in list(words.groupby("chapter"))[:20]:
        heard = [a.norm(w) for w, i in zip(g["word"], g["widx"], strict=True) if i % 10]
        verses = [(k, [a.norm(w) for w in v["word"]]) for k, v in g.groupby("verse", sort=True)]
        at = a.verse_anchors([w for _, w in verses], heard)
        assert [got[chapter, k] for k, _ in verses] == [None if pd.isna(x) else x for x in at]

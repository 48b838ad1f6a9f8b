"""Invariants of the order-dependent matchers."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from cueflow.functions.similarity import bag_similarity, ratio
from cueflow.operators import alignment as a

text = st.text(alphabet="abcde", min_size=1, max_size=5)


@st.composite
def timeline(draw, most=15):
    steps = draw(st.lists(st.tuples(text, st.floats(0.1, 3), st.floats(0, 1)), max_size=most))
    at, out = 0.0, []
    for w, gap, score in steps:
        out.append(a.Word(w, at, at + gap / 2, score))
        at += gap
    return out


@settings(max_examples=60, deadline=None)
@given(timeline(), timeline())
def test_fusion_keeps_every_word(ctc, asr):
    fused = a.fuse(ctc, asr)
    assert [f.text for f in fused] == [w.text for w in ctc]
    assert sum(f.source == "ctc" for f in fused) + sum(f.source == "asr" for f in fused) == len(ctc)
    for f in fused:
        if f.source == "asr":
            assert f.ctc_score < 0.3 and f.score > f.ctc_score


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(text, max_size=6), max_size=8), timeline())
def test_windows_never_go_back(segments, words):
    got = a.windowed("c", segments, 30.0, a.TableAligner(words))
    assert len(got) == len(segments)
    for before, after in zip(got, got[1:], strict=False):
        assert before.start <= before.end and after.start >= before.end - 1e-9


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(text, max_size=4), max_size=6), st.lists(text, max_size=20))
def test_anchors_ascend(verses, heard):
    at = a.verse_anchors(verses, heard)
    known = [(k, n) for k, n in zip(at, map(len, verses), strict=True) if k is not None]
    for (x, n), (y, _) in zip(known, known[1:], strict=False):
        assert y >= x + n


@settings(max_examples=60, deadline=None)
@given(st.lists(text, max_size=8), timeline(), st.integers(0, 10))
def test_stamps_ascend(words, asr, begin):
    got = [s for s in a.word_stamps(words, asr, begin) if s]
    assert got == sorted(got) and len(got) <= len(words)


@given(text, text)
def test_ratio_range(x, y):
    assert 0 <= ratio(x, y) <= 1 and ratio(x, x) == 1
    assert bag_similarity([x], [x, y]) == 1

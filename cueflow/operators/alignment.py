"""Order-dependent matching inside a chapter: pure functions, and grouped maps that run them.

A chapter is one group and small (some thousand words); nothing depends on
another chapter. The functions sort what they get, as the order of a group is
not guaranteed. Re-alignment needs audio and stays behind the ``Aligner`` interface.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import lru_cache
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueflow.functions.similarity import bag_similarity, ratio, ratio_from
from cueflow.functions.text import LanguageRules

_NOT_WORD, _SPACE = re.compile(r"[^\w\s]"), re.compile(r"\s+")


@dataclass(frozen=True)
class Word:
    """A word of a timeline; times in seconds."""

    text: str
    start: float
    end: float
    score: float = 0.0


@lru_cache(maxsize=1 << 17)
def norm(text: str, rules: LanguageRules = LanguageRules()) -> str:
    """Match form of a word: lower case, decomposed, marks and punctuation dropped."""
    kept = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if unicodedata.category(c) not in rules.strip_categories)
    for old, new in (*rules.char_replacements, *rules.pronunciations):
        kept = kept.replace(old, new)
    return _SPACE.sub(" ", _NOT_WORD.sub("", kept)).strip()


def header_boundary(first_verse: str, asr: Sequence[Word], rules: LanguageRules = LanguageRules()) -> tuple[float, str] | None:
    """Start of the text after a spoken header, and the header; None without one.

    The text's first five words are sought in the first fifty recognised ones; a
    window matches where enough of them (0.6 of all, two at least) meet a word at
    0.7. Otherwise a silence of more than 2 s counts if the word after it starts
    by 8 s; silences are looked for up to 80 s.
    """
    wanted = [w for w in (norm(x, rules) for x in first_verse.split()[:5]) if w]
    heard = [norm(w.text, rules) for w in asr[:50]]
    need, n = max(2.0, 0.6 * len(wanted)), len(wanted)
    enough = lambda i: sum(max((ratio(w, h) for h in heard[i : i + n]), default=0.0) >= 0.7 for w in wanted) >= need
    match = next((i for i in range(len(heard) - n + 1) if enough(i)), 0) if n else 0
    quiet = next((j for j in range(1, len(asr)) if asr[j].start <= 80 and asr[j].start - asr[j - 1].end > 2.0), 0)
    at = match or (quiet if quiet and asr[quiet].start <= 8.0 else 0)
    return (asr[at].start, " ".join(w.text for w in asr[:at])) if at else None


@dataclass(frozen=True)
class Fused:
    text: str
    start: float
    end: float
    score: float
    source: str
    ctc_score: float
    asr_score: float | None


def best_match(word: Word, asr: Sequence[Word], forms: Sequence[str], cursor: int, form: str, reach: int = 30, gate: float = 2.0) -> int | None:
    """The recognised word within reach of the cursor and the time gate that agrees best, at 0.4 or more; the first of equals."""
    best, at = 0.0, None
    for j in range(cursor, min(cursor + reach, len(asr))):
        if not forms[j]:
            continue
        apart = asr[j].start - word.start
        if abs(apart) > gate:
            if apart > 0:
                break
            continue
        value = 0.7 * ratio(form, forms[j]) + 0.3 * (1 - abs(apart) / gate)
        if value > best:
            best, at = value, j
    return at if best >= 0.4 else None


def fuse(ctc: Sequence[Word], asr: Sequence[Word], threshold: float = 0.3, header: float | None = None, rules: LanguageRules = LanguageRules()) -> list[Fused]:
    """Both timelines as one: a weak forced-alignment word gives way to a better recognised one. Audio-free."""
    forms, out, cursor = [norm(w.text, rules) for w in asr], [], 0
    for i, word in enumerate(ctc):
        start = header if i == 0 and header is not None and word.start + 0.5 < header < word.end else word.start
        at = best_match(word, asr, forms, cursor, norm(word.text, rules))
        other = asr[at] if at is not None else None
        if at is not None:
            cursor = at + 1
        if other is not None and word.score < threshold and other.score > word.score:
            out.append(Fused(word.text, other.start, other.end, other.score, "asr", word.score, other.score))
        else:
            out.append(Fused(word.text, start, word.end, word.score, "ctc", word.score, other.score if other is not None else None))
    return out


def verse_anchors(verses: Sequence[Sequence[str]], heard: Sequence[str]) -> list[int | None]:
    """Where each verse begins among the recognised words; words are match forms.

    The search runs from three verse lengths before the expected place to five
    after it, never before the cursor, and ends early above 0.7; 0.5 is enough.
    """
    out: list[int | None] = []
    cursor, total = 0, len(heard)
    for v, words in enumerate(verses):
        n = len(words)
        expected = total * v // max(1, len(verses))
        best, at = 0.0, None
        for i in range(max(cursor, expected - 3 * n), min(expected + 5 * n, total - n + 1)) if n else ():
            s = bag_similarity(list(words), list(heard[i : i + n]), max(best, 0.5))  # less is never taken
            if s > best:
                best, at = s, i
            if best > 0.7:
                break
        if at is not None and best >= 0.5:
            out.append(at)
            cursor = at + n
        else:
            out.append(None)
    return out


def word_stamps(words: Sequence[str], asr: Sequence[Word], begin: int, rules: LanguageRules = LanguageRules()) -> list[tuple[float, float] | None]:
    """Start and end of each word of a verse anchored at ``begin``; None where nothing agrees at 0.4.

    Up to three recognised words are looked at, singly and joined with those
    before them; a join that agrees better takes the first one's stamp.
    """
    at, limit = begin, min(begin + 3 * len(words), len(asr))
    out: list[tuple[float, float] | None] = []
    for word in words:
        form = norm(word, rules)
        if not form or at >= limit:
            out.append(None)
            continue
        value, k = 0.0, 0
        for offset in range(min(3, limit - at)):
            single = norm(asr[at + offset].text, rules)
            if not single:
                continue
            least = max(value, 0.4)
            tries = [(ratio_from(form, single, least), offset)]
            if offset:
                tries.append((ratio_from(form, norm(" ".join(w.text for w in asr[at : at + offset + 1]), rules), least), 0))
            value, k = max([(value, k), *tries], key=lambda t: t[0])  # the first of equals
            if value == 1.0:
                break
        if value >= 0.4:
            out.append((asr[at + k].start, asr[at + k].end))
            at += k + 1
        else:
            out.append(None)
    return out


def restart_time(first_form: str, asr: Sequence[Word], expected: int, rules: LanguageRules = LanguageRules()) -> float | None:
    """Where alignment starts again after a collapse: an equal, confident word near the expected place, else that place."""
    for w in asr[max(0, expected - 10) : expected + 30]:
        if norm(w.text, rules) == first_form and w.score > 0.3:
            return w.start
    return asr[expected].start if expected < len(asr) and asr[expected].start > 0 else None


class Aligner(Protocol):
    """Forced alignment of words within [lo, hi] seconds of a chapter's audio."""

    def align(self, chapter: object, lo: float, hi: float, words: Sequence[str]) -> list[Word]: ...


class ClipAligner:
    """An aligner from one that only knows clips, with times from the clip's beginning; times move back to the chapter's, in hundredths."""

    def __init__(self, align_clip: Callable[[object, float, float, Sequence[str]], list[Word]]):
        self.align_clip = align_clip

    def align(self, chapter: object, lo: float, hi: float, words: Sequence[str]) -> list[Word]:
        if hi <= lo:
            return []
        return [replace(w, start=round(w.start + lo, 2), end=round(w.end + lo, 2)) for w in self.align_clip(chapter, lo, hi, words)]


def attempted(aligner: Aligner, chapter: object, lo: float, hi: float, words: Sequence[str]) -> list[Word]:
    """What the aligner gives; nothing where it refuses the window (too short for the words)."""
    try:
        return aligner.align(chapter, lo, hi, words)
    except Exception:  # noqa: BLE001  one refused window must not cost the chapter
        return []


#: Seconds between two word starts that count as a gap.
GAP = 3.0


def gaps_filled(chapter: object, words: Sequence[Fused], asr: Sequence[Word], aligner: Aligner, rounds: int = 3) -> list[Fused]:
    """Words before a gap aligned anew, one a round, until a try fails.

    A word that forced alignment left of a gap is sought after the header's last
    recognised word (the one before the first silence of more than 5 s among the
    first twenty), else shortly before the gap's end; it moves if the new place
    lies inside the gap at a score above 0.3.
    """
    out, tried = list(words), set()
    quiet = next((asr[k - 1].start + 0.5 for k in range(1, min(len(asr), 20)) if asr[k].start - asr[k - 1].start > 5.0), None)
    for _ in range(rounds):
        place = lambda i: (i, round(out[i].start, 2))
        i = next((i for i in range(len(out) - 1) if out[i + 1].start - out[i].start > GAP and out[i].source in ("ctc", "gap_fill") and place(i) not in tried), None)
        if i is None:
            break
        tried.add(place(i))
        begin, end = out[i].start, out[i + 1].start
        lo = quiet if quiet is not None and quiet > begin else max(begin + 1.0, end - 2.0)
        got = attempted(aligner, chapter, lo, end + 1.0, [out[i].text])
        if not got or not (begin < got[0].start < end and got[0].score > 0.3):
            break
        out[i] = replace(out[i], start=got[0].start, end=got[0].end, score=got[0].score, source="gap_fill")
    return out


def heard_earlier(word: Fused, asr: Sequence[Word], rules: LanguageRules = LanguageRules()) -> bool:
    """Whether recognition has the word, surely, more than two seconds before its place."""
    form = norm(word.text, rules)
    return bool(form) and any(w.score > 0.5 and word.start - w.start > 2.0 and norm(w.text, rules) and ratio(form, norm(w.text, rules)) >= 0.6 for w in asr)


def drift_corrected(chapter: object, words: Sequence[Fused], asr: Sequence[Word], aligner: Aligner, rules: LanguageRules = LanguageRules()) -> list[Fused]:
    """Both words of the first gap with drift behind it aligned anew in a tight window.

    Drift: one of the nine words after the gap was heard earlier. A word at a
    score above 0.3 moves if its new place is more than half a second earlier; at
    about the same place only a better score is taken.
    """
    out = list(words)
    for i in range(len(out) - 1):
        if out[i + 1].start - out[i].start < GAP or not any(heard_earlier(w, asr, rules) for w in out[i + 1 : i + 10]):
            continue
        got = attempted(aligner, chapter, max(0.0, out[i].start - 0.5), out[i + 1].start + 0.5, [out[i].text, out[i + 1].text])
        if len(got) == 2:
            for k, new in zip((i, i + 1), got, strict=True):
                apart = new.start - out[k].start
                if new.score > 0.3 and apart < -0.5:
                    out[k] = replace(out[k], start=new.start, end=new.end, score=new.score, source="drift_fix")
                elif new.score > 0.3 and abs(apart) < 0.5:
                    out[k] = replace(out[k], score=max(new.score, out[k].score))
        break
    return out


def collapsed_at(words: Sequence[Word], least: float = 0.1, run: int = 5) -> int | None:
    """First word of the first run of words that forced alignment lost."""
    length = 0
    for k, w in enumerate(words):
        length = length + 1 if w.score <= least else 0
        if length == run:
            return k - run + 1
    return None


def stitched_words(first: Sequence[Word], verse_sizes: Sequence[int], verse: int, second: Sequence[Word]) -> list[Word]:
    """Words before a verse from the first alignment, those from it on from the second."""
    return [*first[: sum(verse_sizes[:verse])], *second]


def forced(chapter: object, verses: Sequence[Sequence[str]], total: float, aligner: Aligner, asr: Sequence[Word] = (), begin: float = 0.0, rules: LanguageRules = LanguageRules()) -> list[Word]:
    """Words of a chapter by forced alignment from ``begin`` on; where it collapses, once more from the verse's place in recognition."""
    flat = [w for v in verses for w in v]
    words = aligner.align(chapter, begin, total, flat)
    lost = collapsed_at(words)
    if lost is None or not asr:
        return words
    sizes = [len(v) for v in verses]
    verse = next((k for k in range(len(sizes)) if sum(sizes[: k + 1]) > lost), len(sizes) - 1)
    at = restart_time(norm(verses[verse][0], rules), asr, sum(sizes[:verse]), rules)
    if not at or at >= total:
        return words
    return stitched_words(words, sizes, verse, aligner.align(chapter, at, total, [w for v in verses[verse:] for w in v]))


@dataclass(frozen=True)
class Segment:
    start: float
    end: float
    score: float
    source: str
    words: tuple[Word, ...] = ()


def windowed(chapter: object, segments: Sequence[Sequence[str]], total: float, aligner: Aligner, least: float = 8.0, share: float = 0.8, accept: float = 0.35, story: bool = False) -> list[Segment]:
    """Segments aligned one after the other, each in a window around its pace estimate; the estimate where that fails.

    The next window begins at a segment's end, which counts no further than the
    next estimate; never before its own start, except in stories.
    """
    counts = [len(s) for s in segments]
    all_words = max(1, sum(counts))
    starts = [total * sum(counts[:i]) / all_words for i in range(len(counts))] + [total]
    out: list[Segment] = []
    floor = 0.0
    for i, words in enumerate(segments):
        expected, length = starts[i], total * counts[i] / all_words
        window = max(share * length, least)
        lo = max(floor, expected - window)
        hi = min(total, expected + length + window)
        if hi - lo < 1.3 * length + 2:
            hi = min(total, lo + 1.3 * length + 2)
        got = attempted(aligner, chapter, lo, hi, words) if words and hi - lo >= 1 else []
        scores = [w.score for w in got if w.score > 0]
        mean = sum(scores) / len(scores) if scores else 0.0
        if got and mean >= accept:
            start = got[0].start
            end = min(got[-1].end, starts[i + 1]) if i + 1 < len(segments) or not story else got[-1].end
            out.append(Segment(start, end if story else max(start, end), mean, "local", tuple(got)))
        else:
            start = end = max(expected, floor)
            out.append(Segment(start, end, 0.0, "fallback"))
        floor = out[-1].end
    return out


class TableAligner:
    """An aligner over stored words, for tests and replays: gives the words of the table that lie in the window."""

    def __init__(self, words: Sequence[Word]):
        self.words = sorted(words, key=lambda w: w.start)

    def align(self, chapter: object, lo: float, hi: float, words: Sequence[str]) -> list[Word]:
        return [w for w in self.words if lo <= w.start < hi][: len(words)]


def chapter_words(pdf: pd.DataFrame) -> list[Word]:
    """Words in order of widx from columns text, start, end, score."""
    pdf = pdf.sort_values("widx")
    return [Word(str(r.text), float(r.start), float(r.end), float(r.score)) for r in pdf.itertuples()]


def per_chapter(left: DataFrame, right: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``fn`` over both sides of each chapter; the sides may come from one table."""
    right = right.select(*(F.col(c).alias(c) for c in right.columns))
    left = left.select(*(F.col(c).alias(c) for c in left.columns))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(fn, schema)

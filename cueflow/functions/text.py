"""Text functions: cleaning, tokens, markers, subtitles, passages, story segments."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space of any kind, for a character class: Unicode's, and the four separators that tokenisers split at, too.
SPACE = r"\t\n\x0b\f\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANKS = f"[{SPACE}]+"


@dataclass(frozen=True)
class LanguageRules:
    """Rules of a language; the order of replacements matters."""

    marker_rules: tuple[tuple[str, str], ...] = ()
    char_replacements: tuple[tuple[str, str], ...] = ()
    pronunciations: tuple[tuple[str, str], ...] = ()
    strip_categories: tuple[str, ...] = ("Mn",)
    fallback_threshold: float = 0.3
    passages: tuple[str, ...] = ()
    verse_only: bool = False
    extra: dict = field(default_factory=dict, compare=False)


@F.pandas_udf(StringType())
def decomposed(texts: pd.Series) -> pd.Series:
    """Canonical decomposition (NFD), which Spark does not have."""
    return texts.map(lambda t: t if t.isascii() else unicodedata.normalize("NFD", t), na_action="ignore")


def _clean(text: Column, rules: LanguageRules) -> Column:
    out = decomposed(text)
    for cat in rules.strip_categories:
        out = F.regexp_replace(out, rf"\p{{{cat}}}", "")
    for old, new in (*rules.char_replacements, *rules.pronunciations):
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.regexp_replace(out, rf"[^\p{{L}}\p{{N}}_{SPACE}]", "")
    return F.trim(F.regexp_replace(out, BLANKS, " "))


def cleaned(column: str, rules: LanguageRules = LanguageRules()) -> Column:
    """Decompose, drop categories, replace, drop what is neither word nor space, collapse spaces. Case stays.

    Only the decomposition leaves the JVM; it is applied once.
    """
    return _clean(F.col(column), rules)


def match_form(column: str, rules: LanguageRules = LanguageRules()) -> Column:
    """Lower case, then cleaned."""
    return _clean(F.lower(F.col(column)), rules)


def without_markers(column: Column, rules: LanguageRules) -> Column:
    """Ordered pattern rules, then trimmed."""
    for pattern, new in rules.marker_rules:
        column = F.regexp_replace(column, pattern, new)
    return F.regexp_replace(column, f"^{BLANKS}|{BLANKS}$", "")


def tokens(column: str) -> Column:
    """Words between white space, none empty."""
    return F.filter(F.split(F.col(column), BLANKS), lambda x: x != "")


def srt_time(ms: str) -> Column:
    """HH:MM:SS,mmm of whole milliseconds."""
    part = lambda e, n: F.lpad(F.expr(e).cast("string"), n, "0")
    hours = F.expr(f"{ms} div 3600000")
    return F.concat(F.when(hours < 10, F.concat(F.lit("0"), hours.cast("string"))).otherwise(hours.cast("string")), F.lit(":"), part(f"({ms} div 60000) % 60", 2), F.lit(":"), part(f"({ms} div 1000) % 60", 2), F.lit(","), part(f"{ms} % 1000", 3))


def duration(seconds: str) -> Column:
    """1h 02m 05s, 1m 05s or 9s."""
    h, m, s = F.expr(f"{seconds} div 3600"), F.expr(f"({seconds} div 60) % 60"), F.expr(f"{seconds} % 60")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return (
        F.when(h > 0, F.concat(h.cast("string"), F.lit("h "), two(m), F.lit("m "), two(s), F.lit("s")))
        .when(m > 0, F.concat(m.cast("string"), F.lit("m "), two(s), F.lit("s")))
        .otherwise(F.concat(s.cast("string"), F.lit("s")))
    )


def without_chapter_header(column: str, chapter: str, word: str = "Kapitel") -> Column:
    """Drops everything up to the chapter's header and its number, once."""
    return F.regexp_replace(F.col(column), F.concat(F.lit(rf"(?i)^.*?\b{word}\s+"), F.col(chapter).cast("string"), F.lit(r"\b\s*")), F.lit(""))


def padded(number: str, width: int = 3) -> Column:
    """Zero-padded, never cut."""
    s = F.col(number).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def in_passages(book: str, chapter: str, passages: list[str]) -> Column:
    """Whether the chapter is the one that a passage such as ``DAN 2:4-49`` or ``DAN 3`` begins in."""
    out = F.lit(False)
    for p in passages:
        name, _, rest = p.partition(" ")
        number = rest.split(":")[0].strip()
        if number.isdigit():
            out = out | ((F.col(book) == name) & (F.col(chapter) == int(number)))
    return out


def story_segments(column: str, marker: str = r"!\[[^\]]*\]\([^)]*\)", citation: str = r"(?s)\n\s*_[^\n]*_\s*$") -> Column:
    """Narration between image markers: the title line and a last line in italics go, empty segments too."""
    body = F.regexp_replace(F.col(column), r"^\s*[^\n]*\n?", "")
    body = F.regexp_replace(F.concat(F.lit("\n"), F.rtrim(body)), citation, "")
    parts = F.split(body, marker)
    trimmed = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.filter(trimmed, lambda x: x != "")


def effective_threshold(book: str, chapter: str, rules: LanguageRules, in_passage: float = 0.01) -> Column:
    """Score below which a forced-alignment word may give way: lower in the configured passages."""
    return F.when(in_passages(book, chapter, list(rules.passages)), in_passage).otherwise(rules.fallback_threshold)


def in_alphabet(column: str, alphabet: str) -> Column:
    """The text with nothing but characters of the alphabet; a star where none is left."""
    kept = F.regexp_replace(F.lower(F.col(column)), "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in alphabet) + "]", "")
    return F.when(kept == "", "*").otherwise(kept)

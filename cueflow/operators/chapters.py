"""Chapters from words to results: strategy, fusion, verse mapping, repair, quality.

Inputs are long tables keyed by ``chapter``: reference words (verse, pos, word,
widx: position among the cleaned words of the chapter) and one or two timelines
(widx, text, start, end, score). Fusion and anchoring run in one grouped map a
chapter; everything after that is native.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueflow.functions.text import LanguageRules
from cueflow.operators import alignment as a
from cueflow.operators import sequence as seq

WORDS = "chapter long, widx long, start double, end double, score double, source string"
ANCHORED = WORDS + ", anchor double"
CH = ["chapter"]


def chapter_strategies(ref: DataFrame, ctc: DataFrame, asr: DataFrame) -> DataFrame:
    """(chapter, strategy): both, ctc, asr, or error without text or without any timeline."""
    has = lambda df, name: df.select("chapter").distinct().withColumn(name, F.lit(True))
    j = has(ref, "t").join(has(ctc, "c"), "chapter", "full").join(has(asr, "r"), "chapter", "full")
    kind = F.when(F.col("t").isNull(), "error").when(F.col("c") & F.col("r"), "both").when(F.col("c"), "ctc").when(F.col("r"), "asr").otherwise("error")
    return j.select("chapter", kind.alias("strategy"))


def openings(ref: DataFrame) -> DataFrame:
    """(chapter, opening): the first five words of its first verse."""
    first = ref.groupBy("chapter").agg(F.min("verse").alias("verse"))
    words = F.slice(F.array_sort(F.collect_list(F.struct("pos", "word"))), 1, 5)
    return ref.join(first, ["chapter", "verse"], "left_semi").groupBy("chapter").agg(F.array_join(words["word"], " ").alias("opening"))


def fused_words(
    ctc: DataFrame, asr: DataFrame, threshold: float = 0.3, ref: DataFrame | None = None,
    rules: LanguageRules = LanguageRules(), limits: DataFrame | None = None, aligner: Callable[[], a.Aligner] | None = None,
) -> DataFrame:
    """Word times from both timelines, by position of the forced-alignment words.

    With ref, a spoken header is cut from the first word. ``limits`` (chapter,
    threshold) sets the score below which a word may give way chapter by chapter,
    as for passages in another language (``text.effective_threshold``). With an
    aligner, made once a chapter, gaps are filled and drift is corrected.
    """
    ctc = ctc.join(openings(ref), "chapter", "left") if ref is not None else ctc.withColumn("opening", F.lit(None).cast("string"))
    if limits is not None:
        ctc = ctc.join(limits.select("chapter", F.col("threshold").alias("__limit")), "chapter", "left")
    ctc = ctc.withColumn("limit", F.coalesce(F.col("__limit") if limits is not None else F.lit(None), F.lit(threshold)).cast("double")).drop("__limit")

    def run(c: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        c = c.sort_values("widx")
        heard = a.chapter_words(r)
        opening = c["opening"].iloc[0] if len(c) else None
        header = a.header_boundary(opening, heard, rules) if opening else None
        got = a.fuse(a.chapter_words(c), heard, float(c["limit"].iloc[0]) if len(c) else threshold, header[0] if header else None, rules)
        if aligner is not None and len(c):
            key, backend = c["chapter"].iloc[0], aligner()
            got = a.drift_corrected(key, a.gaps_filled(key, got, heard, backend), heard, backend, rules)
        return pd.DataFrame([(k, w, f.start, f.end, f.score, f.source) for k, w, f in zip(c["chapter"], c["widx"], got, strict=True)], columns=["chapter", "widx", "start", "end", "score", "source"])

    return a.per_chapter(ctc, asr, CH, run, WORDS)


def anchored_words(ref: DataFrame, asr: DataFrame, rules: LanguageRules = LanguageRules()) -> DataFrame:
    """Word times from recognition alone: verses are anchored in it, their words stamped; (chapter, widx, times, anchor of the verse)."""

    def run(w: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        w, asr_words = w.sort_values("widx"), a.chapter_words(r) if len(r) else []
        groups = [g for _, g in w.groupby("verse", sort=True)]
        at = a.verse_anchors([[f for f in (a.norm(x, rules) for x in g["word"]) if f] for g in groups], [a.norm(x.text, rules) for x in asr_words])
        rows = []
        for g, anchor in zip(groups, at, strict=True):
            stamps = a.word_stamps([*g["word"]], asr_words, anchor, rules) if anchor is not None else [None] * len(g)
            begin = asr_words[anchor].start if anchor is not None else None
            rows += [(c, i, s[0] if s else None, s[1] if s else None, None, "asr", begin) for c, i, s in zip(g["chapter"], g["widx"], stamps, strict=True)]
        return pd.DataFrame(rows, columns=["chapter", "widx", "start", "end", "score", "source", "anchor"])

    return a.per_chapter(ref, asr, CH, run, ANCHORED)


def aligned(
    ref: DataFrame, ctc: DataFrame, asr: DataFrame, threshold: float = 0.3,
    rules: LanguageRules = LanguageRules(), limits: DataFrame | None = None, aligner: Callable[[], a.Aligner] | None = None,
) -> DataFrame:
    """One row for each reference word of a chapter that can be aligned: times (starts monotone within a verse), score, source, anchor of the verse in recognition."""
    kind = chapter_strategies(ref, ctc, asr)
    only = lambda df, k: df.join(kind.where(F.col("strategy") == k).select("chapter"), "chapter", "left_semi")
    times = fused_words(only(ctc, "both"), only(asr, "both"), threshold, ref, rules, limits, aligner)
    times = times.unionByName(only(ctc, "ctc").select("chapter", "widx", "start", "end", "score", F.lit("ctc").alias("source")))
    times = times.unionByName(anchored_words(only(ref, "asr"), only(asr, "asr"), rules), allowMissingColumns=True)
    mapped = ref.join(kind.where("strategy <> 'error'"), "chapter").join(times, ["chapter", "widx"], "left")
    fixed = seq.monotone_repair(mapped, ["chapter", "verse"], ["pos"], "start", "fixed")
    return fixed.select("chapter", "verse", "pos", "word", F.col("fixed").alias("start"), "end", "score", "source", "strategy", "anchor")


def verse_starts(words: DataFrame) -> DataFrame:
    """Start of each verse: its anchor, else its first known word, else interpolated by words; and verse 0 at 0.

    After the last known verse the time before holds, as a chapter's duration is not known here.
    """
    known = F.when(F.col("start").isNotNull(), F.col("pos"))
    v = words.groupBy("chapter", "verse").agg(F.coalesce(F.min("anchor"), F.min_by("start", known)).alias("first"), F.count("*").alias("n"))
    v = v.withColumn("known_us", F.round(F.col("first") * 1_000_000).cast("long"))
    v = seq.anchor_interpolate(v, CH, "verse", "n", "known_us")
    filled = v.select("chapter", "verse", F.coalesce("first", F.col("start") / 1_000_000).alias("ts"))
    zero = words.select("chapter").distinct().select("chapter", F.lit(0).cast(words.schema["verse"].dataType).alias("verse"), F.lit(0.0).alias("ts"))
    return filled.unionByName(zero)


def chapter_quality(words: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Counts of words by source, of low and missing ones, and the verses with low words."""
    low = F.coalesce(F.col("score") < threshold, F.lit(False))
    return words.groupBy("chapter").agg(
        F.count("*").alias("total_words"), F.count_if(F.col("source") == "asr").alias("from_asr"), F.count_if(F.col("source").isin("ctc", "gap_fill", "drift_fix")).alias("from_ctc"),
        F.count_if(F.col("start").isNull()).alias("null_count"), F.count_if(low).alias("low_quality_count"), F.array_sort(F.collect_set(F.when(low, F.col("verse")))).alias("low_verses"),
    )


def without_preserved(timings: DataFrame, items: DataFrame, keys: list[str]) -> DataFrame:
    """Verse timings that may be written: those of items whose contributed timing is to be kept stay out."""
    return timings.join(items.where("preserve_existing_timing").select(*keys).distinct(), keys, "left_anti")


WINDOWED = "chapter long, verse long, pos long, word string, start double, end double, score double, source string, ts double"


def verse_only(ref: DataFrame, durations: DataFrame, aligner: Callable[[], a.Aligner], story: bool = False) -> DataFrame:
    """Chapters without recognition: each verse aligned in a window around its pace; one row for each word.

    ref: chapter, verse, pos, word. durations: chapter, seconds. Words of a verse
    that the aligner has no place for have no times; all words of a verse carry
    its mean score, its source (local, fallback) and its start (ts).
    """

    def run(w: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        w = w.sort_values(["verse", "pos"])
        groups = [g for _, g in w.groupby("verse", sort=True)]
        key = w["chapter"].iloc[0] if len(w) else None
        found = a.windowed(key, [[*g["word"]] for g in groups], float(d["seconds"].iloc[0]), aligner(), story=story) if len(d) and groups else []
        rows = []
        for g, s in zip(groups, found, strict=False):
            times = [(x.start, x.end) for x in s.words] if len(s.words) == len(g) else [(None, None)] * len(g)
            rows += [(c, v, p, x, t[0], t[1], round(s.score, 3), s.source, round(s.start, 2)) for c, v, p, x, t in zip(g["chapter"], g["verse"], g["pos"], g["word"], times, strict=True)]
        return pd.DataFrame(rows, columns=["chapter", "verse", "pos", "word", "start", "end", "score", "source", "ts"])

    return a.per_chapter(ref, durations, CH, run, WINDOWED)


def verse_only_starts(words: DataFrame, verses: DataFrame) -> DataFrame:
    """Start of each verse of ``verses`` (chapter, verse): its own, that of the verse before where it has no words; verse 0 at 0."""
    ts = words.groupBy("chapter", "verse").agg(F.min("ts").alias("ts"))
    zero = verses.select("chapter").distinct().select("chapter", F.lit(0).cast(verses.schema["verse"].dataType).alias("verse"), F.lit(0.0).alias("ts"))
    rows = verses.select("chapter", "verse").join(ts, ["chapter", "verse"], "left").unionByName(zero)
    return seq.forward_fill(rows, CH, ["verse"], "ts").select("chapter", "verse", F.col("filled").alias("ts"))


def segment_stats(words: DataFrame) -> DataFrame:
    """For each chapter or story: segments, fallbacks, mean score of the local ones."""
    v = words.groupBy("chapter", "verse").agg(F.first("score").alias("score"), F.first("source").alias("source"))
    local = F.col("source") == "local"
    return v.groupBy("chapter").agg(F.count("*").alias("segments"), F.count_if(~local).alias("fallbacks"), F.round(F.coalesce(F.avg(F.when(local, F.col("score"))), F.lit(0.0)), 3).alias("avg_score"))


def story_timings(words: DataFrame) -> DataFrame:
    """(chapter, segment, timestamp, score, source) of aligned stories."""
    return words.groupBy("chapter", F.col("verse").alias("segment")).agg(F.min("ts").alias("timestamp"), F.first("score").alias("score"), F.first("source").alias("source"))

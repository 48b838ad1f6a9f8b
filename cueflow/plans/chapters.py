"""Queries of whole chapters: conversations as text, timelines made from their own words."""

from __future__ import annotations

from pyspark.sql import functions as F

from cueflow.operators import alignment as a
from cueflow.operators import chapters as c
from cueflow.plans import views as v
from cueflow.plans.registry import register
from cueflow.session import ship
from cueflow.sources import sinks


def _inputs(spark, sf_dir):
    """Every chapter has text; by its number modulo 4 it has both timelines, one of them, or none."""
    ship(spark)
    ref = v.words(spark, sf_dir)
    start = F.col("widx") / 2
    timeline = ref.select("chapter", "widx", F.col("word").alias("text"), start.alias("start"), (start + 0.4).alias("end"), ((F.col("widx") * 37 % 100) / 100).alias("score"))
    ctc = timeline.where("chapter % 4 in (0, 1)")
    asr = timeline.where("chapter % 4 in (0, 2) and widx % 9 <> 4").withColumn("score", F.lit(0.9)).withColumn("start", F.col("start") + 0.1)
    return ref, ctc, asr


@register("chapter_strategies", f"with {v.WORDS} select distinct chapter, case chapter % 4 when 0 then 'both' when 1 then 'ctc' when 2 then 'asr' else 'error' end as strategy from v_words")
def chapter_strategies(spark, sf_dir):
    return c.chapter_strategies(*_inputs(spark, sf_dir))


@register("aligned_words")
def aligned_words(spark, sf_dir):
    """Word times of every chapter that can be aligned, by its strategy."""
    return c.aligned(*_inputs(spark, sf_dir)).drop("anchor")


def _whole(spark, sf_dir):
    """Every chapter with both timelines, complete: recognition is a tenth of a second late and sure of itself."""
    ship(spark)
    ref = v.words(spark, sf_dir)
    start = F.col("widx") / 2
    ctc = ref.select("chapter", "widx", F.col("word").alias("text"), start.alias("start"), (start + 0.4).alias("end"), ((F.col("widx") * 37 % 100) / 100).alias("score"))
    asr = ctc.select("chapter", "widx", "text", (F.col("start") + 0.1).alias("start"), (F.col("end") + 0.1).alias("end"), F.lit(0.9).alias("score"))
    return ref, ctc, asr


def _tenths(c: str):
    return F.round(F.col(c) * 10).cast("bigint").alias(c)


#: Fusion of the whole timelines: weak words of forced alignment give way, all others stay.
FUSED = v.WORDS + ", f as (select *, widx * 37 % 100 as pct, widx * 37 % 100 < 30 as weak from v_words)"


@register("aligned_fused", f"with {FUSED} select chapter, verse, pos, word, widx * 5 + cast(weak as int) as start, widx * 5 + 4 + cast(weak as int) as \"end\", case when weak then 90 else pct end as score, case when weak then 'asr' else 'ctc' end as source from f")
def aligned_fused(spark, sf_dir):
    """Chapters with both timelines: tenths of seconds, hundredths of scores."""
    w = c.aligned(*_whole(spark, sf_dir))
    return w.select("chapter", "verse", "pos", "word", _tenths("start"), _tenths("end"), F.round(F.col("score") * 100).cast("bigint").alias("score"), "source")


@register("aligned_fused_quality", f"with {FUSED} select chapter, count(*) as total_words, count(*) filter (where weak) as from_asr, count(*) filter (where not weak) as from_ctc, 0 as null_count, count(*) filter (where not weak and pct < 30) as low_quality_count, '' as low_verses from f group by chapter")
def aligned_fused_quality(spark, sf_dir):
    """Quality of the fused chapters: no weak word is left."""
    q = c.chapter_quality(c.aligned(*_whole(spark, sf_dir)))
    return q.withColumn("low_verses", F.array_join("low_verses", ","))


@register("aligned_ctc_words", f"with {v.WORDS} select chapter, verse, pos, word, widx / 2.0 as start, 'ctc' as source from v_words")
def aligned_ctc_words(spark, sf_dir):
    """Chapters with forced alignment only: words by position."""
    ref, ctc, asr = _whole(spark, sf_dir)
    return c.aligned(ref, ctc, asr.where("false")).select("chapter", "verse", "pos", "word", "start", "source")


@register("aligned_ctc_quality", f"with {v.WORDS} select chapter, count(*) as total_words, 0 as from_asr, count(*) as from_ctc, 0 as null_count, count(*) filter (where widx * 37 % 100 < 30) as low_quality_count, array_to_string(list_sort(list_distinct(coalesce(list(verse) filter (where widx * 37 % 100 < 30), []))), ',') as low_verses from v_words group by chapter")
def aligned_ctc_quality(spark, sf_dir):
    """Quality of chapters with forced alignment only, with the verses that hold weak words."""
    ref, ctc, asr = _whole(spark, sf_dir)
    return c.chapter_quality(c.aligned(ref, ctc, asr.where("false"))).withColumn("low_verses", F.array_join("low_verses", ","))


@register("aligned_verses", f"with {v.WORDS}, f as (select v.chapter, v.verse, min(w.widx) / 2.0 as first from v_verses v join v_words w on v.chapter = w.chapter and v.verse = w.verse group by all) select chapter, verse, first as ts from f union all select distinct chapter, 0, 0.0 from f")
def aligned_verses(spark, sf_dir):
    """Verse starts of chapters with forced alignment only."""
    ref, ctc, asr = _whole(spark, sf_dir)
    return c.verse_starts(c.aligned(ref, ctc, asr.where("false")))


@register("aligned_verses_all")
def aligned_verses_all(spark, sf_dir):
    """Verse starts of every chapter that can be aligned, by its strategy."""
    return c.verse_starts(c.aligned(*_inputs(spark, sf_dir)))


@register("aligned_quality")
def aligned_quality(spark, sf_dir):
    """Quality of every aligned chapter."""
    return c.chapter_quality(c.aligned(*_inputs(spark, sf_dir)))


class _Refuses:
    """An aligner without audio: every window is refused, so every segment keeps its estimate."""

    def align(self, chapter, lo, hi, words):
        raise RuntimeError("no audio")


def _paced(spark, sf_dir):
    """Words of every chapter and its duration: half a second a word."""
    ship(spark)
    w = v.words(spark, sf_dir).select("chapter", "verse", "pos", "word")
    return w, w.groupBy("chapter").agg((F.count("*") / 2).alias("seconds"))


#: Estimates of the verses that have words: half a second for each word before.
PACE = v.VERSES + ", e as (select chapter, verse, n_words, (sum(n_words) over (partition by chapter order by verse) - n_words) / 2.0 as ts from v_verses where n_words > 0)"


@register("verse_only_words", f"with {PACE} select e.chapter, e.verse, unnest(generate_series(0, n_words - 1)) as pos, ts, 'fallback' as source from e")
def verse_only_words(spark, sf_dir):
    """Chapters without recognition whose windows the aligner refuses: pace estimates for every verse."""
    return c.verse_only(*_paced(spark, sf_dir), _Refuses).select("chapter", "verse", "pos", "ts", "source")


@register("verse_only_starts", f"with {PACE} select v.chapter, v.verse, coalesce(max(e.ts), 0) as ts from v_verses v left join e on v.chapter = e.chapter and e.verse <= v.verse group by all union all select distinct chapter, 0, 0.0 from v_verses")
def verse_only_starts(spark, sf_dir):
    """Verse starts of such chapters; a verse without words has the start of the one before."""
    return c.verse_only_starts(c.verse_only(*_paced(spark, sf_dir), _Refuses), v.verses(spark, sf_dir))


@register("story_timing_export", f"with {PACE} select chapter, concat('[', string_agg(concat('{{\"story\":\"', chapter, '\",\"segment\":', verse, ',\"timestamp\":', ts, ',\"score\":0.0,\"source\":\"fallback\"}}'), ',' order by verse), ']') as json from e group by chapter")
def story_timing_export(spark, sf_dir):
    """Segments of stories as JSON arrays."""
    return sinks.story_timing_json(c.story_timings(c.verse_only(*_paced(spark, sf_dir), _Refuses, story=True)))


@register("segment_stats", f"with {PACE} select chapter, count(*) as segments, count(*) as fallbacks, 0.0 as avg_score from e group by chapter")
def segment_stats(spark, sf_dir):
    """Segments, fallbacks and mean local score of each story."""
    return c.segment_stats(c.verse_only(*_paced(spark, sf_dir), _Refuses, story=True))


@register("gap_filled_words")
def gap_filled_words(spark, sf_dir):
    """Fused words of every chapter, with gaps filled by an aligner over stored words."""
    ref, ctc, asr = _whole(spark, sf_dir)
    moved = ctc.withColumn("start", F.when(F.col("widx") % 50 == 20, F.col("start") - 4.0).otherwise(F.col("start")))
    return c.aligned(ref, moved, asr, aligner=lambda: a.TableAligner([])).drop("anchor")

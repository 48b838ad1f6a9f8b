"""Queries of the sequence operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from cueflow.operators import sequence as seq
from cueflow.plans import views as v
from cueflow.plans.registry import register

CH = ["chapter"]


@register("gap_scan", f"with {v.TIMELINE} select chapter, widx, gap from (select *, row_number() over (partition by chapter order by widx) rn from (select chapter, widx, lead(null_us) over (partition by chapter order by widx) - null_us as gap from v_timeline) where gap > 3000000) where rn = 1")
def gap_scan(spark, sf_dir):
    """First gap of more than three seconds in each chapter."""
    return seq.first_gap(v.timeline(spark, sf_dir), CH, "widx", "null_us", 3_000_000).select("chapter", "widx", "gap")


@register("gap_worst", f"with {v.TIMELINE} select chapter, max(gap) as gap, arg_max(widx, (gap, -widx)) as widx from (select chapter, widx, lead(null_us) over (partition by chapter order by widx) - null_us as gap from v_timeline) where gap > 3000000 group by chapter")
def gap_worst(spark, sf_dir):
    """Largest gap in each chapter; the first of equals."""
    w = seq.ordered(CH, ["widx"])
    g = v.timeline(spark, sf_dir).withColumn("gap", F.lead("null_us").over(w) - F.col("null_us")).where("gap > 3000000")
    return g.groupBy("chapter").agg(F.max("gap").alias("gap"), F.max_by("widx", F.struct("gap", -F.col("widx"))).alias("widx"))


@register("monotone_repair", f"with {v.JITTER}, i as (select *, count(*) filter (where null_stamp is null) over (partition by chapter order by verse rows unbounded preceding) as island from v_jitter) select chapter, verse, case when null_stamp is not null then max(null_stamp) over (partition by chapter, island order by verse rows unbounded preceding) end as repaired from i")
def monotone_repair(spark, sf_dir):
    return seq.monotone_repair(v.jitter(spark, sf_dir), CH, ["verse"], "null_stamp").select("chapter", "verse", "repaired")


@register("collapse_first", f"with {v.TIMELINE} select chapter, min(b) as first_index from (select chapter, min(widx) as b from (select chapter, widx, widx - row_number() over (partition by chapter order by widx) as run from v_timeline where pct <= 30) group by chapter, run having count(*) >= 5) group by chapter")
def collapse_first(spark, sf_dir):
    """Where the first run of five or more low scores begins."""
    return seq.first_run(v.timeline(spark, sf_dir), CH, "widx", F.col("pct") <= 30, 5)


@register("collapse_half", f"with {v.TIMELINE}, n as (select *, count(*) over (partition by chapter) as n from v_timeline) select chapter, count(*) as n_half, count(*) filter (where pct <= 10) as n_low, 10 * count(*) filter (where pct <= 10) > 3 * count(*) as collapsed from n where n >= 4 and widx >= n // 2 group by chapter")
def collapse_half(spark, sf_dir):
    """Whether more than 30 percent of the second half is low."""
    out = seq.second_half_share(v.timeline(spark, sf_dir), CH, "widx", F.col("pct") <= 10)
    return out.withColumn("collapsed", 10 * F.col("n_low") > 3 * F.col("n_half"))


@register("pace_estimate", f"with {v.VERSES} select chapter, verse, (600000 * coalesce(sum(n_words) over (partition by chapter order by verse rows between unbounded preceding and 1 preceding), 0)) // greatest(sum(n_words) over (partition by chapter), 1) as expected from v_verses")
def pace_estimate(spark, sf_dir):
    """Expected start in a chapter of ten minutes, in milliseconds."""
    return seq.pace(v.verses(spark, sf_dir), CH, ["verse"], "n_words", F.lit(600_000).cast("bigint")).select("chapter", "verse", "expected")


ANCHORS = f"""with {v.VERSES}, a as (select *, case when verse % 3 = 0 then verse * 10000 + (chapter * 37) % 5000 end as anchor from v_verses),
b as (select *, coalesce(max(case when anchor is not null then verse end) over u, 0) as pv, coalesce(last_value(anchor ignore nulls) over u, 0) as pt,
  min(case when anchor is not null then verse end) over d as nv, first_value(anchor ignore nulls) over d as nt from a
  window u as (partition by chapter order by verse rows unbounded preceding), d as (partition by chapter order by verse rows between current row and unbounded following)),
c as (select *, case when anchor is null then n_words else 0 end as w from b),
e as (select *, coalesce(sum(w) over (partition by chapter, pv order by verse rows between unbounded preceding and 1 preceding), 0) as bf, sum(w) over (partition by chapter, pv) as span from c),
r as (select *, case when anchor is not null then anchor when nt is null then pt when span > 0 then pt + ((nt - pt) * bf) // span else pt + ((nt - pt) * (verse - pv)) // greatest(nv - pv, 1) end as raw from e)
select chapter, verse, cast(max(raw) over (partition by chapter, pv order by verse rows unbounded preceding) as bigint) as start from r"""


@register("anchor_interpolate", ANCHORS)
def anchor_interpolate(spark, sf_dir):
    """Every third verse is anchored; the others are interpolated by words."""
    a = v.verses(spark, sf_dir).withColumn("anchor", F.when(F.col("verse") % 3 == 0, F.col("verse") * 10000 + (F.col("chapter") * 37) % 5000))
    return seq.anchor_interpolate(a, CH, "verse", "n_words", "anchor").select("chapter", "verse", F.col("start").cast("bigint").alias("start"))


@register("forward_fill", f"with {v.TIMELINE} select chapter, widx, coalesce(last_value(null_us ignore nulls) over (partition by chapter order by widx rows unbounded preceding), 0) as filled from v_timeline")
def forward_fill(spark, sf_dir):
    return seq.forward_fill(v.timeline(spark, sf_dir), CH, ["widx"], "null_us").select("chapter", "widx", "filled")


@register("first_valid", f"with {v.TIMELINE}, g as (select chapter, widx // 10 + 1 as verse, arg_min(null_us, widx) filter (where null_us is not null) as first_us from v_timeline group by all) select chapter, verse, coalesce(last_value(first_us ignore nulls) over (partition by chapter order by verse rows unbounded preceding), 0) as ts from g")
def first_valid(spark, sf_dir):
    """First known start of each verse of ten words, else the verse before."""
    t = v.timeline(spark, sf_dir).withColumn("verse", F.expr("widx div 10 + 1"))
    g = t.groupBy("chapter", "verse").agg(F.min_by("null_us", F.when(F.col("null_us").isNotNull(), F.col("widx"))).alias("first_us"))
    return seq.forward_fill(g, CH, ["verse"], "first_us", "ts").select("chapter", "verse", "ts")


@register("word_index", f"with {v.WORDS} select chapter, verse, word, widx from v_words")
def word_index(spark, sf_dir):
    return v.words(spark, sf_dir).select("chapter", "verse", "word", "widx")


@register("verse_map", f"with {v.WORDS}, {v.TIMELINE.strip()}, p as (select w.chapter, w.verse, t.null_us, w.widx from v_words w join v_timeline t on w.chapter = t.chapter and w.widx = t.widx), g as (select chapter, verse, count(*) as n_mapped, arg_min(null_us, widx) filter (where null_us is not null) as first_us from p group by all), a as (select v.chapter, v.verse, v.n_words, coalesce(g.n_mapped, 0) as n_mapped, g.first_us from v_verses v left join g on v.chapter = g.chapter and v.verse = g.verse) select chapter, verse, n_words, n_mapped, coalesce(last_value(first_us ignore nulls) over (partition by chapter order by verse rows unbounded preceding), 0) as ts from a")
def verse_map(spark, sf_dir):
    """Words of a timeline mapped to verses by position; a verse starts at its first known word, else with the verse before."""
    w, t = v.words(spark, sf_dir).select("chapter", "verse", "widx"), v.timeline(spark, sf_dir).select("chapter", "widx", "null_us")
    p = w.join(t, ["chapter", "widx"])
    g = p.groupBy("chapter", "verse").agg(F.count("*").alias("n_mapped"), F.min_by("null_us", F.when(F.col("null_us").isNotNull(), F.col("widx"))).alias("first_us"))
    a = v.verses(spark, sf_dir).select("chapter", "verse", "n_words").join(g, ["chapter", "verse"], "left").withColumn("n_mapped", F.coalesce("n_mapped", F.lit(0)))
    return seq.forward_fill(a, CH, ["verse"], "first_us", "ts").select("chapter", "verse", "n_words", "n_mapped", "ts")


@register("endstamp_shift", f"with {v.JITTER} select chapter, verse + 1 as verse, stamp as start from v_jitter union all select distinct chapter, 0, 0 from v_jitter union all select distinct chapter, 1, 0 from v_jitter")
def endstamp_shift(spark, sf_dir):
    return seq.end_to_start(v.jitter(spark, sf_dir), CH, "verse", "stamp").select("chapter", "verse", "start")


@register("silence_boundary", f"with {v.TIMELINE}, s as (select chapter, widx, start_us, start_us - lag(start_us + 400000) over (partition by chapter order by widx) as silence from v_timeline) select chapter, min(widx) as boundary, arg_min(silence, widx) as silence from s where silence > 2000000 and start_us <= 864000000000 group by chapter")
def silence_boundary(spark, sf_dir):
    """First word after a silence of more than two seconds, in the first ten days."""
    t = v.timeline(spark, sf_dir).withColumn("end_us", F.col("start_us") + 400_000)
    return seq.silence(t, CH, "widx", "start_us", "end_us", 2_000_000, 864_000_000_000)


@register("segment_words", f"with {v.VERSES}, s as (select chapter, verse, tokens, n_words, verse * 5000 as a, verse * 5000 + 4000 as b from v_verses), x as (select chapter, verse, n_words, a, b, unnest(tokens) as word, generate_subscripts(tokens, 1) - 1 as pos from s) select chapter, verse, pos, word, a + ((b - a) * pos) // n_words as word_start, a + ((b - a) * (pos + 1)) // n_words as word_end from x")
def segment_words(spark, sf_dir):
    """Segments without word stamps: equal parts of the span."""
    s = v.verses(spark, sf_dir).withColumn("a", F.col("verse") * 5000).withColumn("b", F.col("verse") * 5000 + 4000)
    return seq.per_segment_words(s, "a", "b", "tokens").select("chapter", "verse", "pos", "word", "word_start", "word_end")


@register("fileset_top1", f"with {v.FILESETS} select iso, raw_id, drama, stream from (select *, row_number() over (partition by iso order by drama, stream, l_orderkey, l_linenumber) rn from v_filesets) where rn = 1")
def fileset_top1(spark, sf_dir):
    """Best candidate: no drama, no stream, least id."""
    return seq.top_1(v.filesets(spark, sf_dir), ["iso"], ["drama", "stream", "l_orderkey", "l_linenumber"]).select("iso", "raw_id", "drama", "stream")


@register("fileset_alt", f"with {v.FILESETS}, r as (select *, row_number() over w as rn, first_value(drama) over w as top from v_filesets window w as (partition by iso order by drama, stream, l_orderkey, l_linenumber)) select iso, raw_id, drama from (select *, row_number() over (partition by iso order by rn) k from r where rn > 1 and drama <> top and stream = 0) where k = 1")
def fileset_alt(spark, sf_dir):
    """First candidate after the best one with the opposite drama flag that is no stream."""
    return seq.alternate(v.filesets(spark, sf_dir), ["iso"], ["drama", "stream", "l_orderkey", "l_linenumber"], "drama", F.col("stream") == 0).select("iso", "raw_id", "drama")


@register("standard_over_drama", f"with {v.FILESETS} select iso, raw_id, drama from (select *, max(1 - drama) over (partition by iso) as has from v_filesets) where 1 - drama = has")
def standard_over_drama(spark, sf_dir):
    return seq.prefer(v.filesets(spark, sf_dir), ["iso"], F.col("drama") == 0).select("iso", "raw_id", "drama")


@register("book_spec_format", "with d as (select distinct user_id as book, cast(floor(value) as bigint) % 60 + 1 as ch from events), r as (select book, min(ch) as a, max(ch) as b from (select book, ch, ch - row_number() over (partition by book order by ch) as run from d) group by book, run) select book, string_agg(case when a = b then cast(a as varchar) else concat(a, '-', b) end, ',' order by a) as spec from r group by book")
def book_spec_format(spark, sf_dir):
    """Chapters of each book as runs: 1-3,17."""
    from cueflow.operators.planning import format_spec

    e = v.table(spark, sf_dir, "events").select(F.col("user_id").alias("book"), (F.floor("value").cast("bigint") % 60 + 1).alias("ch"))
    return format_spec(e, "book", "ch")

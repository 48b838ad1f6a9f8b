"""Queries of the timing joins and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from cueflow.operators import reporting as r
from cueflow.operators import timing as t
from cueflow.plans import views as v
from cueflow.plans.registry import register
from cueflow.sources import sinks
from cueflow.sources.tables import table

DEFECTS = f"{v.JITTER}, d as (select *, stamp - lag(stamp) over (partition by chapter order by verse) as delta from v_jitter), f as (select chapter, count(*) as n_verses, count(*) filter (where delta = 0) as n_dupes, count(*) filter (where delta < 0) as n_backwards, count(*) filter (where delta > 0 and delta < 5) as n_tiny, count(*) filter (where delta > 120) as n_gaps from d group by chapter having count(*) >= 2)"
NULLS = "u as (select *, last_value(null_stamp ignore nulls) over (partition by chapter order by verse rows between unbounded preceding and 1 preceding) as prev from v_jitter), nd as (select chapter, count(*) filter (where null_stamp is null) as n_nulls, count(*) filter (where null_stamp = prev) as n_dupes, count(*) as n_words from u group by chapter)"


@register("timing_defects", f"with {DEFECTS} select * from f")
def timing_defects(spark, sf_dir):
    """Defect counts for each chapter of verse stamps."""
    return t.defects(v.jitter(spark, sf_dir), ["chapter"], ["verse"], "stamp", tiny=5)


@register("word_nulls_dupes", f"with {v.JITTER}, {NULLS} select * from nd")
def word_nulls_dupes(spark, sf_dir):
    return t.null_and_repeat_counts(v.jitter(spark, sf_dir), ["chapter"], ["verse"], "null_stamp")


OTHER = "od as (select chapter, stamp - lag(stamp) over (partition by chapter order by verse) as delta from v_jitter where verse % 2 = 0 and chapter % 3 <> 0), o as (select chapter, count(*) filter (where delta = 0 or delta < 0 or (delta > 0 and delta < 5) or delta > 120) as other_issues from od group by chapter having count(*) >= 2), sc as (select chapter, 2 * sum(stamp) < 300 * count(*) as low_score from v_jitter group by chapter)"


@register("chapter_flags", f"with {DEFECTS}, {NULLS}, {OTHER} select f.chapter, concat_ws(',', case when f.n_dupes > 0 then 'DUPES' end, case when n_backwards > 0 then 'BACKWARDS' end, case when n_tiny >= 3 then 'TINY-STEPS' end, case when n_gaps > 0 then 'GAPS' end, case when n_nulls >= 3 then 'NULLS' end, case when low_score then 'LOW-SCORE' end, case when other_issues < f.n_dupes + n_backwards + n_tiny + n_gaps and f.n_dupes + n_backwards + n_tiny + n_gaps > 0 then 'ORIG-BETTER' end) as flags from f left join nd on f.chapter = nd.chapter left join o on f.chapter = o.chapter left join sc on f.chapter = sc.chapter")
def chapter_flags(spark, sf_dir):
    """Flag names of each chapter: verse and word defects, score, and external timing (every second verse) with fewer issues."""
    words = word_nulls_dupes(spark, sf_dir).select("chapter", "n_nulls")
    j = v.jitter(spark, sf_dir)
    other = t.defects(j.where("verse % 2 = 0 and chapter % 3 <> 0"), ["chapter"], ["verse"], "stamp", tiny=5)
    other = other.select("chapter", (F.col("n_dupes") + F.col("n_backwards") + F.col("n_tiny") + F.col("n_gaps")).alias("other_issues"))
    score = j.groupBy("chapter").agg((2 * F.sum("stamp") < 300 * F.count("*")).alias("low_score"))
    all_ = timing_defects(spark, sf_dir).join(words, "chapter", "left").join(other, "chapter", "left").join(score, "chapter", "left")
    return all_.select("chapter", t.flags().alias("flags"))


@register("defects_rollup", f"with {DEFECTS} select chapter % 7 as iso, count(*) as n_chapters, cast(sum(n_dupes) as bigint) as dupes, cast(sum(n_backwards) as bigint) as backwards, cast(sum(n_gaps) as bigint) as gaps, count(*) filter (where n_dupes > 0 or n_gaps > 10) as flagged from f group by rollup (chapter % 7)")
def defects_rollup(spark, sf_dir):
    """Sums by language, and the total row (null iso)."""
    d = timing_defects(spark, sf_dir).withColumn("iso", F.col("chapter") % 7)
    return d.rollup("iso").agg(
        F.count("*").alias("n_chapters"), F.sum("n_dupes").alias("dupes"), F.sum("n_backwards").alias("backwards"), F.sum("n_gaps").alias("gaps"), F.count_if((F.col("n_dupes") > 0) | (F.col("n_gaps") > 10)).alias("flagged")
    )


DELTA = f"with {v.PAIRS}, p as (select *, abs(downloaded - pipeline) as d from v_pairs where verse <> 0), s as (select iso, chapter, count(*) as n, cast(sum(d) as bigint) as sum_delta, max(d) as max_delta, arg_max(verse, (d, -verse)) as max_verse from p group by all), c as (select *, case when sum_delta < 20 * n then 'GOOD' when sum_delta < 60 * n then 'DRIFT' else 'BAD' end as class from s)"


@register("timing_delta", DELTA + " select * from c")
def timing_delta(spark, sf_dir):
    """Downloaded against pipeline stamps by chapter, in days."""
    return t.delta_stats(v.pairs(spark, sf_dir).where("verse <> 0"), ["iso", "chapter"], 20, 60)


@register("verse_deltas", DELTA + " select p.iso, p.chapter, p.verse, p.downloaded, p.pipeline, d as delta, d > 2 as flagged, class from p join c on p.iso = c.iso and p.chapter = c.chapter")
def verse_deltas(spark, sf_dir):
    """Each verse of both timings with its delta, whether it is above two, and the chapter's class."""
    return t.compared_verses(v.pairs(spark, sf_dir).where("verse <> 0"), ["iso", "chapter"], 20, 60, 2)


@register("timing_matched", f"with {v.PAIRS}, d as (select iso, chapter, verse, max(downloaded) as downloaded from v_pairs group by all), p as (select iso, chapter, verse, max(pipeline) as pipeline from v_pairs where verse <> 3 group by all) select d.iso, d.chapter, d.verse, downloaded, pipeline from d join p on d.iso = p.iso and d.chapter = p.chapter and d.verse = p.verse")
def timing_matched(spark, sf_dir):
    """Downloaded and pipeline stamps of the verses that both have; verse 0 counts for nothing."""
    return t.matched(*v.two_timings(spark, sf_dir), ["iso", "chapter"])


LANG = ", l as (select iso, count(*) as n_chapters, count(*) filter (where class = 'GOOD') as good, count(*) filter (where class = 'DRIFT') as drift, count(*) filter (where class = 'BAD') as bad, max(max_delta) as max_delta, cast(sum((2000000 * sum_delta + n) // (2 * n)) as bigint) as sum_means from c group by iso), m as (select *, (2 * sum_means + n_chapters) // (2 * n_chapters) as mean_micro from l)"


@register("delta_by_lang", DELTA + LANG + " select * from m")
def delta_by_lang(spark, sf_dir):
    """Per language: classes, and the mean of chapter means (millionths), each chapter weighing one."""
    c = timing_delta(spark, sf_dir)
    kind = lambda k: F.count_if(F.col("class") == k).alias(k.lower())
    return c.groupBy("iso").agg(kind("GOOD"), kind("DRIFT"), kind("BAD"), F.max("max_delta").alias("max_delta")).join(t.mean_of_means(c, ["iso"]), "iso")


@register("delta_grand", DELTA + LANG + " select cast(sum(n_chapters) as bigint) as n_chapters, cast(sum(good) as bigint) as good, cast(sum(bad) as bigint) as bad, max(max_delta) as max_delta, (2 * cast(sum(mean_micro) as bigint) + count(*)) // (2 * count(*)) as mean_of_means from m")
def delta_grand(spark, sf_dir):
    """Total row: each language weighs one in the mean."""
    lang = delta_by_lang(spark, sf_dir)
    g = lang.agg(F.sum("n_chapters").alias("n_chapters"), F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.max("max_delta").alias("max_delta"), F.sum("mean_micro").alias("m"), F.count("*").alias("k"))
    return g.withColumn("mean_of_means", t.halved_up("m", "k")).drop("m", "k")


@register("coverage_gaps", "select doc_id, source from documents anti join labels using (doc_id)")
def coverage_gaps(spark, sf_dir):
    """Chapters with timecode (documents) and without quality (labels)."""
    return t.covered_but_missing(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels").select("doc_id"), ["doc_id"])


@register("pipeline_only", "select doc_id from labels anti join (select doc_id from documents where lang = 'en') d using (doc_id)")
def pipeline_only(spark, sf_dir):
    """Chapters with output only: labelled, but not among the English documents."""
    d = table(spark, sf_dir, "documents").where("lang = 'en'").select("doc_id")
    return t.covered_but_missing(table(spark, sf_dir, "labels").select("doc_id"), d, ["doc_id"])


@register("coverage_rollup", "with g as (select lang, source, d.doc_id, l.doc_id is not null as has from documents d left join labels l using (doc_id)), b as (select lang, source, count(*) as n, count(*) filter (where has) as k from g group by all) select lang, count(*) as n_books, cast(sum(n) as bigint) as n_chapters, cast(sum(k) as bigint) as n_done, string_agg(concat(source, ':', n - k), ',' order by source) as missing from b group by lang")
def coverage_rollup(spark, sf_dir):
    """Two levels: by book (source), then by fileset (language) with the list of what is missing."""
    lab = table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("has"))
    g = table(spark, sf_dir, "documents").select("lang", "source", "doc_id").join(lab, "doc_id", "left")
    b = g.groupBy("lang", "source").agg(F.count("*").alias("n"), F.count("has").alias("k"))
    item = F.struct("source", F.concat_ws(":", "source", (F.col("n") - F.col("k")).cast("string")).alias("text"))
    return b.groupBy("lang").agg(F.count("*").alias("n_books"), F.sum("n").alias("n_chapters"), F.sum("k").alias("n_done"), F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x.text), ",").alias("missing"))


@register("weighted_overview", "with q as (select source, count(*) as words, cast(sum(quality) as bigint) as score, count(*) filter (where toxic = 1) as low, list_sort(list_distinct(list(d.doc_id) filter (where toxic = 1))) as lows from documents d join labels l using (doc_id) group by source) select source, words, score, low, (200 * low + words) // (2 * words) as low_pct, case when len(lows) > 8 then concat(array_to_string(lows[1:8], ','), ',…') else coalesce(array_to_string(lows, ','), '') end as low_list, row_number() over (order by score * 1.0 / words, low desc, source) as place from q")
def weighted_overview(spark, sf_dir):
    """Overview by source: words, score sum, share, shortened list, place by score, low count and key."""
    from pyspark.sql.window import Window

    q = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id")
    lows = t.first_of(q.where("toxic = 1"), ["source"], "doc_id", 9, "lows")
    q = q.groupBy("source").agg(F.count("*").alias("words"), F.sum("quality").alias("score"), F.count_if(F.col("toxic") == 1).alias("low"))
    q = q.join(lows, "source", "left").withColumn("lows", F.coalesce("lows", F.array().cast("array<bigint>")))
    place = F.row_number().over(Window.orderBy(F.col("score").cast("double") / F.col("words"), F.desc("low"), "source"))  # one row a source
    return q.select("source", "words", "score", "low", t.flagged_share("low", "words").alias("low_pct"), t.shortened("lows").alias("low_list"), place.alias("place"))


@register("overview_totals", "with q as (select source, count(*) as words, cast(sum(quality) as bigint) as score from documents join labels using (doc_id) group by source) select cast(sum(words) as bigint) as words, cast(sum(score) as bigint) as score, count(*) as n_sources, (2000000 * cast(sum(score) as bigint) + cast(sum(words) as bigint)) // (2 * cast(sum(words) as bigint)) as mean_micro from q")
def overview_totals(spark, sf_dir):
    """Word-weighted total: sums over the rows of the overview, and the weighted mean in millionths."""
    q = weighted_overview(spark, sf_dir)
    g = q.agg(F.sum("words").alias("words"), F.sum("score").alias("score"), F.count("*").alias("n_sources"))
    return g.withColumn("mean_micro", t.halved_up("(score * 1000000)", "words"))


@register("overview_orders", "with q as (select source, lang, count(*) as words, cast(sum(quality) as bigint) as score, count(*) filter (where toxic = 1) as low from documents join labels using (doc_id) group by all) select source, lang, row_number() over (order by (1000000 * score) // words, source, lang) as by_score, row_number() over (order by low desc, source, lang) as by_low, row_number() over (order by source, lang) as by_key from q")
def overview_orders(spark, sf_dir):
    """Places of the overview's rows in its three orders; ties by key."""
    q = table(spark, sf_dir, "documents").select("doc_id", "source", "lang").join(table(spark, sf_dir, "labels"), "doc_id")
    q = q.groupBy("source", "lang").agg(F.count("*").alias("words"), F.sum("quality").alias("score"), F.count_if(F.col("toxic") == 1).alias("low"))
    return t.places(q, F.expr("(1000000 * score) div words"), "low", ["source", "lang"])


@register("quality_summary", f"with {v.TIMELINE} select chapter, count(*) as total_words, cast(sum(pct) as bigint) as score_sum, count(*) filter (where pct < 30) as low_quality_count, count(*) filter (where pct is null) as null_count, coalesce(array_to_string(list_sort(list_distinct(list(widx // 10 + 1) filter (where pct < 30))), ','), '') as low_verses, case when count(*) filter (where pct > 0) > 0 then cast(sum(pct) filter (where pct > 0) as bigint) // count(*) filter (where pct > 0) else 0 end as mean_positive from v_timeline group by chapter")
def quality_summary(spark, sf_dir):
    """Chapter quality, with the mean of the positive scores."""
    tl = v.timeline(spark, sf_dir).withColumn("verse", F.expr("widx div 10 + 1"))
    s = t.quality_summary(tl, ["chapter"], "pct", F.col("pct") < 30, "verse").withColumn("low_verses", F.array_join("low_verses", ","))
    p = tl.where("pct > 0").groupBy("chapter").agg(F.expr("sum(pct) div count(*)").alias("mean_positive"))
    return s.join(p, "chapter", "left").withColumn("mean_positive", F.coalesce("mean_positive", F.lit(0)))


@register("model_compare", f"with {v.TIMELINE}, d as (select a.chapter, abs(a.start_us - b.start_us) // 1000000 as d from v_timeline a join v_timeline b on a.chapter = b.chapter and b.widx = a.widx + 1 where a.source = 'click' and b.source = 'view') select chapter, count(*) as n, cast(sum(d) as bigint) as sum_d, max(d) as max_d, cast(quantile_cont(d, 0.5) * 2 as bigint) as median_2x, count(*) filter (where d <= 3600) as within_hour, count(*) filter (where d <= 86400) as within_day, count(*) filter (where d > 86400) as over_day from d group by chapter")
def model_compare(spark, sf_dir):
    """Neighbouring words of two models: count, sum, maximum, twice the median, share within an hour."""
    tl = v.timeline(spark, sf_dir)
    a, b = tl.where("source = 'click'").select("chapter", "widx", F.col("start_us").alias("sa")), tl.where("source = 'view'").select("chapter", (F.col("widx") - 1).alias("widx"), F.col("start_us").alias("sb"))
    d = a.join(b, ["chapter", "widx"]).withColumn("d", F.expr("abs(sa - sb) div 1000000"))
    return r.compared_models(d, ["chapter"], "d", (("within_hour", 3600), ("within_day", 86400)), (("over_day", 86400),)).withColumn("median_2x", (F.col("median") * 2).cast("bigint")).drop("median")


@register("top_divergences", DELTA + " select iso, chapter, max_delta, max_verse from c order by max_delta desc, chapter limit 10")
def top_divergences(spark, sf_dir):
    return timing_delta(spark, sf_dir).select("iso", "chapter", "max_delta", "max_verse").orderBy(F.desc("max_delta"), "chapter").limit(10)


@register("nearest_before", f"with {v.TIMELINE} select a.chapter, a.event_id as id, a.start_us, max(b.start_us) as asr_us from v_timeline a left join v_timeline b on a.chapter = b.chapter and b.source = 'view' and b.start_us <= a.start_us where a.source = 'click' group by all")
def nearest_before(spark, sf_dir):
    """Each CTC word with the latest ASR word not after it."""
    tl = v.timeline(spark, sf_dir)
    left = tl.where("source = 'click'").select("chapter", F.col("event_id").alias("id"), "start_us")
    right = tl.where("source = 'view'").select("chapter", "start_us", F.col("start_us").alias("asr_us"))
    return t.as_of(left, right, ["chapter"], "start_us", "asr_us")


@register("error_log_merge", "select user_id as chapter, event_type as kind, count(*) as n, string_agg(cast(event_id as varchar), ',' order by event_id) as details from events where event_type in ('error', 'signup') group by all")
def error_log_merge(spark, sf_dir):
    """Append-only error rows seen as one list for each key."""
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("error", "signup"))
    log = sinks.error_log(e.select(F.col("user_id").alias("chapter"), F.col("event_type").alias("kind"), "event_id"), ["chapter", "kind"])
    return log.select("chapter", "kind", F.size("errors").cast("bigint").alias("n"), F.array_join(F.transform("errors", lambda x: x.event_id.cast("string")), ",").alias("details"))


@register("error_lists", "select user_id as chapter, max(ts) as timestamp, count(*) filter (where event_type = 'click') as n_audio, count(*) filter (where event_type = 'view') as n_text, string_agg(cast(event_id as varchar), ',' order by ts, event_id) filter (where event_type = 'error') as timing from events where event_type in ('click', 'view', 'error') group by user_id")
def error_lists(spark, sf_dir):
    """Error rows of each chapter in lists by content."""
    content = F.when(F.col("event_type") == "click", "audio").when(F.col("event_type") == "view", "text").otherwise("timing")
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view", "error"))
    e = e.select(F.col("user_id").alias("chapter"), sinks.error_row(F.lit("not_found"), content, F.lit("F"), F.lit("D"), F.format_string("%09d", "event_id"), F.col("ts")).alias("error"))
    ids = F.array_join(F.transform("timing_errors", lambda x: x.details.cast("bigint").cast("string")), ",")
    return sinks.error_lists(e, ["chapter"]).select("chapter", "timestamp", F.size("audio_errors").cast("bigint").alias("n_audio"), F.size("text_errors").cast("bigint").alias("n_text"), F.nullif(ids, F.lit("")).alias("timing"))


@register("provenance_upsert", "with o as (select user_id as k, max(event_id) filter (where event_type = 'click') as audio, max(event_id) filter (where event_type = 'view') as text from events where event_id % 2 = 0 group by all), n as (select user_id as k, max(event_id) filter (where event_type = 'click') as audio, max(event_id) filter (where event_type = 'purchase') as text from events where event_id % 3 = 0 group by all) select coalesce(o.k, n.k) as k, coalesce(n.audio, o.audio) as audio, coalesce(n.text, o.text) as text from o full join n on o.k = n.k")
def provenance_upsert(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("k"), "event_id", "event_type")
    pick = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("event_id")))
    old = e.where("event_id % 2 = 0").groupBy("k").agg(pick("click").alias("audio"), pick("view").alias("text"))
    new = e.where("event_id % 3 = 0").groupBy("k").agg(pick("click").alias("audio"), pick("purchase").alias("text"))
    return t.upsert(old, new, ["k"], ["audio", "text"])


@register("run_counters", "select event_type as status, count(*) as n, count(distinct user_id) as chapters, cast(sum(cast(floor(value) as bigint)) as bigint) as seconds from events group by all")
def run_counters(spark, sf_dir):
    """Counters by status, with seconds of audio."""
    return r.run_counters(table(spark, sf_dir, "events"), "event_type", "user_id", F.floor("value").cast("bigint"))

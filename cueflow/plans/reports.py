"""Queries of scans, sinks and reports over values made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cueflow.functions import text as x
from cueflow.operators import discovery as d
from cueflow.operators import reporting as r
from cueflow.plans import views as v
from cueflow.plans.registry import register
from cueflow.sources import files, sinks
from cueflow.sources.tables import table


@register("path_keys", "select p_partkey, 'nt' as canon, concat('i', p_size) as iso, concat('D', p_size % 4) as distinct_id, concat('B', p_size % 3) as book, cast(case when p_size % 5 = 0 then null else p_size end as int) as chapter, 'A_B' as fileset from part")
def path_keys(spark, sf_dir):
    """Chapter keys read from paths; what is no number gives a null chapter."""
    s = F.col("p_size")
    c = lambda head, e: F.concat(F.lit(head), e.cast("string"))
    number = F.when(s % 5 == 0, "x").otherwise(F.lpad(s.cast("string"), 3, "0"))
    book = c("B", s % 3)
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("file:/r/nt/"), c("i", s), F.lit("/"), c("D", s % 4), F.lit("/"), book, F.lit("/"), book, F.lit("_"), number, F.lit("_A_B_mms_words.json")).alias("path"))
    return p.select("p_partkey", *files.path_key("path"))


@register("json_defaults", "select event_id, coalesce(cast(json_extract(props, '$.k') as bigint), -1) as k, coalesce(json_extract_string(props, '$.missing'), 'none') as missing from events")
def json_defaults(spark, sf_dir):
    """JSON fields with defaults."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.coalesce(F.get_json_object("props", "$.k").cast("bigint"), F.lit(-1)).alias("k"), F.coalesce(F.get_json_object("props", "$.missing"), F.lit("none")).alias("missing"))


@register("safe_numbers", "select event_id, event_id % 1000 as n from events where event_id % 3 <> 0")
def safe_numbers(spark, sf_dir):
    """Rows whose text reads as a whole number; the others are skipped."""
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("v"), (F.col("event_id") % 1000).cast("string"))).otherwise((F.col("event_id") % 1000).cast("string")).alias("raw"))
    return e.withColumn("n", F.expr("try_cast(raw as bigint)")).where("n is not null").select("event_id", "n")


@register("timing_last_wins", f"with {v.JITTER} select chapter, verse % 20 as verse, arg_max(stamp, verse) as ts from v_jitter group by chapter, verse % 20")
def timing_last_wins(spark, sf_dir):
    """Of repeated verses in a file the last stamp counts."""
    j = v.jitter(spark, sf_dir)
    return j.groupBy("chapter", (F.col("verse") % 20).alias("v")).agg(F.max_by("stamp", "verse").alias("ts")).withColumnRenamed("v", "verse")


@register("timecode_scan", "with f as (select o_custkey as chapter, o_orderkey as path, case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as search from orders) select chapter, arg_max(path, (search, path)) as path from f group by chapter")
def timecode_scan(spark, sf_dir):
    """Downloaded timecode of each chapter: a later search directory overwrites an earlier one."""
    search = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("chapter"), F.col("o_orderkey").alias("path"), search.alias("search"))
    return r.latest_timecodes(o, ["chapter"])


@register("csv_times", f"with {v.JITTER}, l as (select chapter, verse, stamp, row_number() over (partition by chapter order by verse) as line from v_jitter where event_type <> 'error') select chapter, line, stamp as value from l")
def csv_times(spark, sf_dir):
    """One stamp a line; lines that are no number are skipped before lines are numbered."""
    raw = v.jitter(spark, sf_dir).select("chapter", "verse", F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("stamp").cast("string")).alias("raw"))
    good = raw.withColumn("value", F.expr("try_cast(raw as bigint)")).where("value is not null")
    return good.select("chapter", F.row_number().over(Window.partitionBy("chapter").orderBy("verse")).alias("line"), "value")


@register("drama_filter", "select l_orderkey, l_linenumber, l_linenumber % 3 = 0 as drama, case when l_linenumber % 2 = 0 then 'ET' else 'NT' end as tag from lineitem where l_linenumber % 3 = 0 or l_returnflag = 'R'")
def drama_filter(spark, sf_dir):
    """Drama flag from a file set, tag from a text name, filter without regard to case."""
    n = F.col("l_linenumber")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.when(n % 3 == 0, "XX2DA").otherwise("XX1DA").alias("fileset"), F.concat(F.lit("GEN_001_"), F.when(n % 2 == 0, "ET").otherwise("NT"), F.lit(".txt")).alias("name"))
    li = li.withColumn("part", F.split_part("name", F.lit("_"), F.lit(3)))
    return li.where(d.is_drama("fileset") | (F.upper("l_returnflag") == "R")).select("l_orderkey", "l_linenumber", d.is_drama("fileset").alias("drama"), d.text_tag("part").alias("tag"))


@register("chapters_merge", "select user_id % 9 as book, count(distinct event_id % 60) as n_chapters, string_agg(distinct cast(event_id % 60 as varchar), ',' order by cast(event_id % 60 as varchar)) as chapters from events group by all")
def chapters_merge(spark, sf_dir):
    """Chapters of each book over all jobs, as sets."""
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 9).alias("book"), (F.col("event_id") % 60).cast("string").alias("chapter"))
    return r.merged_chapters(e, ["book"]).withColumn("chapters", F.array_join("chapters", ","))


@register("availability", "with a as (select user_id % 5 as k, event_id % 12 + 1 as ch from events) select r_name as book, cast(r_regionkey * 7 + 5 as int) as expected, count(distinct ch) filter (where ch <= r_regionkey * 7 + 5) as available from region left join a on k = r_regionkey group by all")
def availability(spark, sf_dir):
    """Available and expected chapters of each book."""
    have = table(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("k"), (F.col("event_id") % 12 + 1).alias("chapter"))
    expected = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"), "r_name", (F.col("r_regionkey") * 7 + 5).cast("int").alias("expected"))
    got = r.availability(expected.select("k", "expected"), have, ["k"]).drop("expected")
    return expected.join(got, "k").select(F.col("r_name").alias("book"), "expected", "available")


@register("story_stats", f"with {v.TIMELINE} select chapter, count(*) as segments, count(*) filter (where pct < 35) as fallback, coalesce(cast(sum(pct) filter (where pct >= 35) as bigint) // nullif(count(*) filter (where pct >= 35), 0), 0) as mean_local from v_timeline group by chapter")
def story_stats(spark, sf_dir):
    """Segments, fallbacks and the mean score of local ones."""
    t = v.timeline(spark, sf_dir).withColumn("local", F.when(F.col("pct") >= 35, F.col("pct")))
    g = t.groupBy("chapter").agg(F.count("*").alias("segments"), F.count_if(F.col("pct") < 35).alias("fallback"), F.sum("local").alias("s"), F.count("local").alias("k"))
    return g.select("chapter", "segments", "fallback", F.coalesce(F.expr("s div nullif(k, 0)"), F.lit(0)).alias("mean_local"))


@register("first_last_words", f"with {v.WORDS}, n as (select *, count(*) over (partition by chapter) as n from v_words) select chapter, widx, word from n where widx < 5 or widx >= n - 5")
def first_last_words(spark, sf_dir):
    """First and last five words of each chapter."""
    w = v.words(spark, sf_dir).withColumn("n", F.count("*").over(Window.partitionBy("chapter")))
    return w.where("widx < 5 or widx >= n - 5").select("chapter", "widx", "word")


@register("subtitle_blocks", f"with {v.TIMELINE}, s as (select chapter, widx + 1 as ordinal, widx * 2500 as a, widx * 2500 + 1999 as b, case when source = 'error' then ' ' else source end as text from v_timeline), f as (select chapter, ordinal, concat(ordinal, chr(10), strftime(make_timestamp(a * 1000), '%H:%M:%S'), ',', lpad(cast(a % 1000 as varchar), 3, '0'), ' --> ', strftime(make_timestamp(b * 1000), '%H:%M:%S'), ',', lpad(cast(b % 1000 as varchar), 3, '0'), chr(10), text, chr(10)) as block from s where trim(text) <> '') select chapter, string_agg(block, chr(10) order by ordinal) as srt from f group by chapter")
def subtitle_blocks(spark, sf_dir):
    """Subtitle text of each chapter; numbers keep their gaps."""
    t = v.timeline(spark, sf_dir)
    s = t.select("chapter", (F.col("widx") + 1).alias("ordinal"), (F.col("widx") * 2500).alias("start_ms"), (F.col("widx") * 2500 + 1999).alias("end_ms"), F.when(F.col("source") == "error", " ").otherwise(F.col("source")).alias("text"))
    return sinks.subtitles(s, ["chapter"])


@register("words_export", f"with {v.TIMELINE} select chapter, concat('{{\"words\":[', string_agg(concat('{{\"text\":\"', source, '\",\"start\":', start_us, ',\"end\":', start_us + 400, ',\"score\":', pct, '}}'), ',' order by widx), ']}}') as json from v_timeline group by chapter")
def words_export(spark, sf_dir):
    """Word timeline of each chapter as JSON."""
    t = v.timeline(spark, sf_dir).select("chapter", "widx", F.col("source").alias("text"), F.col("start_us").alias("start"), (F.col("start_us") + 400).alias("end"), F.col("pct").alias("score"))
    return sinks.words_json(t, ["chapter"])


@register("verse_timing_export", f"with {v.JITTER} select chapter, 'B' as book, concat('[', string_agg(concat('{{\"book\":\"B\",\"chapter\":\"', case when chapter < 1000 then lpad(cast(chapter as varchar), 3, '0') else cast(chapter as varchar) end, '\",\"verse_start\":\"', verse, '\",\"verse_start_alt\":\"', verse, '\",\"timestamp\":', stamp, '}}'), ',' order by verse), ']') as json from v_jitter group by chapter")
def verse_timing_export(spark, sf_dir):
    """Verse stamps of each chapter as a JSON array."""
    j = v.jitter(spark, sf_dir).select("chapter", F.lit("B").alias("book"), "verse", F.col("stamp").alias("ts"))
    return sinks.verse_timing_json(j, ["chapter", "book"])


@register("bad_outputs_kept", f"with {v.PAIRS}, b as (select chapter from v_pairs group by chapter having sum(abs(downloaded - pipeline)) >= 60 * count(*)) select o_orderkey as chapter from orders anti join b on o_orderkey = b.chapter")
def bad_outputs_kept(spark, sf_dir):
    """Outputs that stay when those classed BAD go (asked for explicitly)."""
    bad = v.pairs(spark, sf_dir).groupBy("chapter").agg(F.sum(F.abs(F.col("downloaded") - F.col("pipeline"))).alias("s"), F.count("*").alias("n")).where("s >= 60 * n")
    return sinks.without_bad(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("chapter")), bad, ["chapter"], confirm=True)


@register("external_source", "with x as (select distinct p_brand as v, p_size % 4 as ref from part where p_size < 20), d as (select ref, min(v) as via from (select distinct p_brand as v, p_size % 4 as ref from part where p_size < 10) group by ref), a as (select distinct p_brand as v, p_size % 6 as r from part), e as (select v, min(ref) as ref from x where ref < 3 group by v) select a.v, a.r, coalesce(cast(e.ref as varchar), d.via, 'none') as source from a left join e on a.v = e.v and a.r < 2 left join d on a.r = d.ref")
def external_source(spark, sf_dir):
    """Versions, then cross references, then none."""
    p = table(spark, sf_dir, "part")
    e = p.where("p_size < 20 and p_size % 4 < 3").groupBy(F.col("p_brand").alias("v")).agg(F.min(F.col("p_size") % 4).alias("ref"))
    via = p.where("p_size < 10").groupBy((F.col("p_size") % 4).alias("r4")).agg(F.min("p_brand").alias("via"))
    a = p.select(F.col("p_brand").alias("v"), (F.col("p_size") % 6).alias("r")).distinct()
    j = a.join(e, (a.v == e.v) & (a.r < 2), "left").drop(e.v).join(via, F.col("r") == F.col("r4"), "left")
    return j.select("v", "r", F.coalesce(F.col("ref").cast("string"), "via", F.lit("none")).alias("source"))


@register("reader_lookup", "with r as (select n_nationkey as reader, unnest([concat('D', n_nationkey), concat('E', n_regionkey, '-', n_nationkey)]) as distinct_id from nation), w as (select distinct concat('D', c_custkey % 40) as distinct_id from customer) select w.distinct_id, reader from w left join r on w.distinct_id = r.distinct_id")
def reader_lookup(spark, sf_dir):
    """Reader of an id through the exploded configuration."""
    n = table(spark, sf_dir, "nation")
    k, g = F.col("n_nationkey").cast("string"), F.col("n_regionkey").cast("string")
    r = n.select(F.col("n_nationkey").alias("reader"), F.explode(F.array(F.concat(F.lit("D"), k), F.concat(F.lit("E"), g, F.lit("-"), k))).alias("distinct_id"))
    w = table(spark, sf_dir, "customer").select(F.concat(F.lit("D"), (F.col("c_custkey") % 40).cast("string")).alias("distinct_id")).distinct()
    return w.join(r, "distinct_id", "left").select("distinct_id", "reader")


@register("chunk_words", f"with {v.VERSES}, c as (select chapter, cast(sum(n_words) as bigint) as n, cast(max(verse) as bigint) as k from v_verses group by chapter), x as (select chapter, n, k, unnest(generate_series(0, k - 1)) as chunk from c) select chapter, chunk, (n * (chunk + 1)) // k - (n * chunk) // k as words from x")
def chunk_words(spark, sf_dir):
    """Words of a chapter allotted to equal chunks in proportion to time."""
    c = v.verses(spark, sf_dir).groupBy("chapter").agg(F.sum("n_words").alias("n"), F.max("verse").cast("bigint").alias("k"))
    c = c.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("k") - 1)).alias("chunk"))
    return c.select("chapter", "chunk", F.expr("(n * (chunk + 1)) div k - (n * chunk) div k").alias("words"))


@register("match_forms", r"select item_id, trim(regexp_replace(regexp_replace(strip_accents(lower(text)), '[^\p{L}\p{N}_\t\n\x0b\f\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]', '', 'g'), '[\t\n\x0b\f\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) as form from benchmark")
def match_forms(spark, sf_dir):
    """Lower case, then cleaned."""
    from cueflow.session import ship

    ship(spark)
    return table(spark, sf_dir, "benchmark").select("item_id", x.match_form("text").alias("form"))


@register("chapter_detail", f"with {v.WORDS}, {v.TIMELINE.strip()}, j as (select w.chapter, w.verse, w.word, w.pos, coalesce(t.pct, -1) as pct from v_words w left join v_timeline t on w.chapter = t.chapter and w.widx = t.widx) select chapter, verse, count(*) as n, count(*) filter (where pct between 0 and 29) as low, string_agg(case when pct between 0 and 29 then concat(word, '*') else word end, ' ' order by pos) as shown from j group by chapter, verse")
def chapter_detail(spark, sf_dir):
    """Words of each verse with low ones marked."""
    w, t = v.words(spark, sf_dir), v.timeline(spark, sf_dir).select("chapter", "widx", "pct")
    j = w.join(t, ["chapter", "widx"], "left").withColumn("low", F.coalesce(F.col("pct") < 30, F.lit(False)))
    word = F.struct("pos", F.when(F.col("low"), F.concat("word", F.lit("*"))).otherwise(F.col("word")).alias("w"))
    return j.groupBy("chapter", "verse").agg(F.count("*").alias("n"), F.count_if("low").alias("low"), F.array_join(F.transform(F.array_sort(F.collect_list(word)), lambda y: y.w), " ").alias("shown"))

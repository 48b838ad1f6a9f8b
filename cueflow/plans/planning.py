"""Queries of scope, catalogue resolution and planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from cueflow.functions import reference_data as ref
from cueflow.operators import planning as p
from cueflow.plans import views as v
from cueflow.plans.registry import register
from cueflow.sources.tables import table

BOOKS_SQL = "books as (select r_name as book, case when r_regionkey < 3 then 'OT' else 'NT' end as canon, cast(r_regionkey * 7 + 5 as int) as n_chapters from region)"


def books(spark, sf_dir):
    """Canon dimension from region: book, canon, n_chapters."""
    return table(spark, sf_dir, "region").select(F.col("r_name").alias("book"), F.when(F.col("r_regionkey") < 3, "OT").otherwise("NT").alias("canon"), (F.col("r_regionkey") * 7 + 5).cast("int").alias("n_chapters"))


@register("book_spec_expand", f"with {BOOKS_SQL}, e as (select user_id, cast(floor(value) as int) % 9 + 1 as a, event_id % 5 as b from events where event_id < 1000000000), s as (select distinct user_id as spec_id, a, b from e), x as (select spec_id, r_name as book, a, a + b as z from s join region on r_regionkey = b union all select spec_id, r_name, 40, 40 from s join region on r_regionkey = b), y as (select distinct spec_id, book, unnest(generate_series(a, z)) as chapter from x) select spec_id, book, cast(chapter as int) as chapter from y")
def book_spec_expand(spark, sf_dir):
    """Specs such as ASIA:3-5,40 for each user, read back."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("spec_id"), (F.floor("value").cast("int") % 9 + 1).alias("a"), (F.col("event_id") % 5).alias("b")).distinct()
    r = table(spark, sf_dir, "region")
    part = F.concat(F.col("r_name"), F.lit(":"), F.col("a").cast("string"), F.lit("-"), (F.col("a") + F.col("b")).cast("string"), F.lit(",40"))
    specs = e.join(F.broadcast(r), F.col("b") == F.col("r_regionkey")).groupBy("spec_id").agg(F.array_join(F.array_sort(F.collect_list(part)), ",").alias("spec"))
    return p.expand_spec(specs, "spec_id", "spec", books(spark, sf_dir))


@register("book_spec_full", f"with {BOOKS_SQL}, d as (select distinct r_name as book, cast(floor(value) as bigint) % (r_regionkey * 9 + 3) + 1 as ch, n_chapters from events join region on user_id % 5 = r_regionkey join books on book = r_name), r as (select book, min(ch) as a, max(ch) as b from (select book, ch, ch - row_number() over (partition by book order by ch) as run from d) group by book, run), f as (select book, count(*) as k, min(ch) as lo, max(ch) as hi, any_value(n_chapters) as n from d group by book) select f.book, case when k = n and lo = 1 and hi = n then f.book else concat(f.book, ':', s) end as spec from f join (select book, string_agg(case when a = b then cast(a as varchar) else concat(a, '-', b) end, ',' order by a) as s from r group by book) g on f.book = g.book")
def book_spec_full(spark, sf_dir):
    e = table(spark, sf_dir, "events").join(F.broadcast(table(spark, sf_dir, "region")), F.col("user_id") % 5 == F.col("r_regionkey"))
    d = e.select(F.col("r_name").alias("book"), (F.floor("value").cast("bigint") % (F.col("r_regionkey") * 9 + 3) + 1).alias("ch"))
    return p.format_full(d, books(spark, sf_dir), "book", "ch")


@register("testament_chapters", f"with {BOOKS_SQL} select canon, count(*) as n_books, cast(sum(n_chapters) as bigint) as n_chapters from books group by canon")
def testament_chapters(spark, sf_dir):
    """Expected chapters of each canon."""
    return books(spark, sf_dir).groupBy("canon").agg(F.count("*").alias("n_books"), F.sum("n_chapters").alias("n_chapters"))


@register("passage_overlap", f"with {BOOKS_SQL}, g as (select distinct r_name as book, cast(floor(value) as int) % 12 + 1 as chapter from events join region on user_id % 5 = r_regionkey) select book, chapter, (book = 'ASIA' and chapter = 2) or (book = 'EUROPE' and chapter = 7) as configured from g")
def passage_overlap(spark, sf_dir):
    """Chapters that a configured passage (ASIA 2:4-9, EUROPE 7:1-3) touches."""
    from cueflow.functions.text import in_passages

    e = table(spark, sf_dir, "events").join(F.broadcast(table(spark, sf_dir, "region")), F.col("user_id") % 5 == F.col("r_regionkey"))
    g = e.select(F.col("r_name").alias("book"), (F.floor("value").cast("int") % 12 + 1).alias("chapter")).distinct()
    return g.withColumn("configured", in_passages("book", "chapter", ["ASIA 2:4-9", "EUROPE 7:1-3"]))


@register("language_resolve", "with q as (select distinct lang as iso from documents union select lower(n_name) from nation), k as (select lang as iso, count(*) as tier from documents group by lang) select q.iso, coalesce(k.tier, 99) as tier, coalesce(case q.iso when 'en' then 'english' when 'de' then 'german' when 'fr' then 'french' end, 'auto') as asr from q left join k on q.iso = k.iso")
def language_resolve(spark, sf_dir):
    """Requested languages, known or with defaults, and their recogniser's code."""
    d = table(spark, sf_dir, "documents")
    asked = d.select(F.col("lang").alias("iso")).union(table(spark, sf_dir, "nation").select(F.lower("n_name"))).distinct().withColumn("ordinal", F.lit(0))
    known = d.groupBy(F.col("lang").alias("iso")).agg(F.count("*").alias("tier"))
    codes = spark.createDataFrame([("en", "english"), ("de", "german"), ("fr", "french")], "iso string, asr string")
    out = p.chosen_or_default(asked, known.join(F.broadcast(codes), "iso", "left"), "iso", {"tier": F.lit(99).cast("bigint"), "asr": F.lit("auto")})
    return out.drop("ordinal")


@register("catalog_fallback", "with c as (select p_brand || case when p_size % 3 = 0 then 'p' else '' end as key, min(p_name) as entry from part group by all), a as (select distinct p_brand as asked from part union select 'none') select asked, coalesce(x.entry, y.entry) as entry from a left join c x on x.key = asked left join c y on y.key = asked || 'p' where coalesce(x.entry, y.entry) is not null")
def catalog_fallback(spark, sf_dir):
    """Entry of the full key, else of the partial key."""
    part = table(spark, sf_dir, "part")
    c = part.groupBy(F.concat("p_brand", F.when(F.col("p_size") % 3 == 0, "p").otherwise("")).alias("key")).agg(F.min("p_name").alias("entry"))
    asked = part.select(F.col("p_brand").alias("key")).distinct()
    return p.with_partial(c, asked, "key", "entry")


@register("overlap_match", "with o as (select p_size as group_id, case when p_partkey % 2 = 0 then 'd' else 'h' end as prefix, p_partkey % 400 as id, cast(p_size % 4 = 0 as int) as partial from part) select d.id as asked, arg_min(h.id, (h.partial, h.group_id, h.id)) as match from o d join o h on d.group_id = h.group_id where d.prefix = 'd' and h.prefix = 'h' group by d.id")
def overlap_match(spark, sf_dir):
    """Equivalent ids through groups; full keys before partial ones."""
    o = table(spark, sf_dir, "part").select(F.col("p_size").alias("group_id"), F.when(F.col("p_partkey") % 2 == 0, "d").otherwise("h").alias("prefix"), (F.col("p_partkey") % 400).alias("id"), (F.col("p_size") % 4 == 0).cast("int").alias("partial")).distinct()
    return p.equivalents(o, o.where("prefix = 'd'").select(F.col("id").alias("asked")).distinct())


@register("catalog_ids", "select distinct l_shipmode, raw, case when kind = lower(kind) then l_shipmode || tail else tail end as id from (select concat('K', l_suppkey) as l_shipmode, concat(case when l_returnflag = 'R' then 'A' else 'a' end, ':N', l_linenumber, 'DA') as raw, case when l_returnflag = 'R' then 'A' else 'a' end as kind, concat('N', l_linenumber, 'DA') as tail from lineitem)")
def catalog_ids(spark, sf_dir):
    """Catalogue ids resolved by the case of their type."""
    li = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("K"), F.col("l_suppkey").cast("string")).alias("l_shipmode"), F.concat(F.when(F.col("l_returnflag") == "R", "A").otherwise("a"), F.lit(":N"), F.col("l_linenumber").cast("string"), F.lit("DA")).alias("raw"))
    return li.distinct().withColumn("id", p.resolved_id("l_shipmode", "raw"))


@register("fileset_suffix", "with f as (select distinct concat('XYZ', p_size, case p_size % 4 when 0 then '-opus16' when 1 then '-mp3-64' when 2 then '-other' else '' end) as fileset from part) select fileset, regexp_replace(fileset, '-(opus16|opus32|mp3-64|mp3-128|mp3|json|usx|html)$', '') as plain from f")
def fileset_suffix(spark, sf_dir):
    tail = F.when(F.col("p_size") % 4 == 0, "-opus16").when(F.col("p_size") % 4 == 1, "-mp3-64").when(F.col("p_size") % 4 == 2, "-other").otherwise("")
    f = table(spark, sf_dir, "part").select(F.concat(F.lit("XYZ"), F.col("p_size").cast("string"), tail).alias("fileset")).distinct()
    return f.withColumn("plain", p.without_suffix("fileset"))


@register("failure_kinds", "select event_id, case when s is null or s < 400 then 'empty_data' when s = 403 then 'http_403_forbidden' when s = 404 then 'http_404_not_found' else 'http_error' end as kind from (select event_id, case when event_id % 5 <> 0 then 400 + cast(floor(value) as int) % 7 - case when event_id % 2 = 0 then 200 else 0 end end as s from events)")
def failure_kinds(spark, sf_dir):
    status = 400 + F.floor("value").cast("int") % 7 - F.when(F.col("event_id") % 2 == 0, 200).otherwise(0)
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 5 != 0, status).alias("s"))
    return e.select("event_id", p.failure_kind("s").alias("kind"))


@register("skip_done", "select o_orderkey from orders anti join (select distinct l_orderkey as o_orderkey from lineitem where l_returnflag = 'R') d using (o_orderkey)")
def skip_done(spark, sf_dir):
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return p.not_done(table(spark, sf_dir, "orders").select("o_orderkey"), done, ["o_orderkey"])


@register("stale_outputs", "select o_orderkey as k from orders left join (select l_orderkey, min(l_shipdate) as m from lineitem where l_linestatus = 'F' group by all) on l_orderkey = o_orderkey where m is null or o_orderdate > m")
def stale_outputs(spark, sf_dir):
    """Orders are inputs, shipped lines outputs; dates are their times."""
    i = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("mtime"))
    o = table(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("k"), F.col("l_shipdate").alias("mtime"))
    return p.stale(i, o, ["k"])


@register("coverage_filter", "with c as (select distinct user_id % 20 as unit, event_id % 10 as chapter from events where user_id % 20 < 15 and event_type = 'view'), w as (select distinct user_id % 20 as unit, event_id % 10 as chapter from events) select w.unit, w.chapter from w where w.unit not in (select unit from c) or exists (select 1 from c where c.unit = w.unit and c.chapter = w.chapter)")
def coverage_filter(spark, sf_dir):
    """Chapters that coverage knows, and all chapters of units whose coverage is unknown."""
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 20).alias("unit"), (F.col("event_id") % 10).alias("chapter"), "event_type")
    return p.keep_unless_known(e.select("unit", "chapter").distinct(), e.where("unit < 15 and event_type = 'view'").select("unit", "chapter"), "unit", ["chapter"])


@register("lpt_shards")
def lpt_shards(spark, sf_dir):
    """Languages of each region in three balanced shards, largest first."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "customer"), F.col("n_nationkey") == F.col("c_nationkey"))
    sizes = n.groupBy(F.col("n_regionkey").alias("region"), F.col("n_nationkey").alias("item")).agg(F.count("*").alias("size"))
    return p.balanced_shards(sizes, ["region"], "size", "item", 3)


@register("chunk_overlap", "with c as (select vec_id, len(embedding) as n from embeddings) select vec_id, n, cast(greatest(1, ceil((n - 4) / 12.0)) as bigint) as n_chunks, true as whole from c")
def chunk_overlap(spark, sf_dir):
    """Chunks of 16 with an overlap of 4, and whether stitching gives the array back."""
    e = table(spark, sf_dir, "embeddings").withColumn("chunks", p.overlapping_chunks("embedding", 16, 4))
    return e.select("vec_id", F.size("embedding").cast("bigint").alias("n"), F.size("chunks").cast("bigint").alias("n_chunks"), (p.stitched("chunks", 4) == F.col("embedding")).alias("whole"))


@register("priority_lookup", "select iso, arg_min(raw_id, (drama, stream, l_orderkey, l_linenumber)) as raw_id from (" + "select l_partkey as iso, concat(l_orderkey, '-', l_linenumber) as raw_id, cast(l_returnflag = 'R' as int) as drama, cast(l_linestatus = 'O' as int) as stream, l_orderkey, l_linenumber from lineitem) group by iso")
def priority_lookup(spark, sf_dir):
    """Text-file lookup: the first candidate by category priority, as one aggregate."""
    return p.first_by_priority(v.filesets(spark, sf_dir), ["iso"], "raw_id", ["drama", "stream", "l_orderkey", "l_linenumber"])


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("null" if x is None else f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


@register("canon_books", f"select canon, count(*) as n_books, cast(sum(n) as bigint) as n_chapters, string_agg(book, ',' order by book) as books from (values {_values((b, c, n) for c, d in (('OT', ref.OT), ('NT', ref.NT)) for b, n in d.items())}) t(book, canon, n) group by canon")
def canon_books(spark, sf_dir):
    """Books and expected chapters of each canon."""
    return ref.books(spark).groupBy("canon").agg(F.count("*").alias("n_books"), F.sum("n_chapters").alias("n_chapters"), F.array_join(F.array_sort(F.collect_list("book")), ",").alias("books"))


@register("recogniser_lookup", f"select e.event_id, l.asr from (select event_id, case event_id % 4 when 0 then 'deu' when 1 then 'fra' when 2 then 'yue' else 'ibo' end as iso from events) e left join (values {_values(ref.RECOGNISER.items())}) l(iso, asr) on e.iso = l.iso")
def recogniser_lookup(spark, sf_dir):
    """Recogniser's code of a language; null for unknown ones and for those that ask for detection."""
    n = F.col("event_id") % 4
    e = table(spark, sf_dir, "events").select("event_id", F.when(n == 0, "deu").when(n == 1, "fra").when(n == 2, "yue").otherwise("ibo").alias("iso"))
    return e.join(F.broadcast(ref.recogniser_languages(spark)), "iso", "left").select("event_id", F.col("asr_lang").alias("asr"))

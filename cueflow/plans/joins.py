"""Queries of joins, set operations and merges between inventories."""

from __future__ import annotations

from pyspark.sql import functions as F

from cueflow.operators import discovery as d
from cueflow.operators import reporting as r
from cueflow.plans import views as v
from cueflow.plans.registry import register
from cueflow.sources.tables import table


def _sides(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("book"), F.floor("value").cast("bigint").alias("chapter"), "event_type")
    return e.where("event_type = 'click'").select("book", "chapter"), e.where("event_type = 'view'").select("book", "chapter")


SIDES = "a as (select user_id as book, cast(floor(value) as bigint) as chapter from events where event_type = 'click'), b as (select user_id as book, cast(floor(value) as bigint) as chapter from events where event_type = 'view')"


@register("set_intersection", f"with {SIDES} select * from a intersect select * from b")
def set_intersection(spark, sf_dir):
    a, b = _sides(spark, sf_dir)
    return a.intersect(b)


@register("set_difference", f"with {SIDES} select * from a except select * from b")
def set_difference(spark, sf_dir):
    a, b = _sides(spark, sf_dir)
    return a.subtract(b)


@register("set_union", f"with {SIDES} select book, count(*) as n_chapters from (select * from a union select * from b) group by book")
def set_union(spark, sf_dir):
    """Chapters of each book from both sides, merged as sets."""
    a, b = _sides(spark, sf_dir)
    return a.unionByName(b).distinct().groupBy("book").agg(F.count("*").alias("n_chapters"))


@register("subset_test", f"with {SIDES}, u as (select book, chapter, 'a' as src from a union select book, chapter, 'b' from b) select book, chapter, bool_and(src = 'a') as only_a from u group by all")
def subset_test(spark, sf_dir):
    """Whether all sources of a chapter are the first one."""
    a, b = _sides(spark, sf_dir)
    u = a.withColumn("src", F.lit("a")).unionByName(b.withColumn("src", F.lit("b")))
    return u.groupBy("book", "chapter").agg(F.collect_set("src").alias("s")).select("book", "chapter", F.forall("s", lambda x: x == "a").alias("only_a"))


@register("full_coverage", "with d as (select user_id as book, cast(floor(value) as bigint) % 6 + 1 as ch from events) select book, count(distinct ch) = 6 and min(ch) = 1 and max(ch) = 6 as complete from d group by book")
def full_coverage(spark, sf_dir):
    d = table(spark, sf_dir, "events").select(F.col("user_id").alias("book"), (F.floor("value").cast("bigint") % 6 + 1).alias("ch"))
    return d.groupBy("book").agg(((F.countDistinct("ch") == 6) & (F.min("ch") == 1) & (F.max("ch") == 6)).alias("complete"))


@register("audio_text_pairs", "with t as (select l_orderkey as chapter, concat(l_suppkey % 9, case when l_linestatus = 'F' then '_ET' else '_NT' end) as text from lineitem) select o_orderkey as chapter, arg_min(text, (case when text like '%\\_ET' escape '\\' then 0 else 1 end, text)) as text from orders join t on chapter = o_orderkey group by all")
def audio_text_pairs(spark, sf_dir):
    """Each chapter with audio, and its first text: _ET before others, then by name."""
    t = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("chapter"), F.concat((F.col("l_suppkey") % 9).cast("string"), F.when(F.col("l_linestatus") == "F", "_ET").otherwise("_NT")).alias("text"))
    a = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("chapter"))
    first = t.groupBy("chapter").agg(F.min_by("text", F.struct(F.when(F.col("text").endswith("_ET"), 0).otherwise(1), F.col("text"))).alias("text"))
    return a.join(first, "chapter")


@register("quality_with_timing", "with q as (select l_orderkey as k, count(*) as words from lineitem group by all), t as (select o_orderkey as k, o_custkey from orders where o_orderstatus = 'F'), d as (select c_custkey, c_nationkey from customer where c_acctbal > 0) select q.k, words, t.o_custkey is not null as has_timing, d.c_nationkey from q left join t on q.k = t.k left join d on t.o_custkey = d.c_custkey")
def quality_with_timing(spark, sf_dir):
    """Quality rows with pipeline timing and downloaded timing where they exist."""
    q = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("words"))
    t = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"), "o_custkey")
    d = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return q.join(t, "k", "left").join(d, "o_custkey", "left").select("k", "words", F.col("o_custkey").isNotNull().alias("has_timing"), "c_nationkey")


@register("job_fanout", "with w as (select o_orderkey as item, o_custkey as key, case when o_orderkey % 5 = 0 then null else o_orderkey % 3 end as did from orders), j as (select distinct c_custkey as key, c_custkey % 3 as did from customer union select c_custkey, (c_custkey + 1) % 3 from customer where c_nationkey < 5) select item, w.key, j.did from w join j on w.key = j.key and (w.did is null or w.did = j.did)")
def job_fanout(spark, sf_dir):
    """Work items meet the jobs of their key; items without an id fan out to all of them."""
    w = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item"), F.col("o_custkey").alias("key"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey") % 3).alias("wanted"))
    c = table(spark, sf_dir, "customer")
    j = c.select(F.col("c_custkey").alias("key"), (F.col("c_custkey") % 3).alias("did")).union(c.where("c_nationkey < 5").select("c_custkey", (F.col("c_custkey") + 1) % 3)).distinct()
    return r.fanned_out(w, j, ["key"])[0].select("item", "key", "did")


@register("job_fanout_unmet", "with w as (select o_orderkey as item, o_custkey % 700 as key, case when o_orderkey % 5 = 0 then null else o_orderkey % 3 end as did from orders), j as (select distinct c_custkey % 600 as key, c_custkey % 2 as did from customer) select item, w.key, w.did as wanted from w where not exists (select 1 from j where w.key = j.key and (w.did is null or w.did = j.did))")
def job_fanout_unmet(spark, sf_dir):
    """Work that no job of its key takes."""
    o = F.col("o_orderkey")
    w = table(spark, sf_dir, "orders").select(o.alias("item"), (F.col("o_custkey") % 700).alias("key"), F.when(o % 5 != 0, o % 3).alias("wanted"))
    j = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 600).alias("key"), (F.col("c_custkey") % 2).alias("did")).distinct()
    return r.fanned_out(w, j, ["key"])[1].select("item", "key", "wanted")


@register("external_chapters", "select n_nationkey as book, c_custkey as chapter from nation join customer on c_nationkey = n_nationkey and c_custkey <= n_nationkey * 40 + 10")
def external_chapters(spark, sf_dir):
    """Local chapters that an external book list reaches: equal books, chapter not above their number."""
    n, c = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    books = n.select(F.col("n_nationkey").alias("book"), (F.col("n_nationkey") * 40 + 10).alias("n_chapters"))
    return d.external_chapters(books, c.select(F.col("c_nationkey").alias("book"), F.col("c_custkey").alias("chapter")))


@register("word_quality_join", f"with {v.WORDS}, {v.TIMELINE.strip()} select w.chapter, w.widx, w.word, coalesce(t.source, '?') as source, coalesce(t.pct, -1) as pct from v_words w left join v_timeline t on w.chapter = t.chapter and w.widx = t.widx")
def word_quality_join(spark, sf_dir):
    """Reference words with quality by position, ? where there is none."""
    w, t = v.words(spark, sf_dir).select("chapter", "widx", "word"), v.timeline(spark, sf_dir).select("chapter", "widx", "source", "pct")
    j = w.join(t, ["chapter", "widx"], "left")
    return j.select("chapter", "widx", "word", F.coalesce("source", F.lit("?")).alias("source"), F.coalesce("pct", F.lit(-1)).alias("pct"))


@register("text_source", "with d as (select distinct source from documents), l as (select distinct source from documents join labels using (doc_id) where toxic = 1) select d.source, case when l.source is not null then 'index' when right(d.source, 1) in ('1', '3') then 'overlap' else 'default' end as chosen from d left join l on d.source = l.source")
def text_source(spark, sf_dir):
    """Preferred text source: index membership, then an overlap rule, then the default."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    index = docs.join(table(spark, sf_dir, "labels").where("toxic = 1"), "doc_id").select("source").distinct().withColumn("hit", F.lit(True))
    out = docs.select("source").distinct().join(index, "source", "left")
    return out.select("source", F.when(F.col("hit"), "index").when(F.substring("source", -1, 1).isin("1", "3"), "overlap").otherwise("default").alias("chosen"))

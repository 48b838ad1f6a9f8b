"""Queries of work discovery over an inventory made from orders and their lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from cueflow.operators import discovery as d
from cueflow.plans.registry import register
from cueflow.sources.tables import table

FILES_SQL = """files as (
  select case when l_orderkey % 2 = 0 then 'nt' else 'ot' end as canon, concat('i', l_suppkey % 40) as iso, concat('D', l_orderkey % 50) as distinct_id,
    concat('B', l_orderkey % 13) as book, cast(l_orderkey % 997 as int) as chapter,
    case l_linenumber % 4 when 0 then 'X2DA' when 1 then 'Y1DA' when 2 then 'T_ET' else 'T_NT' end as fileset,
    case when l_linenumber % 4 < 2 then 'audio' else 'text' end as kind, concat('/p/', l_orderkey, '/', l_linenumber) as path,
    case when l_returnflag = 'R' then 'contrib' when l_returnflag = 'A' then 'helloao' else 'BB' end as root
  from lineitem)"""
DONE_SQL = "done as (select distinct canon, iso, distinct_id, book, chapter, fileset as audio_fileset from files where kind = 'audio' and chapter % 3 = 0)"
KEY = "canon, iso, distinct_id, book, chapter"


def inventory(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    k, n = F.col("l_orderkey"), F.col("l_linenumber") % 4
    c = lambda head, x: F.concat(F.lit(head), x.cast("string"))
    return li.select(
        F.when(k % 2 == 0, "nt").otherwise("ot").alias("canon"), c("i", F.col("l_suppkey") % 40).alias("iso"), c("D", k % 50).alias("distinct_id"), c("B", k % 13).alias("book"), (k % 997).cast("int").alias("chapter"),
        F.when(n == 0, "X2DA").when(n == 1, "Y1DA").when(n == 2, "T_ET").otherwise("T_NT").alias("fileset"), F.when(n < 2, "audio").otherwise("text").alias("kind"),
        F.concat(c("/p/", k), c("/", F.col("l_linenumber"))).alias("path"), F.when(F.col("l_returnflag") == "R", "contrib").when(F.col("l_returnflag") == "A", "helloao").otherwise("BB").alias("root"),
    )


def _done(files):
    return files.where("kind = 'audio' and chapter % 3 = 0").select(*d.CHAPTER, F.col("fileset").alias("audio_fileset")).distinct()


TEXTS = f"t as (select {KEY}, arg_min(fileset, (case when fileset like '%\\_ET' escape '\\' then 0 else 1 end, fileset)) as text_fileset from files where kind = 'text' group by all)"
AUDIO = f"a as (select distinct {KEY}, fileset as audio_fileset from (select *, max(cast(fileset not like '%2DA%' as int)) over (partition by {KEY}) as has from files where kind = 'audio') where cast(fileset not like '%2DA%' as int) = has)"


@register("work_discovery", f"with {FILES_SQL}, {DONE_SQL}, {TEXTS}, {AUDIO} select {KEY}, audio_fileset, text_fileset from a join t using ({KEY}) anti join done using ({KEY}, audio_fileset)")
def work_discovery(spark, sf_dir):
    """Chapters to align: audio with text, standard before drama, not done."""
    files = inventory(spark, sf_dir)
    return d.alignable(files, _done(files)).select(*d.CHAPTER, "audio_fileset", "text_fileset").distinct()


@register("work_skipped", f"with {FILES_SQL}, {DONE_SQL}, {TEXTS}, {AUDIO} select iso, count(*) as skipped from a join t using ({KEY}) join done using ({KEY}, audio_fileset) group by iso")
def work_skipped(spark, sf_dir):
    """Chapters that are done already, by language."""
    files = inventory(spark, sf_dir)
    files = files.groupBy(*d.CHAPTER, "fileset", "kind").agg(F.min("path").alias("path"))
    return d.skipped(files, _done(files))


@register("text_lookup", f"with {FILES_SQL}, {TEXTS} select * from t")
def text_lookup(spark, sf_dir):
    return d.first_texts(inventory(spark, sf_dir)).drop("text_path")


@register("base_dirs", f"with {FILES_SQL} select canon, iso, distinct_id, arg_min(root, list_position(['BB', 'contrib', 'helloao'], root)) as root from files group by all")
def base_dirs(spark, sf_dir):
    return d.base_dirs(inventory(spark, sf_dir), ["BB", "contrib", "helloao"])


@register("languages_both", f"with {FILES_SQL} select iso from files where kind = 'audio' and book = 'B3' intersect select iso from files where kind = 'text' and book = 'B3'")
def languages_both(spark, sf_dir):
    return d.languages_with(inventory(spark, sf_dir).where("book = 'B3'"), "audio", "text")


@register("fusion_strategy", f"with {FILES_SQL}, g as (select {KEY}, bool_or(kind = 'text') as has_text, bool_or(fileset = 'X2DA') as has_ctc, bool_or(fileset = 'Y1DA') as has_asr from files group by all) select {KEY}, case when not has_text then 'error' when has_ctc and has_asr then 'both' when has_ctc then 'ctc' when has_asr then 'asr' else 'error' end as strategy from g")
def fusion_strategy(spark, sf_dir):
    has = lambda c: F.max(c.cast("int")).cast("boolean")
    g = inventory(spark, sf_dir).groupBy(*d.CHAPTER).agg(has(F.col("kind") == "text").alias("has_text"), has(F.col("fileset") == "X2DA").alias("has_ctc"), has(F.col("fileset") == "Y1DA").alias("has_asr"))
    return g.select(*d.CHAPTER, d.strategy("has_text", "has_ctc", "has_asr").alias("strategy"))


@register("fusable_chapters", f"with {FILES_SQL}, k as (select {KEY}, case when book < 'B5' then 'all' else 'one' end as audio_fileset, fileset from files where kind = 'audio'), g as (select {KEY}, audio_fileset, bool_or(fileset = 'Y1DA') as has_asr, bool_or(fileset = 'X2DA') as has_ctc from k group by all) select * from g where chapter % 3 <> 0")
def fusable_chapters(spark, sf_dir):
    kind = F.when(F.col("fileset") == "Y1DA", "asr").otherwise("ctc")
    files = inventory(spark, sf_dir).where("kind = 'audio'").withColumn("kind", kind).withColumn("fileset", F.when(F.col("book") < "B5", "all").otherwise("one"))
    done = files.where("chapter % 3 = 0").select(*d.CHAPTER, F.col("fileset").alias("audio_fileset")).distinct()
    return d.fusable(files, done)


@register("source_types", f"with {FILES_SQL} select canon, iso, distinct_id, case when bool_or(root = 'contrib') then 'contrib' when bool_or(root = 'helloao') then 'helloao' else 'dbt' end as source from files group by all")
def source_types(spark, sf_dir):
    has = lambda r: F.max((F.col("root") == r).cast("int")).cast("boolean")
    g = inventory(spark, sf_dir).groupBy("canon", "iso", "distinct_id").agg(has("contrib").alias("c"), has("helloao").alias("h"))
    return g.select("canon", "iso", "distinct_id", d.source_type("c", "h").alias("source"))


@register("usable_text", f"with {FILES_SQL}, w as (select distinct iso, canon from files), c as (select distinct iso, canon from files where kind = 'text' and book = 'B1') select * from w semi join c using (iso, canon)")
def usable_text(spark, sf_dir):
    files = inventory(spark, sf_dir)
    return d.usable_text(files.select("iso", "canon").distinct(), files.where("kind = 'text' and book = 'B1'").select("iso", "canon"), ["iso", "canon"])


@register("usable_text_open", f"with {FILES_SQL} select distinct iso, canon from files")
def usable_text_open(spark, sf_dir):
    """An empty catalogue filters nothing."""
    files = inventory(spark, sf_dir)
    return d.usable_text(files.select("iso", "canon").distinct(), files.where("book = 'none'").select("iso", "canon"), ["iso", "canon"])


@register("version_ids", "with i as (select distinct concat('b', p_size % 5) as iso, concat(case when p_size % 2 = 0 then 'B' else 'b' end, p_size % 7, 'V', p_size % 11) as id from part), v as (select version, min(ordinal) as ordinal from (select concat('v', p_size % 11) as version, p_size % 11 as ordinal from part where p_size % 11 < 6 union all select concat(p_size % 7, 'V', p_size % 11), 20 - p_size % 7 from part where p_size % 11 < 3) group by version), j as (select iso, id, case when starts_with(upper(id), upper(iso)) and length(id) > length(iso) then substr(id, length(iso) + 1) end as bare, version, ordinal from i left join v on ends_with(upper(id), upper(version))) select iso, id, coalesce(any_value(bare), arg_min(version, (ordinal, version)), id) as version from j group by iso, id")
def version_ids(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("s", F.col("p_size"))
    c = lambda head, x: F.concat(F.lit(head), x.cast("string"))
    ids = p.select(c("b", F.col("s") % 5).alias("iso"), F.concat(F.when(F.col("s") % 2 == 0, "B").otherwise("b"), (F.col("s") % 7).cast("string"), c("V", F.col("s") % 11)).alias("id")).distinct()
    v = p.where("s % 11 < 6").select(c("v", F.col("s") % 11).alias("version"), (F.col("s") % 11).alias("ordinal"))
    v = v.union(p.where("s % 11 < 3").select(F.concat(c("", F.col("s") % 7), c("V", F.col("s") % 11)), 20 - F.col("s") % 7)).groupBy("version").agg(F.min("ordinal").alias("ordinal"))
    return d.version_ids(ids, v)


@register("audio_urls", "select o_orderkey, concat('http://x/', code, case when length(ch) >= w then ch else lpad(ch, cast(w as int), '0') end, '-', o_orderstatus, '_Kapitel-', case when length(ch) >= 3 then ch else lpad(ch, 3, '0') end, '.mp3') as url from (select o_orderkey, o_orderstatus, concat('B', o_custkey % 166) as code, cast(o_orderkey % 1500 as varchar) as ch, greatest(2, 5 - length(concat('B', o_custkey % 166))) as w from orders)")
def audio_urls(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.lit("http://x/").alias("base"), F.concat(F.lit("B"), (F.col("o_custkey") % 166).cast("string")).alias("code"), F.col("o_orderstatus").alias("title"), (F.col("o_orderkey") % 1500).alias("chapter"))
    return o.select("o_orderkey", d.audio_url("base", "code", "title", "chapter").alias("url"))


@register("work_items", f"with {FILES_SQL}, w as (select distinct {KEY}, fileset as audio_fileset from files where kind = 'audio') select {KEY}, audio_fileset, concat_ws('/', '/out', canon, iso, distinct_id, book, concat(book, '_', lpad(cast(chapter as varchar), 3, '0'), '_', audio_fileset, '_timing.json')) as timing_path from w")
def work_items(spark, sf_dir):
    w = inventory(spark, sf_dir).where("kind = 'audio'").select(*d.CHAPTER, F.col("fileset").alias("audio_fileset")).distinct()
    return d.work_items(w, "/out").select(*d.CHAPTER, "audio_fileset", "timing_path")


@register("batch_restriction", f"with {FILES_SQL}, w as (select distinct iso, case when distinct_id < 'D2' then null else distinct_id end as distinct_id from files) select * from w where distinct_id is null or distinct_id in ('D3', 'D30', 'D45')")
def batch_restriction(spark, sf_dir):
    w = inventory(spark, sf_dir).select("iso", F.when(F.col("distinct_id") >= "D2", F.col("distinct_id")).alias("distinct_id")).distinct()
    jobs = spark.createDataFrame([("D3",), ("D30",), ("D45",), ("D3",)], "distinct_id string")
    return d.restricted(w, jobs)


@register("contributed_pairs", f"with {FILES_SQL}, t as (select {KEY}, arg_min(path, (fileset, path)) as text_path from files where kind = 'text' group by all) select a.canon, a.iso, a.distinct_id, a.book, a.chapter, a.path as audio_path, text_path from files a join t on a.canon = t.canon and a.iso = t.iso and a.distinct_id = t.distinct_id and a.book = t.book and a.chapter = t.chapter where a.kind = 'audio'")
def contributed_pairs(spark, sf_dir):
    return d.contributed_pairs(inventory(spark, sf_dir).withColumn("pattern", F.col("fileset")))

"""Queries of reports and of the choice of sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from cueflow.operators import discovery as d
from cueflow.operators import planning as pl
from cueflow.operators import reporting as r
from cueflow.operators import sequence as seq
from cueflow.operators import timing as t
from cueflow.plans import views as v
from cueflow.plans.discovery import FILES_SQL, inventory
from cueflow.plans.registry import register
from cueflow.sources import edge
from cueflow.sources.tables import table


def _words(spark, sf_dir):
    """The timeline in verses of ten words, with the language of a chapter."""
    return v.timeline(spark, sf_dir).select((F.col("chapter") % 7).alias("iso"), "chapter", F.expr("widx div 10").alias("verse"), "widx", F.col("null_us").alias("start"))


GAPS = f"{v.TIMELINE}, g as (select chapter, widx // 10 as verse, widx, null_us as start, lead(null_us) over (partition by chapter, widx // 10 order by widx) - null_us as gap from v_timeline), f as (select *, row_number() over (partition by chapter, verse order by widx) as k from g where gap > 3000000), w as (select *, row_number() over (partition by chapter order by gap desc, verse) as place from f where k = 1), worst as (select chapter % 7 as iso, chapter, verse, widx, start, gap from w where place = 1)"


@register("gap_report", f"with {GAPS} select * from worst order by iso, chapter")
def gap_report(spark, sf_dir):
    """The worst gap of each chapter, in the report's order."""
    return r.gap_report(r.worst_gaps(_words(spark, sf_dir), ["iso", "chapter"], "verse", "widx", "start", 3_000_000), ["iso", "chapter"])


@register("gap_totals", f"with {GAPS} select count(*) as n_chapters, count(distinct iso) as n_languages from worst")
def gap_totals(spark, sf_dir):
    """Chapters with gaps and their languages."""
    return r.gap_totals(gap_report(spark, sf_dir))


@register("gap_repair_selection", f"with {GAPS} select chapter, gap, case when chapter not in (select c_custkey from customer where c_acctbal > 0) then 'audio' when chapter not in (select o_custkey from orders) then 'forced alignment' end as lacks from worst")
def gap_repair_selection(spark, sf_dir):
    """Chapters with gaps: what each lacks to be repaired, null for nothing."""
    audio = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("chapter"))
    forced = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("chapter"))
    able, not_able = r.repairable(gap_report(spark, sf_dir), audio, forced, ["chapter"])
    return able.select("chapter", "gap", F.lit(None).cast("string").alias("lacks")).unionByName(not_able.select("chapter", "gap", "lacks"))


@register("gap_repaired", f"with {GAPS}, n as (select chapter, gap // 2 as new_gap from worst where chapter % 3 = 0 union all select chapter, gap from worst where chapter % 3 = 1) select worst.chapter, gap, new_gap, coalesce(new_gap < gap, true) as fixed from worst left join n on worst.chapter = n.chapter")
def gap_repaired(spark, sf_dir):
    """Gaps before and after a repair: some halved, some as before, some gone."""
    w = gap_report(spark, sf_dir).select("chapter", "gap")
    after = w.where("chapter % 3 = 0").select("chapter", F.expr("gap div 2").alias("gap")).unionByName(w.where("chapter % 3 = 1"))
    return r.repaired(w, after, ["chapter"])


@register("run_summary", "with e as (select user_id % 9 as iso, case event_type when 'error' then 'failed' when 'view' then 'skipped' else 'done' end as status, cast(floor(value) as bigint) * 40 as audio_s, cast(floor(value) as bigint) + 1 as spent_s from events) select count(distinct iso) as languages, count(*) filter (where status = 'done') as processed, count(*) filter (where status = 'skipped') as skipped, count(*) filter (where status = 'failed') as failed, cast(sum(audio_s) as bigint) as audio_s, cast(sum(spent_s) as bigint) as spent_s, round(sum(audio_s) * 1.0 / sum(spent_s), 1) as realtime from e")
def run_summary(spark, sf_dir):
    """Totals of a run, with seconds of audio for each second spent."""
    kind = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "skipped").otherwise("done")
    s = F.floor("value").cast("bigint")
    return r.run_summary(table(spark, sf_dir, "events").select((F.col("user_id") % 9).alias("iso"), kind.alias("status"), (s * 40).alias("audio_s"), (s + 1).alias("spent_s")))


@register("download_report", "select count(*) filter (where o_orderstatus = 'F') as present, count(*) filter (where o_orderstatus = 'O') as downloaded, count(*) filter (where o_orderstatus not in ('F', 'O')) as failed, count(*) filter (where o_orderstatus in ('F', 'O')) as total from orders")
def download_report(spark, sf_dir):
    """Files that were there, came and failed."""
    kind = F.when(F.col("o_orderstatus") == "F", "present").when(F.col("o_orderstatus") == "O", "downloaded").otherwise("failed")
    return r.download_report(table(spark, sf_dir, "orders").select(kind.alias("status")))


@register("memory_needed", "select p_partkey, cast(case p_size % 6 when 0 then 500 when 1 then 1100 when 2 then 2600 when 3 then 1600 else 3500 end as bigint) * 1048576 as bytes from part")
def memory_needed(spark, sf_dir):
    """Graphics memory by the last part of a model's name."""
    names = F.array(*(F.lit(n) for n in ("tiny", "org/Small", "medium", "x/distil-large-v3", "large-v2", "unknown")))
    return table(spark, sf_dir, "part").select("p_partkey", F.element_at(names, F.col("p_size").cast("int") % 6 + 1).alias("model")).select("p_partkey", r.memory_needed("model").alias("bytes"))


EQUIV = "e as (select distinct iso, canon, distinct_id, concat('X', substring(distinct_id, 2)) as external_id from files where right(distinct_id, 1) in ('1', '2', '3', '4', '5'))"


def _equivalent(spark, sf_dir):
    f = inventory(spark, sf_dir).where(F.expr("right(distinct_id, 1) in ('1', '2', '3', '4', '5')"))
    return f.select("iso", "canon", "distinct_id", F.concat(F.lit("X"), F.expr("substring(distinct_id, 2)")).alias("external_id")).distinct()


@register("cross_source", f"with {FILES_SQL}, {EQUIV}, t as (select distinct canon, iso, distinct_id from files where kind = 'text' and book < 'B'), a as (select distinct canon, iso, distinct_id, book from files where kind = 'audio' and distinct_id = upper(distinct_id) and distinct_id not like '%\\_%' escape '\\'), b as (select a.canon, a.iso, a.distinct_id, string_agg(book, ',' order by book) as books from a anti join t on a.canon = t.canon and a.iso = t.iso and a.distinct_id = t.distinct_id group by all) select b.canon, b.iso, b.distinct_id, books, external_id from b join e on b.canon = e.canon and b.iso = e.iso and b.distinct_id = e.distinct_id")
def cross_source(spark, sf_dir):
    """Versions with audio only and a verified external text, with their books."""
    f = inventory(spark, sf_dir)
    some = f.where("kind <> 'text' or book < 'B'")
    return d.cross_source(some, _equivalent(spark, sf_dir)).withColumn("books", F.array_join("books", ","))


@register("preferred_texts", f"with {FILES_SQL}, {EQUIV}, w as (select distinct iso, canon, distinct_id from files), i as (select distinct iso, canon from files where length(iso) % 2 = 0) select w.iso, w.canon, w.distinct_id, case when i.iso is not null and external_id is not null then 'external' else 'default' end as chosen, case when i.iso is not null then external_id end as source_id from w left join i on w.iso = i.iso and w.canon = i.canon left join e on w.iso = e.iso and w.canon = e.canon and w.distinct_id = e.distinct_id")
def preferred_texts(spark, sf_dir):
    """Index first, then a verified match, else the default."""
    f = inventory(spark, sf_dir)
    index = f.where("length(iso) % 2 = 0").select("iso", "canon", F.lit("external").alias("source")).distinct().unionByName(f.select("iso", "canon", F.lit("default").alias("source")).distinct())
    return d.preferred_texts(f.select("iso", "canon", "distinct_id").distinct(), index, _equivalent(spark, sf_dir))


@register("external_texts", "with v as (select n_name as version, concat('i', n_regionkey) as iso, n_nationkey as k, c as canon, case when c = 'nt' and n_nationkey % 5 = 0 then 'at' else 'a' end as dbt, case when n_nationkey % 2 = 0 then 't' end as hel, case when n_nationkey % 3 < 2 then 't' end as eb, case when n_nationkey % 3 = 0 then concat('e', n_nationkey) end as own from (select *, unnest(['nt', 'ot']) as c from nation)), l as (select concat('i', n_regionkey) as iso, arg_min(concat('x', n_nationkey), n_name) as lang_id from nation where n_regionkey > 1 group by 1), s as (select v.version, v.iso, canon, case when hel = 't' and k % 4 = 0 and canon = 'ot' then 'external' when eb = 't' and coalesce(own, lang_id) is not null then 'archive' end as source, case when hel = 't' and k % 4 = 0 and canon = 'ot' then concat('h', k) when eb = 't' then coalesce(own, lang_id) end as source_id from v left join l on v.iso = l.iso where dbt not like '%t%'), f as (select version, iso, arg_min(source, canon) as source, arg_min(source_id, canon) as source_id from s where source is not null group by all) select n.iso, n.version, source, source_id from (select distinct iso, version from v) n left join f on n.iso = f.iso and n.version = f.version")
def external_texts(spark, sf_dir):
    """Texts of versions that the service only has as audio: verified match, then the archive by its own id or a cross reference."""
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("version"), F.concat(F.lit("i"), "n_regionkey").alias("iso"), F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("r"))
    when = lambda c, value: F.when(F.expr(c), value)
    versions = n.select("*", F.explode(F.array(F.lit("nt"), F.lit("ot"))).alias("canon")).select(
        "iso", "version", "canon", F.when(F.expr("canon = 'nt' and k % 5 = 0"), "at").otherwise("a").alias("dbt"), when("k % 2 = 0", F.lit("t")).alias("helloao"),
        when("k % 3 < 2", F.lit("t")).alias("ebible"), when("k % 3 = 0", F.concat(F.lit("e"), "k")).alias("ebible_id"),
    )
    cross = n.where("r > 1").select("iso", "version", F.concat(F.lit("x"), "k").alias("ebible"))
    match = n.where("k % 4 = 0").select("iso", "version", F.lit("ot").alias("canon"), F.concat(F.lit("h"), "k").alias("external_id"))
    return d.external_texts(n.select("iso", "version"), versions, cross, match)


@register("remote_sources", "select concat('v', c_custkey) as version_dir, concat('D', c_custkey % 40) as distinct_id, case when c_nationkey < 5 then 'site' when c_custkey % 2 = 0 and n_nationkey is not null then 'reader' else 'local' end as kind, case when c_nationkey >= 5 and c_custkey % 2 = 0 and n_nationkey is not null then concat('t', n_regionkey) end as translation, case when c_nationkey >= 5 and c_custkey % 2 = 0 then n_name end as reader from customer left join nation on c_custkey % 40 = n_nationkey")
def remote_sources(spark, sf_dir):
    """Where the audio of versions is read from."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    name = F.concat(F.lit("v"), "c_custkey").alias("version_dir")
    dirs = c.select(name, F.concat(F.lit("D"), F.col("c_custkey") % 40).alias("distinct_id"), (F.col("c_custkey") % 2 == 0).alias("external"))
    known = n.select(F.concat(F.lit("t"), "n_regionkey").alias("translation"), F.col("n_name").alias("reader"), F.concat(F.lit("D"), "n_nationkey").alias("distinct_id"))
    return d.remote_sources(dirs, c.where("c_nationkey < 5").select(name, F.lit("site").alias("type")), known)


@register("external_contributions", "with t as (select p_partkey as chapter, concat('B', p_size % 9) as book from part), c as (select distinct p_partkey as chapter, concat('B', p_size % 9) as book from part where p_size % 2 = 0) select t.book, t.chapter, concat('/t/', t.chapter) as text_path, case when c.chapter is not null then concat('/c/', t.chapter) end as times_path from t left join c on t.book = c.book and t.chapter = c.chapter where t.book < 'B6'")
def external_contributions(spark, sf_dir):
    """Contributed texts of the books in the metadata, with stamps where there are any."""
    p = table(spark, sf_dir, "part").withColumn("book", F.concat(F.lit("B"), F.col("p_size") % 9))
    named = lambda df, folder: df.select(F.concat("book", F.lit("_"), "p_partkey").alias("name"), F.concat(F.lit(folder), "p_partkey").alias("path"))
    texts = named(p, "/t/").unionByName(p.select(F.concat("book", F.lit("_x")).alias("name"), F.lit("/no").alias("path"))).unionByName(p.select("book", F.lit("/no").alias("path")).toDF("name", "path"))
    return d.external_contributions(texts, named(p.where("p_size % 2 = 0"), "/c/"), p.where("book < 'B6'").select("book"))


@register("coverage_gaps_partial", "select doc_id, source, c.conv_id is not null as has_partial from documents anti join labels using (doc_id) left join (select distinct conv_id from conversations) c on doc_id = c.conv_id")
def coverage_gaps_partial(spark, sf_dir):
    """Covered documents without label, and whether a conversation of the number exists."""
    partial = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"))
    return t.gaps_with_partial(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels").select("doc_id"), partial, ["doc_id"])


@register("overview_filtered", "select source, lang, count(*) filter (where toxic = 1) as low from documents join labels using (doc_id) where upper(lang) = 'EN' group by all having count(*) filter (where toxic = 1) >= 1")
def overview_filtered(spark, sf_dir):
    """Overview rows of one file set with low words."""
    q = table(spark, sf_dir, "documents").select("doc_id", "source", "lang").join(table(spark, sf_dir, "labels"), "doc_id")
    return t.overview_filtered(q.groupBy("source", "lang").agg(F.count_if(F.col("toxic") == 1).alias("low")), "low", 1, "En", "lang")


@register("interpolated_starts", f"with {v.VERSES}, e as (select user_id as chapter, max(cast(floor(value) as bigint)) as last from events group by 1), p as (select chapter, verse, n_words, cast(sum(n_words) over (partition by chapter order by verse) - n_words as bigint) as prior, cast(sum(n_words) over (partition by chapter) as bigint) as total from v_verses) select p.chapter, verse, case when total > 0 then (2 * coalesce(last, 0) * prior + total) // (2 * total) else 0 end as start from p left join e on p.chapter = e.chapter")
def interpolated_starts(spark, sf_dir):
    """Verse starts in proportion to words, up to the last segment's end."""
    ends = table(spark, sf_dir, "events").select(F.col("user_id").alias("chapter"), F.floor("value").cast("bigint").alias("end"))
    return seq.interpolated(v.verses(spark, sf_dir), ["chapter"], ["verse"], "n_words", ends).select("chapter", "verse", "start")


@register("stitched_frames", "with c as (select p_partkey, p_size * 100 as total, unnest(generate_series(0, cast(greatest(1, ceil((p_size * 100 - 200) / 800.0)) as bigint) - 1)) as k from part), d as (select p_partkey, k, least(k * 800 + 1000, total) - k * 800 as samples from c) select p_partkey, cast(sum(samples // 20 - case when k = 0 then 0 else cast(floor((samples // 20) * least(200, samples) / samples) as bigint) end) as bigint) as n_frames, count(*) as n_chunks from d group by p_partkey")
def stitched_frames(spark, sf_dir):
    """Frames of chunked samples, of which later chunks lose their overlap's share."""
    c = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 100).alias("total")).withColumn("chunks", pl.sample_chunks("total", 1000, 200))
    made = F.transform("chunks", lambda x: F.struct(x.k.alias("k"), x.samples.alias("samples"), F.array_repeat(F.lit(0), (x.samples / 20).cast("int")).alias("frames")))
    c = c.withColumn("framed", made)
    return c.select("p_partkey", F.size(pl.stitched_frames("framed", 200)).cast("bigint").alias("n_frames"), F.size("chunks").cast("bigint").alias("n_chunks"))


@register("resampled_vectors", "with x as (select vec_id, list_transform(embedding, lambda v: cast(v as double)) as x, len(embedding) * 2 // 3 as n from embeddings) select vec_id, n, cast(round(list_sum(list_transform(generate_series(0, n - 1), lambda i: x[(3 * i) // 2 + 1] + (x[least((3 * i) // 2 + 2, len(x))] - x[(3 * i) // 2 + 1]) * (i * 1.5 - (3 * i) // 2))) * 1000) as bigint) as total from x")
def resampled_vectors(spark, sf_dir):
    """Vectors at two thirds of their rate: length and sum in thousandths."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", edge.resampled("embedding", 3, 2).alias("r"))
    return e.select("vec_id", F.size("r").cast("bigint").alias("n"), F.round(F.aggregate("r", F.lit(0.0), lambda s, x: s + x) * 1000).cast("bigint").alias("total"))


@register("valid_tags", f"with {FILES_SQL} select canon, iso, distinct_id, path from files where kind = 'text' and fileset = case when iso < 'i2' then 'T_ET' else 'T_NT' end")
def valid_tags(spark, sf_dir):
    """Texts whose tag their version can have."""
    f = inventory(spark, sf_dir).where("kind = 'text'").withColumn("full", F.col("fileset"))
    expected = f.select("iso", F.when(F.col("iso") < "i2", "ET").otherwise("NT").alias("tag")).distinct()
    named = f.withColumn("fileset", F.split_part("full", F.lit("_"), F.lit(2)))
    return d.with_valid_tags(named, expected, ["iso"], True).select("canon", "iso", "distinct_id", "path")


@register("redo_collapsed", f"with {FILES_SQL}, done as (select distinct canon, iso, distinct_id, book, chapter, fileset as audio_fileset from files where kind = 'audio' and chapter % 3 = 0) select * from done where chapter % 5 <> 0")
def redo_collapsed(spark, sf_dir):
    """Outputs that count as done when collapsed ones are made again."""
    done = inventory(spark, sf_dir).where("kind = 'audio' and chapter % 3 = 0").select(*d.CHAPTER, F.col("fileset").alias("audio_fileset")).distinct()
    return d.redone(done, done.where("chapter % 5 = 0"), [*d.CHAPTER, "audio_fileset"])


@register("verse_access", "select doc_id, case when doc_id % 2 = 0 then 1 else 3 end as verse, string_split(rtrim(text, chr(10)), chr(10))[case when doc_id % 2 = 0 then 1 else 3 end] as text from documents")
def verse_access(spark, sf_dir):
    """The first or third line of each document, null beyond its end."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", r"\n+\z", "").alias("text"))
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text")).select("doc_id", (F.col("pos") + 1).alias("verse"), "text")
    return d.verse_line(lines, docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 1).otherwise(3).alias("verse")), ["doc_id"])


@register("import_plan", "select c_custkey as chapter, concat_ws(',', case when c_nationkey % 2 = 0 and c_custkey % 3 > 0 then 'copy audio' end, case when c_custkey % 5 > 0 then 'copy text' end, case when c_nationkey % 4 = 0 then 'convert times' end) as actions from customer where (c_nationkey % 2 = 0 and c_custkey % 3 > 0) or c_custkey % 5 > 0 or c_nationkey % 4 = 0")
def import_plan(spark, sf_dir):
    """What an import of contributed chapters would do."""
    c = table(spark, sf_dir, "customer").withColumn("chapter", F.col("c_custkey"))
    path = lambda cond, name: F.when(F.expr(cond), F.lit("/p")).alias(name)
    pairs = c.select("chapter", path("c_nationkey % 2 = 0", "audio_path"), path("true", "text_path"), path("c_nationkey % 4 = 0", "times_path"))
    there = c.where("c_custkey % 3 = 0").select("chapter", F.lit("audio").alias("kind")).unionByName(c.where("c_custkey % 5 = 0").select("chapter", F.lit("text").alias("kind")))
    return d.import_plan(pairs, there, ["chapter"]).select("chapter", F.array_join("actions", ",").alias("actions"))

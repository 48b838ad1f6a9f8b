"""Queries of the text functions and of the order-dependent matchers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from cueflow.functions import similarity as sim
from cueflow.functions import text as x
from cueflow.operators import alignment as a
from cueflow.plans import views as v
from cueflow.plans.registry import register
from cueflow.session import ship
from cueflow.sources.tables import table


@register("text_clean", r"select doc_id, trim(regexp_replace(regexp_replace(strip_accents(text), '[^\p{L}\p{N}_\t\n\x0b\f\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]', '', 'g'), '[\t\n\x0b\f\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) as clean from documents")
def text_clean(spark, sf_dir):
    ship(spark)
    return table(spark, sf_dir, "documents").select("doc_id", x.cleaned("text").alias("clean"))


@register("text_tokens", r"select doc_id, len(list_filter(string_split_regex(lower(text), '[\t\n\x0b\f\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda x: x <> '')) as n_tokens from documents")
def text_tokens(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("text"))
    return d.select("doc_id", F.size(x.tokens("text")).cast("bigint").alias("n_tokens"))


@register("markers_stripped", r"select doc_id, trim(regexp_replace(regexp_replace(text, '[#*$%&]+', '', 'g'), '\|', ' ', 'g')) as plain from documents")
def markers_stripped(spark, sf_dir):
    rules = x.LanguageRules(marker_rules=((r"[#*$%&]+", ""), (r"\|", " ")))
    return table(spark, sf_dir, "documents").select("doc_id", x.without_markers(F.col("text"), rules).alias("plain"))


@register("seq_ratio")
def seq_ratio(spark, sf_dir):
    """Ratio of neighbouring benchmark passages."""
    ship(spark)
    b = table(spark, sf_dir, "benchmark")
    pairs = b.join(b.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("other")), "item_id")
    return pairs.select("item_id", sim.sequence_ratio("text", "other").alias("ratio"))


@register("srt_format", f"with {v.TIMELINE} select chapter, widx, concat(lpad(cast(ms // 3600000 as varchar), cast(greatest(2, length(cast(ms // 3600000 as varchar))) as int), '0'), ':', lpad(cast((ms // 60000) % 60 as varchar), 2, '0'), ':', lpad(cast((ms // 1000) % 60 as varchar), 2, '0'), ',', lpad(cast(ms % 1000 as varchar), 3, '0')) as stamp from (select *, start_us // 1000 as ms from v_timeline)")
def srt_format(spark, sf_dir):
    t = v.timeline(spark, sf_dir).withColumn("ms", F.expr("start_us div 1000"))
    return t.select("chapter", "widx", x.srt_time("ms").alias("stamp"))


@register("duration_text", "select event_id, case when s >= 3600 then concat(s // 3600, 'h ', lpad(cast((s // 60) % 60 as varchar), 2, '0'), 'm ', lpad(cast(s % 60 as varchar), 2, '0'), 's') when s >= 60 then concat(s // 60, 'm ', lpad(cast(s % 60 as varchar), 2, '0'), 's') else concat(s, 's') end as shown from (select event_id, cast(floor(value) as bigint) * 37 as s from events)")
def duration_text(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", (F.floor("value").cast("bigint") * 37).alias("s"))
    return e.select("event_id", x.duration("s").alias("shown"))


@register("chapter_header", "select event_id, concat('Vers ', event_id) as text from events")
def chapter_header(spark, sf_dir):
    """Chapter headers dropped from lines that begin with one."""
    e = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("Buch KAPITEL "), F.col("event_id").cast("string"), F.lit(" Vers "), F.col("event_id").cast("string")).alias("line"))
    return e.select("event_id", x.without_chapter_header("line", "event_id").alias("text"))


@register("chapter_pad", "select event_id, case when event_id < 1000 then lpad(cast(event_id as varchar), 3, '0') else cast(event_id as varchar) end as chapter from events")
def chapter_pad(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", x.padded("event_id").alias("chapter"))


@register("story_segments", r"select doc_id, len(s) as n_segments, coalesce(array_to_string(s, '|'), '') as segments from (select doc_id, list_filter(list_transform(string_split_regex(text, '\n')[2:], lambda y: trim(y)), lambda y: y <> '') as s from documents)")
def story_segments(spark, sf_dir):
    """Lines of documents told as a story: an image marker before each line after the title."""
    story = F.regexp_replace("text", "\n", "\n![x](y)\n")
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(story, F.lit("\n_A citation_")).alias("md"))
    d = d.select("doc_id", x.story_segments("md").alias("s"))
    return d.select("doc_id", F.size("s").cast("bigint").alias("n_segments"), F.array_join("s", "|").alias("segments"))


@register("verse_lines", r"select doc_id, generate_subscripts(l, 1) as verse, unnest(l) as line from (select doc_id, string_split(rtrim(text, chr(10)), chr(10)) as l from documents)")
def verse_lines(spark, sf_dir):
    """Verse number = line number; trailing blank lines dropped."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(F.regexp_replace("text", r"\n+\z", ""), "\n")).alias("pos", "line"))
    return d.select("doc_id", (F.col("pos") + 1).cast("bigint").alias("verse"), "line")


def _two(spark, sf_dir):
    """Two timelines of each chapter: clicks as forced alignment, views as recognition; seconds compressed to minutes of speech."""
    word = F.element_at(F.array(*(F.lit(w) for w in ("alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta"))), (F.col("pct") % 7 + 1).cast("int"))
    t = v.timeline(spark, sf_dir).select("chapter", "widx", "source", word.alias("text"), (F.col("start_us") / 4e10).alias("start"), (F.col("pct") / 100).alias("score"))
    t = t.withColumn("end", F.col("start") + 0.4)
    return t.where("source = 'click'"), t.where("source = 'view'")


FUSED = "chapter long, widx long, text string, start double, end double, score double, source string"


@register("fuse_words")
def fuse_words(spark, sf_dir):
    """Fusion of both timelines of a chapter."""
    ship(spark)

    def run(ctc: pd.DataFrame, asr: pd.DataFrame) -> pd.DataFrame:
        ctc = ctc.sort_values("widx")
        fused = a.fuse(a.chapter_words(ctc), a.chapter_words(asr))
        rows = [(c, w, f.text, f.start, f.end, f.score, f.source) for c, w, f in zip(ctc["chapter"], ctc["widx"], fused, strict=True)]
        return pd.DataFrame(rows, columns=["chapter", "widx", "text", "start", "end", "score", "source"])

    return a.per_chapter(*_two(spark, sf_dir), ["chapter"], run, FUSED)


@register("header_detect")
def header_detect(spark, sf_dir):
    """Spoken header before the first verse of each chapter."""
    ship(spark)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        words = a.chapter_words(pdf)
        found = a.header_boundary("delta epsilon zeta eta alpha", words)
        return pd.DataFrame({"chapter": [pdf["chapter"].iloc[0]], "start": [found[0] if found else None], "header": [found[1] if found else None]})

    return _two(spark, sf_dir)[1].groupBy("chapter").applyInPandas(run, "chapter long, start double, header string")


@register("verse_anchor")
def verse_anchor(spark, sf_dir):
    """Verses of each conversation found again in its words, of which every tenth is missing."""
    ship(spark)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("widx")
        heard = [a.norm(w) for w, i in zip(pdf["word"], pdf["widx"], strict=True) if i % 10]
        groups = [(k, [a.norm(w) for w in g["word"]]) for k, g in pdf.groupby("verse", sort=True)]
        at = a.verse_anchors([w for _, w in groups], heard)
        return pd.DataFrame({"chapter": pdf["chapter"].iloc[0], "verse": [k for k, _ in groups], "anchor": pd.array(at, dtype="Int64")})

    return v.words(spark, sf_dir).groupBy("chapter").applyInPandas(run, "chapter long, verse long, anchor long")


@register("word_align")
def word_align(spark, sf_dir):
    """Stamps of each word of a verse from a timeline anchored at its beginning."""
    ship(spark)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("widx")
        asr = [a.Word(w, i * 0.5, i * 0.5 + 0.4) for w, i in zip(pdf["word"], pdf["widx"], strict=True) if i % 7]
        rows, at = [], 0
        for verse, g in pdf.groupby("verse", sort=True):
            stamps = a.word_stamps([*g["word"]], asr, at)
            rows += [(pdf["chapter"].iloc[0], verse, k, s[0] if s else None, s[1] if s else None) for k, s in enumerate(stamps)]
            at += sum(i % 7 > 0 for i in g["widx"])
        return pd.DataFrame(rows, columns=["chapter", "verse", "pos", "start", "end"])

    return v.words(spark, sf_dir).groupBy("chapter").applyInPandas(run, "chapter long, verse long, pos long, start double, end double")


@register("windowed_align")
def windowed_align(spark, sf_dir):
    """Verses aligned in windows over a table-backed aligner."""
    ship(spark)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("widx")
        words = [a.Word(w, i * 0.5, i * 0.5 + 0.4, 0.9 if i % 5 else 0.1) for w, i in zip(pdf["word"], pdf["widx"], strict=True)]
        groups = [(k, [*g["word"]]) for k, g in pdf.groupby("verse", sort=True)]
        got = a.windowed(pdf["chapter"].iloc[0], [w for _, w in groups], len(words) * 0.5, a.TableAligner(words))
        rows = [(pdf["chapter"].iloc[0], k, s.start, s.end, s.score, s.source) for (k, _), s in zip(groups, got, strict=True)]
        return pd.DataFrame(rows, columns=["chapter", "verse", "start", "end", "score", "source"])

    return v.words(spark, sf_dir).groupBy("chapter").applyInPandas(run, "chapter long, verse long, start double, end double, score double, source string")


@register("match_quality", f"with {v.TIMELINE}, c as (select chapter, widx, pct, start_us from v_timeline where source = 'click'), w as (select chapter, widx, pct, start_us from v_timeline where source = 'view') select c.chapter, c.widx, count(*) as n, max(700 * cast(c.pct % 7 = w.pct % 7 as int) + 300 - abs(c.start_us - w.start_us) * 3 // 800000000) as quality from c join w on c.chapter = w.chapter and w.start_us between c.start_us - 80000000000 and c.start_us + 80000000000 group by all")
def match_quality(spark, sf_dir):
    """Best blend of text and time among the recognised words within the gate; buckets of the gate make the join equal."""
    gate = 80_000_000_000
    t = v.timeline(spark, sf_dir).select("chapter", "widx", "pct", "start_us", "source").withColumn("bucket", F.expr(f"start_us div {gate}L"))
    c = t.where("source = 'click'").drop("source").withColumn("bucket", F.explode(F.array(F.col("bucket") - 1, F.col("bucket"), F.col("bucket") + 1)))
    w = t.where("source = 'view'").select("chapter", "bucket", F.col("pct").alias("wp"), F.col("start_us").alias("ws"))
    near = c.join(w, ["chapter", "bucket"]).where(F.abs(F.col("start_us") - F.col("ws")) <= gate)
    q = 700 * (F.col("pct") % 7 == F.col("wp") % 7).cast("int") + 300 - F.expr("(abs(start_us - ws) * 3) div 800000000")
    return near.groupBy("chapter", "widx").agg(F.count("*").alias("n"), F.max(q).cast("bigint").alias("quality"))

"""Queries of the file scans: small files are written from the nation table (25 rows at any scale) and read back by the library's readers."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from cueflow.functions import text as x
from cueflow.plans.registry import register
from cueflow.session import shared_folder
from cueflow.sources import files
from cueflow.sources.tables import table


def _nations(spark, sf_dir) -> list[tuple[int, str, int]]:
    return [(r.n_nationkey, r.n_name, r.n_regionkey) for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect()]


def _written(spark, contents: dict[str, str]) -> str:
    """A new folder below the shared one with these files; it goes when the session ends."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    root = f"{shared_folder(spark)}/cueflow-scan-{uuid.uuid4().hex}"
    fs = hadoop(root).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop(root))
    fs.deleteOnExit(hadoop(root))
    for path, body in contents.items():
        out = fs.create(hadoop(f"{root}/{path}"), True)
        out.write(bytearray(body.encode()))
        out.close()
    return root


def _chapter(k: int, region: int, tail: str) -> str:
    return f"nt/i{region}/D{k}/GEN/GEN_{k + 1:03d}_A_B{tail}"


KEY = "'nt' as canon, concat('i', n_regionkey) as iso, concat('D', n_nationkey) as distinct_id, 'GEN' as book, n_nationkey + 1 as chapter, 'A_B' as fileset"


@register("scan_word_timelines", f"select {KEY}, 'ctc' as source, w as widx, concat(n_name, '_', w) as text, cast(w * 0.5 as double) as start, cast(case when w % 2 = 0 then w * 0.5 else w * 0.5 + 0.25 end as double) as \"end\", cast(w / 10.0 as double) as score from (select *, unnest(generate_series(0, n_regionkey + 1)) as w from nation where n_nationkey % 6 <> 5)")
def scan_word_timelines(spark, sf_dir):
    """Word timelines; a missing end is the start, corrupt files give no rows."""
    word = lambda name, w: {"text": f"{name}_{w}", "start": w * 0.5, "score": w / 10} | ({"end": w * 0.5 + 0.25} if w % 2 else {})
    made = {_chapter(k, r, "_mms_words.json"): json.dumps({"book": "GEN", "words": [word(n, w) for w in range(r + 2)]}) if k % 6 != 5 else "{broken" for k, n, r in _nations(spark, sf_dir)}
    return files.word_timelines(spark, _written(spark, made), "ctc")


@register("scan_verse_timings", f"select {KEY}, v as verse, cast(case when v = 1 then 99 else v * 1.5 end as double) as ts from (select *, unnest(generate_series(0, n_regionkey + 1)) as v from nation)")
def scan_verse_timings(spark, sf_dir):
    """Verse timings; of repeated verses the last counts, verses that are no number are skipped."""
    row = lambda v, ts: {"verse_start": str(v), "timestamp": ts}
    made = {_chapter(k, r, "_timing.json"): json.dumps([*(row(v, v * 1.5) for v in range(r + 2)), row(1, 99), row("x", 5)]) for k, _, r in _nations(spark, sf_dir)}
    return files.verse_timings(spark, _written(spark, made))


@register("scan_word_quality", f"select {KEY}, v as verse, p as pos, cast((v + p) / 10.0 as double) as score, case when p = 0 then 'whisper' end as source from (select *, unnest(generate_series(0, v)) as p from (select *, unnest(generate_series(1, n_regionkey + 1)) as v from nation))")
def scan_word_quality(spark, sf_dir):
    """Word quality by verse and position."""
    made = {_chapter(k, r, "_words_quality.json"): json.dumps({"verses": {str(v): [{"score": (v + p) / 10} | ({"source": "whisper"} if not p else {}) for p in range(v + 1)] for v in range(1, r + 2)}}) for k, _, r in _nations(spark, sf_dir)}
    return files.word_quality(spark, _written(spark, made)).select("canon", "iso", "distinct_id", "book", "chapter", "fileset", "verse", "pos", "score", "source")


@register("scan_inventory", f"select {KEY}, ext, cast(length(n_name) as bigint) as length from (select *, unnest(['json', 'txt', 'mp3']) as ext from nation)")
def scan_inventory(spark, sf_dir):
    """Files with their chapter keys; names without a chapter number are left out."""
    made = {_chapter(k, r, f".{ext}"): n for k, n, r in _nations(spark, sf_dir) for ext in ("json", "txt", "mp3")} | {"nt/i0/D0/GEN/readme_x_y.txt": "no chapter"}
    return files.inventory(spark, _written(spark, made)).select("canon", "iso", "distinct_id", "book", "chapter", "fileset", "ext", "length")


@register("scan_texts", f"select {KEY}, v as verse, case when v = 2 then '' else concat(n_name, ' ', v) end as text from (select *, unnest(generate_series(1, n_regionkey + 3)) as v from nation)")
def scan_texts(spark, sf_dir):
    """Lines of texts as verses; empty ones inside stay, trailing ones go."""
    made = {_chapter(k, r, ".txt"): "\n".join("" if v == 2 else f"{n} {v}" for v in range(1, r + 4)) + "\n\n \n" for k, n, r in _nations(spark, sf_dir)}
    return files.reference_texts(spark, _written(spark, made))


@register("scan_jobs", "select 'b' as batch_id, concat('i', n_regionkey) as iso, concat('D', n_nationkey) as distinct_id, 'GEN' as book, c as chapter from (select *, unnest(generate_series(1, n_regionkey + 1)) as c from nation)")
def scan_jobs(spark, sf_dir):
    """Jobs of a batch, one row a chapter; a second manifest of the same batch in a later tier does not count, nor does a tier that is missing."""
    job = lambda k, r: {"iso": f"i{r}", "distinct_id": f"D{k}", "chapters": {"GEN": [*range(1, r + 2)]}}
    made = {"first/b.json": json.dumps({"id": "b", "jobs": [job(k, r) for k, _, r in _nations(spark, sf_dir)]}), "second/b.json": json.dumps({"id": "b", "jobs": [job(99, 3)]})}
    root = _written(spark, made)
    return files.jobs(spark, [f"{root}/none", f"{root}/first", f"{root}/second"]).select("batch_id", "iso", "distinct_id", "book", "chapter")


@register("scan_stories", "select concat('i', n_regionkey) as iso, 'src' as source, lpad(cast(n_nationkey as varchar), 2, '0') as story_id, concat('http://a.example/', n_name) as audio_url, n_regionkey + 1 as segment_count from nation")
def scan_stories(spark, sf_dir):
    """Stories of the manifests of languages."""
    by: dict[int, dict] = {}
    for k, n, r in _nations(spark, sf_dir):
        by.setdefault(r, {})[f"{k:02d}"] = {"audio_url": f"http://a.example/{n}", "segment_count": r + 1}
    return files.stories(spark, _written(spark, {f"i{r}.json": json.dumps({"iso": f"i{r}", "source": "src", "stories": s}) for r, s in by.items()}))


@register("scan_priority_languages", "select concat('i', n_nationkey) as iso, n_name as language, n_regionkey as tier, c as canon, 'syncable' as category, concat(n_name, '-', c, f) as fileset from (select *, unnest(['nt', 'ot']) as c from nation), (select unnest([1, 2]) as f) where c = 'nt' or n_regionkey > 1")
def scan_priority_languages(spark, sf_dir):
    """Priority languages by testament and category."""
    side = lambda n, c: {"syncable": [f"{n}-{c}1", f"{n}-{c}2"], "with_timecode": []}
    langs = [{"iso": f"i{k}", "language": n, "tier": r, "nt": side(n, "nt")} | ({"ot": side(n, "ot")} if r > 1 else {}) for k, n, r in _nations(spark, sf_dir)]
    return files.priority_languages(spark, _written(spark, {"p.json": json.dumps({"languages": langs})}) + "/p.json")


@register("scan_versions", "select concat('i', n_regionkey) as iso, n_name as version, c as canon, case when c = 'nt' then 'at' else 'a' end as dbt, case when n_nationkey % 2 = 0 then 't' end as helloao, 't' as ebible, case when n_nationkey % 3 = 0 then 'E' else concat('e', n_nationkey) end as ebible_id from (select *, unnest(['nt', 'ot']) as c from nation)")
def scan_versions(spark, sf_dir):
    """Versions of languages with the kinds that each source has."""
    by: dict[int, dict] = {}
    for k, n, r in _nations(spark, sf_dir):
        side = lambda dbt: {"dbt": dbt, "ebible": "t"} | ({"helloao": "t"} if k % 2 == 0 else {}) | ({"ebible_id": "E"} if k % 3 == 0 else {})  # noqa: B023, E731
        by.setdefault(r, {})[n] = {"nt": side("at"), "ot": side("a"), "ebible_id": f"e{k}"}
    return files.versions(spark, _written(spark, {f"i{r}/versions.json": json.dumps(v) for r, v in by.items()} | {"broken/versions.json": "{"}))


@register("scan_cross_references", "select concat('i', n_regionkey) as iso, n_name as version, case when n_nationkey % 4 > 0 then concat('e', n_nationkey) end as ebible from nation")
def scan_cross_references(spark, sf_dir):
    """Cross references of versions."""
    by: dict[str, dict] = {}
    for k, n, r in _nations(spark, sf_dir):
        by.setdefault(f"i{r}", {})[n] = {"ebible": f"e{k}"} if k % 4 else {}
    return files.cross_references(spark, _written(spark, {"x.json": json.dumps(by)}) + "/x.json")


@register("scan_catalog", "select concat('i', n_regionkey) as iso, 'nt' as canon, n_name as distinct_id, concat('a:', n_nationkey) as raw_id, 'mp3' as codec, n_regionkey as n_formats from nation")
def scan_catalog(spark, sf_dir):
    """Catalogue entries; a catalogue that is missing or broken adds none."""
    by: dict[str, dict] = {}
    for k, n, r in _nations(spark, sf_dir):
        by.setdefault(f"i{r}:nt", {})[n] = [{"id": f"a:{k}", "c": "mp3", "fmt": ["f"] * r}]
    root = _written(spark, {"c.json": json.dumps({"entries": by}), "broken.json": "{"})
    all_ = [files.catalog(spark, f"{root}/{n}") for n in ("c.json", "broken.json", "missing.json")]
    return all_[0].unionByName(all_[1]).unionByName(all_[2]).select("iso", "canon", "distinct_id", "raw_id", "codec", F.size("fmt").alias("n_formats"))


@register("scan_coverage", "select 'D' as distinct_id, n_name as book, c as chapter from (select *, unnest(generate_series(1, n_regionkey + 1)) as c from nation)")
def scan_coverage(spark, sf_dir):
    """Chapters by book of one id; what cannot be read is unknown and gives no rows."""
    root = _written(spark, {"D.json": json.dumps({n: [*range(1, r + 2)] for _, n, r in _nations(spark, sf_dir)})})
    return files.coverage(spark, f"{root}/D.json", "D").unionByName(files.coverage(spark, f"{root}/E.json", "E"))


@register("scan_contributed_times", "select n_nationkey as chapter, l as line, cast(l * 2.5 + n_nationkey as double) as \"end\" from (select *, unnest(generate_series(1, n_regionkey + 2)) as l from nation)")
def scan_contributed_times(spark, sf_dir):
    """End stamps of contributed chapters; lines that are no number are not counted."""
    made = {f"C_{k}.csv": "\n".join(["end", "", *(str(i * 2.5 + k) for i in range(1, r + 3)), ""]) for k, _, r in _nations(spark, sf_dir)}
    t = files.contributed_times(spark, _written(spark, made))
    return t.select(F.regexp_extract("path", r"C_(\d+)\.csv$", 1).cast("bigint").alias("chapter"), "line", "end")


@register("scan_audio_books", "select 'external' as type, 'http://a.example/' as base_url, concat('B', n_nationkey) as book, cast(n_nationkey as varchar) as code, n_name as title from nation")
def scan_audio_books(spark, sf_dir):
    """Books of a contribution's audio metadata."""
    books = {f"B{k}": {"code": str(k), "title": n} for k, n, _ in _nations(spark, sf_dir)}
    return files.audio_books(spark, _written(spark, {"audio.json": json.dumps({"type": "external", "baseUrl": "http://a.example/", "books": books})}) + "/audio.json")


@register("scan_chapter_json", "select n_nationkey as chapter, v as verse, concat(n_name, ' ', v) as text from (select *, unnest(generate_series(1, n_regionkey + 1)) as v from nation)")
def scan_chapter_json(spark, sf_dir):
    """Verses of external chapters; headings are left out."""
    body = lambda k, n, r: {"chapter": {"number": k, "content": [{"type": "heading", "content": ["h"]}, *({"type": "verse", "number": v, "content": [f"{n} ", str(v)]} for v in range(1, r + 2))]}}
    return files.chapter_json(spark, _written(spark, {f"{k}.json": json.dumps(body(k, n, r)) for k, n, r in _nations(spark, sf_dir)}))


@register("scan_audio_links", "select n_nationkey as chapter, concat('r', l) as reader, concat('http://a.example/', n_name, '/', l) as url from (select *, unnest(generate_series(0, n_regionkey)) as l from nation)")
def scan_audio_links(spark, sf_dir):
    """Audio of external chapters by reader."""
    made = {f"{k}.json": json.dumps({"thisChapterAudioLinks": {f"r{i}": f"http://a.example/{n}/{i}" for i in range(r + 1)}}) for k, n, r in _nations(spark, sf_dir)}
    links = files.audio_links(spark, _written(spark, made))
    return links.select(F.regexp_extract("path", r"(\d+)\.json$", 1).cast("bigint").alias("chapter"), "reader", "url")


@register("chapter_text_answers", "select n_nationkey as chapter, case when n_regionkey = 0 then concat('http://a.example/', n_name) end as path, case when n_regionkey > 0 then concat(n_name, chr(10), n_name, '2') end as text from nation")
def chapter_text_answers(spark, sf_dir):
    """Answers of a text service: a path, or verses of which the empty ones are dropped."""
    verses = F.array(F.struct(F.lit(None).cast("string").alias("path"), F.col("n_name").alias("verse_text")), F.struct(F.lit(None).cast("string").alias("path"), F.lit("").alias("verse_text")), F.struct(F.lit(None).cast("string").alias("path"), F.concat("n_name", F.lit("2")).alias("verse_text")))
    path = F.array(F.struct(F.concat(F.lit("http://a.example/"), "n_name").alias("path"), F.lit(None).cast("string").alias("verse_text")))
    n = table(spark, sf_dir, "nation").withColumn("body", F.to_json(F.struct(F.when(F.col("n_regionkey") == 0, path).otherwise(verses).alias("data"))))
    where, body = files.chapter_text("body")
    return n.select(F.col("n_nationkey").alias("chapter"), where.alias("path"), body.alias("text"))


@register("alphabet_words", "select p_partkey, case when k = '' then '*' else k end as word from (select p_partkey, regexp_replace(lower(p_brand), '[^a-m]', '', 'g') as k from part)")
def alphabet_words(spark, sf_dir):
    """Words cut down to an alphabet; a star where nothing is left."""
    return table(spark, sf_dir, "part").select("p_partkey", x.in_alphabet("p_brand", "abcdefghijklm").alias("word"))

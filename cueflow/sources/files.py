"""Scans of manifests, timelines, timings, texts, catalogues and contributed files.

Paths are the primary key: chapter columns come from the path of each file.
Scans read directories with Spark's readers; nothing lists files on the driver
except the two small TOML readers.
"""

from __future__ import annotations

import json
import tomllib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cueflow.functions.text import LanguageRules

WORDS_SCHEMA = "book string, chapter string, words array<struct<text:string,start:double,end:double,score:double>>, _corrupt_record string"
TIMING_SCHEMA = "book string, chapter string, verse_start string, verse_start_alt string, timestamp double"
QUALITY_SCHEMA = "verses map<string,array<struct<score:double,source:string,mms_score:double,whisper_score:double>>>"
MANIFEST_SCHEMA = "id string, template string, jobs array<struct<iso:string,language:string,canon:string,distinct_id:string,has_downloads:boolean,chapters:map<string,array<int>>,audio_fileset:string,text_fileset:string,text_source:string>>"
STORY_SCHEMA = "iso string, source string, source_repo string, license string, checking_level string, content_base_url string, stories map<string,struct<audio_url:string,segment_count:int>>"
CATALOG_SCHEMA = "entries map<string,map<string,array<struct<id:string,c:string,fmt:array<string>>>>>"


def path_key(path: str = "path") -> list[Column]:
    """canon, iso, distinct_id, book, chapter, fileset of ``…/canon/iso/id/BOOK/BOOK_CCC_FILESET…``; the file set may hold underscores."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    part = lambda k: F.regexp_extract(path, rf"([^/]+)/([^/]+)/([^/]+)/[^/]+/[^/]+$", k)  # noqa: E731, F541
    split = F.split(name, "_", 3)
    stem = F.regexp_replace(F.get(split, F.lit(2)), r"(_(timing|words|words_quality|mms_words|whisper_words))?\.[^.]*$", "")
    return [
        part(1).alias("canon"), part(2).alias("iso"), part(3).alias("distinct_id"), F.get(split, F.lit(0)).alias("book"),
        F.expr("try_cast(get(split(regexp_extract(" + path + ", '([^/]+)$', 1), '_', 3), 1) as int)").alias("chapter"), stem.alias("fileset"),
    ]


def inventory(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Files under a root with their chapter key, extension, time and length; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "modificationTime", "length")
    ext = F.regexp_extract("path", r"\.([^./]+)$", 1)
    return files.select("path", *path_key(), ext.alias("ext"), F.col("modificationTime").alias("mtime"), "length").where("chapter is not null")


def word_timelines(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Words in long form; a missing end is the start; corrupt or wordless files give no rows."""
    raw = spark.read.schema(WORDS_SCHEMA).option("multiLine", "true").option("mode", "PERMISSIVE").option("recursiveFileLookup", "true").json(path)
    raw = raw.withColumn("path", F.col("_metadata.file_path")).where("words is not null")
    long = raw.select(*path_key(), F.posexplode("words").alias("widx", "w"))
    return long.select("canon", "iso", "distinct_id", "book", "chapter", "fileset", F.lit(source).alias("source"), "widx", "w.text", "w.start", F.coalesce("w.end", "w.start").alias("end"), "w.score")


def verse_timings(spark: SparkSession, path: str) -> DataFrame:
    """Stamps by verse; the last of repeated verses counts."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    rows = raw.select(*path_key(), F.posexplode(F.from_json("value", f"array<struct<{TIMING_SCHEMA.replace(' ', ':').replace(',:', ',')}>>")).alias("ordinal", "t"))
    rows = rows.select("canon", "iso", "distinct_id", "book", "chapter", "fileset", "ordinal", F.expr("try_cast(t.verse_start as int)").alias("verse"), F.col("t.timestamp").alias("ts"))
    return rows.where("verse is not null").groupBy("canon", "iso", "distinct_id", "book", "chapter", "fileset", "verse").agg(F.max_by("ts", "ordinal").alias("ts"))


def word_quality(spark: SparkSession, path: str) -> DataFrame:
    """Quality in long form: verse, pos, score, source."""
    raw = spark.read.schema(QUALITY_SCHEMA).option("multiLine", "true").option("recursiveFileLookup", "true").json(path).withColumn("path", F.col("_metadata.file_path"))
    v = raw.select(*path_key(), F.explode("verses").alias("verse", "q"))
    return v.select("canon", "iso", "distinct_id", "book", "chapter", "fileset", F.col("verse").cast("int").alias("verse"), F.posexplode("q").alias("pos", "w")).select("canon", "iso", "distinct_id", "book", "chapter", "fileset", "verse", "pos", "w.*")


def reference_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row a line: verse number = line number; trailing blank lines dropped."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    lines = raw.select(*path_key(), F.posexplode(F.split(F.regexp_replace("value", r"\s+\z", ""), "\r?\n")).alias("pos", "text"))
    return lines.select("canon", "iso", "distinct_id", "book", "chapter", "fileset", (F.col("pos") + 1).alias("verse"), "text")


def jobs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Jobs of batch manifests, one row a chapter; of equal batch ids the one in the earliest path counts. Paths that do not exist are skipped; if none does, they are named."""
    tiers = []
    there = [p for p in paths if any(c in p for c in "*?[{") or exists(spark, p)]
    if not there:
        raise FileNotFoundError(f"no manifest in {', '.join(paths)}")
    for tier, p in enumerate(there):
        tiers.append(spark.read.schema(MANIFEST_SCHEMA).option("multiLine", "true").json(p).withColumn("tier", F.lit(tier)))
    raw = tiers[0]
    for t in tiers[1:]:
        raw = raw.unionByName(t)
    best = raw.withColumn("rn", F.row_number().over(Window.partitionBy("id").orderBy("tier"))).where("rn = 1")
    j = best.select(F.col("id").alias("batch_id"), F.explode("jobs").alias("j")).select("batch_id", "j.*")
    return j.select("*", F.explode("chapters").alias("book", "numbers")).select("*", F.explode("numbers").alias("chapter")).drop("chapters", "numbers")


def stories(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(STORY_SCHEMA).option("multiLine", "true").json(path)
    return raw.select("iso", "source", F.explode("stories").alias("story_id", "s")).select("iso", "source", "story_id", "s.audio_url", "s.segment_count")


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def parsed_or_nothing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row from a JSON document of a file; none where the file is missing or no JSON: unknown, not empty."""
    kind = schema if schema.startswith(("map<", "array<", "struct<")) else f"struct<{schema}>"
    if not exists(spark, path):
        return spark.createDataFrame([], f"doc {kind}")
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.from_json("value", kind).alias("doc")).where("doc is not null")


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue entries in long form: iso, canon, distinct_id, raw_id, codec, fmt; no rows where it cannot be read."""
    raw = parsed_or_nothing(spark, path, "struct<entries:map<string,map<string,array<struct<id:string,c:string,fmt:array<string>>>>>>").select(F.col("doc.entries").alias("entries"))
    e = raw.select(F.explode("entries").alias("key", "ids")).select("key", F.explode("ids").alias("distinct_id", "files")).select("key", "distinct_id", F.explode("files").alias("f"))
    return e.select(F.split_part("key", F.lit(":"), F.lit(1)).alias("iso"), F.split_part("key", F.lit(":"), F.lit(2)).alias("canon"), "distinct_id", F.col("f.id").alias("raw_id"), F.col("f.c").alias("codec"), "f.fmt")


def coverage(spark: SparkSession, path: str, distinct_id: str) -> DataFrame:
    """book -> chapters of one id; no rows where it cannot be read, which readers take for unknown."""
    m = parsed_or_nothing(spark, path, "map<string,array<int>>").select(F.col("doc").alias("m"))
    return m.select(F.explode("m").alias("book", "chapters")).select(F.lit(distinct_id).alias("distinct_id"), "book", F.explode("chapters").alias("chapter"))


_SOURCES = "struct<dbt:string,helloao:string,ebible:string,ebible_id:string>"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """(iso, version, canon, dbt, helloao, ebible, ebible_id) of ``root/<iso>/versions.json``: which kinds each source has.

    The id of the third source stands at the testament or at the version. A file
    that is no JSON gives no rows. Cached by the caller, if at all.
    """
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "versions.json").text(root, wholetext=True)
    raw = raw.withColumn("iso", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/versions\.json$", 1))
    entry = f"map<string,struct<nt:{_SOURCES},ot:{_SOURCES},ebible_id:string>>"
    v = raw.select("iso", F.explode(F.from_json("value", entry)).alias("version", "v"))
    sides = F.array(*(F.struct(F.lit(c).alias("canon"), F.col(f"v.{c}").alias("s")) for c in ("nt", "ot")))
    flat = v.select("iso", "version", F.col("v.ebible_id").alias("own"), F.explode(sides).alias("x")).where("x.s is not null")
    return flat.select("iso", "version", "x.canon", "x.s.dbt", "x.s.helloao", "x.s.ebible", F.coalesce("x.s.ebible_id", "own").alias("ebible_id"))


def cross_references(spark: SparkSession, path: str) -> DataFrame:
    """(iso, version, ebible) of a cross-reference file; no rows where it cannot be read."""
    raw = parsed_or_nothing(spark, path, "map<string,map<string,struct<ebible:string>>>")
    return raw.select(F.explode("doc").alias("iso", "versions")).select("iso", F.explode("versions").alias("version", "x")).select("iso", "version", "x.ebible")


def readers(path: str) -> list[tuple[str, str, str]]:
    """(translation, reader, distinct_id) of a TOML file; none where it cannot be read."""
    try:
        with open(path, "rb") as f:
            known = tomllib.load(f)
    except (OSError, tomllib.TOMLDecodeError):
        return []
    return [(t, r, m["distinct_id"]) for t, meta in known.get("translations", {}).items() for r, m in meta.get("readers", {}).items() if m.get("distinct_id")]


def audio_links(spark: SparkSession, path: str) -> DataFrame:
    """(path, reader, url) of external chapter JSON."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    links = F.from_json("value", "struct<thisChapterAudioLinks:map<string,string>>")
    return raw.select("path", F.explode(links["thisChapterAudioLinks"]).alias("reader", "url"))


def chapter_text(body: str) -> tuple[Column, Column]:
    """(path, text) of a text service's answer: the path of a file, or verses given in line, of which empty ones are dropped."""
    data = F.from_json(F.col(body), "struct<data:array<struct<path:string,verse_text:string>>>")["data"]
    lines = F.filter(F.transform(data, lambda d: d.verse_text), lambda t: t.isNotNull() & (t != ""))
    first = F.get(data, F.lit(0))["path"]
    return first, F.when(first.isNull() & (F.size(lines) > 0), F.array_join(lines, "\n"))


def contributed_times(spark: SparkSession, path: str) -> DataFrame:
    """CSV of one end stamp a line; blank and non-numeric lines are skipped, lines are numbered after that."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    lines = raw.select("path", F.posexplode(F.split("value", "\r?\n")).alias("pos", "line")).withColumn("end", F.expr("try_cast(trim(line) as double)")).where("`end` is not null")
    return lines.select("path", F.row_number().over(Window.partitionBy("path").orderBy("pos")).alias("line"), "end")


def chapter_json(spark: SparkSession, path: str) -> DataFrame:
    """External chapter JSON: verse items with their strings joined by spaces."""
    schema = "chapter struct<number:int,content:array<struct<type:string,number:int,content:array<string>>>>"
    raw = spark.read.schema(schema).option("multiLine", "true").json(path)
    items = F.filter("chapter.content", lambda x: x.type == "verse")
    return raw.select(F.col("chapter.number").alias("chapter"), F.explode(items).alias("v")).select("chapter", F.col("v.number").alias("verse"), F.array_join(F.transform("v.content", lambda s: F.trim(s)), " ").alias("text"))


def language_rules(path: str, fallback: str | None = None) -> LanguageRules:
    """TOML rules of a language, else of the fallback file, else the built-in default."""
    for p in (path, fallback):
        try:
            with open(p or "", "rb") as f:
                t = tomllib.load(f)
        except FileNotFoundError:
            continue
        return LanguageRules(
            marker_rules=tuple((r["pattern"], r.get("replacement", "")) for r in t.get("strip_marker_rules", [])),
            char_replacements=tuple(t.get("char_replacements", {}).items()),
            pronunciations=tuple(t.get("pronunciation_map", {}).items()),
            strip_categories=tuple(t.get("strip_unicode_categories", ["Mn"])),
            fallback_threshold=float(t.get("mms_fallback_threshold", 0.3)),
            passages=tuple(t.get("aramaic_passages", [])),
            verse_only=bool(t.get("verse_only_mode", False)),
        )
    return LanguageRules()


def machine_options(values: dict, defaults: dict) -> dict:
    """Known keys over the defaults; unknown keys are ignored."""
    return defaults | {k: v for k, v in values.items() if k in defaults}


def machine_file(path: str, defaults: dict) -> tuple[dict, str | None]:
    """Options of a JSON file over the defaults, and a warning where the file is there but cannot be read."""
    try:
        with open(path, encoding="utf-8") as f:
            values = json.load(f)
    except FileNotFoundError:
        return dict(defaults), None
    except (OSError, ValueError) as e:
        return dict(defaults), f"{path}: {e}"
    return (machine_options(values, defaults), None) if isinstance(values, dict) else (dict(defaults), f"{path}: no object")


def contribution(text: str, directory: str) -> dict[str, str | None]:
    """canon and distinct_id of a contribution: TOML, else plain ``key = value`` lines, else parts of ``iso_id_canon``."""
    try:
        known = tomllib.loads(text)
    except tomllib.TOMLDecodeError:
        pairs = (line.split("=", 1) for line in text.splitlines() if "=" in line)
        known = {k.strip(): v.strip().strip("\"'") for k, v in pairs}
    parts = directory.rstrip("/").rsplit("/", 1)[-1].split("_")
    return {"canon": known.get("canon") or (parts[2] if len(parts) > 2 else None), "distinct_id": known.get("distinct_id") or (parts[1] if len(parts) > 1 else None)}


def audio_books(spark: SparkSession, path: str) -> DataFrame:
    """Books of an audio.json: book, code, title, with type and base URL."""
    raw = spark.read.schema("type string, baseUrl string, books map<string,struct<code:string,title:string>>").option("multiLine", "true").json(path)
    return raw.select("type", F.col("baseUrl").alias("base_url"), F.explode("books").alias("book", "b")).select("type", "base_url", "book", "b.code", "b.title")


def priority_languages(spark: SparkSession, path: str) -> DataFrame:
    """Languages with tier and file sets by canon and category; a missing file gives no rows."""
    sets = "struct<syncable:array<string>,with_timecode:array<string>,audio_with_timecode:array<string>>"
    schema = f"languages array<struct<iso:string,language:string,tier:int,nt:{sets},ot:{sets}>>"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], "iso string, language string, tier int, canon string, category string, fileset string")
    langs = spark.read.schema(schema).option("multiLine", "true").json(path).select(F.explode("languages").alias("l"))
    cells = [
        F.struct(F.lit(canon).alias("canon"), F.lit(cat).alias("category"), F.col(f"l.{canon}.{cat}").alias("filesets"))
        for canon in ("nt", "ot") for cat in ("syncable", "with_timecode", "audio_with_timecode")
    ]
    flat = langs.select("l.iso", "l.language", "l.tier", F.explode(F.array(*cells)).alias("c"))
    return flat.select("iso", "language", "tier", "c.canon", "c.category", F.explode("c.filesets").alias("fileset"))


def chapter_spec(column: str) -> tuple[Column, Column]:
    """(book, chapter) of ``GEN_017`` or ``GEN 17``; null where it is neither."""
    book = F.nullif(F.upper(F.regexp_extract(column, r"^\s*(\w{3})[_ ]\d+\s*$", 1)), F.lit(""))
    return book, F.expr(f"try_cast(regexp_extract({column}, '[_ ](\\\\d+)\\\\s*$', 1) as int)")

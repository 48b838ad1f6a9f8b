"""Work discovery over a file inventory: what can be aligned, from which files, and what is done.

The inventory has canon, iso, distinct_id, book, chapter, fileset, kind (audio,
text, asr, ctc, timing, quality), path, root and mtime. Look-ups by priority are
aggregates; what is unknown is never taken for empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cueflow.functions.text import padded
from cueflow.operators.planning import not_done

CHAPTER = ["canon", "iso", "distinct_id", "book", "chapter"]


def text_tag(fileset: str = "fileset") -> Column:
    """The tag of a text file: the third part of its name."""
    return F.split_part(F.col(fileset), F.lit("."), F.lit(1))


def is_drama(fileset: str = "fileset") -> Column:
    return F.col(fileset).contains("2DA") | F.col(fileset).contains("2SA")


def first_texts(files: DataFrame) -> DataFrame:
    """The text of each chapter: ``_ET`` tags first, then by name."""
    rank = F.struct(F.when(F.col("fileset").endswith("_ET"), 0).otherwise(1), F.col("fileset"))
    return files.where("kind = 'text'").groupBy(*CHAPTER).agg(F.min_by("path", rank).alias("text_path"), F.min_by("fileset", rank).alias("text_fileset"))


def base_dirs(files: DataFrame, roots: list[str]) -> DataFrame:
    """The first root that exists for each (canon, iso, distinct_id)."""
    rank = F.array_position(F.array(*map(F.lit, roots)), F.col("root"))
    return files.where(rank > 0).groupBy("canon", "iso", "distinct_id").agg(F.min_by("root", rank).alias("root"))


def alignable(files: DataFrame, done: DataFrame, drama: bool = False, force: bool = False) -> DataFrame:
    """Chapters with audio and text and no output; standard audio where there is any, unless drama is asked for."""
    audio = files.where("kind = 'audio'").select(*CHAPTER, F.col("fileset").alias("audio_fileset"), F.col("path").alias("audio_path"))
    if not drama:
        std = (~is_drama("audio_fileset")).cast("int")
        audio = audio.withColumn("__s", std).withColumn("__h", F.max(std).over(Window.partitionBy(*CHAPTER))).where("__s = __h").drop("__s", "__h")
    work = audio.join(first_texts(files), CHAPTER)
    return work if force else not_done(work, done, [*CHAPTER, "audio_fileset"])


def skipped(files: DataFrame, done: DataFrame) -> DataFrame:
    """How many chapters of each language the anti join leaves out."""
    return alignable(files, done, force=True).join(done.select(*CHAPTER, "audio_fileset").distinct(), [*CHAPTER, "audio_fileset"], "left_semi").groupBy("iso").agg(F.count("*").alias("skipped"))


def fusable(files: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """Chapters with at least one word timeline, which of them exist, and no output."""
    has = lambda k: F.max((F.col("kind") == k).cast("int")).cast("boolean")
    found = files.where(F.col("kind").isin("asr", "ctc")).groupBy(*CHAPTER, F.col("fileset").alias("audio_fileset")).agg(has("asr").alias("has_asr"), has("ctc").alias("has_ctc"))
    return found if force else not_done(found, done, [*CHAPTER, "audio_fileset"])


def strategy(has_text: str, has_ctc: str, has_asr: str) -> Column:
    """How a chapter is aligned: both, ctc, asr or error."""
    return F.when(~F.col(has_text), "error").when(F.col(has_ctc) & F.col(has_asr), "both").when(F.col(has_ctc), "ctc").when(F.col(has_asr), "asr").otherwise("error")


def languages_with(files: DataFrame, *kinds: str) -> DataFrame:
    """Languages that have files of every kind named."""
    found = files.where(F.col("kind").isin(*kinds)).groupBy("iso").agg(F.collect_set("kind").alias("k"))
    return found.where(F.size("k") == len(set(kinds))).select("iso")


def source_type(contributed: str, external: str) -> Column:
    """Contributed before external before the default service."""
    # Names of the sources.
    return F.when(F.col(contributed), "contrib").when(F.col(external), "helloao").otherwise("dbt")


def usable_text(work: DataFrame, catalog_texts: DataFrame, keys: list[str]) -> DataFrame:
    """Work whose text the catalogue lists; all of it if the catalogue is empty (unreachable). Asks for one row of the catalogue."""
    if catalog_texts.isEmpty():
        return work
    return work.join(catalog_texts.select(*keys), keys, "left_semi")


def version_ids(ids: DataFrame, versions: DataFrame) -> DataFrame:
    """Version of an id: what follows its language prefix, else the first version (by ordinal) that it ends with, else itself.

    Case does not count. Ids are short: each meets the versions through its suffixes, by equality.
    """
    bare = F.when(F.upper("id").startswith(F.upper("iso")) & (F.length("id") > F.length("iso")), F.expr("substring(id, length(iso) + 1)"))
    tails = ids.withColumn("bare", bare).withColumn("tail", F.explode(F.transform(F.sequence(F.lit(1), F.length("id")), lambda k: F.upper(F.substring("id", k, F.length("id"))))))
    j = tails.join(versions.select("version", "ordinal", F.upper("version").alias("tail")), "tail", "left")
    g = j.groupBy("iso", "id").agg(F.first("bare").alias("bare"), F.min_by("version", F.when(F.col("version").isNotNull(), F.struct("ordinal", "version"))).alias("v"))
    return g.select("iso", "id", F.coalesce("bare", "v", "id").alias("version"))


def audio_url(base: str, code: str, title: str, chapter: str) -> Column:
    """base, code and chapter filled to five places (two at least), title, and the chapter in three places."""
    width = F.greatest(F.lit(2), 5 - F.length(code))
    number = F.col(chapter).cast("string")
    wide = lambda n: F.when(F.length(number) >= n, number).otherwise(F.lpad(number, n, "0"))
    return F.concat(F.col(base), F.col(code), wide(width), F.lit("-"), F.col(title), F.lit("_Kapitel-"), wide(F.lit(3)), F.lit(".mp3"))


def work_items(work: DataFrame, out_root: str) -> DataFrame:
    """Work with its output paths; where the source type is known, whether contributed timing is to be kept."""
    if "source_type" in work.columns:
        work = work.withColumn("preserve_existing_timing", F.coalesce(F.col("source_type") == "contrib", F.lit(False)))
    stem = F.concat_ws("/", F.lit(out_root), "canon", "iso", "distinct_id", "book", F.concat_ws("_", "book", padded("chapter"), "audio_fileset"))
    return work.select("*", *(F.concat(stem, F.lit(f"_{k}.json")).alias(f"{k}_path") for k in ("timing", "words", "words_quality")))


def restricted(work: DataFrame, jobs: DataFrame) -> DataFrame:
    """Work of the batch's ids; work without an id passes."""
    ids = jobs.select("distinct_id").distinct()
    return work.where("distinct_id is null").unionByName(work.join(ids, "distinct_id", "left_semi").select(*work.columns))


def contributed_pairs(files: DataFrame) -> DataFrame:
    """Audio and text of the same contributed chapter; of several texts the first pattern counts."""
    audio = files.where("kind = 'audio'").select(*CHAPTER, F.col("path").alias("audio_path"))
    text = files.where("kind = 'text'").groupBy(*CHAPTER).agg(F.min_by("path", F.struct("pattern", "path")).alias("text_path"))
    return audio.join(text, CHAPTER)


def external_contributions(texts: DataFrame, times: DataFrame, books: DataFrame) -> DataFrame:
    """Contributed chapters whose audio lies elsewhere: texts of the books that the metadata has, with their stamps where there are any.

    texts and times: name (``BOOK_N``), path. Names without a number are left out.
    """
    name = lambda df, c: df.select(F.split_part("name", F.lit("_"), F.lit(1)).alias("book"), F.expr("try_cast(substring(name, instr(name, '_') + 1) as int)").alias("chapter"), F.col("path").alias(c))
    t = name(texts.where("instr(name, '_') > 0"), "text_path").where("chapter is not null").join(books.select("book").distinct(), "book", "left_semi")
    return t.join(name(times, "times_path"), ["book", "chapter"], "left")


def remote_sources(dirs: DataFrame, audio_meta: DataFrame, known_readers: DataFrame) -> DataFrame:
    """Where the audio of a version is read from: its own metadata, else the reader that its id belongs to, else local.

    dirs: version_dir, distinct_id, external (whether it lies among aligned
    external content). audio_meta: version_dir, type. known_readers: translation, reader, distinct_id.
    """
    first = known_readers.groupBy("distinct_id").agg(F.min(F.struct("translation", "reader")).alias("r"))
    meta = audio_meta.select("version_dir", F.coalesce("type", F.lit("external")).alias("type"))
    j = dirs.join(meta, "version_dir", "left").join(first, "distinct_id", "left")
    read = F.col("external") & F.col("r").isNotNull()
    kind = F.coalesce(F.col("type"), F.when(read, "reader"), F.lit("local"))
    only = F.col("type").isNull() & read
    return j.select("version_dir", "distinct_id", kind.alias("kind"), F.when(only, F.col("r.translation")).alias("translation"), F.when(only, F.col("r.reader")).alias("reader"))


def cross_source(files: DataFrame, equivalent: DataFrame) -> DataFrame:
    """Audio-only versions with an equivalent external text: (canon, iso, distinct_id, external_id, books).

    Ids are upper-case without underscores. equivalent: iso, canon, distinct_id, external_id (verified matches).
    """
    key = ["canon", "iso", "distinct_id"]
    audio = files.where("kind = 'audio'").where((F.col("distinct_id") == F.upper("distinct_id")) & ~F.col("distinct_id").contains("_"))
    without = audio.join(files.where("kind = 'text'").select(*key).distinct(), key, "left_anti")
    books = without.select(*key, "book").distinct().groupBy(*key).agg(F.array_sort(F.collect_list("book")).alias("books"))
    return books.join(equivalent.groupBy(*key).agg(F.min("external_id").alias("external_id")), key)


def external_chapters(books: DataFrame, local: DataFrame) -> DataFrame:
    """Local chapters that an external book list reaches. books: book, n_chapters. local: book, chapter, …"""
    return local.join(books.select("book", "n_chapters"), "book").where("chapter <= n_chapters").drop("n_chapters")


def preferred_texts(wanted: DataFrame, index: DataFrame, equivalent: DataFrame) -> DataFrame:
    """Source of the text of each (iso, canon, distinct_id): the external one where the index lists it and a verified match is known, else the default.

    index: iso, canon, source. equivalent: iso, canon, distinct_id, external_id.
    """
    listed = index.where("source = 'external'").select("iso", "canon").distinct().withColumn("listed", F.lit(True))
    match = equivalent.groupBy("iso", "canon", "distinct_id").agg(F.min("external_id").alias("external_id"))
    j = wanted.join(listed, ["iso", "canon"], "left").join(match, ["iso", "canon", "distinct_id"], "left")
    use = F.col("listed") & F.col("external_id").isNotNull()
    return j.select("iso", "canon", "distinct_id", F.when(use, "external").otherwise("default").alias("chosen"), F.when(use, F.col("external_id")).alias("source_id"))


def external_texts(wanted: DataFrame, versions: DataFrame, cross: DataFrame, equivalent: DataFrame) -> DataFrame:
    """Where the text of a version without one is found: (iso, version, source, source_id), nulls where nowhere.

    Testaments are tried in order (nt, ot) where the service has audio and no
    text: first the verified external match, then the archive, whose id is the
    version's own or the first of the language's cross references.
    """
    lang = cross.where("ebible is not null").groupBy("iso").agg(F.min_by("ebible", "version").alias("lang_id"))
    v = versions.where(F.col("dbt").contains("a") & ~F.col("dbt").contains("t")).join(lang, "iso", "left").join(equivalent, ["iso", "version", "canon"], "left")
    archive = F.when(F.col("ebible") == "t", F.coalesce("ebible_id", "lang_id"))
    match = F.when(F.col("helloao") == "t", F.col("external_id"))
    found = v.select("iso", "version", "canon", F.when(match.isNotNull(), F.struct(F.lit("external").alias("source"), match.alias("source_id"))).when(archive.isNotNull(), F.struct(F.lit("archive").alias("source"), archive.alias("source_id"))).alias("s"))
    first = found.where("s is not null").groupBy("iso", "version").agg(F.min_by("s", "canon").alias("s"))
    return wanted.join(first, ["iso", "version"], "left").select("iso", "version", "s.source", "s.source_id")


def with_valid_tags(files: DataFrame, expected: DataFrame, keys: list[str], reachable: bool) -> DataFrame:
    """Texts whose tag is one that their version can have; all of them if the catalogue could not be reached.

    expected: keys, tag.
    """
    if not reachable:
        return files
    return files.withColumn("tag", text_tag()).join(expected.select(*keys, "tag").distinct(), [*keys, "tag"], "left_semi").drop("tag")


def redone(done: DataFrame, collapsed: DataFrame, keys: list[str]) -> DataFrame:
    """What counts as done when collapsed outputs are to be made again."""
    return done.join(collapsed.select(*keys).distinct(), keys, "left_anti")


def verse_line(texts: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The line of each wanted verse (keys, verse); null beyond the text's end."""
    return wanted.join(texts.select(*keys, "verse", "text"), [*keys, "verse"], "left")


def import_plan(pairs: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """What an import would do to each contributed chapter: its actions in order, chapters without any left out.

    pairs: keys, audio_path, text_path, times_path. existing: keys, kind (audio, text, timing).
    """
    has = existing.groupBy(*keys).agg(F.collect_set("kind").alias("__has"))
    j = pairs.join(has, keys, "left").withColumn("__has", F.coalesce("__has", F.array().cast("array<string>")))
    step = lambda path, kind, name: F.when(F.col(path).isNotNull() & ~F.array_contains("__has", kind), F.lit(name))
    steps = F.array_compact(F.array(step("audio_path", "audio", "copy audio"), step("text_path", "text", "copy text"), step("times_path", "timing", "convert times")))
    return j.withColumn("actions", steps).where(F.size("actions") > 0).drop("__has")

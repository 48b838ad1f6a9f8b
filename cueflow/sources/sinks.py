"""Sinks: long tables as parquet, and the nested JSON, subtitle and manifest forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueflow.functions.text import padded, srt_time
from cueflow.operators.sequence import Keys


def verse_timing_json(df: DataFrame, keys: Keys) -> DataFrame:
    """One JSON array a chapter, verses in order."""
    item = F.struct("verse", F.struct("book", padded("chapter").alias("chapter"), F.col("verse").cast("string").alias("verse_start"), F.col("verse").cast("string").alias("verse_start_alt"), F.col("ts").alias("timestamp")).alias("row"))
    return df.groupBy(*keys).agg(F.to_json(F.transform(F.array_sort(F.collect_list(item)), lambda x: x.row)).alias("json"))


def word_timing_json(df: DataFrame, keys: Keys) -> DataFrame:
    """Map from verse to starts and to ends; null cells stay."""
    cell = F.struct("pos", "start", "end")
    v = df.groupBy(*keys, "verse").agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    listed = F.array_sort(F.collect_list(F.struct("verse", "cells")))
    as_map = lambda f: F.map_from_entries(F.transform(F.col("vs"), lambda x: F.struct(x.verse.cast("string"), F.transform(x.cells, lambda c: c[f]))))
    g = v.groupBy(*keys).agg(listed.alias("vs"))
    return g.select(*keys, F.to_json(F.struct(as_map("start").alias("verses"), as_map("end").alias("verse_ends")), {"ignoreNullFields": "false"}).alias("json"))


def words_json(df: DataFrame, keys: Keys) -> DataFrame:
    """Word timeline of a chapter, in order of widx."""
    item = F.struct("widx", F.struct("text", "start", "end", "score").alias("w"))
    return df.groupBy(*keys).agg(F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(item)), lambda x: x.w).alias("words"))).alias("json"))


def recogniser_words_json(df: DataFrame, book: str = "book", chapter: str = "chapter") -> DataFrame:
    """Recognised words of a chapter: times in hundredths, scores in thousandths and left out where unknown, the chapter's number as it is."""
    words = F.struct(F.col("text"), F.round("start", 2).alias("start"), F.round(F.coalesce("end", "start"), 2).alias("end"), F.round("score", 3).alias("score"))
    return _chapter_words(df, book, chapter, words, F.col(chapter).cast("string"))


def forced_words_json(df: DataFrame, book: str = "book", chapter: str = "chapter") -> DataFrame:
    """Words of forced alignment: values as they are, the chapter's number in three places at least."""
    return _chapter_words(df, book, chapter, F.struct("text", "start", "end", "score"), padded(chapter))


def _chapter_words(df: DataFrame, book: str, chapter: str, word: Column, number: Column) -> DataFrame:
    listed = F.transform(F.array_sort(F.collect_list(F.struct("widx", word.alias("w")))), lambda x: x.w)
    g = df.groupBy(book, chapter).agg(listed.alias("words"))
    return g.select(book, chapter, F.to_json(F.struct(F.col(book).alias("book"), number.alias("chapter"), "words")).alias("json"))


def quality_json(df: DataFrame, keys: Keys, threshold: float = 0.3) -> DataFrame:
    """Word quality by verse with its summary: recognised words name their source and both scores, others the recogniser's score where it is known.

    df: verse, pos, score, source, ctc_score, asr_score, start.
    """
    heard = F.col("source") == "asr"
    word = F.struct(
        F.round("score", 3).alias("score"), F.when(heard, F.lit("asr")).alias("source"),
        F.when(heard, F.round("ctc_score", 3)).alias("ctc_score"), F.when(~heard, F.round("asr_score", 3)).alias("asr_score"),
    )
    low = F.coalesce(F.col("score") < threshold, F.lit(False))
    v = df.groupBy(*keys, "verse").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", word.alias("q")))), lambda x: x.q).alias("words"), F.max(low).alias("low"), F.count("*").alias("n"), F.sum("score").alias("total"),
        F.count_if(low).alias("n_low"), F.count_if(F.col("start").isNull()).alias("nulls"), F.count_if(heard).alias("heard"),
    )
    g = v.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("verse", "words", "low"))).alias("vs"), F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("n_low").alias("n_low"), F.sum("nulls").alias("nulls"), F.sum("heard").alias("heard"),
    )
    verses = F.map_from_entries(F.transform("vs", lambda x: F.struct(x.verse.cast("string"), x.words)))
    summary = F.struct(
        F.col("n").alias("total_words"), F.round(F.col("total") / F.col("n"), 3).alias("avg_score"), F.col("n_low").alias("low_quality_count"), F.col("nulls").alias("null_count"),
        F.col("heard").alias("from_asr"), (F.col("n") - F.col("heard")).alias("from_ctc"), F.transform(F.filter("vs", lambda x: x.low), lambda x: x.verse.cast("string")).alias("low_quality_verses"),
    )
    return g.select(*keys, F.to_json(F.struct(verses.alias("verses"), summary.alias("summary"))).alias("json"))


def story_timing_json(df: DataFrame) -> DataFrame:
    """One JSON array a story (column chapter), segments in order."""
    item = F.struct("segment", F.struct(F.col("chapter").cast("string").alias("story"), "segment", "timestamp", "score", "source").alias("row"))
    return df.groupBy("chapter").agg(F.to_json(F.transform(F.array_sort(F.collect_list(item)), lambda x: x.row)).alias("json"))


def error_row(error_type: Column, content: Column, fileset: Column, distinct_id: Column, details: Column, at: Column) -> Column:
    """An entry of the error log; content is audio, text or timing."""
    return F.struct(at.alias("timestamp"), error_type.alias("error_type"), content.alias("content"), fileset.alias("fileset"), distinct_id.alias("distinct_id"), details.alias("details"))


def error_lists(errors: DataFrame, keys: Keys, column: str = "error") -> DataFrame:
    """The log of each key: audio, text and timing errors in lists of their own, in order of time."""
    kinds = {f"{k}_errors": F.array_sort(F.collect_list(F.when(F.col(f"{column}.content") == k, F.col(column)))) for k in ("audio", "text", "timing")}
    return errors.groupBy(*keys).agg(F.max(f"{column}.timestamp").alias("timestamp"), *(v.alias(k) for k, v in kinds.items()))


def subtitles(df: DataFrame, keys: Keys) -> DataFrame:
    """Subtitle blocks from segments (ordinal, start_ms, end_ms, text); blank ones are left out and numbers keep their gaps."""
    df = df.where(F.trim("text") != "")
    block = F.concat_ws("\n", F.col("ordinal").cast("string"), F.concat_ws(" --> ", srt_time("start_ms"), srt_time("end_ms")), F.trim("text"), F.lit(""))
    return df.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", block.alias("b")))), lambda x: x.b), "\n").alias("srt"))


def run_manifest(results: DataFrame, batch_id: str, completed_at: str) -> DataFrame:
    """One row: the batch, when it ended (ISO 8601) and its results in key order. The results of a run are few."""
    row = F.struct(*results.columns)
    return results.agg(F.array_sort(F.collect_list(row)).alias("results")).select(F.lit(batch_id).alias("batch_id"), F.lit(completed_at).alias("completed_at"), "results")


def append_errors(errors: DataFrame, path: str) -> None:
    """The error log only grows; ``error_log`` merges it by key."""
    errors.write.mode("append").parquet(path)


def error_log(errors: DataFrame, keys: Keys) -> DataFrame:
    cols = [c for c in errors.columns if c not in keys]
    return errors.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("errors"))


def without_bad(outputs: DataFrame, bad: DataFrame, keys: Keys, confirm: bool = False) -> DataFrame:
    """Outputs without the chapters classed BAD; without ``confirm`` nothing goes."""
    return outputs.join(bad.select(*keys), keys, "left_anti") if confirm else outputs


def import_new(rows: DataFrame, existing: DataFrame, keys: Keys) -> DataFrame:
    """What an import would copy: rows whose target is missing."""
    return rows.join(existing.select(*keys), keys, "left_anti")


def run_rows(results: DataFrame, batch_id: str, completed_at: str) -> DataFrame:
    """The run manifest as rows, one a result, for runs of any size; ``run_manifest`` gathers those of a small one."""
    return results.select(F.lit(batch_id).alias("batch_id"), F.lit(completed_at).alias("completed_at"), "*")

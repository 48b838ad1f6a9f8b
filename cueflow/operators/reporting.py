"""Reports over chapters, runs and downloads: joins and aggregates that leave one row for each thing reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueflow.operators import sequence as seq
from cueflow.operators.sequence import Keys


def latest_timecodes(files: DataFrame, keys: Keys, search: str = "search") -> DataFrame:
    """The timecode file of each chapter: later search directories overwrite earlier ones, of equal ones the last path counts."""
    return files.groupBy(*keys).agg(F.max_by("path", F.struct(search, "path")).alias("path"))


def quality_with_timings(quality: DataFrame, timings: DataFrame, downloaded: DataFrame, keys: Keys) -> DataFrame:
    """Quality rows with the pipeline's timing and the downloaded one, where they exist."""
    return quality.join(timings, keys, "left").join(downloaded, keys, "left")


def fanned_out(work: DataFrame, jobs: DataFrame, keys: Keys, wanted: str = "wanted", given: str = "did") -> tuple[DataFrame, DataFrame]:
    """Work met by the jobs of its key, and the work that meets none; work that names no id fans out to all jobs of its key."""
    met = work.join(jobs, keys).where(F.col(wanted).isNull() | (F.col(wanted) == F.col(given)))
    fits = work.where(F.col(wanted).isNull()).join(jobs.select(*keys).distinct(), keys, "left_anti")
    named = work.where(F.col(wanted).isNotNull()).join(jobs.select(*keys, F.col(given).alias(wanted)).distinct(), [*keys, wanted], "left_anti")
    return met, fits.unionByName(named.select(*fits.columns))


def merged_chapters(jobs: DataFrame, keys: Keys, chapter: str = "chapter") -> DataFrame:
    """Chapters of each book over all jobs, as a set in order."""
    return jobs.select(*keys, chapter).distinct().groupBy(*keys).agg(F.count("*").alias("n_chapters"), F.array_sort(F.collect_list(chapter)).alias("chapters"))


def availability(expected: DataFrame, have: DataFrame, keys: Keys) -> DataFrame:
    """expected (keys, expected) with the number of different chapters up to it that are there."""
    there = have.select(*keys, "chapter").distinct()
    j = expected.join(there, keys, "left")
    return j.groupBy(*keys, "expected").agg(F.count(F.when(F.col("chapter") <= F.col("expected"), True)).alias("available"))


def worst_gaps(words: DataFrame, chapter: Keys, verse: str, order: str, start: str, threshold) -> DataFrame:
    """Chapters to repair: of the first gaps of their verses the widest, the first of equals, with its verse and word."""
    gaps = seq.first_gap(words, [*chapter, verse], order, start, threshold)
    worst = F.max_by(F.struct(verse, order, start, "gap"), F.struct(F.col("gap"), -F.col(verse))).alias("g")
    return gaps.groupBy(*chapter).agg(worst).select(*chapter, F.col(f"g.{verse}").alias(verse), F.col(f"g.{order}").alias(order), F.col(f"g.{start}").alias(start), "g.gap")


def gap_report(worst: DataFrame, order: Keys) -> DataFrame:
    """Worst gaps in the order of a report; the sort is the sink's."""
    return worst.orderBy(*order)


def gap_totals(worst: DataFrame, language: str = "iso") -> DataFrame:
    """Chapters with gaps and the number of their languages."""
    return worst.agg(F.count("*").alias("n_chapters"), F.countDistinct(language).alias("n_languages"))


def repairable(worst: DataFrame, audio: DataFrame, forced: DataFrame, keys: Keys) -> tuple[DataFrame, DataFrame]:
    """Worst gaps that can be repaired (audio and forced alignment are there), and the others with what they lack."""
    has = lambda df, name: df.select(*keys).distinct().withColumn(name, F.lit(True))
    j = worst.join(has(audio, "__a"), keys, "left").join(has(forced, "__f"), keys, "left")
    lack = F.when(F.col("__a").isNull(), "audio").when(F.col("__f").isNull(), "forced alignment")
    j = j.withColumn("lacks", lack).drop("__a", "__f")
    return j.where("lacks is null").drop("lacks"), j.where("lacks is not null")


def repaired(before: DataFrame, after: DataFrame, keys: Keys) -> DataFrame:
    """Whether each gap got smaller: before and after have keys and gap; a gap that is gone counts as repaired."""
    j = before.select(*keys, "gap").join(after.select(*keys, F.col("gap").alias("new_gap")), keys, "left")
    return j.withColumn("fixed", F.coalesce(F.col("new_gap") < F.col("gap"), F.lit(True)))


def run_counters(results: DataFrame, status: str, chapter: str, seconds: Column) -> DataFrame:
    """Results, chapters and seconds of audio by status."""
    return results.groupBy(F.col(status).alias("status")).agg(F.count("*").alias("n"), F.countDistinct(chapter).alias("chapters"), F.sum(seconds).alias("seconds"))


def run_summary(results: DataFrame) -> DataFrame:
    """Totals of a recognition run: languages, chapters by status, audio and processing seconds, and audio seconds for each one spent.

    results: iso, status (done, skipped, failed), audio_s, spent_s. The factor is null where nothing was spent.
    """
    is_ = lambda k: F.count_if(F.col("status") == k)
    g = results.agg(
        F.countDistinct("iso").alias("languages"), is_("done").alias("processed"), is_("skipped").alias("skipped"), is_("failed").alias("failed"),
        F.sum("audio_s").alias("audio_s"), F.sum("spent_s").alias("spent_s"),
    )
    return g.withColumn("realtime", F.round(F.col("audio_s") / F.when(F.col("spent_s") > 0, F.col("spent_s")), 1))


def download_report(results: DataFrame, status: str = "status") -> DataFrame:
    """Files that were there, were downloaded and failed, and the total that is there now. Status: present, downloaded, failed."""
    is_ = lambda k: F.count_if(F.col(status) == k)
    return results.agg(is_("present").alias("present"), is_("downloaded").alias("downloaded"), is_("failed").alias("failed"), (is_("present") + is_("downloaded")).alias("total"))


def compared_models(pairs: DataFrame, keys: Keys, delta: str, within: tuple, over: tuple = ()) -> DataFrame:
    """Two models by group: count, sum, maximum and median of the deltas, and how many lie within and over thresholds (name, value)."""
    near = [F.count_if(F.col(delta) <= v).alias(n) for n, v in within]
    far = [F.count_if(F.col(delta) > v).alias(n) for n, v in over]
    return pairs.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(delta).alias("sum_d"), F.max(delta).alias("max_d"), F.percentile(delta, F.lit(0.5)).alias("median"), *near, *far)


def memory_needed(model: str) -> Column:
    """Bytes of graphics memory that a recogniser's model needs, by the last part of its name; unknown ones count as large."""
    name = F.lower(F.element_at(F.split(F.col(model), "/"), -1))
    mib = F.lit(None)
    # MiB by model.
    for names, need in ((("tiny", "base"), 500), (("small",), 1100), (("medium",), 2600), (("large", "large-v2", "large-v3"), 3500), (("large-v3-turbo", "distil-large-v3"), 1600)):
        mib = F.when(name.isin(*names), need).otherwise(mib)
    return F.coalesce(mib, F.lit(3500)).cast("bigint") * (1 << 20)

"""Joins and aggregates over chapters: deltas, defects, roll-ups, coverage, top-k reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cueflow.operators.sequence import Keys, prev_equal, with_delta


def matched(a: DataFrame, b: DataFrame, keys: Keys) -> DataFrame:
    """Timing against timing: inner join on chapter and verse, verse 0 left out."""
    return a.where("verse <> 0").join(b.where("verse <> 0"), [*keys, "verse"])


def delta_stats(df: DataFrame, keys: Keys, good: int, drift: int) -> DataFrame:
    """Per chapter: n, sum and maximum of absolute deltas, its first verse, class by the mean (compared without division)."""
    d = df.withColumn("__d", F.abs(F.col("downloaded") - F.col("pipeline")))
    out = d.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum("__d").alias("sum_delta"), F.max("__d").alias("max_delta"), F.max_by("verse", F.struct("__d", -F.col("verse"))).alias("max_verse")
    )
    kind = F.when(F.col("sum_delta") < good * F.col("n"), "GOOD").when(F.col("sum_delta") < drift * F.col("n"), "DRIFT").otherwise("BAD")
    return out.withColumn("class", kind)


def halved_up(total: str, count: str) -> Column:
    """Whole quotient, rounded half up, of numbers that are not negative; exact in every engine."""
    return F.expr(f"(2 * {total} + {count}) div (2 * {count})")


def mean_of_means(df: DataFrame, keys: Keys, total: str = "sum_delta", count: str = "n") -> DataFrame:
    """Unweighted mean of chapter means in millionths, each of which weighs one; with the sum of the means and their number."""
    each = df.withColumn("__mean", halved_up(f"({total} * 1000000)", count))
    g = each.groupBy(*keys).agg(F.sum("__mean").alias("sum_means"), F.count("*").alias("n_chapters"))
    return g.withColumn("mean_micro", halved_up("sum_means", "n_chapters"))


def defects(df: DataFrame, keys: Keys, order: list, stamp: str, gap=120, tiny=0.1) -> DataFrame:
    """Counts of repeated, backward, tiny and gap deltas; chapters of two verses at least."""
    d = with_delta(df, keys, order, stamp)
    return (
        d.groupBy(*keys)
        .agg(
            F.count("*").alias("n_verses"),
            F.count_if(F.col("delta") == 0).alias("n_dupes"),
            F.count_if(F.col("delta") < 0).alias("n_backwards"),
            F.count_if((F.col("delta") > 0) & (F.col("delta") < tiny)).alias("n_tiny"),
            F.count_if(F.col("delta") > gap).alias("n_gaps"),
        )
        .where("n_verses >= 2")
    )


def null_and_repeat_counts(df: DataFrame, keys: Keys, order: list, value: str) -> DataFrame:
    r = prev_equal(df, keys, order, value)
    return r.groupBy(*keys).agg(F.count_if(F.col(value).isNull()).alias("n_nulls"), F.count_if("repeats").alias("n_dupes"), F.count("*").alias("n_words"))


def flags() -> Column:
    """Names of the rules that a chapter breaks, in fixed order.

    Columns: n_dupes, n_backwards, n_tiny, n_gaps; n_nulls; low_score (mean below 0.5);
    other_issues (of the external timing, null without one).
    """
    issues = F.col("n_dupes") + F.col("n_backwards") + F.col("n_tiny") + F.col("n_gaps")
    # The flags' names.
    parts = [
        F.when(F.col("n_dupes") > 0, "DUPES"),
        F.when(F.col("n_backwards") > 0, "BACKWARDS"),
        F.when(F.col("n_tiny") >= 3, "TINY-STEPS"),
        F.when(F.col("n_gaps") > 0, "GAPS"),
        F.when(F.col("n_nulls") >= 3, "NULLS"),
        F.when(F.col("low_score"), "LOW-SCORE"),
        F.when((F.col("other_issues") < issues) & (issues > 0), "ORIG-BETTER"),
    ]
    return F.concat_ws(",", *parts)


def quality_summary(df: DataFrame, keys: Keys, score: str, low: Column, verse: str) -> DataFrame:
    """Words, sum of scores, low words, nulls, and the verses with low words in order."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("total_words"),
        F.sum(score).alias("score_sum"),
        F.count_if(low).alias("low_quality_count"),
        F.count_if(F.col(score).isNull()).alias("null_count"),
        F.array_sort(F.collect_set(F.when(low, F.col(verse)))).alias("low_verses"),
    )


def shortened(items: str, limit: int = 8) -> Column:
    """The first items joined by commas, with an ellipsis if there are more."""
    shown = F.array_join(F.slice(F.col(items), 1, limit), ",")
    return F.when(F.size(items) > limit, F.concat(shown, F.lit(",…"))).otherwise(shown)


def covered_but_missing(have: DataFrame, lack: DataFrame, keys: Keys) -> DataFrame:
    return have.join(lack, keys, "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: Keys, fields: list[str]) -> DataFrame:
    """Full outer join; a new value that is not null replaces the old one."""
    n = new.select(*keys, *(F.col(f).alias(f"__new_{f}") for f in fields))
    return old.join(n, keys, "full").select(*keys, *(F.coalesce(f"__new_{f}", f).alias(f) for f in fields))


def flagged_share(part: str, whole: str) -> Column:
    """Whole percent, rounded half up, 0 of nothing."""
    return F.when(F.col(whole) > 0, F.expr(f"(200 * {part} + {whole}) div (2 * {whole})")).otherwise(F.lit(0))


def as_of(left: DataFrame, right: DataFrame, keys: Keys, time: str, value: str) -> DataFrame:
    """Each left row with the latest right value not after it: union and last non-null value, one sort, no range join."""
    both = left.select(*keys, time, F.lit(1).alias("__side"), "id").unionByName(
        right.select(*keys, time, F.lit(0).alias("__side"), F.lit(None).cast(left.schema["id"].dataType).alias("id"), F.col(value).alias("__v")), allowMissingColumns=True
    )
    w = Window.partitionBy(*keys).orderBy(time, "__side", F.col("__v")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn(value, F.last("__v", ignorenulls=True).over(w)).where("__side = 1").select(*keys, "id", time, value)


def compared_verses(pairs: DataFrame, keys: Keys, good: int, drift: int, flag: int) -> DataFrame:
    """Each verse with both stamps, its absolute delta, whether that is above ``flag``, and the class of its chapter."""
    kinds = delta_stats(pairs, keys, good, drift).select(*keys, "class")
    delta = F.abs(F.col("downloaded") - F.col("pipeline"))
    return pairs.withColumn("delta", delta).withColumn("flagged", F.col("delta") > flag).join(kinds, keys)


def first_of(df: DataFrame, keys: Keys, value: str, n: int, name: str) -> DataFrame:
    """The n least distinct values of each group as a sorted array; no group is gathered whole."""
    ranked = df.select(*keys, value).distinct().withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(value)))
    return ranked.where(F.col("__rn") <= n).groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias(name))


def places(df: DataFrame, score: Column, low: str, keys: list[str]) -> DataFrame:
    """Places of the rows of an overview by score, by low words and by key; one row for each group, so the table is small."""
    n = lambda *order: F.row_number().over(Window.orderBy(*order))
    return df.select(*keys, n(score, *keys).alias("by_score"), n(F.desc(low), *keys).alias("by_low"), n(*keys).alias("by_key"))


def gaps_with_partial(have: DataFrame, lack: DataFrame, partial: DataFrame, keys: Keys) -> DataFrame:
    """Covered rows without output, and whether some output was made for them all the same."""
    some = partial.select(*keys).distinct().withColumn("has_partial", F.lit(True))
    return covered_but_missing(have, lack, keys).join(some, keys, "left").withColumn("has_partial", F.coalesce("has_partial", F.lit(False)))


def overview_filtered(df: DataFrame, low: str, least: int = 0, fileset: str | None = None, column: str = "fileset") -> DataFrame:
    """Rows with at least so many low words, of one file set if it is named; case does not count."""
    out = df.where(F.col(low) >= least)
    return out.where(F.upper(column) == fileset.upper()) if fileset else out

"""Operators over ordered rows of a chapter: deltas, gaps, repair, interpolation, top-1 choices.

Every function takes the partition columns and the ordering columns; the
ordering must be unique within a partition. All of them are native windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

Keys = list[str]


def ordered(keys: Keys, order: list) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def before(keys: Keys, order: list) -> WindowSpec:
    return ordered(keys, order).rowsBetween(Window.unboundedPreceding, -1)


def upto(keys: Keys, order: list) -> WindowSpec:
    return ordered(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def after(keys: Keys, order: list) -> WindowSpec:
    return ordered(keys, order).rowsBetween(Window.currentRow, Window.unboundedFollowing)


def with_delta(df: DataFrame, keys: Keys, order: list, value: str, name: str = "delta") -> DataFrame:
    """Difference to the previous row of the chapter; null on the first."""
    return df.withColumn(name, F.col(value) - F.lag(value).over(ordered(keys, order)))


def with_index(df: DataFrame, keys: Keys, order: list, name: str = "widx") -> DataFrame:
    """Zero-based position within the chapter."""
    return df.withColumn(name, F.row_number().over(ordered(keys, order)) - 1)


def first_gap(df: DataFrame, keys: Keys, order: str, start: str, threshold) -> DataFrame:
    """First row of each group whose next start lies more than threshold later; both starts known."""
    w = ordered(keys, [order])
    gap = df.withColumn("gap", F.lead(start).over(w) - F.col(start)).where(F.col("gap") > threshold)
    return gap.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def monotone_repair(df: DataFrame, keys: Keys, order: list, start: str, name: str = "repaired") -> DataFrame:
    """Running maximum that begins anew after each null; nulls stay null."""
    island = F.count_if(F.col(start).isNull()).over(upto(keys, order))
    df = df.withColumn("__island", island)
    top = F.max(start).over(upto([*keys, "__island"], order))
    return df.withColumn(name, F.when(F.col(start).isNotNull(), top)).drop("__island")


def first_run(df: DataFrame, keys: Keys, index: str, low: Column, least: int) -> DataFrame:
    """Index at which the first run of at least ``least`` consecutive low rows begins, by group."""
    low_rows = df.where(low).select(*keys, index)
    runs = low_rows.withColumn("__run", F.col(index) - F.row_number().over(ordered(keys, [index])))
    runs = runs.groupBy(*keys, "__run").agg(F.count("*").alias("n"), F.min(index).alias("begin"))
    return runs.where(F.col("n") >= least).groupBy(*keys).agg(F.min("begin").alias("first_index"))


def second_half_share(df: DataFrame, keys: Keys, index: str, low: Column, least: int = 4) -> DataFrame:
    """Low rows and all rows in the second half (index >= n div 2) of groups of at least ``least`` rows."""
    n = F.count("*").over(Window.partitionBy(*keys))
    half = df.withColumn("__n", n).where(F.col("__n") >= least).where(F.col(index) >= F.expr("__n div 2"))
    return half.groupBy(*keys).agg(F.count("*").alias("n_half"), F.count_if(low).alias("n_low"))


def pace(df: DataFrame, keys: Keys, order: list, words: str, total: Column) -> DataFrame:
    """Expected start: total time times the share of words before the row, in whole units."""
    prior = F.coalesce(F.sum(words).over(before(keys, order)), F.lit(0))
    all_words = F.greatest(F.sum(words).over(Window.partitionBy(*keys)), F.lit(1))
    df = df.withColumn("__prior", prior).withColumn("__all", all_words).withColumn("__total", total)
    return df.withColumn("expected", F.expr("(__total * __prior) div __all")).drop("__prior", "__all", "__total")


def forward_fill(df: DataFrame, keys: Keys, order: list, value: str, name: str = "filled", default=0) -> DataFrame:
    """The row's value, else the last one known before it, else the default."""
    return df.withColumn(name, F.coalesce(F.last(value, ignorenulls=True).over(upto(keys, order)), F.lit(default)))


def anchor_interpolate(df: DataFrame, keys: Keys, verse: str, words: str, anchor: str) -> DataFrame:
    """Start of each verse: its anchor, else in proportion to the words since the previous anchored verse.

    Words of the anchored verse itself do not count, so the verse after an
    anchor inherits its time. Without words in between the spacing is even. A
    missing previous anchor counts as verse 0 at 0; without a next anchor the previous
    time holds. Interpolated starts never fall below the start emitted before; anchors are emitted as they are.
    """
    w_up, w_down = upto(keys, [verse]), after(keys, [verse])
    known = F.col(anchor).isNotNull()
    df = df.withColumn("__pv", F.coalesce(F.max(F.when(known, F.col(verse))).over(w_up), F.lit(0)))
    df = df.withColumn("__pt", F.coalesce(F.last(anchor, ignorenulls=True).over(w_up), F.lit(0)))
    df = df.withColumn("__nv", F.min(F.when(known, F.col(verse))).over(w_down)).withColumn("__nt", F.first(anchor, ignorenulls=True).over(w_down))
    gap = ordered([*keys, "__pv"], [verse])
    # words of the verses strictly between the anchors, before this one and in all
    inner = F.when(known, F.lit(0)).otherwise(F.col(words))
    df = df.withColumn("__w", inner)
    df = df.withColumn("__before", F.coalesce(F.sum("__w").over(gap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    df = df.withColumn("__span", F.sum("__w").over(Window.partitionBy(*keys, "__pv")))
    even = F.expr(f"__pt + ((__nt - __pt) * ({verse} - __pv)) div greatest(__nv - __pv, 1)")
    share = F.expr("__pt + ((__nt - __pt) * __before) div __span")
    raw = F.when(known, F.col(anchor)).when(F.col("__nt").isNull(), F.col("__pt")).when(F.col("__span") > 0, share).otherwise(even)
    df = df.withColumn("__raw", raw)
    held = F.max("__raw").over(upto([*keys, "__pv"], [verse]))
    return df.withColumn("start", held).drop("__pv", "__pt", "__nv", "__nt", "__w", "__before", "__span", "__raw")


def end_to_start(df: DataFrame, keys: Keys, line: str, end: str) -> DataFrame:
    """End stamps by line -> start stamps by verse: verse i starts where line i-1 ends; verse 0 and 1 at 0; one more verse at the end."""
    starts = df.select(*keys, (F.col(line) + 1).alias("verse"), F.col(end).alias("start"))
    heads = df.select(*keys).distinct().withColumn("verse", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("start", F.lit(0).cast(df.schema[end].dataType))
    kind = starts.schema["verse"].dataType
    return starts.unionByName(heads.withColumn("verse", F.col("verse").cast(kind)))


def silence(df: DataFrame, keys: Keys, order: str, start: str, end: str, longer, within) -> DataFrame:
    """First row that starts more than ``longer`` after the previous end, and not later than ``within``."""
    w = ordered(keys, [order])
    gaps = df.withColumn("silence", F.col(start) - F.lag(end).over(w)).where((F.col("silence") > longer) & (F.col(start) <= within))
    return gaps.groupBy(*keys).agg(F.min(order).alias("boundary"), F.min_by("silence", order).alias("silence"))


def prev_equal(df: DataFrame, keys: Keys, order: list, value: str) -> DataFrame:
    """Whether a value equals the last non-null one before it."""
    last = F.last(value, ignorenulls=True).over(before(keys, order))
    return df.withColumn("repeats", F.coalesce(F.col(value) == last, F.lit(False)))


def top_1(df: DataFrame, keys: Keys, priority: list) -> DataFrame:
    """The first row of each group by priority."""
    return df.withColumn("__rn", F.row_number().over(ordered(keys, priority))).where("__rn = 1").drop("__rn")


def alternate(df: DataFrame, keys: Keys, priority: list, flag: str, allowed: Column) -> DataFrame:
    """After the first row by priority: the next allowed row whose flag is the opposite."""
    w = ordered(keys, priority)
    ranked = df.withColumn("__rn", F.row_number().over(w)).withColumn("__flag", F.first(flag).over(w))
    rest = ranked.where((F.col("__rn") > 1) & (F.col(flag) != F.col("__flag")) & allowed)
    return rest.withColumn("__k", F.row_number().over(ordered(keys, ["__rn"]))).where("__k = 1").drop("__rn", "__flag", "__k")


def prefer(df: DataFrame, keys: Keys, preferred: Column) -> DataFrame:
    """Preferred rows; the others only in groups without any."""
    has = F.max(preferred.cast("int")).over(Window.partitionBy(*keys))
    return df.withColumn("__own", preferred.cast("int")).withColumn("__has", has).where("__own = __has").drop("__own", "__has")


def ranges(df: DataFrame, keys: Keys, number: str) -> DataFrame:
    """Runs of consecutive distinct numbers: first and last of each."""
    distinct = df.select(*keys, number).distinct()
    runs = distinct.withColumn("__run", F.col(number) - F.row_number().over(ordered(keys, [number])))
    return runs.groupBy(*keys, "__run").agg(F.min(number).alias("first"), F.max(number).alias("last")).drop("__run")


def per_segment_words(df: DataFrame, start: str, end: str, words: str) -> DataFrame:
    """Words of a segment without stamps of their own: its span in equal parts, in whole units."""
    size = F.size(words)
    out = df.withColumn("__n", size).select("*", F.posexplode(words).alias("pos", "word"))
    span = f"({end} - {start})"
    return out.withColumn("word_start", F.expr(f"{start} + ({span} * pos) div __n")).withColumn("word_end", F.expr(f"{start} + ({span} * (pos + 1)) div __n")).drop("__n")


def interpolated(df: DataFrame, keys: Keys, order: list, words: str, ends: DataFrame, name: str = "start") -> DataFrame:
    """Starts in proportion to words up to the end of the last segment of ``ends`` (keys, end), both whole; rounded half up, 0 without words or segments."""
    last = ends.groupBy(*keys).agg(F.max("end").alias("__end"))
    prior = F.coalesce(F.sum(words).over(before(keys, order)), F.lit(0))
    df = df.withColumn("__prior", prior).withColumn("__all", F.sum(words).over(Window.partitionBy(*keys))).join(last, keys, "left")
    share = F.when(F.col("__all") > 0, F.expr("(2 * coalesce(__end, 0) * __prior + __all) div (2 * __all)")).otherwise(F.lit(0))
    return df.withColumn(name, share).drop("__prior", "__all", "__end")

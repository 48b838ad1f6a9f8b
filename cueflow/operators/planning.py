"""Scope and planning: book specs, language selection, resolution by priority, staleness, shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cueflow.operators.sequence import Keys, ranges


def format_spec(df: DataFrame, book: str, chapter: str) -> DataFrame:
    """Chapters of each book as runs of consecutive numbers: ``1-3,17``."""
    r = ranges(df, [book], chapter)
    item = F.struct("first", F.when(F.col("first") == F.col("last"), F.col("first").cast("string")).otherwise(F.concat_ws("-", F.col("first").cast("string"), F.col("last").cast("string"))).alias("text"))
    return r.groupBy(book).agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x.text), ",").alias("spec"))


def format_full(df: DataFrame, books: DataFrame, book: str, chapter: str) -> DataFrame:
    """As format_spec, with the bare book where its chapters are all of 1 to n_chapters."""
    full = df.groupBy(book).agg(F.countDistinct(chapter).alias("k"), F.min(chapter).alias("lo"), F.max(chapter).alias("hi"))
    spec = format_spec(df, book, chapter).join(full, book).join(books, book)
    whole = (F.col("k") == F.col("n_chapters")) & (F.col("lo") == 1) & (F.col("hi") == F.col("n_chapters"))
    return spec.select(book, F.when(whole, F.col(book)).otherwise(F.concat_ws(":", book, "spec")).alias("spec"))


def expand_spec(specs: DataFrame, spec_id: str, spec: str, books: DataFrame) -> DataFrame:
    """``JHN,GEN:1-3,17`` -> (spec id, book, chapter), distinct.

    Parts are split at commas. A part names a book, a book with a number or range
    after a colon, or a number or range alone, which belongs to the book named
    last, also when that book is unknown. Unknown books and what cannot be read
    are dropped; a book alone means all of its chapters. NT, OT and ALL stand for
    books only as the whole spec. ``books`` has book, canon and n_chapters.
    """
    specs = specs.select(spec_id, spec)
    whole = F.upper(F.trim(spec))
    named = whole.isin("NT", "OT", "ALL")
    of_canon = books.select("book", "n_chapters", F.explode(F.array(F.col("canon"), F.lit("ALL"))).alias("__named"))
    testament = specs.where(named).join(F.broadcast(of_canon), whole == F.col("__named"))
    testament = testament.select(spec_id, "book", F.explode(F.sequence(F.lit(1), F.col("n_chapters"))).alias("chapter"))
    parts = specs.where(~named).select(spec_id, F.posexplode(F.split(spec, ",")).alias("pos", "part")).withColumn("part", F.upper(F.trim("part")))
    bare = F.col("part").rlike(r"^\d+(-\d+)?$")
    parts = parts.withColumn("named", F.when(~bare, F.regexp_extract("part", r"^([^:]*)", 1)))
    w = Window.partitionBy(spec_id).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumn("book", F.last("named", ignorenulls=True).over(w))
    number = F.when(bare, F.col("part")).otherwise(F.regexp_extract("part", r"^[^:]*:\s*(\d+(?:-\d+)?)$", 1))
    parts = parts.withColumn("number", number).withColumn("all", ~bare & ~F.col("part").contains(":"))
    lo = F.expr("try_cast(split(number, '-')[0] as int)")
    hi = F.coalesce(F.expr("try_cast(get(split(number, '-'), 1) as int)"), lo)
    found = parts.join(F.broadcast(books), "book").withColumn("lo", F.when(F.col("all"), 1).otherwise(lo)).withColumn("hi", F.when(F.col("all"), F.col("n_chapters")).otherwise(hi))
    found = found.where("lo is not null and hi >= lo").select(spec_id, "book", F.explode(F.sequence("lo", "hi")).alias("chapter"))
    return testament.unionByName(found).distinct()


def chosen_or_default(requested: DataFrame, known: DataFrame, key: str, defaults: dict[str, Column]) -> DataFrame:
    """Requested keys with what is known of them, else defaults; in the order of ``requested`` (column ordinal)."""
    j = requested.join(known, key, "left")
    return j.select("ordinal", key, *(F.coalesce(F.col(c), d).alias(c) for c, d in defaults.items()))


def first_by_priority(df: DataFrame, keys: Keys, value: str, priority: list[str]) -> DataFrame:
    """The value of the least priority for each key."""
    return df.groupBy(*keys).agg(F.min_by(value, F.struct(*priority)).alias(value))


def with_partial(df: DataFrame, requested: DataFrame, key: str, entry: str) -> DataFrame:
    """Entry under the exact key, else under the key with ``p`` appended."""
    tries = requested.select(F.col(key).alias("asked"), F.posexplode(F.array(F.col(key), F.concat(F.col(key), F.lit("p")))).alias("priority", key))
    return tries.join(df, key).groupBy("asked").agg(F.min_by(entry, F.struct("priority", entry)).alias(entry))


def equivalents(overlap: DataFrame, asked: DataFrame) -> DataFrame:
    """For each asked id: the least ``h`` id of a group that also holds it as ``d`` id; full keys before partial ones."""
    d = overlap.where("prefix = 'd'").select("group_id", F.col("id").alias("asked"))
    h = overlap.where("prefix = 'h'").select("group_id", "id", "partial")
    return d.join(asked, "asked").join(h, "group_id").groupBy("asked").agg(F.min_by("id", F.struct("partial", "group_id", "id")).alias("match"))


def resolved_id(iso: str, raw: str) -> Column:
    """``a:N2DA``: a lower-case type means that the id follows the key; an upper-case one that it stands alone."""
    kind, rest = F.split_part(raw, F.lit(":"), F.lit(1)), F.split_part(raw, F.lit(":"), F.lit(2))
    return F.when(kind == F.lower(kind), F.concat(F.col(iso), rest)).otherwise(rest)


#: Suffixes of file-set ids that name an audio or text format.
SUFFIXES = ("opus16", "opus32", "mp3-64", "mp3-128", "mp3", "json", "usx", "html")


def without_suffix(fileset: str) -> Column:
    return F.regexp_replace(fileset, f"-({'|'.join(SUFFIXES)})$", "")


def failure_kind(status: str) -> Column:
    """Kind of a failed request by its last status; without a failure the answer was empty."""
    # The error types of the error log.
    failed = F.when(F.col(status) == 403, "http_403_forbidden").when(F.col(status) == 404, "http_404_not_found").otherwise("http_error")
    return F.when(F.col(status).isNull() | (F.col(status) < 400), "empty_data").otherwise(failed)


def stale(inputs: DataFrame, outputs: DataFrame, keys: Keys, force: bool = False) -> DataFrame:
    """Keys whose output is missing or older than an input."""
    latest = inputs.groupBy(*keys).agg(F.max("mtime").alias("in_time"))
    made = outputs.groupBy(*keys).agg(F.min("mtime").alias("out_time"))
    j = latest.join(made, keys, "left")
    return j.where(F.lit(force) | F.col("out_time").isNull() | (F.col("in_time") > F.col("out_time"))).select(*keys)


def not_done(work: DataFrame, outputs: DataFrame, keys: Keys) -> DataFrame:
    """Work without output; running again finds none."""
    return work.join(outputs.select(*keys), keys, "left_anti")


def keep_unless_known(df: DataFrame, coverage: DataFrame, unit: str, keys: Keys) -> DataFrame:
    """Rows whose unit has no known coverage, or whose keys are covered: unknown is not empty."""
    known = coverage.select(unit).distinct().withColumn("__known", F.lit(True))
    hit = coverage.select(unit, *keys).distinct().withColumn("__hit", F.lit(True))
    j = df.join(known, unit, "left").join(hit, [unit, *keys], "left")
    return j.where(F.col("__known").isNull() | F.col("__hit")).drop("__known", "__hit")


def balanced_shards(items: DataFrame, keys: Keys, size: str, order: str, shards: int) -> DataFrame:
    """Longest first, each to the first shard with the least total: a fold over one group's items (a plan is small)."""
    item = F.struct((-F.col(size)).alias("neg"), F.col(order).alias("item"))
    listed = items.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("items"))
    zero = F.struct(F.array_repeat(F.lit(0).cast("bigint"), shards).alias("totals"), F.array().cast(f"array<struct<item:{items.schema[order].dataType.simpleString()},size:bigint,shard:int>>").alias("placed"))

    def step(acc: Column, x: Column) -> Column:
        at = (F.array_position(acc.totals, F.array_min(acc.totals)) - 1).cast("int")
        n = (-x.neg).cast("bigint")
        totals = F.transform(acc.totals, lambda t, i: F.when(i == at, t + n).otherwise(t))
        return F.struct(totals.alias("totals"), F.concat(acc.placed, F.array(F.struct(x.item.alias("item"), n.alias("size"), at.alias("shard")))).alias("placed"))

    folded = listed.select(*keys, F.aggregate("items", zero, step).alias("f"))
    return folded.select(*keys, F.explode("f.placed").alias("p")).select(*keys, F.col("p.item").alias(order), F.col("p.size").alias(size), F.col("p.shard").alias("shard"))


def overlapping_chunks(values: str, chunk: int, overlap: int) -> Column:
    """Chunks of an array, each beginning ``overlap`` before the end of the one before: structs (k, begin, part)."""
    n = F.size(values)
    step = chunk - overlap
    count = F.greatest(F.lit(1), F.ceil((n - overlap) / F.lit(step)).cast("int"))
    return F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.struct(k.alias("k"), (k * step).alias("begin"), F.slice(F.col(values), k * step + 1, F.lit(chunk)).alias("part")))


def stitched(chunks: str, overlap: int) -> Column:
    """The array again: later chunks lose the overlap that they begin with."""
    return F.flatten(F.transform(F.col(chunks), lambda c: F.when(c.k == 0, c.part).otherwise(F.slice(c.part, overlap + 1, F.greatest(F.size(c.part) - overlap, F.lit(0))))))


def stitched_frames(chunks: str, overlap: int) -> Column:
    """Frames of chunks (structs k, samples, frames) as one array: later chunks lose the share of frames that their overlap makes, rounded down."""

    def kept(c: Column) -> Column:
        lost = F.floor(F.size(c.frames) * F.least(F.lit(overlap), c.samples) / c.samples).cast("int")
        return F.when(c.k == 0, c.frames).otherwise(F.slice(c.frames, lost + 1, F.greatest(F.size(c.frames) - lost, F.lit(0))))

    return F.flatten(F.transform(F.col(chunks), kept))


def sample_chunks(total: str, chunk: int, overlap: int) -> Column:
    """Chunks of so many samples as structs (k, begin, samples); each begins ``overlap`` before the end of the one before."""
    step = chunk - overlap
    count = F.greatest(F.lit(1), F.ceil((F.col(total) - overlap) / F.lit(step)).cast("int"))
    return F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.struct(k.alias("k"), (k * step).alias("begin"), (F.least(k * step + chunk, F.col(total).cast("int")) - k * step).alias("samples")))

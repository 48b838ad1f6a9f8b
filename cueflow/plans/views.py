"""Views that present the driver's tables as timed text, and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cueflow.operators.sequence import with_index
from cueflow.sources.tables import table

#: White space of the tokeniser: the same class in every engine.
BLANKS = r"[ \t\n\r\f]+"


def micros(column: str):
    """Microseconds since the epoch of a timestamp without zone."""
    return F.unix_micros(F.col(column).cast("timestamp"))


def verses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chapter, verse, tokens, n_words: one row for each turn of a conversation."""
    tokens = F.filter(F.split("text", BLANKS), lambda x: x != "")
    t = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("chapter"), (F.col("turn") + 1).alias("verse"), F.coalesce(tokens, F.array().cast("array<string>")).alias("tokens"))
    return t.withColumn("n_words", F.size("tokens").cast("bigint"))


VERSES = r"""
v_verses as (
  select chapter, verse, tokens, cast(len(tokens) as bigint) as n_words from (
    select conv_id as chapter, turn + 1 as verse,
      coalesce(list_filter(string_split_regex(text, '[ \t\n\r\f]+'), lambda x: x <> ''), []) as tokens
    from conversations))"""


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chapter, verse, pos, word, widx: words of all verses in order."""
    flat = verses(spark, sf_dir).select("chapter", "verse", F.posexplode("tokens").alias("pos", "word"))
    return with_index(flat, ["chapter"], ["verse", "pos"])


WORDS = (
    VERSES
    + """,
v_words as (
  select chapter, verse, pos, word, row_number() over (partition by chapter order by verse, pos) - 1 as widx from (
    select chapter, verse, unnest(tokens) as word, generate_subscripts(tokens, 1) - 1 as pos from v_verses))"""
)


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chapter, widx, event_id, start_us (null for errors in null_us), pct score, source."""
    e = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("chapter"), "event_id", micros("ts").alias("us"), F.least(F.floor("value"), F.lit(100)).cast("bigint").alias("pct"), F.col("event_type").alias("source")
    )
    e = with_index(e, ["chapter"], ["us", "event_id"])
    start = F.col("us") - F.min("us").over(Window.partitionBy("chapter"))
    return e.withColumn("start_us", start).drop("us").withColumn("null_us", F.when(F.col("source") != "error", F.col("start_us")))


TIMELINE = """
v_timeline as (
  select chapter, event_id, pct, source, start_us, case when source <> 'error' then start_us end as null_us,
    row_number() over (partition by chapter order by start_us, event_id) - 1 as widx
  from (select user_id as chapter, event_id, cast(least(floor(value), 100) as bigint) as pct, event_type as source,
      epoch_us(ts) - min(epoch_us(ts)) over (partition by user_id) as start_us from events))"""


def jitter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chapter, verse, stamp (and null_stamp): stamps in file order, not monotone."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("chapter"), "event_id", F.floor("value").cast("bigint").alias("stamp"), "event_type")
    e = e.withColumn("verse", F.row_number().over(Window.partitionBy("chapter").orderBy("event_id")).cast("bigint"))
    return e.withColumn("null_stamp", F.when(F.col("event_type") != "error", F.col("stamp")))


JITTER = """
v_jitter as (
  select user_id as chapter, event_id, cast(floor(value) as bigint) as stamp, event_type,
    row_number() over (partition by user_id order by event_id) as verse,
    case when event_type <> 'error' then cast(floor(value) as bigint) end as null_stamp
  from events)"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """iso (nation), chapter (order), verse (line), downloaded and pipeline day numbers."""
    day = lambda c: F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", day("o_orderdate").alias("downloaded"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", day("l_shipdate").alias("pipeline"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("iso"))
    joined = lines.join(o, lines.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return joined.select("iso", F.col("o_orderkey").alias("chapter"), F.col("l_linenumber").alias("verse"), "downloaded", "pipeline")


def two_timings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two sides of pairs as timings of their own, one stamp a verse; each has a verse 0, the second lacks verse 3."""
    p = pairs(spark, sf_dir)
    zero = p.select("iso", "chapter", F.lit(0).cast(p.schema["verse"].dataType).alias("verse"), F.lit(0).cast("bigint").alias("stamp")).distinct()
    side = lambda df, c: df.groupBy("iso", "chapter", "verse").agg(F.max(c).alias(c)).unionByName(zero.withColumnRenamed("stamp", c))
    return side(p, "downloaded"), side(p.where("verse <> 3"), "pipeline")


PAIRS = """
v_pairs as (
  select n_name as iso, o_orderkey as chapter, l_linenumber as verse,
    cast(datediff('day', date '1970-01-01', cast(o_orderdate as date)) as bigint) as downloaded,
    cast(datediff('day', date '1970-01-01', cast(l_shipdate as date)) as bigint) as pipeline
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""


def filesets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """iso (part), raw_id, drama, stream, size_class: candidates for each part."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("iso"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("raw_id"),
        (F.col("l_returnflag") == "R").cast("int").alias("drama"),
        (F.col("l_linestatus") == "O").cast("int").alias("stream"),
        F.col("l_orderkey"), F.col("l_linenumber"),
    )
    return li


FILESETS = """
v_filesets as (
  select l_partkey as iso, concat(l_orderkey, '-', l_linenumber) as raw_id, cast(l_returnflag = 'R' as int) as drama,
    cast(l_linestatus = 'O' as int) as stream, l_orderkey, l_linenumber from lineitem)"""

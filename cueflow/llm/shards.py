"""Shards of nearly equal bytes: sampled splitters, range partitioning, overfull ranges subdivided.

Records are keyed by a hash of their text, so that equal texts stand together
and fall apart only where a shard has to end among them. Keys are sampled with
weights by size; quantiles of the sample split the key space into many more
ranges than shards. In a range that comes out overfull, the keys that fill a
range by themselves get stretches of their own, in the order of the keys, and
such a stretch is subdivided by a second hash, one for each record; all other
keys stay whole. Records are then numbered within their stretch, exact sums of
the stretches place each record on the line of all bytes, and the shards are
equal pieces of that line.

The law is ``bytes``: shard sizes differ by the size of one record at most.

Null text has no bytes: size 1, the checksum of nothing. Null and repeated ids,
repeated rows and ties are placed like any others; an empty table gives an empty
result. Texts of any length are placed whole. Other columns are not read,
whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import documents, small_batches, stash, text_of

SHARDS = 8
#: Records in a range; ranges of more than twice as many are subdivided.
RANGE_ROWS = 200_000
#: Ranges for each shard at least, ranges at most at any size, and sampled keys for each range.
RANGES_PER_SHARD, MAX_RANGES, SAMPLES_PER_RANGE = 4, 1 << 13, 40
#: Small tables (one row a stretch) are broadcast up to this number of rows, else joined with a shuffle.
BROADCAST_ROWS = 400_000


def splitters(sample: DataFrame, ranges: int) -> np.ndarray:
    """Quantile boundaries of sampled keys: distinct, ascending, fewer than ``ranges``. Only they reach the driver."""
    if ranges < 2:
        return np.empty(0, np.int64)
    at = [k / ranges for k in range(1, ranges)]
    return np.unique(np.array(sample.agg(F.percentile_approx("key", at, F.lit(8 * ranges))).first()[0] or [], np.int64))


def small(df: DataFrame) -> DataFrame:
    """df written; with a hint to broadcast it where it is short enough."""
    df = stash(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def subdivided(placed: DataFrame, range_rows: int) -> DataFrame:
    """placed (range, key, tie) with the stretch of each row in its range: ``seg`` in the order of keys, ``part`` within a hot key."""
    full = small(placed.groupBy("range").agg(F.count("*").alias("n")).where(F.col("n") > 2 * range_rows).select("range"))
    counts = placed.join(full, "range", "left_semi").groupBy("range", "key").agg(F.count("*").alias("n"))
    hot = counts.where(F.col("n") > range_rows)  # at most one for range_rows records
    hot = hot.groupBy("range").agg(F.sort_array(F.collect_list("key")).alias("keys"), F.map_from_entries(F.collect_list(F.struct("key", F.ceil(F.col("n") / range_rows).alias("m")))).alias("parts"))
    met = placed.join(small(hot), "range", "left")
    below = F.coalesce(F.size(F.filter("keys", lambda k: k < F.col("key"))), F.lit(0))
    own = F.coalesce(F.array_contains("keys", F.col("key")), F.lit(False))
    part = F.when(own, F.pmod(F.xxhash64("tie", F.lit("part")), F.get(F.map_values(F.map_filter("parts", lambda k, _: k == F.col("key"))), F.lit(0)))).otherwise(0)
    keyed = met.withColumn("seg", F.when(F.col("keys").isNull(), 0).otherwise(2 * below + own.cast("int"))).withColumn("part", F.when(F.col("keys").isNull(), 0).otherwise(part).cast("int"))
    return keyed.drop("keys", "parts")


def sharded(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row for each record: id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    text = text_of(text_col)
    meta = stash(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
            F.xxhash64(text).alias("key"),
            F.xxhash64(F.monotonically_increasing_id()).alias("tie"),
        )
    )
    rows, total = meta.agg(F.count("*"), F.sum("size")).first()
    ranges = min(MAX_RANGES, max(shards * RANGES_PER_SHARD, -(-rows // range_rows))) if rows else 1
    want = ranges * SAMPLES_PER_RANGE
    # a record is drawn with a chance in proportion to its size; the draw is a hash, so a lost task draws alike again
    draw = (F.xxhash64(F.col("tie"), F.lit("draw")).cast("double") / 2.0**64 + 0.5) < F.col("size") * (want / max(1, total or 1))
    split = splitters(meta.where(draw).select("key"), ranges)
    held = spark.sparkContext.broadcast(split)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(held.value, keys.to_numpy(np.int64), side="right").astype(np.int32))

    placed = meta.withColumn("range", range_of("key"))
    placed = stash(subdivided(placed, max(1, range_rows)))

    # prefix sums over stretches, in their order
    stretch = ["range", "seg", "part"]
    sums = placed.groupBy(*stretch).agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    line = Window.orderBy(*stretch).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*stretch, F.coalesce(F.sum("n").over(line), F.lit(0)).alias("n0"), F.coalesce(F.sum("bytes").over(line), F.lit(0)).alias("b0"))
    here = Window.partitionBy(*stretch).orderBy("key", "tie")
    before = F.coalesce(F.sum("size").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = placed.withColumn("row", F.row_number().over(here) - 1).withColumn("bytes", before)
    numbered = numbered.join(small(sums), stretch)
    middle = F.col("b0") + F.col("bytes") + F.expr("size div 2")
    shard = F.least(F.lit(shards - 1), F.floor(middle.cast("decimal(38,0)") * shards / max(1, total or 1))).cast("int")
    numbered = numbered.select("id", "size", "crc", (F.col("n0") + F.col("row")).alias("at"), shard.alias("shard"))
    starts = stash(numbered.groupBy("shard").agg(F.min("at").alias("first")))
    return numbered.join(F.broadcast(starts), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", (F.col("at") - F.col("first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return sharded(documents(spark, sf_dir))

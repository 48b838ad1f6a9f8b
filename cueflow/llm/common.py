"""Helpers that several corpus operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cueflow.session import ship

#: Rows and bytes in one Arrow batch at most; with whole texts in a batch this bounds a Python worker's memory.
BATCH_ROWS, BATCH_BYTES = 512, 2 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Rows carry whole texts: keep Arrow batches short. Python workers get this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ship(spark)


def scratch(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; a folder of our own only where it is unset and Spark runs locally (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cueflow-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


#: Paths that stash has written and that still stand.
_stashed: list[str] = []


def stash(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends here and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/cueflow-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    _stashed.append(path)
    return spark.read.schema(df.schema).parquet(path)


def stashed() -> list[str]:
    """What stash has written so far, oldest first."""
    return list(_stashed)


def unstash(spark: SparkSession, paths: list[str]) -> None:
    """Delete written tables that nothing reads any more."""
    for path in paths:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
        _stashed.remove(path)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    name, n = f"__{stem}", 0
    while name.lower() in taken:
        n += 1
        name = f"__{stem}{n}"
    return name


def text_of(name: str = "text") -> Column:
    """A text column; null counts as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))

"""A polled queue of batch manifests as a stream: each micro-batch plans what is not done yet.

Batches are idempotent: a manifest that comes again finds its chapters done.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cueflow.operators.planning import not_done
from cueflow.sources.files import MANIFEST_SCHEMA


def manifests(spark: SparkSession, queue_dir: str, per_trigger: int = 2) -> DataFrame:
    """Manifests as they arrive, at most so many at a time (the prefetch depth)."""
    return spark.readStream.schema(MANIFEST_SCHEMA).option("multiLine", "true").option("maxFilesPerTrigger", per_trigger).json(queue_dir)


def work_queue(spark: SparkSession, queue_dir: str, done: Callable[[], DataFrame], handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Runs ``handle`` on the open chapters of each micro-batch and stops when the queue is empty."""

    def plan(batch: DataFrame, epoch: int) -> None:
        j = batch.selectExpr("id as batch_id", "explode(jobs) as j").selectExpr("batch_id", "j.iso", "j.canon", "j.distinct_id", "explode(j.chapters) as (book, numbers)")
        work = j.selectExpr("batch_id", "iso", "canon", "distinct_id", "book", "explode(numbers) as chapter")
        handle(not_done(work, done(), ["iso", "canon", "distinct_id", "book", "chapter"]), epoch)

    return manifests(spark, queue_dir).writeStream.foreachBatch(plan).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

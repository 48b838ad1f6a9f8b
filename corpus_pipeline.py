"""The corpus pipeline: quality rules, quality classifier, near-duplicate removal, secret redaction, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again as the next stage's docs. All stages but the last return the
columns of docs; the last one returns packed pieces. Null texts count as empty;
extra columns go through; an empty table goes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cueflow.llm import common, cotraining, near_dups, packing, quality_rules, secret_scan


def quality_rule_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or meet a learned rule go."""
    common.small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rules = quality_rules.learn(quality_rules.labelled_rows(docs, labels))
    out, _, failed, rule = quality_rules.judged(docs, rules)
    return out.where(~failed & rule.isNull()).select(*docs.columns)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    common.small_batches(spark)
    model = cotraining.fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out, name = cotraining.scored(docs, model)
    return out.where(F.col(f"`{name}`.kept")).select(*docs.columns)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays, the one with the least id; ids may be null or repeat. Five-word shingles, 0.8."""
    common.small_batches(spark)
    return near_dups.deduplicated(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark in the text, and n_chars follows; no document goes."""
    common.small_batches(spark)
    found, name = secret_scan.find_secrets(docs, secret_scan.fit_on(docs))
    hit = F.col(f"`{name}`.redacted")
    changed = {"text": F.coalesce(hit, F.col("text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(hit.isNotNull(), F.length(hit).cast(kind)).otherwise(F.col("n_chars"))
    return found.select(*(changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    common.small_batches(spark)
    return packing.packed(docs)


STAGES = [
    ("quality rules", quality_rule_stage),
    ("quality classifier", classifier_stage),
    ("near duplicates", near_dup_stage),
    ("secret scan", secret_stage),
    ("packing", packing_stage),
]

#: Learned models, sketches and tokenizers: SQL does not express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder before the next; what a stage has written on its way goes then."""
    docs = common.documents(spark, sf_dir)
    before = common.stashed()
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = common.stash(docs)
            common.unstash(spark, [p for p in common.stashed()[:-1] if p not in before])
    return docs

"""Registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import bpe_codec, cotraining, fingerprints, html_text, near_dups, packing, quality_rules, secret_scan, shards, token_counts

#: DuckDB SQL by query name.
SQL: dict[str, str] = {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": secret_scan.op1_secret_scan,
        "op2_near_dups": near_dups.op2_near_dups,
        "op3_html_text": html_text.op3_html_text,
        "op4_quality_classifier": cotraining.op4_quality_classifier,
        "op5_packing": packing.op5_packing,
        "op6_token_counts": token_counts.op6_token_counts,
        "op7_bpe_codec": bpe_codec.op7_bpe_codec,
        "op8_shards": shards.op8_shards,
        "op9_quality_rules": quality_rules.op9_quality_rules,
        "op10_fingerprints": fingerprints.op10_fingerprints,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

"""Token counts of whole texts, long ones by overlap resynchronisation.

Null text counts as empty (0 bytes, 0 tokens); an empty table gives an empty
result; repeated rows are counted each by itself; other columns, also such with
the result's names, are left alone by :func:`token_counts` and not read by the query.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import documents, fresh, small_batches, text_of

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512


def count_tokens(text: str, tokenizer: str = TOKENIZER, chunk: int = bpe.CHUNK_CHARS, overlap: int = bpe.OVERLAP_CHARS) -> int:
    """Tokens of one text, as the tokenizers library counts them."""
    if len(text) <= chunk:
        return len(bpe.json_ids(text, tokenizer))
    lengths = bpe.byte_lengths(tokenizer.replace(".json", ".tiktoken"))
    return len(bpe.encode_overlapping(text, lambda s: bpe.encode_json(s, tokenizer), lengths, chunk, overlap))


def token_counts(df: DataFrame, text_col: str = "text", tokenizer: str = TOKENIZER, limit: int = LIMIT) -> tuple[DataFrame, dict]:
    """df with one more column, the token count, and expressions for the result by name.

    Rows stay where they are: nothing is shuffled.
    """
    name = fresh(df, "n_tokens")

    @F.pandas_udf("long")
    def counted(texts: pd.Series) -> pd.Series:
        return pd.Series([count_tokens(t, tokenizer) for t in texts], dtype="int64")

    out = df.withColumn(name, counted(text_of(text_col)))
    return out, {
        "n_bytes": F.octet_length(text_of(text_col)).cast("long"),
        "n_tokens": F.col(name),
        "over_limit": F.col(name) > limit,
    }


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    out, made = token_counts(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", *(c.alias(k) for k, c in made.items()))

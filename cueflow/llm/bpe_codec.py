"""Byte-level BPE encoding and decoding by ranks.

Long texts are pre-tokenised in overlapping chunks; neighbours are stitched
where their pre-token boundaries resynchronise at a proven edge, and the pieces
between stitches are then encoded one by one. Decoding concatenates each id's bytes.

Null text is empty text: no ids, the digests of nothing. Repeated rows are
encoded each by itself; an empty table gives an empty result; other columns stay,
also such with the result's names. Texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import documents, fresh, small_batches, text_of

RANKS = "byte_bpe_multi_50k.tiktoken"


@lru_cache(maxsize=None)
def _pattern() -> regex.Pattern:
    return regex.compile(public_tokenizers.PATTERN)


def _boundaries(text: str, lo: int, hi: int) -> list[int]:
    """Starts of pre-tokens in text[lo:hi], as positions in text."""
    return [lo + m.start() for m in _pattern().finditer(text[lo:hi])]


def pieces(text: str, chunk: int = bpe.CHUNK_CHARS, overlap: int = bpe.OVERLAP_CHARS) -> list[str]:
    """Cuts of the text at pre-token boundaries that two overlapping chunks agree on.

    A cut is taken at a boundary of both chunks that is a proven edge. Without
    one the overlap is doubled.
    """
    n, out, begin = len(text), [], 0
    while n - begin > chunk:
        cut, wide = begin + chunk, overlap
        while cut + wide < n:
            lo, hi = max(begin, cut - wide), cut + wide
            left, right = set(_boundaries(text, begin, hi)), set(_boundaries(text, lo, min(n, hi + wide)))
            common = [m.start() for m in bpe.proven_edges().finditer(text, lo + 1, hi) if m.start() in left and m.start() in right]
            if common:
                break
            wide *= 2
        else:
            break
        stitch = min(common, key=lambda b: (abs(b - cut), b))
        out.append(text[begin:stitch])
        begin = stitch
    out.append(text[begin:])
    return out


def encode(text: str, ranks: str = RANKS, chunk: int = bpe.CHUNK_CHARS, overlap: int = bpe.OVERLAP_CHARS) -> list[int]:
    """Ids of the whole text."""
    enc = bpe.rank_encoding(ranks)
    if len(text) <= chunk:
        return enc.encode_ordinary(text)
    out: list[int] = []
    for piece in pieces(text, chunk, overlap):
        out += enc.encode_ordinary(piece)
    return out


def decode(ids: list[int], ranks: str = RANKS) -> bytes:
    """Bytes of the ids, concatenated."""
    return b"".join(map(bpe.token_bytes(ranks).__getitem__, ids))


@lru_cache(maxsize=None)
def _decimals(ranks: str) -> tuple[str, ...]:
    return tuple(map(str, range(len(bpe.token_bytes(ranks)))))


def encoded(df: DataFrame, text_col: str = "text", ranks: str = RANKS) -> tuple[DataFrame, str]:
    """df with the ids of each text (array of int) in a column whose name is returned. No shuffle."""
    name = fresh(df, "ids")

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series([encode(t, ranks) for t in texts])

    return df.withColumn(name, ids(text_of(text_col))), name


def round_trip(df: DataFrame, text_col: str = "text", ranks: str = RANKS) -> tuple[DataFrame, str]:
    """df with a struct of the count and the digests of ids and decoded bytes. No shuffle."""
    name = fresh(df, "codec")

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pd.Series) -> pd.DataFrame:
        decimal = _decimals(ranks)
        rows = []
        for t in texts:
            ids = encode(t, ranks)
            joined = ",".join(map(decimal.__getitem__, ids)).encode()
            rows.append((len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(decode(ids, ranks)).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return df.withColumn(name, digests(text_of(text_col))), name


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    out, name = round_trip(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", f"`{name}`.*")

"""White space of any kind parts words."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from cueflow.functions import text as x
from cueflow.operators.alignment import norm
from cueflow.session import ship

TEXTS = ["a b", " a　b c ", "a\u0085b\x1cc\x0bd", " x ", "été !", "a​b", " ", ""]


def test_cleaning_and_tokens(spark):
    ship(spark)
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = df.select("t", x.cleaned("t").alias("c"), x.match_form("t").alias("m"), x.tokens("t").alias("w"), x.without_markers(F.col("t"), x.LanguageRules()).alias("s")).collect()
    for r in got:
        assert r.w == r.t.split()
        assert r.m == norm(r.t)
        assert r.c.split(" ") == re.sub(r"[^\w\s]", "", "".join(c for c in __import__("unicodedata").normalize("NFD", r.t) if __import__("unicodedata").category(c) != "Mn")).split() or r.c == ""
        assert r.s == r.t.strip()


def test_alphabet(spark):
    df = spark.createDataFrame([("Ab-c'd]\\é",), ("123",), ("",)], "t string")
    assert [r.a for r in df.select(x.in_alphabet("t", "abcd'-]\\^").alias("a")).collect()] == ["ab-c'd]\\", "*", "*"]

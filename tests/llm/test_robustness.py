"""Rows of null ids, very long texts, columns that clash, and verdicts by the learned rules."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cueflow.llm import bpe, bpe_codec, common, cotraining, fingerprints, html_text, near_dups, packing, quality_rules, queries, secret_scan, shards, token_counts

QUERIES = queries.queries()
TOKENIZER = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def long_dir(spark, tmp_path_factory):
    """One text of 300,000 words beside short ones; all ids are null."""
    d = str(tmp_path_factory.mktemp("long"))
    rnd = random.Random(1)
    long = " ".join(f"w{rnd.randrange(9973)}" for _ in range(300_000)) + " token = abcdef123"
    rows = [(None, long, "en", "s", None), (None, long, "en", "s", None), (None, None, None, None, None), (None, "a b\nc", "en", "s", 5)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d, [r[1] or "" for r in rows]


def test_null_ids_and_very_long_texts(spark, long_dir):
    d, texts = long_dir
    tok, enc = bpe.json_tokenizer(TOKENIZER), bpe.rank_encoding(bpe_codec.RANKS)
    n = Counter(len(tok.encode(t, add_special_tokens=False).ids) for t in texts)
    assert Counter(r.n_tokens for r in QUERIES["op6_token_counts"](spark, d).collect()) == n
    want = Counter(hashlib.sha256(",".join(map(str, enc.encode_ordinary(t))).encode()).hexdigest() for t in texts)
    got = QUERIES["op7_bpe_codec"](spark, d).collect()
    assert Counter(r.ids_sha256 for r in got) == want and Counter(r.decoded_sha256 for r in got) == Counter(hashlib.sha256(t.encode()).hexdigest() for t in texts)
    assert Counter(r.n_assign for r in QUERIES["op1_secret_scan"](spark, d).collect()) == Counter([1, 1, 0, 0])
    two = QUERIES["op2_near_dups"](spark, d).collect()
    assert all(r.component_id is None and r.kept for r in two) and Counter(r.n_shingles > 200_000 for r in two) == Counter([True, True, False, False])
    five = QUERIES["op5_packing"](spark, d).collect()
    assert sum(r.length for r in five) == sum(k * c for k, c in n.items()) + 4
    assert Counter(r.n_words for r in QUERIES["op9_quality_rules"](spark, d).collect()) == Counter(len(t.split()) for t in texts)
    assert sorted(r["size"] for r in QUERIES["op8_shards"](spark, d).collect()) == sorted(len(t.encode()) + 1 for t in texts)
    assert Counter(r.n_chars for r in QUERIES["op10_fingerprints"](spark, d).collect()) == Counter(map(len, texts))
    assert len(QUERIES["op4_quality_classifier"](spark, d).collect()) == 4


def test_columns_that_clash(spark, awkward):
    common.small_batches(spark)
    names = ["__n_tokens", "__ids", "__codec", "__quality", "__counts", "__print", "__sketch", "__row", "__secrets", "__paragraphs", "__raw", "__words"]
    df = awkward
    for c in names:
        df = df.withColumn(c, F.lit("keep"))
    kept = lambda out: out.select(*names).distinct().collect() == [tuple(["keep"] * len(names))]
    assert kept(token_counts.token_counts(df)[0]) and kept(bpe_codec.encoded(df)[0]) and kept(bpe_codec.round_trip(df)[0])
    assert kept(cotraining.scored(df, None)[0]) and kept(quality_rules.judged(df, [])[0]) and kept(fingerprints.fingerprinted(df, "text")[0])
    assert kept(secret_scan.find_secrets(df, secret_scan.train([("a" * 20, 0), ("Zk3" * 8, 1)] * 5))[0]) and kept(near_dups.sketches(df, "text", 5)[0])
    assert near_dups.deduplicated(df).columns == df.columns
    n = awkward.count()
    for out in (near_dups.near_duplicates(df), shards.sharded(df), fingerprints.fingerprint_report(df)):
        assert out.count() == n
    assert packing.packed(df).select(F.sum("length")).first() == packing.packed(awkward).select(F.sum("length")).first()
    pages = spark.createDataFrame([(1, "http://h.example/", "<p>a</p>", "keep", "keep")], "page_id long, url string, html string, __main string, __host string")
    out, name = html_text.main_text(pages)
    assert out.select("__main", "__host", name).collect() == [("keep", "keep", "a")]


def test_op9_kept_follows_the_learned_rules(spark, sf_dir):
    """The verdicts of the whole table against the rules applied in Python to features computed in Python."""
    d = sf_dir.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    rules = quality_rules.learn(quality_rules.labelled_rows(docs, spark.read.parquet(f"{d}/labels.parquet")))
    assert rules
    got = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, d).collect()}
    for i, t in docs.collect():
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        r = got[i]
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        count = lambda chars: sum(t.count(c) for c in chars)  # noqa: B023, E731
        ratio = lambda a, b: a / max(b, 1.0)
        x = {
            "symbol_ratio": ratio(r.n_symbols, r.word_chars), "mark_ratio": ratio(count("!?"), r.word_chars), "bar_ratio": ratio(count("|"), len(w)),
            "upper_ratio": ratio(sum("A" <= c <= "Z" for c in t), r.word_chars), "digit_ratio": ratio(sum("0" <= c <= "9" for c in t), r.word_chars), "stop_ratio": ratio(count("."), len(w)),
            "dup_line_ratio": ratio(r.n_dup_lines, len(lines)), "repeat_ratio": ratio(r.n_repeat_words, len(w)), "distinct_ratio": ratio(len(set(w)), len(w)),
            "word_length": ratio(r.word_chars, len(w)), "n_words": len(w),
        }
        hit = next((k + 1 for k, rule in enumerate(rules) if all(x[f] >= c if ge else x[f] < c for f, ge, c in rule)), None)
        assert (r.rule, r.kept) == (hit, not r.base_failed and hit is None), i

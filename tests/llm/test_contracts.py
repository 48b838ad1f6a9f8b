"""Every corpus query on awkward and empty tables, and against brute force on small ones."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cueflow.llm import bpe, bpe_codec, near_dups, quality_rules, queries

QUERIES = queries.queries()


def read(sf_dir: str, table: str = "documents") -> list[tuple]:
    import pyarrow.parquet as pq

    return [tuple(r.values()) for r in pq.read_table(f"{sf_dir}/{table}.parquet").to_pylist()]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_awkward(spark, awkward_dir, name):
    rows = QUERIES[name](spark, awkward_dir).collect()
    if name not in ("op3_html_text", "pipeline", "op5_packing"):
        assert len(rows) == 19
    assert rows or name == "pipeline"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []


def test_op1_base(spark, awkward_dir, sf_dir):
    for d in (awkward_dir, sf_dir):
        got = {r.doc_id: r for r in QUERIES["op1_secret_scan"](spark, d).collect() if r.doc_id is not None}
        for i, text, *_ in read(d):
            if i is None:
                continue
            text = text or ""
            spans = [(m.start(), 0, "assign", m.end()) for m in re.finditer(r"""(?a:(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", text) if len(m[1]) >= 6]
            spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
            spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
            shown = [f"{k}:{a}:{b}" for a, _, k, b in sorted(spans)]
            assert got[i].base_sha256 == hashlib.sha256(",".join(shown).encode()).hexdigest()
            assert set(shown) <= set(got[i].spans.split(","))
            assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(Counter(k for _, _, k, _ in spans)[k] for k in ("assign", "access", "hex"))


def brute_components(rows: list[tuple], size: int) -> dict:
    sets = {}
    for i, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_op2_brute_force(spark, awkward_dir, sf_dir):
    for d in (awkward_dir, sf_dir):
        want = brute_components([r for r in read(d) if r[0] is not None], 4)
        got = [r for r in QUERIES["op2_near_dups"](spark, d).collect() if r.doc_id is not None]
        for r in got:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)


def test_op2_large_near_group_in_blocks(spark, monkeypatch):
    """A chain of near copies whose ends are far apart, with blocks of a few nodes."""
    monkeypatch.setattr(near_dups, "BLOCK", 7)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(60):
        w = list(base)
        w[2 * k : 2 * k + 1] = [f"x{k}"]
        base = w
        rows.append((k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows, 4)
    got = {r.doc_id: r.component_id for r in near_dups.near_duplicates(df, size=4).collect()}
    assert got == {i: c for i, (_, c) in want.items()}


def test_op2_estimate():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        both = rng.integers(0, 2**63, int(4000 * share), dtype=np.uint64)
        rest = rng.integers(0, 2**63, 8000, dtype=np.uint64) * np.uint64(2)
        n = (4000 - len(both)) // 2
        a, b = (np.unique(np.concatenate([both * np.uint64(2) + np.uint64(1), x])) for x in (rest[:n], rest[n : 2 * n]))
        value, _ = near_dups.estimate(near_dups.registers(a), near_dups.registers(b), len(a), len(b))
        assert abs(value - share) < 0.2


def test_op4_held_out(spark, sf_dir):
    d = sf_dir.replace("0.001", "0.01")
    got = {r.doc_id: r.kept for r in QUERIES["op4_quality_classifier"](spark, d).collect()}
    labels = [(i, q) for i, q, _ in read(d, "labels")]
    assert sum(got[i] for i, q in labels if q) >= 0.98 * sum(q for _, q in labels)
    assert sum(not got[i] for i, q in labels if not q) >= 0.8 * sum(1 - q for _, q in labels)


def test_op5_round_trip(spark, awkward_dir, sf_dir):
    tok = bpe.json_tokenizer("byte_bpe_50k.json")
    for d in (sf_dir, awkward_dir):
        rows = QUERIES["op5_packing"](spark, d).collect()
        ids = {i: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t, *_ in read(d) if i is not None}
        seen: dict = {}
        for r in rows:
            if r.doc_id is None:
                continue
            x = ids[r.doc_id]
            assert r.doc_tokens == len(x) and r.ids_crc32 == zlib.crc32(x[r.start : r.start + r.length].tobytes())
            seen.setdefault(r.doc_id, Counter()).update(range(r.start, r.start + r.length))
        copies = Counter(r[0] for r in read(d))
        assert all(seen[i] == Counter({k: copies[i] for k in range(len(x))}) for i, x in ids.items())
        by: dict = {}
        for r in rows:
            by.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for pieces in by.values():
            at = 0
            for o, n in sorted(pieces):
                assert o == at
                at += n
            assert at <= 2048 and at & (at - 1) == 0


def test_op6_and_op7(spark, awkward_dir, sf_dir):
    tok, enc = bpe.json_tokenizer("byte_bpe_50k.json"), bpe.rank_encoding(bpe_codec.RANKS)
    for d in (awkward_dir, sf_dir):
        six = {r.doc_id: r for r in QUERIES["op6_token_counts"](spark, d).collect()}
        seven = {r.doc_id: r for r in QUERIES["op7_bpe_codec"](spark, d).collect()}
        for i, t, *_ in read(d):
            if i is None:
                continue
            t = t or ""
            n = len(tok.encode(t, add_special_tokens=False).ids)
            assert (six[i].n_bytes, six[i].n_tokens, six[i].over_limit) == (len(t.encode()), n, n > 512)
            ids = enc.encode_ordinary(t)
            assert (seven[i].n_tokens, seven[i].ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
            assert seven[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


@pytest.mark.parametrize("chunk,overlap", [(40, 4), (300, 10), (2000, 1)])
def test_overlaps(chunk, overlap, sf_dir):
    tok, enc = bpe.json_tokenizer("byte_bpe_50k.json"), bpe.rank_encoding(bpe_codec.RANKS)
    lengths = bpe.byte_lengths("byte_bpe_50k.tiktoken")
    texts = [t for _, t, *_ in read(sf_dir)][:40] + ["a" * 3000, " " * 500, "x \n \n y " * 100, "é🙂 " * 200, "a<|endoftext|> b " * 80, "word " * 300 + "🙂"]
    for t in texts:
        assert bpe.encode_overlapping(t, bpe.encode_json, lengths, chunk, overlap).tolist() == tok.encode(t, add_special_tokens=False).ids
        assert bpe_codec.encode(t, chunk=chunk, overlap=overlap) == enc.encode_ordinary(t)
        assert "".join(bpe_codec.pieces(t, chunk, overlap)) == t


def test_op8_law(spark, awkward_dir, sf_dir):
    from cueflow.llm import shards

    for d, small in ((sf_dir, False), (awkward_dir, True)):
        df = spark.read.parquet(f"{d}/documents.parquet")
        rows = (shards.sharded(df, range_rows=3) if small else QUERIES["op8_shards"](spark, d)).collect()
        want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in read(d))
        assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
        total, most = sum(r["size"] for r in rows), max(r["size"] for r in rows)
        for s in range(8):
            own = [r for r in rows if r.shard == s]
            assert sorted(r.slot for r in own) == list(range(len(own)))
            assert abs(sum(r["size"] for r in own) - total / 8) <= most


def test_op9_counts(spark, awkward_dir, sf_dir):
    for d in (awkward_dir, sf_dir):
        got = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, d).collect()}
        for i, t, *_ in read(d):
            if i is None:
                continue
            w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
            tri = [*zip(w, w[1:], w[2:], strict=False)]
            n, twice = Counter(tri), set()
            for k, x in enumerate(tri):
                if n[x] > 1:
                    twice |= {k, k + 1, k + 2}
            lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
            r = got[i]
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(twice)), i
            assert r.base_failed == (len(w) < 50 or 100 * len(twice) > 50 * len(w))
            assert not (r.base_failed and r.kept)


def test_op9_learning():
    row = lambda s, n, bad: quality_rules._Row(dict.fromkeys(quality_rules.FEATURES, 0.0) | {"symbol_ratio": s, "n_words": n}, bad)
    rows = [row(0.3 + k / 1000, 100, True) for k in range(40)] + [row(0.01 + k / 1000, 100, False) for k in range(80)] + [row(0.02, 900 + k, True) for k in range(30)]
    rules = quality_rules.learn(rows)
    hit = [any(quality_rules._meets(r, x) for x in rules) for r in rows]
    assert hit == [r.bad for r in rows]
    assert quality_rules.learn([r for r in rows if not r.bad]) == []


def test_op10_edited(spark, awkward_dir, sf_dir):
    for d in (sf_dir,):
        rows = sorted((i, t or "") for i, t, *_ in read(d))
        got = {r.doc_id: r for r in QUERIES["op10_fingerprints"](spark, d).collect()}
        prints: dict = {}
        for k, (i, t) in enumerate(rows):
            n = len(t) // 4
            e = t[: len(t) - n] + rows[(k + 1) % len(rows)][1][:n]
            r = got[i]
            assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
            assert prints.setdefault(t, r.fingerprint) == r.fingerprint
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert len(set(prints.values())) == len(prints)
        assert np.mean([r.near_edited for r in got.values()]) > 0.5 > 0.1 > np.mean([r.near_next for r in got.values()])


def test_op10_homomorphic(spark):
    from pyspark.sql import functions as F

    from cueflow.llm import fingerprints as f

    df = spark.createDataFrame([("a. b\nc d e", "f g\nh", "f g\nh\na. b\nc d e", "h\na. b\nf g\nc d e")], "x string, y string, both string, mixed string")
    for c in df.columns:
        df, name = f.fingerprinted(df, c)
        df = df.withColumnRenamed(name, f"p_{c}")
    r = df.select(f.combined("p_x", "p_y").alias("sum"), "p_both", "p_mixed", "p_x", "p_y").first()
    assert r["sum"] == r.p_both == r.p_mixed != r.p_x
    back = df.select(f.combined("p_both", "p_y", -1).alias("d"), F.col("p_x")).first()
    assert back.d == back.p_x


def test_op3_pages(spark, awkward_dir):
    from cueflow.llm.html_text import extract

    got = {r.page_id: r.text for r in QUERIES["op3_html_text"](spark, awkward_dir).collect()}
    assert got == {1: "a & b", 2: "", None: ""}
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>H</header><nav><a href=x>menu</a></nav>
    <div class="cookie-notice">We use cookies</div><aside>side</aside><main><h1>Title</h1><p>One <b>two</b><br>three<p>Four&nbsp;five
    <script>var t="</p>";</script><form>name</form></p><div class="ad">buy</div></main><section id="comments"><p>nice</p></section><footer>F</footer></body></html>"""
    assert extract(page) == "Title\n\nOne two three\n\nFour five"
    assert extract("plain <b>text</b> only") == "plain text only"
    assert extract("<p>a</p><p>unclosed <i>b") == "a\n\nunclosed b"


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rules = docs.count()
    columns = docs.columns
    for name, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns, name
        assert 0 < docs.count() <= rules
        rules = docs.count()
    assert not [r for r in docs.collect() if re.search(r"token = .?[0-9a-f]{20}", r.text)]
    pieces = p.packing_stage(spark, docs, sf_dir)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in docs.collect()}


def test_clashing_columns(spark, awkward):
    from cueflow.llm import bpe_codec, secret_scan, token_counts

    out, _ = token_counts.token_counts(awkward.withColumn("__n_tokens", awkward.doc_id))
    assert out.count() == 19
    out, name = secret_scan.find_secrets(awkward.withColumn("__secrets", awkward.doc_id), secret_scan.fit_on(awkward))
    assert name != "__secrets" and out.count() == 19
    out, name = bpe_codec.encoded(awkward)
    assert all(bpe_codec.decode(list(r[name])) == (r.text or "").encode() for r in out.collect())


def test_op3_hostile_pages():
    from cueflow.llm.html_text import blocks, extract

    assert extract('<p title="a<b">x</p>') == "x"
    assert len(extract('<a "' * 20_000)) == 80_000
    deep = "<div>" * 5_000 + "<p>deep</p>"
    assert extract(deep) == "deep" and max(len(p) for p, _, _ in blocks(deep)) < 1_000

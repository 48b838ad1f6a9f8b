"""Near duplicates by HyperMinHash: banded compressed registers, corrected estimates, exact confirmation.

A document's set holds its distinct word shingles (words are runs without ASCII
white space, A-Z lower-cased). Equal sets collapse to one *node* first. A node's
sketch has one 16-bit register for each of 128 buckets: the leading-zero count
and ten mantissa bits of the least hash that fell in the bucket, zero for an
empty one. Four registers make a band; nodes that agree on a band (not an empty
one) become candidates:

1. Each node of a band goes against the band's least node, so that a band of n
   nodes makes n-1 pairs. Pairs pass an estimate of the similarity, corrected
   for registers that agree by chance, with five standard errors of slack; the
   rest are confirmed on their full sets and connected.
2. Bands that still hold nodes of different components are merged into groups
   by their largest component. A group of at most BLOCK nodes compares its
   sketches in one task, and then the full sets of the nodes that have a likely
   partner. The nodes of larger groups are grouped anew, by the shingles of
   their prefixes: all shingles are set in one order, frequent ones last, and two
   sets at the threshold share one of the first fifth of each. So documents that
   only have frequent passages in common part ways, at a cost in proportion to
   their sets. Full sets are compared in blocks of bounded nodes and bytes; a
   block returns the links that connect it, not its pairs. So each pair of nodes
   of a band is confirmed, refuted, or already connected. Only groups of sets
   that nearly all come near the threshold with each other need more than one block.

Two sets at a similarity of exactly 0.8 share none of the 32 bands with a
probability of (1 - 0.8 ** 4) ** 32 = 5e-8, and less above it.

Null text is empty text; documents without words have an empty set and are
linked with nothing. Repeated rows are kept, each with its own result row; rows
with a null id take part, and a component whose ids are all null has a null
id (kept is then true). Very long texts are read whole. An empty table gives an empty
result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, fresh, small_batches, stash, text_of

BUCKETS, BAND, BANDS = 128, 4, 32
MANTISSA_BITS = 10
PERCENT = 80
#: Standard errors by which an estimate may fall short of the threshold.
SLACK = 5.0
#: Nodes of a block, and bytes of their full sets, about; a task holds two blocks.
BLOCK, BLOCK_BYTES = 500, 16 << 20
#: Counters for the frequency of shingles, by hash; their number bounds what the driver holds.
COUNTERS = 1 << 14
#: Rows wanted from the documents are broadcast up to this number, else joined with a shuffle.
BROADCAST_ROWS = 400_000
#: Word hashes kept in a worker at a time.
CACHE_WORDS = 1 << 15


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


@lru_cache(maxsize=1)
def _word_hashes() -> _WordHashes:
    return _WordHashes()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; the whole sequence is one if it is shorter."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only ASCII is lowered, only ASCII white space splits
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_word_hashes().__getitem__, words), np.uint64, len(words))
    k = min(size, len(w))
    h = np.full(len(w) - k + 1, 0x9E3779B97F4A7C15 ^ k, np.uint64)
    for i in range(k):
        h = _mixed(h ^ w[i : len(w) - k + 1 + i])
    return np.unique(h)


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set: 6 bits of leading zeros plus one, 10 of mantissa; 0 is empty."""
    out = np.zeros(BUCKETS, np.uint16)
    if len(hashes):
        shift = np.uint64(64 - BUCKETS.bit_length() + 1)
        bucket = (hashes >> shift).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))  # the least hash of each bucket
        rest = ((hashes[first] << (np.uint64(64) - shift)) >> np.uint64(11)).astype(np.float64)  # 53 bits
        fraction, exponent = np.frexp(rest)
        zeros = np.where(rest > 0, 53 - exponent, 53)
        mantissa = np.where(rest > 0, (fraction * 2 - 1) * (1 << MANTISSA_BITS), 0)
        out[bucket[first]] = ((zeros.astype(np.int64) + 1) << MANTISSA_BITS) | mantissa.astype(np.int64)
    return out


@lru_cache(maxsize=4096)
def _chance(na: int, nb: int) -> float:
    """Probability that the registers of two unrelated sets agree in a bucket that both fill."""
    a, b = max(1.0, na / BUCKETS), max(1.0, nb / BUCKETS)
    z = np.arange(0, 54)
    lo, hi = 2.0 ** -(z + 1), 2.0 ** -z.astype(float)  # least hash in [lo, hi): z leading zeros
    cells = 1 << MANTISSA_BITS
    p = lambda n: np.exp(-n * lo) - np.exp(-n * hi)
    return float((p(a) * p(b)).sum() / cells)


def estimate(a: np.ndarray, b: np.ndarray, na: int, nb: int) -> tuple[float, int]:
    """Similarity from two sketches, less what agrees by chance, and the buckets that it rests on."""
    filled = int(((a | b) > 0).sum())
    if not filled:
        return 0.0, 0
    agree = float(((a == b) & (a > 0)).sum()) / filled
    chance = _chance(1 << na.bit_length(), 1 << nb.bit_length())
    return max(0.0, (agree - chance) / (1 - chance)), filled


def may_link(a: np.ndarray, b: np.ndarray, na: int, nb: int, percent: int = PERCENT) -> bool:
    """Whether the estimate leaves a link possible: sizes and sketch."""
    if 100 * min(na, nb) < percent * max(na, nb):
        return False
    t = percent / 100
    value, filled = estimate(a, b, na, nb)
    return value >= t - SLACK * (t * (1 - t) / max(1, filled)) ** 0.5


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """100 * intersection >= percent * union, on full sorted sets."""
    if not len(a) or not len(b):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketches(df: DataFrame, text_col: str, size: int) -> tuple[DataFrame, str]:
    """df with struct(n, node, sketch): set size, digest of the set, registers."""
    name = fresh(df, "sketch")

    @F.pandas_udf("n long, node binary, sketch binary")
    def made(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            s = shingle_set(t, size)
            rows.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), registers(s).tobytes()))
        return pd.DataFrame(rows, columns=["n", "node", "sketch"])

    return df.withColumn(name, made(text_of(text_col))), name


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sketches leave a link possible."""

    @F.pandas_udf("boolean")
    def may(sa: pd.Series, sb: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        read = lambda x: np.frombuffer(x, np.uint16)
        return pd.Series([may_link(read(x), read(y), int(i), int(j), percent) for x, y, i, j in zip(sa, sb, na, nb, strict=True)], dtype=bool)

    side = lambda k: nodes.select(F.col("node").alias(k), F.col("sketch").alias(f"s{k}"), F.col("n").alias(f"n{k}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(may("sa", "sb", "na", "nb")).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that are linked on their full sets."""

    @F.pandas_udf("boolean")
    def exact(xa: pd.Series, xb: pd.Series) -> pd.Series:
        return pd.Series([linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(xa, xb, strict=True)], dtype=bool)

    side = lambda k: sets.select(F.col("node").alias(k), F.col("set").alias(f"x{k}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(exact("xa", "xb")).select("a", "b")


def _full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(node, set) of the wanted nodes, from the whole text of one row of each; written to the shared folder."""

    @F.pandas_udf("binary")
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, size).tobytes() for t in texts])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text")).withColumn("key", F.xxhash64("text"))
    wanted = _hinted(wanted.select("node", F.col("row.key").alias("wkey"), F.col("row.id").alias("wid")))  # some tens of bytes each
    found = rows.join(wanted, (rows.key == wanted.wkey) & rows.id.eqNullSafe(wanted.wid)).select("node", made("text").alias("set"))
    return stash(found.groupBy("node").agg(F.first("set").alias("set")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node with an edge: the least node that it is connected with.

    Large-star and small-star steps in turn, each written to the shared folder,
    until nothing changes; the number of steps grows with the logarithm of the
    longest path. Nothing is collected but two numbers a step.
    """
    edges = stash(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct())
    seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while seen[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that the join shuffles both sides and a node with very many neighbours can be split
        least = stash(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select("u", F.col("m").alias("v")).union(small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = stash(small.where("u > v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v"), F.col("v")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = PERCENT) -> DataFrame:
    """One row for each row of docs: id, n_shingles, component_id, kept. See the module's docstring."""
    made, name = sketches(docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text")), "text", size)
    rows = stash(made.select("id", F.xxhash64("text").alias("key"), F.col(f"{name}.n").alias("n"), F.col(f"{name}.node").alias("digest"), F.col(f"{name}.sketch").alias("sketch")))
    full = rows.where("n > 0")
    nodes = full.groupBy("digest").agg(F.min("id").alias("label"), F.min(F.struct("id", "key")).alias("row"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    nodes = stash(nodes.withColumn("node", F.monotonically_increasing_id()))  # numbered once, as written
    roots = components(_edges(docs, nodes, id_col, text_col, size, percent))
    ids = nodes.select("node", "label").join(roots, "node").select("node", "root", "label")
    found = ids.join(ids.groupBy("root").agg(F.min("label").alias("component_id")), "root").select("node", F.col("component_id").alias("joined"))
    own = nodes.select("node", "digest", "label").join(found, "node", "left").select("digest", F.coalesce("joined", "label").alias("component_id"))
    out = full.select("id", "n", "digest").join(own, "digest").select("id", "n", "component_id")
    out = out.unionByName(rows.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = PERCENT) -> DataFrame:
    """docs with one row of each group: the one with the least id, nulls last; of equal ids, one of the rows.

    Rows are numbered as they are written, and go by number: an id that is null,
    repeated, or shared by different texts takes no other row with it. Rows
    without words are linked with nothing and stay. Columns are those of docs.
    """
    row = fresh(docs, "row")
    docs_ = stash(docs.withColumn(row, F.monotonically_increasing_id()))
    key = F.struct(F.col(f"`{id_col}`").isNull().alias("unknown"), F.col(f"`{id_col}`").alias("id"), F.col(row).alias("row"))
    found = near_duplicates(docs_.select(key.alias("key"), text_of(text_col).alias("text")), "key", "text", size, percent)
    gone = found.where(~F.col("kept")).select(F.col("key.row").alias(row))
    return docs_.join(gone, row, "left_anti").select(*(f"`{c}`" for c in docs.columns))


def _edges(docs, nodes, id_col, text_col, size, percent) -> DataFrame:
    """Confirmed links (a, b) between nodes, enough of them to connect all that are linked."""
    width = 2 * BAND
    band = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.substring("sketch", i * width + 1, width).alias("r")) for i in range(BANDS)))).alias("band")
    bands = nodes.select("node", band).where(F.col("band.r") != F.lit(bytes(width))).select("node", F.xxhash64("band.i", "band.r").alias("key"))
    # written, so that the join shuffles both sides and a band with very many nodes can be split
    least = stash(bands.groupBy("key").agg(F.min("node").alias("least"), F.count("*").alias("members")).where("members > 1").select("key", "least"))
    shared = stash(bands.join(least, "key"))
    row = lambda x: nodes.select("node", "row").join(x, "node", "left_semi")

    pairs = shared.where("node > least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    likely = stash(_likely(pairs, nodes, percent))
    known = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    sets = _full_sets(docs, row(known), id_col, text_col, size)
    edges = stash(_confirmed(likely, sets, percent))

    roots = components(edges)
    placed = shared.select("key", "node").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    placed = stash(placed)
    groups = stash(_mixed_groups(placed))
    large = _hinted(groups.groupBy("major").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select("major"))
    few = groups.join(large, "major", "left_anti").join(nodes.select("node", "sketch", "n"), "node")
    few = few.withColumn("bytes", F.lit(0).cast("long"))
    late = _in_blocks(few, "node long, root long, sketch binary, n long", _likely_nodes(percent), "major long, node long, root long").distinct()
    many = stash(groups.join(large, "major", "left_semi").select("node", "root").distinct())

    late = stash(late)
    known = late.select("node").union(many.select("node")).distinct().join(sets, "node", "left_anti")
    sets = sets.unionByName(_full_sets(docs, row(known), id_col, text_col, size))
    if not many.isEmpty():
        late = late.unionByName(_prefix_groups(many.join(sets, "node"), percent).withColumn("major", -1 - F.col("major")))
    late = late.join(sets, "node").withColumn("bytes", F.octet_length("set").cast("long"))
    return edges.unionByName(stash(_in_blocks(late, "node long, root long, set binary", _block_links(percent), "a long, b long")))


def _hinted(df: DataFrame) -> DataFrame:
    """df written; broadcast where it is short."""
    df = stash(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _mixed_groups(placed: DataFrame) -> DataFrame:
    """(major, node, root) from (key, node, root): keys of more than one component, merged by the largest of them."""
    mixed = placed.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("major"), F.count("*").alias("roots")).where("roots > 1").select("key", "major")
    # written, so that the join shuffles both sides and a key with very many nodes can be split
    return placed.join(stash(mixed), "key").select("major", "node", "root").distinct()


def prefix_size(n: int, percent: int) -> int:
    """Shingles of a set of n, the first in any common order, of which two sets at the threshold share one."""
    return n - -(-percent * n // 100) + 1


def _prefix_groups(members: DataFrame, percent: int) -> DataFrame:
    """(major, node, root) of members (node, root, set) that share a shingle of their prefixes with another component."""
    spark = members.sparkSession

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for x in batch["set"]:
                total += np.bincount((np.frombuffer(x, np.uint64) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        yield pd.DataFrame({"part": [TaskContext.get().partitionId() % 32], "counts": [total.tobytes()]})

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum((np.frombuffer(x, np.int64) for x in pdf["counts"]), np.zeros(COUNTERS, np.int64))
        return pd.DataFrame({"counts": [total.tobytes()]})

    # one row a task, then at most 32 for the driver
    rows = members.select("set").mapInPandas(count, "part int, counts binary").groupBy("part").applyInPandas(added, "counts binary").collect()
    total = sum((np.frombuffer(r.counts, np.int64) for r in rows), np.zeros(COUNTERS, np.int64))
    held = spark.sparkContext.broadcast(total)

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        often = held.value
        for batch in batches:
            keys, sizes = [], []
            for x in batch["set"]:
                h = np.frombuffer(x, np.uint64)
                order = np.argsort(often[(h % np.uint64(COUNTERS)).astype(np.int64)], kind="stable")  # ties by hash, as the set is sorted
                mine = h[order[: prefix_size(len(h), percent)]]
                keys.append(mine.view(np.int64))
                sizes.append(len(mine))
            if keys:
                yield pd.DataFrame({"key": np.concatenate(keys), "node": np.repeat(batch["node"].to_numpy(), sizes), "root": np.repeat(batch["root"].to_numpy(), sizes)})

    return _mixed_groups(stash(members.select("node", "root", "set").mapInPandas(first, "key long, node long, root long")))


def _in_blocks(groups: DataFrame, schema: str, one: Callable[..., dict[str, np.ndarray]], out: str) -> DataFrame:
    """``one`` over each pair of blocks of each group (column major); blocks hold about BLOCK nodes and BLOCK_BYTES (column bytes) at most.

    Rows are dealt by (group, block pair) and sorted, and a task reads its
    groups as a stream; it holds two blocks at a time, however large a group is.
    ``one`` gets the number of nodes of the first block, with which those of the
    second are compared; a block with itself has all of them in the first.
    """
    names = [x.split()[0] for x in schema.split(", ")]
    need = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("bytes") / BLOCK_BYTES)).cast("int")
    # groups of more than one block: few, and without their rows dealt to one task
    blocks = _hinted(groups.groupBy("major").agg(need.alias("blocks")).where("blocks > 1"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int")
    dealt = groups.join(blocks, "major", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("major", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", *names)
    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n, "major", "p", "q").sortWithinPartitions("major", "p", "q", "own", "node")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (major, p, _), cols in _groups(batches, ["major", "p", "q"], ["own", *names]):
            first = int((cols["own"] == p).sum())
            if len(cols["node"]) > 1 and first:
                found = one(major, cols, first)
                if len(next(iter(found.values()))):
                    yield pd.DataFrame(found)

    return dealt.mapInPandas(run, out)


def _groups(batches: Iterator[pd.DataFrame], keys: list[str], names: list[str]) -> Iterator[tuple[tuple, dict[str, np.ndarray]]]:
    """Runs of equal keys in sorted batches, as arrays by column."""
    held: list[dict[str, np.ndarray]] = []
    last: tuple | None = None
    whole = lambda: {c: np.concatenate([x[c] for x in held]) if len(held) > 1 else held[0][c] for c in names}
    for batch in batches:
        if not len(batch):
            continue
        k = batch[keys].to_numpy()
        cols = {c: batch[c].to_numpy() for c in names}
        starts = np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1, [len(k)]])
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            key = tuple(k[lo].tolist())
            if last is not None and key != last:
                yield last, whole()
                held = []
            held.append({c: v[lo:hi] for c, v in cols.items()})
            last = key
    if held:
        yield last, whole()


def _likely_nodes(percent: int) -> Callable[..., dict[str, np.ndarray]]:
    """Nodes of a group that have a likely partner of another component: sizes and registers, as in may_link."""
    t = percent / 100

    def one(major: int, cols: dict[str, np.ndarray], _: int) -> dict[str, np.ndarray]:
        sketch = np.frombuffer(b"".join(cols["sketch"]), np.uint16).reshape(len(cols["node"]), BUCKETS)
        n, root = cols["n"].astype(np.int64), cols["root"]
        keep = np.zeros(len(n), bool)
        for i in range(len(n) - 1):
            js = np.flatnonzero((root[i + 1 :] != root[i]) & (100 * np.minimum(n[i + 1 :], n[i]) >= percent * np.maximum(n[i + 1 :], n[i]))) + i + 1
            if len(js):
                a, b = sketch[i], sketch[js]
                filled = np.maximum(1, ((a | b) > 0).sum(axis=1))
                agree = ((a == b) & (a > 0)).sum(axis=1) / filled  # at least the corrected value
                hit = js[agree >= t - SLACK * np.sqrt(t * (1 - t) / filled)]
                if len(hit):
                    keep[i] = keep[hit] = True
        at = np.flatnonzero(keep)
        return {"major": np.full(len(at), major, np.int64), "node": cols["node"][at], "root": root[at]}

    return one


def _block_links(percent: int) -> Callable[..., dict[str, np.ndarray]]:
    """Links that connect the components of a block pair: shared shingles are counted through an inverted index of the first block."""

    def one(_: int, cols: dict[str, np.ndarray], first: int) -> dict[str, np.ndarray]:
        sets = [np.frombuffer(x, np.uint64) for x in cols["set"]]
        sizes = np.array([len(x) for x in sets], np.int64)
        owner = np.repeat(np.arange(first), sizes[:first])
        values, term = np.unique(np.concatenate(sets[:first]), return_inverse=True)
        order = np.argsort(term, kind="stable")
        postings, begin = owner[order], np.searchsorted(term[order], np.arange(len(values) + 1))
        parent = {r: r for r in cols["root"].tolist()}

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out: list[tuple[int, int]] = []
        itself = first == len(sets)
        for i in range(1 if itself else first, len(sets)):
            upto = i if itself else first
            at = np.minimum(np.searchsorted(values, sets[i]), len(values) - 1)
            at = at[values[at] == sets[i]]
            if not len(at):
                continue
            both = np.bincount(np.concatenate([postings[begin[x] : begin[x + 1]] for x in at.tolist()]), minlength=first)[:upto]
            for j in np.flatnonzero(100 * both >= percent * (sizes[i] + sizes[:upto] - both)).tolist():
                a, b = find(int(cols["root"][i])), find(int(cols["root"][j]))
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    out.append((int(cols["node"][i]), int(cols["node"][j])))
        return {"a": np.array([x for x, _ in out], np.int64), "b": np.array([y for _, y in out], np.int64)}

    return one


def op2_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return near_duplicates(documents(spark, sf_dir), size=4)

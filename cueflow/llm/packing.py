"""Packing by lexical retrieval: a sharded BM25 index fills each window with a seed's unused neighbours.

Documents are tokenised; document frequencies and the mean length are counted
over all of them. They are then set in a line by a sketch of their ids (minimum
hashes, weighted by rarity), and the line is cut into ranges and shards of bounded size, so
that related documents and copies tend to stand in one shard; what is lost is in
the README. Each shard gets an inverted index over its token ids, queried with
all ids of the seed.
Windows are filled one after the other: the
rest of the document that was cut last, else the next unused document, is the
seed; its unused neighbours follow in the order of their BM25 scores until the
window is full; the last one is cut. A shard's final window is cut into
sequences whose lengths are powers of two, which need no padding.

Null text is empty text: one id, the end-of-document id. Repeated rows are
packed each by itself. Very long documents run through as many windows as they
need. An empty table gives an empty result. Documents of a hot minimum are told
apart by the next ones, then by their text, and copies of one text by row. Other
columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import documents, small_batches, stash, text_of
from .shards import SAMPLES_PER_RANGE

WINDOW = 2048
TOKENIZER = "byte_bpe_50k.json"
END_ID = 1
#: Text in a shard, about; a shard's ids are held by one task.
SHARD_BYTES = 8 << 20
#: Ids are below this number; larger vocabularies are refused.
IDS = 1 << 16
#: Ranges of the line at most, so that what the driver holds is bounded; a task cuts its ranges into shards as it reads them.
MAX_RANGES = 1 << 13
#: Shards that one task packs one after the other, about.
SHARDS_PER_TASK = 16
#: Minima that place a document on the line.
KEY_TERMS = 3
#: Neighbours that are put in order at a time.
NEIGHBOURS = 32
#: Terms in more than this share of a shard's documents are kept as rows of a matrix.
DENSE = 0.3
K1, B = 1.2, 0.75

#: (document, start, length, sequence, offset)
Piece = tuple[int, int, int, int, int]


@dataclass(frozen=True)
class Stats:
    """Of all documents: number, mean length, and document frequency by id."""

    n: int
    mean: float
    df: np.ndarray

    @staticmethod
    def of(docs: list[np.ndarray]) -> Stats:
        df, last = np.zeros(IDS, np.int64), np.empty(IDS, np.int64)
        for d in docs:
            at = np.arange(len(d))
            last[d] = at
            df[d[last[d] == at]] += 1  # each id once, where it stands last
        return Stats(len(docs), sum(map(len, docs)) / max(1, len(docs)), df)

    def ranks(self) -> np.ndarray:
        """Seeded order of all ids in which rare ones tend to come early; ids of a single document, which nothing shares, come last.

        The first id of a document in it is a weighted minimum hash: two documents
        agree in it with a chance of the share of their weight that is common.
        """
        idf = np.log1p((self.n - self.df + 0.5) / (self.df + 0.5))
        draw = -np.log(np.random.default_rng(5).random(IDS)) / np.maximum(idf, 1e-9) ** 2
        order = np.lexsort((draw, self.df < 2))
        rank = np.empty(IDS, np.int64)
        rank[order] = np.arange(IDS)
        return rank


def distinct(ids: np.ndarray) -> np.ndarray:
    """Distinct ids, ascending."""
    x = np.sort(ids, kind="stable")  # 16 bits: by radix
    return x[np.concatenate([[True], x[1:] != x[:-1]])]


class Index:
    """Inverted index of one shard: postings by term, with BM25 weights by the statistics of all documents."""

    def __init__(self, docs: list[np.ndarray], stats: Stats):
        self.n = len(docs)
        size = np.array([len(d) for d in docs], np.int64)
        pair = np.repeat(np.arange(self.n, dtype=np.int64), size) << 16 | (np.concatenate(docs).astype(np.int64) if docs else np.empty(0, np.int64))
        pair, tf = np.unique(pair, return_counts=True)
        owner, term = pair >> 16, pair & (IDS - 1)
        norm = K1 * (1 - B + B * size / max(1.0, stats.mean))
        order = np.argsort(term.astype(np.uint16), kind="stable")  # 16 bits: sorted by radix
        self.vocabulary, first, df = np.unique(term[order], return_index=True, return_counts=True)
        every = stats.df[self.vocabulary]
        idf = np.log1p((stats.n - every + 0.5) / (every + 0.5))
        self.owner = owner[order]
        self.weight = (tf * (K1 + 1) / (tf + norm[owner]))[order] * np.repeat(idf, df)
        self.begin, self.end = first, first + df
        common = np.flatnonzero(df > DENSE * self.n)
        self.row = np.full(len(df), -1)
        self.row[common] = np.arange(len(common))
        self.dense = np.zeros((len(common), self.n), np.float32)
        for r, t in enumerate(common.tolist()):
            a, b = self.begin[t], self.end[t]
            self.dense[r, self.owner[a:b]] = self.weight[a:b]

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """BM25 of every document of the index for distinct terms."""
        at = np.searchsorted(self.vocabulary, terms)
        at = at[self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == terms] if len(self.vocabulary) else at[:0]
        row = self.row[at]
        rare = at[row < 0]
        cuts = [slice(a, b) for a, b in zip(self.begin[rare].tolist(), self.end[rare].tolist(), strict=True)]
        asked = np.zeros(len(self.dense), np.float32)
        asked[row[row >= 0]] = 1.0
        score = (asked @ self.dense).astype(np.float64)
        if cuts:
            score += np.bincount(np.concatenate([self.owner[c] for c in cuts]), np.concatenate([self.weight[c] for c in cuts]), self.n)
        return score

    def neighbours(self, terms: np.ndarray, unused: np.ndarray) -> Iterator[int]:
        """Unused documents that have one of the seed's terms, best score first; ties by number."""
        score = np.where(unused, self.scores(terms), 0.0)
        left, some = int((score > 0).sum()), NEIGHBOURS
        while left > 0:
            least = np.partition(score, self.n - min(some, left))[self.n - min(some, left)]
            found = np.flatnonzero(score >= least)
            yield from found[np.argsort(-score[found], kind="stable")].tolist()
            score[found] = 0.0
            left, some = left - len(found), 8 * some


def pack(docs: list[np.ndarray], window: int = WINDOW, stats: Stats | None = None) -> list[Piece]:
    """Pieces of all documents of a shard; each id lies in exactly one, windows are full but for the end."""
    stats = stats or Stats.of(docs)
    live = np.arange(len(docs))  # documents of the index; it is built again when three tenths of them are used
    index, unused = Index(docs, stats), np.ones(len(docs), bool)
    order: list[tuple[int, int, int]] = []  # document, start, length in the line of windows
    room, seed, ahead, rest = window, 0, iter(()), None

    def put(d: int, start: int) -> int:
        """As much of d as fits, and whole windows for what is longer; ids placed so far."""
        nonlocal room
        take = min(room, len(docs[d]) - start)
        order.append((d, start, take))
        room -= take
        if not room:
            room = window
        return start + take

    while True:
        if rest is None and room == window or ahead is None:
            while seed < len(docs) and not unused[seed]:
                seed += 1
            if seed == len(docs):
                break
            d, start = seed, 0
            unused[d] = False
            ahead = iter(())
            fresh_window = True
        elif rest is not None:
            (d, start), rest = rest, None
            fresh_window = True
        else:
            d = next((x for x in ahead if unused[x]), None)
            if d is None:
                ahead = None
                continue
            start, fresh_window = 0, False
            unused[d] = False
        start = put(d, start)
        while start < len(docs[d]) and len(docs[d]) - start >= window:
            start = put(d, start)
        if start < len(docs[d]):
            rest = (d, start)
        elif fresh_window and room < window:
            if 10 * int(unused[live].sum()) < 7 * len(live):
                live = np.flatnonzero(unused)
                index = Index([docs[k] for k in live], stats)
            ahead = (int(live[k]) for k in index.neighbours(distinct(docs[d]), unused[live]))
    return _cut(order, sum(map(len, docs)), window)


def _cut(order: list[tuple[int, int, int]], total: int, window: int) -> list[Piece]:
    """Sequences along the line: full windows, then powers of two."""
    sizes = [window] * (total // window) + [1 << k for k in range(window.bit_length() - 1, -1, -1) if (total % window) >> k & 1]
    out: list[Piece] = []
    sequence = offset = 0
    for d, start, length in order:
        while length:
            take = min(length, sizes[sequence] - offset)
            out.append((d, start, take, sequence, offset))
            start, length, offset = start + take, length - take, offset + take
            if offset == sizes[sequence]:
                sequence, offset = sequence + 1, 0
    return out


def line_key(ids: np.ndarray, rank: np.ndarray, tie: int) -> bytes:
    """Place on the line, 16 bytes: the least ranks of the ids, the checksum of the ids, a number of the row."""
    left, out = rank[ids], 0
    for _ in range(KEY_TERMS):
        least = int(left.min()) if len(left) else IDS - 1
        out = out << 16 | least
        left = left[left > least]
    return out.to_bytes(8, "big") + zlib.crc32(ids.tobytes()).to_bytes(4, "big") + (tie & 0xFFFFFFFF).to_bytes(4, "big")


def shard_of(lines: np.ndarray, split: np.ndarray) -> np.ndarray:
    """Stretch of the line between the splitters that each place lies in."""
    return np.searchsorted(split, lines, side="right").astype(np.int32)


def splitters(lines: list[bytes], shards: int) -> np.ndarray:
    """Quantile boundaries of sampled places: distinct, ascending, fewer than ``shards``."""
    held = np.sort(np.array(lines, "S16"))
    return np.unique(held[(np.arange(1, shards) * len(held)) // shards]) if len(held) else held


def written_ids(docs: DataFrame, id_col: str, text_col: str, tokenizer: str) -> tuple[DataFrame, Stats]:
    """Ids of all documents (id, ids, size, tie), written, and their statistics.

    Each task counts what it encodes and adds its counts as one more row; they
    are summed in Spark, and at most 32 vectors reach the driver. Ids of
    documents stay in Arrow, so their type and value do not matter.
    """
    lengths = tokenizer.replace(".json", ".tiktoken")
    if len(bpe.byte_lengths(lengths)) > IDS:
        raise ValueError(f"{tokenizer} has more than {IDS} ids")
    names = ["id", "ids", "size", "tie", "counts"]

    def encoded(text: str) -> bytes:
        if len(text) <= bpe.CHUNK_CHARS:
            ids = bpe.json_ids(text, tokenizer)
        else:
            ids = bpe.encode_overlapping(text, lambda s: bpe.encode_json(s, tokenizer), bpe.byte_lengths(lengths)).tolist()
        ids.append(END_ID)
        return array("H", ids).tobytes()  # 16 bits each

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, total, kinds = np.zeros(IDS, np.int64), 0, 0, []
        for batch in batches:
            ids = [encoded(t) for t in batch.column("text").to_pylist()]
            own = Stats.of([np.frombuffer(x, np.uint16) for x in ids])
            df, n, total = df + own.df, n + own.n, total + sum(map(len, ids)) // 2
            kinds = [batch.schema.field(c).type for c in ("id", "size", "tie")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.binary()), batch.column("size"), batch.column("tie"), pa.nulls(len(ids), pa.binary())], names=names)
        if n:
            counts = pa.array([np.append(df, [n, total]).tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kinds[0]), pa.nulls(1, pa.binary()), pa.nulls(1, kinds[1]), pa.nulls(1, kinds[2]), counts], names=names)

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"counts": [sum((np.frombuffer(x, np.int64) for x in pdf["counts"]), np.zeros(IDS + 2, np.int64)).tobytes()]})

    kind = docs.schema[id_col].dataType.simpleString()
    tie = F.xxhash64(F.monotonically_increasing_id())
    source = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"), (F.octet_length(text_of(text_col)) + 16).cast("long").alias("size"), tie.alias("tie"))
    all_ = stash(source.mapInArrow(encode, f"id {kind}, ids binary, size long, tie long, counts binary"))
    part = F.pmod(F.monotonically_increasing_id(), F.lit(32)).cast("int")
    parts = all_.where("counts is not null").select("counts", part.alias("part")).groupBy("part").applyInPandas(added, "counts binary").collect()
    sums = sum((np.frombuffer(r.counts, np.int64) for r in parts), np.zeros(IDS + 2, np.int64))
    n, total = int(sums[-2]), int(sums[-1])
    return all_.where("counts is null").drop("counts"), Stats(n, total / max(1, n), sums[:IDS])


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, tokenizer: str = TOKENIZER) -> DataFrame:
    """Pieces: id, start, length, ids_crc32, doc_tokens, sequence_id, offset. The ids are written once and shuffled once."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows, stats = written_ids(docs, id_col, text_col, tokenizer)
    total = rows.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    ranges = min(shards, MAX_RANGES)
    held = spark.sparkContext.broadcast((stats, stats.ranks()))

    def keys(ids: pd.Series, ties: pd.Series) -> list[bytes]:
        rank = held.value[1]
        return [line_key(np.frombuffer(x, np.uint16), rank, t) for x, t in zip(ids, ties.tolist(), strict=True)]

    @F.pandas_udf("binary")
    def line(ids: pd.Series, ties: pd.Series) -> pd.Series:
        return pd.Series(keys(ids, ties))

    # a row is drawn with a chance in proportion to its size; the draw is a hash, so a lost task draws alike again
    draw = (F.xxhash64("tie", F.lit("draw")).cast("double") / 2.0**64 + 0.5) < F.col("size") * (ranges * SAMPLES_PER_RANGE / max(1, total))
    sample = [bytes(r.line) for r in rows.where(draw).select(line("ids", "tie").alias("line")).collect()] if ranges > 1 else []
    split = spark.sparkContext.broadcast(splitters(sample, ranges))

    @F.pandas_udf("line binary, range int")
    def placed(ids: pd.Series, ties: pd.Series) -> pd.DataFrame:
        lines = keys(ids, ties)
        return pd.DataFrame({"line": lines, "range": shard_of(np.array(lines, "S16"), split.value)})

    rows = rows.select("id", "ids", placed("ids", "tie").alias("at")).select("id", "ids", "at.line", "at.range")
    parts = min(ranges, max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shards // SHARDS_PER_TASK)))
    rows = rows.repartition(parts, "range").sortWithinPartitions("range", "line", "id")
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, last = 0, -1
        for number, part in _shards(batches, SHARD_BYTES):
            at, last = (at, last) if number == last else (0, number)
            docs = [np.frombuffer(x, np.uint16) for x in part.column("ids").to_pylist()]
            pieces = pack(docs, window, held.value[0])
            crc = np.array([zlib.crc32(docs[d][a : a + n].astype("<u4").tobytes()) for d, a, n, _, _ in pieces], np.int64)
            d, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
            numbers = (start, length, crc, np.array([len(x) for x in docs], np.int64)[d], (number << 40) + at + sequence, offset)
            ids = pa.concat_arrays(part.column("id").chunks).take(pa.array(d))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(x) for x in numbers)], names=names)
            at += int(sequence[-1]) + 1

    return rows.mapInArrow(run, f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, pa.Table]]:
    """Shard after shard, with its range, from batches sorted by range and line; a range of more than ``most`` bytes of ids is cut into several."""
    held: list[pa.RecordBatch] = []
    size, number = 0, -1

    def taken(limit: int) -> pa.Table:
        """The first rows of what is held, up to ``limit`` bytes and at least one."""
        nonlocal held, size
        rows = pa.Table.from_batches(held)
        lengths = pc.binary_length(rows.column("ids")).to_numpy().astype(np.int64)
        n = max(1, int(np.searchsorted(np.cumsum(lengths), limit, side="right")))
        held, size = rows.slice(n).to_batches(), int(lengths[n:].sum())
        return rows.slice(0, n)

    for batch in batches:
        if not batch.num_rows:
            continue
        ranges = batch.column("range").to_numpy()
        cuts = [0, *(np.flatnonzero(ranges[1:] != ranges[:-1]) + 1).tolist(), len(ranges)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if held and number != ranges[lo]:
                yield number, taken(size)
            number, part = int(ranges[lo]), batch.slice(lo, hi - lo)
            held.append(part)
            size += int(pc.sum(pc.binary_length(part.column("ids"))).as_py())
            while size > most and sum(x.num_rows for x in held) > 1:
                yield number, taken(most // 2)
    if held:
        yield number, taken(size)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packed(documents(spark, sf_dir).select("doc_id", "text"))

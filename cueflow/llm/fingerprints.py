"""Document fingerprints by a homomorphic multiset hash, native from end to end.

A fingerprint is a vector of sums over paragraphs (lines that are not empty), so
adding or removing a paragraph adds or subtracts that paragraph's vector and the
order of paragraphs does not matter:

* four words: hashes of the paragraph under four seeds, each over its whole
  text, added modulo 2**62. They decide equality.
* one word: the number of pieces.
* 21 words of three lanes each: every piece of a paragraph adds or subtracts one
  in the lane that its hash names, modulo 2**21. The lanes of two fingerprints
  differ by a vector whose square length estimates how many pieces only one of
  the two texts has. No text is too long: every sum is taken modulo its power.

A piece ends after a blank that follows one of a few common letters or a mark,
at the end of its line, or after 96 code points: the cuts depend on the text
around them only, so an edit changes the pieces that it touches.

The edited text is fingerprinted by the sums: the paragraphs from the cut on are
taken out of the document's fingerprint and those of the new end are added.

Null text is empty text. Rows are fingerprinted each by itself, so equal texts
have equal fingerprints, and repeated rows and rows of repeated ids get results
of their own. The *next* document is the next row by (id, hash of the text),
whatever orderable type the id has; null ids come first, the last row's next is
the first row, and a table of one row is its own next. An empty table gives an
empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import os.path
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import documents, fresh, stash, text_of

SEEDS = 4
#: Words that hold sums modulo 2**62: the seeds and the number of pieces.
PLAIN = SEEDS + 1
SUM_MASK = (1 << 62) - 1
#: Lanes, three in a word.
WORDS, LANE_BITS = 21, 21
LANES = 3 * WORDS
LANE_MASK = (1 << LANE_BITS) - 1
#: Where a line is cut into pieces, and the most code points of a piece.
CUT = r"(?<=[esnr.,;:!?#&%$*|])[ \t]|\n"
PIECE_CHARS = 96
#: Bytes of text in a range of the ordered documents, about, and ranges at most.
RANGE_BYTES = 6 << 20
MAX_RANGES = 1 << 13


def paragraph_hashes(paragraphs: Column, seed: int) -> Column:
    """Sum of the paragraphs' hashes under a seed, modulo 2**62; the seed goes first, so that each hash reads the whole text."""
    mask = F.lit(SUM_MASK)
    return F.aggregate(paragraphs, F.lit(0).cast("long"), lambda a, p: (a + F.xxhash64(F.lit(seed), p).bitwiseAND(mask)).bitwiseAND(mask))


def _pieces(text: Column) -> tuple[Column, Callable[[Column], Column]]:
    """Pieces before long ones are cut, and the function that cuts those."""
    whole = F.filter(F.split(text, CUT), lambda p: p != "")
    part = lambda p: F.when(F.length(p) <= PIECE_CHARS, F.array(p)).otherwise(F.regexp_extract_all(p, F.lit(f"(?s).{{1,{PIECE_CHARS}}}"), F.lit(0)))
    return whole, lambda pieces: F.when(F.exists(pieces, lambda p: F.length(p) > PIECE_CHARS), F.flatten(F.transform(pieces, part))).otherwise(pieces)


def fingerprinted(df: DataFrame, text_col: str) -> tuple[DataFrame, str]:
    """df with the fingerprint as array<long>: SEEDS sums, the piece count, WORDS packed lane words. No shuffle.

    Each piece becomes one of 2 * LANES marks; a mark's count is what the string
    of marks loses when it is taken out, so lanes cost no step for each piece.
    """
    paragraphs, pieces, marks, lanes, name = (fresh(df, x) for x in ("paragraphs", "pieces", "marks", "lanes", "print"))
    text = text_of(text_col)
    whole, cut = _pieces(text)
    # columns of their own: inside a lambda an expression is evaluated for each element
    out = df.withColumn(paragraphs, F.filter(F.split(text, "\n"), lambda p: p != "")).withColumn(pieces, whole)
    mark = lambda p: F.char(F.pmod(F.xxhash64(F.lit(SEEDS), p), F.lit(2 * LANES)) + 1)
    out = out.withColumn(marks, F.array_join(F.transform(cut(F.col(pieces)), mark), ""))
    m = F.col(marks)
    letters = lambda k: F.array(*(F.lit(chr(i + 1)) for i in range(k * LANES, (k + 1) * LANES)))
    without = lambda c: F.octet_length(F.replace(m, c, F.lit("")))
    out = out.withColumn(lanes, F.zip_with(letters(0), letters(1), lambda up, down: (without(down) - without(up)).cast("long").bitwiseAND(F.lit(LANE_MASK))))
    lane = lambda i: F.get(F.col(lanes), i)
    packed = [lane(F.lit(i)).bitwiseOR(F.shiftleft(lane(F.lit(i + WORDS)), LANE_BITS)).bitwiseOR(F.shiftleft(lane(F.lit(i + 2 * WORDS)), 2 * LANE_BITS)) for i in range(WORDS)]
    sums = [paragraph_hashes(F.col(paragraphs), s) for s in range(SEEDS)]
    words = F.array(*sums, F.octet_length(m).cast("long"), *packed)
    return out.withColumn(name, F.explode(F.array(words))).drop(paragraphs, pieces, marks, lanes), name


def shown(words: str) -> Column:
    """Hexadecimal, 16 digits a word."""
    return F.lower(F.array_join(F.transform(F.col(words), lambda w: F.lpad(F.hex(w), 16, "0")), ""))


def _lane(word: Column, k: int) -> Column:
    return F.shiftrightunsigned(word, LANE_BITS * k).bitwiseAND(F.lit(LANE_MASK))


def combined(a: str, b: str, sign: int = 1) -> Column:
    """Fingerprint of two multisets together (sign 1), or of a without b (-1): sum by sum and lane by lane, modulo the powers."""

    def word(x: Column, y: Column) -> Column:
        return (x + sign * y).bitwiseAND(F.lit(SUM_MASK))

    def lanes(x: Column, y: Column) -> Column:
        low, middle, high = (F.shiftleft((_lane(x, k) + sign * _lane(y, k)).bitwiseAND(F.lit(LANE_MASK)), LANE_BITS * k) for k in range(3))
        return low.bitwiseOR(middle).bitwiseOR(high)

    both = lambda first, n, f: F.zip_with(F.slice(F.col(a), first, n), F.slice(F.col(b), first, n), f)
    return F.concat(both(1, PLAIN, word), both(PLAIN + 1, WORDS, lanes))


def likeness(a: str, b: str) -> Column:
    """1 less the estimated share of pieces that only one text has; 1 for equal fingerprints; 0 to 1."""
    x, y = F.col(a), F.col(b)
    na, nb = F.get(x, F.lit(SEEDS)), F.get(y, F.lit(SEEDS))

    def squares(u: Column, v: Column) -> Column:
        def lane(k: int) -> Column:
            d = (_lane(u, k) - _lane(v, k) + (1 << LANE_BITS - 1)).bitwiseAND(F.lit(LANE_MASK)) - (1 << LANE_BITS - 1)  # signed
            return d * d

        return lane(0) + lane(1) + lane(2)

    apart = F.aggregate(F.zip_with(F.slice(x, PLAIN + 1, WORDS), F.slice(y, PLAIN + 1, WORDS), squares), F.lit(0.0), lambda s, d: s + d.cast("double"))
    near = F.greatest(F.lit(0.0), 1 - apart / F.greatest(F.lit(1.0), (na + nb).cast("double")))
    return F.when(x == y, F.lit(1.0)).otherwise(near)


def _code(df: DataFrame, id_col: str) -> tuple[Column | None, bool]:
    """A number that never falls where ids rise, and whether it tells all ids apart; None where the type has no such number."""
    kind, c = df.schema[id_col].dataType, F.col(f"`{id_col}`")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return c.cast("long"), True
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long"), True
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")), True
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(F.isnan(c), F.lit(1.7e308)).otherwise(c.cast("double")), False
    if isinstance(kind, T.DecimalType):
        return c.cast("double"), False
    if isinstance(kind, (T.StringType, T.BinaryType)):
        raw = F.encode(c, "utf-8") if isinstance(kind, T.StringType) else c
        ends = df.agg(F.min(raw), F.max(raw)).first()
        common = len(os.path.commonprefix([bytes(x or b"") for x in ends]))
        return F.conv(F.rpad(F.hex(F.substring(raw, common + 1, 6)), 12, "0"), 16, 10).cast("double"), False  # the six bytes after what all ids share
    return None, False


def _ranges(df: DataFrame, id_col: str, key: str, size: Column) -> Column:
    """Number of the range that a row falls in: ascending in (id, key), of about RANGE_BYTES each.

    Null ids have ranges of their own in front, cut by the key. The other ranges
    are cut at quantiles of the ids, of which there are MAX_RANGES at most at any
    size; an id that fills several ranges is cut by the key.
    """
    total, nulls = df.agg(F.sum(size), F.sum(F.when(F.col(id_col).isNull(), size))).first()
    n = min(MAX_RANGES, -(-(total or 0) // RANGE_BYTES))
    if n <= 1:
        return F.lit(0)
    share = lambda parts: F.least(F.lit(parts - 1), F.floor((F.col(key).cast("double") / 2.0**64 + 0.5) * parts).cast("int"))
    front = max(1, round(n * nulls / total)) if nulls else 0
    code, exact = _code(df, id_col)
    rest = n - front
    found = df.agg(F.percentile_approx(code, [k / rest for k in range(1, rest)], F.lit(8 * MAX_RANGES))).first()[0] if rest > 1 and code is not None else None
    place = F.lit(front)
    if found:
        bounds = F.split(F.lit(",".join(map(repr, found))), ",").cast("array<long>" if exact else "array<double>")  # one literal, folded to an array once
        steps = F.array(*(F.lit(1 << k) for k in range(len(found).bit_length() - 1, -1, -1)))

        def upto(within: Callable[[Column], Column]) -> Column:
            """How many bounds lie within: a search by halves."""
            ahead = lambda at, step: (at + step <= len(found)) & within(F.get(bounds, at + step - 1))
            return F.aggregate(steps, F.lit(0), lambda at, step: F.when(ahead(at, step), at + step).otherwise(at))

        hi = upto(lambda b: b <= code)
        if exact and len(set(found)) < len(found):
            lo = upto(lambda b: b < code)
            often = F.floor((F.col(key).cast("double") / 2.0**64 + 0.5) * (hi - lo)).cast("int")
            hi = F.when(hi - lo > 1, lo + 1 + F.least(hi - lo - 1, often)).otherwise(hi)
        place = hi + front
    return F.when(F.col(id_col).isNull(), share(front) if front else F.lit(0)).otherwise(place)


def with_next(df: DataFrame, id_col: str, text_col: str, made: Callable[[DataFrame], DataFrame], carried: list[str]) -> tuple[DataFrame, str]:
    """made(df) with a struct of the carried columns of the next row by (id, hash of text); the struct's name.

    Rows are dealt to ranges of ids; ``lead`` runs within a range, and the last
    row of a range is followed by the first one of the next range, found by ids
    alone. The text is shuffled once. ``made`` adds columns row by row; it runs
    once over all rows, and once over the first row of each range.
    """
    key, place, name, edge = (fresh(df, x) for x in ("key", "range", "next", "edge"))
    found = df.withColumn(key, F.xxhash64(text_of(text_col)))
    found = found.withColumn(place, _ranges(found, id_col, key, (F.octet_length(text_of(text_col)) + 64).cast("long")))
    order = F.struct(F.col(id_col).isNotNull().alias("known"), F.col(id_col).alias("id"), F.col(key).alias("key"))
    firsts = stash(found.groupBy(place).agg(F.min(order).alias("first")))
    line = Window.orderBy(place)  # over ranges, of which each holds about RANGE_BYTES of text
    after = F.coalesce(F.lead(F.struct("first", place)).over(line), F.first(F.struct("first", place)).over(line.rowsBetween(Window.unboundedPreceding, 0)))
    # the first row of each range, under the number of the range before it
    firsts = firsts.select(F.col(place).alias("at"), after.alias("n")).select("at", F.col(f"n.{place}").alias("place"), "n.first.id", "n.first.key")
    meets = (found[place] == firsts["place"]) & found[id_col].eqNullSafe(firsts["id"]) & (found[key] == firsts["key"])
    heads = stash(found.join(firsts, meets).groupBy("at").agg(*(F.first(found[c]).alias(c) for c in df.columns)))
    heads = made(heads).select(F.col("at").alias("at_range"), F.struct(*carried).alias(edge))
    w = Window.partitionBy(place).orderBy(F.col(id_col).asc_nulls_first(), key)
    led = made(found).withColumn(name, F.lead(F.struct(*carried)).over(w))
    led = led.join(heads, led[place] == heads["at_range"], "left")
    return led.withColumn(name, F.coalesce(name, edge)).drop(edge, key, place, "at_range"), name


def parted(df: DataFrame, text_col: str) -> tuple[DataFrame, str, str]:
    """df with the text's beginning, whole lines that end before the last quarter of the code points, and the rest of the line that this quarter begins in."""
    head, line = fresh(df, "head"), fresh(df, "line")
    text = F.col(text_col)
    n = F.length(text)
    kept = F.substring(text, F.lit(1), n - F.floor(n / 4).cast("int"))
    out = df.withColumn(line, F.substring_index(kept, "\n", -1))
    return out.withColumn(head, F.substring(text, F.lit(1), F.length(kept) - F.length(line))), head, line


def fingerprint_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: its fingerprint, that of its edited text, and how near they and the next one's are.

    Edited: the last quarter of the code points replaced by as many from the
    beginning of the next text (or all of it).
    """
    docs = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    quarter = F.floor(F.length("text") / 4).cast("int")

    def own(df: DataFrame) -> DataFrame:
        out, head, line = parted(df, "text")
        out = out.withColumn("end", F.concat(F.col(line), F.expr("right(text, cast(floor(length(text) / 4) as int))")))
        out, a = fingerprinted(out, head)
        out, b = fingerprinted(out, "end")
        return out.withColumn("own", combined(a, b)).withColumnRenamed(b, "last").drop(head, "end", a).withColumnRenamed(line, "line")

    led, nxt = with_next(docs, "id", "text", own, ["text", "own"])
    led = led.withColumn("new", F.concat("line", F.substring(F.col(f"{nxt}.text"), F.lit(1), quarter)))
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - quarter - F.length("line")), "new")
    led = led.select("id", "own", "last", "new", F.length("text").cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"), F.col(f"{nxt}.own").alias("next"))
    both, added = fingerprinted(led, "new")
    both = both.withColumn("kept", combined("own", "last", -1)).withColumn("edited", combined("kept", added))
    return both.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", shown("own").alias("fingerprint"), shown("edited").alias("edited_fingerprint"),
        likeness("own", "edited").alias("near_edited"), likeness("own", "next").alias("near_next"),
    )


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(documents(spark, sf_dir))

"""Document fingerprints by one-permutation MinHash, packed to eight bits a bin. DataFrame functions only.

A single hash of each shingle gives its bin (the high bits) and its rank there. A bin that no shingle falls into takes
the value of the first filled bin in an order of its own (optimal densification, Shrivastava 2017), so that every bin
of two texts agrees with the probability of their similarity. Only low-order bits are kept; chance agreement is taken
off again (b-bit MinHash, Li and Koenig 2010).
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, isqrt
from random import Random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshlark.plans.lineage import store

BIN_BITS = 7
BINS = 1 << BIN_BITS
VALUE_BITS = 8
WIDTH = 5
_RANDOM = Random(17)
#: For each bin the first bins that an empty one looks at.
_PROBES = [[_RANDOM.randrange(BINS) for _ in range(BINS)] for _ in range(6)]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, 64 - BIN_BITS)


def with_codes(df: DataFrame, text: str, into: str, width: int = WIDTH) -> DataFrame:
    """Add ``into``: an array of one byte per bin, null for a text without words.

    Words are runs without ASCII white space, A-Z in lower case; shingles are ``width`` words, or all words of a
    shorter text. Each step is a column of its own, so that Spark evaluates it once.
    """
    w, h, f = (f"_{into}_{x}" for x in "whf")
    words = F.filter(F.split(F.translate(F.col(text), _UPPER, _LOWER), r"[\x09-\x0D ]+"), lambda x: x != "")
    df = df.withColumn(w, F.transform(words, lambda x: F.xxhash64(x)))
    several = F.transform(F.sequence(F.lit(0), F.size(w) - width),
                          lambda i: F.xxhash64(*[F.get(F.col(w), i + k) for k in range(width)]))
    hashes = F.when(F.size(w) >= width, several).when(F.size(w) > 0, F.array(F.xxhash64(F.col(w)))).otherwise(
        F.array().cast("array<bigint>"))
    df = df.withColumn(h, F.sort_array(hashes)).drop(w)
    # The least hash of each bin that has any: sorted hashes lie bin by bin.
    least = F.filter(F.col(h), lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(F.col(h), i - 1))))
    df = df.withColumn(f, least).drop(h)
    low = lambda x: x.bitwiseAND((1 << VALUE_BITS) - 1)
    # Nulls fill the gaps between filled bins. Hashes are signed, so the upper half of the bins comes first.
    r, d, half = f"_{into}_r", f"_{into}_d", BINS // 2
    place = lambda x: F.shiftright(x, 64 - BIN_BITS) + half
    none = lambda n: F.array_repeat(F.lit(None).cast("smallint"), n.cast("int"))
    runs = F.transform(f, lambda x, i: F.concat(
        none(place(x) - F.when(i > 0, place(F.get(F.col(f), i - 1))).otherwise(-1) - 1), F.array(low(x).cast("smallint"))))
    rest = none(BINS - 1 - F.coalesce(place(F.get(F.col(f), F.size(f) - 1)), F.lit(-1)))
    df = df.withColumn(r, F.concat(F.flatten(runs), rest))
    df = df.withColumn(d, F.concat(F.slice(r, half + 1, half), F.slice(r, 1, half))).drop(r)

    def value(x: Column, b: Column) -> Column:
        # The first filled bin in the order of bin b: some places are looked up, the rest follow by hash.
        tried = [F.get(F.col(d), F.get(F.array(*[F.lit(j) for j in probe]), b)) for probe in _PROBES]
        after = F.array_min(F.transform(F.col(f), lambda y: F.struct(F.xxhash64(b, _bin(y)).alias("o"), low(y).alias("v"))))
        return F.coalesce(x, *tried, after["v"].cast("smallint"))

    return df.withColumn(into, F.when(F.size(f) > 0, F.transform(F.col(d), value))).drop(f, d)


def packed(codes: str) -> Column:
    """The fingerprint as text: two hexadecimal digits a bin; empty for a text without words."""
    return F.coalesce(F.array_join(F.transform(codes, lambda v: F.lpad(F.hex(v.cast("long")), 2, "0")), ""), F.lit(""))


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of two code columns, from 0 to 1. Texts without words are like each other only."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(BINS))
    chance = 1.0 / (1 << VALUE_BITS)
    fixed = F.greatest((same - chance) / (1 - chance), F.lit(0.0))
    return F.when(F.col(a).isNull() & F.col(b).isNull(), 1.0).when(F.col(a).isNull() | F.col(b).isNull(), 0.0).otherwise(fixed)


def _piece(ids: DataFrame, rows: int, piece_rows: int) -> Column:
    """Number of the stretch of ids that ``doc_id`` lies in; stretches of about ``piece_rows`` rows, 100,000 at most.

    Their bounds are looked up in two steps, so that many stretches cost little per row.
    """
    pieces = ceil(rows / max(piece_rows, rows / 100_000, 1))
    if pieces <= 1:
        return F.lit(0)
    shares = F.array(*[F.lit(k / pieces) for k in range(1, pieces)])
    bounds = sorted(set(ids.agg(F.percentile_approx("doc_id", shares, 20 * pieces)).first()[0] or []))
    step = isqrt(len(bounds)) + 1
    outer = F.array(*[F.lit(b) for b in bounds[::step]])
    inner = F.array(*[F.array(*[F.lit(b) for b in bounds[i:i + step]]) for i in range(0, len(bounds), step)])
    group = F.size(F.filter(outer, lambda b: b <= F.col("doc_id"))) - 1
    within = F.size(F.filter(F.get(inner, group), lambda b: b <= F.col("doc_id")))
    return F.when(F.col("doc_id") >= bounds[0], group * step + within).otherwise(0)


def with_next(docs: DataFrame, columns: list[str], piece_rows: int = 2_000,
              derive: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Add the columns of ``derive``, a function of the row, and ``next``, a struct of ``columns`` of the row that follows by ``doc_id`` (ties by text); after the last row
    comes the first. Null ids come first.

    Rows move once, to their stretch of ids, where a window finds the next; only the last row of a stretch needs the
    first of the following one, found by its id.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    rows = ids.count()
    cut = docs.withColumn("_order", F.struct(F.col("doc_id").alias("id"), F.md5("text").alias("text")))
    cut = cut.withColumn("_piece", _piece(ids, rows, piece_rows))
    heads = store(cut.groupBy("_piece").agg(F.min("_order").alias("_first"))).df
    chosen = cut.alias("c").join(heads.alias("h"), (F.col("c._piece") == F.col("h._piece"))
                                 & F.col("c._order").eqNullSafe(F.col("h._first")))
    # One row per stretch, and rows that repeat it; only of these is anything derived here.
    chosen = store(chosen.select("c.*")).df.dropDuplicates(["_piece"])
    chosen = store(derive(chosen).select("_piece", F.struct(*columns).alias("_head"))).df
    follow = Window.orderBy("_piece")
    order = heads.select("_piece", F.lead("_piece").over(follow).alias("_after"))  # one short row per stretch
    order = order.withColumn("_after", F.coalesce("_after", F.lit(0) + _least(heads)))
    after = store(order.join(chosen.withColumnRenamed("_piece", "_after"), "_after").select("_piece", "_head")).df
    inside = Window.partitionBy("_piece").orderBy("_order")
    led = derive(cut).withColumn("_in", F.lead(F.struct(*columns)).over(inside)).join(after, "_piece")
    return led.withColumn("next", F.coalesce("_in", "_head")).drop("_in", "_head", "_piece", "_order")


def _least(heads: DataFrame) -> Column:
    return F.lit(heads.agg(F.min("_piece")).first()[0])


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text, codes`` for each row of ``docs`` (columns ``doc_id``, ``text``); null text is empty. Compare
    ``codes`` by ``likeness``, write them by ``packed``. Equal texts have equal codes."""
    return with_codes(_plain(docs), "text", "codes")


def edited_likeness(docs: DataFrame) -> DataFrame:
    """For each row of ``docs`` its fingerprint, that of its edited text, and how like its own they and the next
    row's are. Edited: the last half of the code points, rounded down, is replaced by the first as many (or all) of
    the next text. Repeated rows follow each other; a single row follows itself; an empty table gives no rows."""
    both = with_next(_plain(docs), ["text", "codes"], derive=lambda df: with_codes(df, "text", "codes"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next.text", F.lit(1), half))
    both = both.withColumn("edited", edited).withColumn("next_codes", F.col("next.codes"))
    both = with_codes(both.select("doc_id", "text", "codes", "edited", "next_codes"), "edited", "edited_codes")
    return both.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        packed("codes").alias("fingerprint"), packed("edited_codes").alias("edited_fingerprint"),
        likeness("codes", "edited_codes").alias("near_edited"), likeness("codes", "next_codes").alias("near_next"))

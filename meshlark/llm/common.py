"""Helpers that several operators share: table access, text buffers, word shingles, components of a graph."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshlark.plans.lineage import forget, store

#: Bytes of text that a kernel handles at a time; one longer text is handled alone. Kernels hold several values of 8 bytes
#: for each, and what Python once took from the system it seldom gives back.
SLICE_BYTES = 250_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and the offsets of the texts. Null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    size, first = len(column), column.offset
    _, offsets, data = column.buffers()
    if not size:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64, size + 1 + first)[first:]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        yield start, stop
        start = stop


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_RNG = np.random.RandomState(20240229)
#: A random 64-bit value for each byte value.
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, size: int) -> np.ndarray:
    """``base ** 0 .. base ** (size - 1)`` modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) < size:
        known = np.full(max(size, SLICE_BYTES + 1), base, np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        _powers[base] = known
    return known[:size]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``ranges_hash`` takes the hash of any byte range from them."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers(_BASE, len(data)), dtype=np.uint64, out=sums[1:])
    return sums


def ranges_hash(sums: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hash of each byte range, equal for equal bytes wherever they stand."""
    return (sums[stops] - sums[starts]) * powers(_BASE_INVERSE, len(sums))[starts]


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _LOWER[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of bytes other than ASCII white space start and stop; none reaches over the start of a text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~_IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], solid[:-1])) & ~edge[:-1]
    after = np.concatenate((solid[1:], [False])) & ~edge[1:]
    return np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and the number of words before each text.

    Words are runs of bytes other than ASCII white space, with A-Z in lower case.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = lowered(data)
    starts, stops = word_bounds(low, offsets)
    hashes = mixed(ranges_hash(prefix_hash(low), starts, stops) + (stops - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``width`` words.

    A text of 1 to ``width - 1`` words has one shingle, all its words; one without words has none.
    """
    hashes, counts = words(data, offsets)
    runs = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for k in range(width):
        runs += hashes[k:k + len(runs)] * powers(_BASE, width + 1)[k + 1]
    runs = mixed(runs)
    for first, last in zip(counts[:-1], counts[1:]):
        if last - first >= width:
            yield np.unique(runs[first:last - width + 1])
        elif last > first:
            own = hashes[first:last] * powers(_BASE, width + 1)[1:1 + last - first]
            yield mixed(np.array([own.sum(dtype=np.uint64) + np.uint64(last - first)]))
        else:
            yield np.zeros(0, np.uint64)


def text_kernel(per_slice):
    """Arrow kernel from ``per_slice(batch, data, offsets) -> RecordBatch``; the batch and its texts (column
    ``text``) come in slices of bounded size."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(batch.schema.get_field_index("text")))
            for start, stop in slices(offsets):
                made = per_slice(batch.slice(start, stop - start), data[offsets[start]:offsets[stop]],
                                 offsets[start:stop + 1] - offsets[start])
                if made is not None and made.num_rows:
                    yield made

    return kernel


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the least node of the connected component of every node of ``edges`` (columns ``a``, ``b``).

    Alternates large-star and small-star rounds (Kiveris et al., 2014) until the edges are stars. Every round is a
    few aggregations with map-side combining; the edges of a round are written to the shared folder.
    """
    def kept(df: DataFrame):
        return store(df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                     digest=F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")))

    now = kept(edges.select("a", "b"))
    while True:
        if not now.rows:
            return now.df.select(F.col("a").alias("node"), F.col("b").alias("root"))
        both = now.df.union(now.df.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        middle = kept(large)
        lowest = middle.df.groupBy("a").agg(F.min("b").alias("_m"))
        small = middle.df.join(lowest, "a").select(F.col("b").alias("a"), F.col("_m").alias("b")).union(
            lowest.select("a", F.col("_m").alias("b")))
        new = kept(small)
        forget(middle)
        done = new.rows == now.rows and new.measures["digest"] == now.measures["digest"]
        forget(now)
        now = new
        if done:
            roots = now.df.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return now.df.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)

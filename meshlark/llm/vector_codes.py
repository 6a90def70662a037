"""Vector compression by codes: parts of integer vectors are replaced by the nearest entry of their codebook.

Rows are handled in blocks. For each part position the block's distinct parts, in lexicographic order, are a trie
whose levels are the dimensions. It is walked depth first, some leaves at a time: a node's squared distances to all
entries are those of its parent plus one dimension, so parts with a common prefix share the sums up to there. At the
leaves the least distance gives the code, and the part times its number of rows goes into the entry's sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshlark.plans.lineage import store

#: Rows and bytes of a block, and leaves of a trie whose paths are open at a time.
BLOCK, BLOCK_BYTES, SEGMENT = 32_768, 16_000_000, 4_096
_MOST = 1 << 27
_LARGEST = (1 << 63) - 1


def _limit(size: int) -> int:
    """Largest magnitude of components for which a squared distance over all dimensions fits a long."""
    return 1 << ((62 - (size - 1).bit_length()) // 2 - 1)


def _whole(vectors: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the rows that are kept, lengths of their vectors, and ``floor(scale * x)`` one after the other."""
    lists = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False)  # nulls become NaN
    bad = np.add.reduceat(np.append(~np.isfinite(values), False), np.minimum(np.cumsum(lengths) - lengths, len(values))) \
        if len(lengths) else np.zeros(0, int)
    good = lists.is_valid().to_numpy(zero_copy_only=False) & ((bad == 0) | (lengths == 0))
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(scale * values[np.repeat(good, lengths)]), -_MOST, _MOST).astype(np.int64)
    return np.flatnonzero(good), lengths[good], whole


def _matrix(lengths: np.ndarray, whole: np.ndarray, size: int) -> np.ndarray:
    """Rows of ``size`` components; shorter vectors end in zeros."""
    out = np.zeros((len(lengths), size), np.int64)
    column = np.arange(len(whole)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(lengths)), lengths), column] = np.clip(whole, -_limit(size), _limit(size))
    return out


def _smallest(scale: float, entries: int):
    """Kernel: of each batch, the longest vector's size and the vectors of the least ids."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lengths, whole = _whole(batch.column(1), scale)
            longest = int(lengths.max()) if len(lengths) else -1
            ends = np.cumsum(lengths)
            ids = batch.column(0).take(pa.array(rows))
            known = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False))
            ids = ids.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
            # Rows that share the last id must all be looked at, as the vector decides between them.
            last = np.partition(ids, entries - 1)[entries - 1] if len(ids) > entries else np.iinfo(np.int64).max
            picked = sorted((int(i), whole[ends[r] - lengths[r]:ends[r]].tolist())
                            for i, r in zip(ids.tolist(), known.tolist()) if i <= last)[:entries]
            yield pa.RecordBatch.from_arrays(
                [pa.array([longest, *[None] * len(picked)], pa.int32()), pa.array([None, *[p[0] for p in picked]], pa.int64()),
                 pa.array([None, *[p[1] for p in picked]], pa.list_(pa.int64()))], ["longest", "vec_id", "x"])

    return kernel


def trie_assign(parts: np.ndarray, book: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Nearest entry (the lower index of equals) and squared distance of distinct parts in lexicographic order.

    Leaves are taken in their order, ``SEGMENT`` at a time. On each level the nodes above them are the places where the
    prefix changes; a node adds one dimension to its parent's line of distances.
    """
    for start in range(0, len(parts), SEGMENT):
        here = parts[start:start + SEGMENT]
        new = np.zeros(len(here), bool)
        new[0] = True
        node = np.zeros(len(here), np.int64)  # the leaf's node on the level above; the root first
        lines = np.zeros((1, len(book)), np.int64)
        for d in range(parts.shape[1]):
            new[1:] |= here[1:, d] != here[:-1, d]
            at = np.flatnonzero(new)
            step = here[at, d][:, None] - book[None, :, d]
            lines = lines[node[at]] + step * step
            node = np.cumsum(new) - 1
        codes = lines.argmin(1)
        yield slice(start, start + len(here)), codes[node], lines[np.arange(len(lines)), codes][node]


def _tries(x: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each part position: the distinct parts in order, their number of rows, and each row's place among them."""
    width = x.shape[1] // parts
    for p in range(parts):
        own = x[:, p * width:(p + 1) * width]
        order = np.lexsort(own.T[::-1])
        ordered = own[order]
        new = np.concatenate(([True], (ordered[1:] != ordered[:-1]).any(1)))
        place = np.empty(len(own), np.int64)
        place[order] = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        yield p, ordered[first], np.diff(np.append(first, len(own))), place


def _blocks(batches: Iterator[pa.RecordBatch], column: int, scale: float, size: int):
    """Batches joined to blocks: the batch, the numbers of its rows that are kept, and their vectors."""
    most = max(1, min(BLOCK, BLOCK_BYTES // (8 * size)))

    def joined() -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                piece = batch.slice(start, most)
                if held and rows + piece.num_rows > most:
                    yield pa.concat_batches(held)
                    held, rows = [], 0
                held.append(piece)
                rows += piece.num_rows
        if held:
            yield pa.concat_batches(held)

    for piece in joined():
        rows, lengths, whole = _whole(piece.column(column), scale)
        if len(rows):
            yield piece, rows, _matrix(lengths, whole, size)


def _sums(scale: float, size: int, books: np.ndarray):
    """Kernel of a round: for each entry the number of its parts and the sum of each component."""
    parts, entries, width = books.shape

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sums of one task: rows times the largest component stay far inside a long; Spark adds them as decimals.
        total = np.zeros((parts, entries, width + 1), np.int64)
        for _, _, x in _blocks(batches, 0, scale, size):
            for p, leaves, often, _ in _tries(x, parts):
                for at, codes, _ in trie_assign(leaves, books[p]):
                    np.add.at(total[p, :, 0], codes, often[at])
                    np.add.at(total[p, :, 1:], codes, leaves[at] * often[at][:, None])
        cells = np.flatnonzero(total.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel()[cells])], ["cell", "value"])

    return kernel


def _codes(scale: float, size: int, books: np.ndarray):
    parts = len(books)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, rows, x in _blocks(batches, 2, scale, size):
            code = np.zeros((len(rows), parts), np.uint8)
            error = np.zeros(len(rows), np.int64)
            for p, leaves, _, place in _tries(x, parts):
                found = [np.concatenate(f) for f in zip(*[f[1:] for f in trie_assign(leaves, books[p])])]
                code[:, p] = found[0][place]
                error += found[1][place]
            taken = pa.array(rows)
            text = code.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).take(taken), piece.column(1).take(taken),
                 pa.array([text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)], pa.string()), pa.array(error)],
                ["vec_id", "label", "code", "error"])

    return kernel


def fit_codebooks(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0) -> np.ndarray:
    """Codebooks (part, entry, component) of ``floor(scale * x)``: the parts of the ``entries`` least ids, moved by
    ``rounds`` of assignment and mean (rounded down; entries without a part stay).

    Vectors that are null or hold null or non-finite components take no part. Sizes: all vectors are filled with zeros
    to the longest, rounded up to a multiple of ``parts``. Rows that repeat an id are rows each, the lesser vector first;
    rows without an id are assigned, but are no first entries. Components beyond what squared distances in a long
    allow (2^27 for 64 dimensions) count as that. Fewer rows give fewer entries, none gives an empty array.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256")
    table = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    first = store(table.mapInArrow(_smallest(scale, entries), "longest int, vec_id long, x array<bigint>"), longest=F.max("longest"))
    longest = first.measures["longest"]
    if longest is None or longest < 0:
        return np.zeros((parts, 0, 1), np.int64)
    size = max(1, -(-longest // parts)) * parts
    seeds = first.df.where("vec_id IS NOT NULL").orderBy("vec_id", "x").limit(entries).collect()
    x = _matrix(np.array([len(s.x) for s in seeds], np.int64), np.array([v for s in seeds for v in s.x], np.int64), size)
    width = size // parts
    books = np.ascontiguousarray(x.reshape(len(seeds), parts, width).transpose(1, 0, 2))
    for _ in range(rounds if len(seeds) else 0):
        sums = table.select("v").mapInArrow(_sums(scale, size, books), "cell long, value long").groupBy("cell").agg(
            F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()  # a row for each codebook number
        total = np.zeros(parts * len(seeds) * (width + 1), object)
        for row in sums:
            total[row.cell] = int(row.value)
        total = total.reshape(parts, len(seeds), width + 1)
        used = (total[:, :, 0] > 0).astype(bool)
        books[used] = (total[used][:, 1:] // total[used][:, :1]).astype(np.int64)
    return books


def encode(vectors: DataFrame, books: np.ndarray, scale: float = 256.0) -> DataFrame:
    """``vec_id, label, code, error, label_error`` of every row that takes part (see ``fit_codebooks``): the indexes of
    the nearest entries, two hexadecimal digits each, their squared distance over all parts, and the sum of these over
    all rows with an equal label; rows without a label count together. A table without ``label`` has nulls there.

    The labels' sums are rows of their own, joined back; no label's rows are gathered in a task. Sums above a long's
    range are given as its largest value.
    """
    spark = vectors.sparkSession
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int").alias("label")
    table = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label, F.col("embedding").cast("array<double>").alias("v"))
    kind = table.schema["label"].dataType.simpleString()
    coded = spark.createDataFrame([], f"vec_id long, label {kind}, code string, error long")
    if books.shape[1]:
        size = books.shape[0] * books.shape[2]
        coded = store(table.mapInArrow(_codes(scale, size, books), coded.schema)).df
    summed = coded.groupBy("label").agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LARGEST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    totals = store(summed.withColumnRenamed("label", "_label")).df
    return coded.join(totals, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def decode(code: str, books: np.ndarray) -> np.ndarray:
    """The integer vector that a code stands for."""
    return reduce(lambda a, b: np.concatenate((a, b)), [books[p, int(code[2 * p:2 * p + 2], 16)] for p in range(len(books))])


def codebooks_digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimals by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()

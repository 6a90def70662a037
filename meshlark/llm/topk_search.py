"""Exact largest inner products over a table sorted by vector length.

Vectors lie in tiles of descending length, rotated onto the principal axes of the table. For each query a first look
at the longest vectors gives a score to beat. By Cauchy and Schwarz a tile whose longest vector cannot reach it is
skipped; in a tile, the leading coordinates plus the product of the lengths of the rest bound each score, and only
vectors whose bound reaches the mark are multiplied out, in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meshlark.plans.lineage import store

TILE = 2048
#: Queries of a round: bounds what is sent to every task.
ROUND = 4096
#: Tiles that give the first marks.
SEED_TILES = 4
#: Leading rotated coordinates after which vectors are pruned.
STEPS = (8, 24)
_SLACK = 1e-9


def _vectors(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and integer vectors; shorter vectors are filled with zeros."""
    ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    lists = batch.column(1)
    lengths = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, int)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(ids), size), np.int64)
    row = np.repeat(np.arange(len(ids)), lengths)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, column] = flat
    return ids, out


def _gram(size: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            x = _vectors(batch, size)[1].astype(float)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size * size)), pa.array(total.ravel())], ["cell", "value"])

    return kernel


def _tiles(size: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TILE):
                ids, x = _vectors(batch.slice(start, TILE), size)
                longest = float(np.sqrt((x.astype(float) ** 2).sum(1).max()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([longest]), pa.array([ids.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())],
                    ["longest", "ids", "vectors"])

    return kernel


def _best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best rows of each query: highest score, then least id."""
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    keep = rank < k
    return query[keep], ids[keep], scores[keep]


def _products(queries: np.ndarray, vectors: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i), np.int64)
    for start in range(0, len(i), 50_000):
        part = slice(start, start + 50_000)
        out[part] = np.einsum("ij,ij->i", queries[i[part]], vectors[j[part]])
    return out


def _search(query_ids: np.ndarray, queries: np.ndarray, marks: np.ndarray, turn: np.ndarray, k: int):
    """Kernel over tiles. ``marks``: a score that k other vectors of each query are known to reach, or -inf."""
    lengths = np.sqrt((queries.astype(float) ** 2).sum(1))
    turned = queries @ turn
    steps = [s for s in STEPS if s < queries.shape[1]]
    rests = {s: np.sqrt((turned[:, s:] ** 2).sum(1)) for s in steps}

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = marks.astype(float)
        held = (np.zeros(0, np.int64),) * 3
        for batch in batches:
            for longest, raw_ids, raw in zip(*[c.to_pylist() for c in batch.columns]):
                ids = np.frombuffer(raw_ids, np.int64)
                x = np.frombuffer(raw, np.int64).reshape(len(ids), -1)
                slack = _SLACK * lengths * longest + 1e-6
                live = np.flatnonzero(lengths * longest + slack >= mark)
                if not len(live):
                    continue
                own = x @ turn
                done, sums = 0, np.zeros((len(live), len(ids)))
                alive = np.ones(sums.shape, bool)
                for s in steps:
                    sums += turned[live, done:s] @ own[:, done:s].T
                    rest = np.sqrt((own[:, s:] ** 2).sum(1))
                    alive &= sums + np.outer(rests[s][live], rest) + slack[live][:, None] >= mark[live][:, None]
                    done = s
                i, j = np.nonzero(alive & (query_ids[live][:, None] != ids[None, :]))
                i = live[i]
                scores = _products(queries, x, i, j)
                reach = scores >= mark[i]
                held = _best(*[np.concatenate(p) for p in zip(held, (i[reach], ids[j[reach]], scores[reach]))], k)
                full = np.bincount(held[0], minlength=len(mark)) >= k
                last = np.concatenate((held[0][1:] != held[0][:-1], [True])) if len(held[0]) else np.zeros(0, bool)
                lowest = np.full(len(mark), -np.inf)
                lowest[held[0][last]] = held[2][last]
                mark = np.where(full, np.maximum(mark, lowest), mark)
        yield pa.RecordBatch.from_arrays(
            [pa.array(query_ids[held[0]]), pa.array(held[1]), pa.array(held[2])], ["query_id", "vec_id", "score"])

    return kernel


def _marks(query_ids: np.ndarray, queries: np.ndarray, seeds: list, k: int) -> np.ndarray:
    marks = np.full(len(queries), -np.inf)
    if not seeds:
        return marks
    ids = np.concatenate([np.frombuffer(s["ids"], np.int64) for s in seeds])
    x = np.concatenate([np.frombuffer(s["vectors"], np.int64).reshape(-1, queries.shape[1]) for s in seeds])
    if len(ids) <= k:
        return marks
    for start in range(0, len(queries), 256):
        part = slice(start, start + 256)
        scores = queries[part] @ x.T
        scores = np.where(query_ids[part][:, None] == ids[None, :], np.iinfo(np.int64).min, scores)
        marks[part] = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
    return marks


def largest_products(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of ``vectors`` with the largest inner product with each row
    of ``queries`` (both: ``vec_id long, x array<long>``), other than the query's own id; all, if there are fewer.

    Ties go to the smaller id. Rows with a null id, a null vector or a null component take no part. Rows that repeat
    an id count once, with the least vector. Vectors of unequal sizes are filled with zeros. Squared lengths must
    fit a long. Empty tables give no rows.

    The queries are answered in rounds of about ``ROUND``, chosen by a hash, each sent to all tasks; vectors stay
    where they are. Tiles that no query needs are skipped unread where their stored length shows it.
    """
    spark = vectors.sparkSession
    valid = "vec_id IS NOT NULL AND x IS NOT NULL AND forall(x, v -> v IS NOT NULL)"
    clean = vectors.where(valid).groupBy("vec_id").agg(F.min("x").alias("x"))
    asked = queries.where(valid).groupBy("vec_id").agg(F.min("x").alias("x"))
    table = store(clean, size=F.max(F.size("x")))
    asked = store(asked, size=F.max(F.size("x")))
    size = max(table.measures["size"] or 0, asked.measures["size"] or 0, 1)
    schema = "query_id long, rank int, vec_id long, score long"
    if not table.rows or not asked.rows:
        return spark.createDataFrame([], schema)
    cells = table.df.mapInArrow(_gram(size), "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    gram = cells.orderBy("cell").toPandas()["value"].to_numpy().reshape(size, size)
    turn = np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1].copy()

    squared = F.expr("aggregate(x, 0D, (a, v) -> a + CAST(v AS DOUBLE) * v)")
    tiles = store(table.df.withColumn("_s", -squared).repartitionByRange("_s", "vec_id").sortWithinPartitions("_s", "vec_id")
                  .select("vec_id", "x").mapInArrow(_tiles(size), "longest double, ids binary, vectors binary")).df
    seeds = tiles.orderBy(F.desc("longest")).limit(SEED_TILES).collect()
    rounds = -(-asked.rows // ROUND)
    found = []
    for turn_no in range(rounds):
        block = asked.df.where(F.pmod(F.xxhash64("vec_id"), F.lit(rounds)) == turn_no).toArrow().combine_chunks()
        if not block.num_rows:
            continue
        ids, x = _vectors(block.to_batches()[0], size)
        marks = _marks(ids, x, seeds, k)
        most = float(np.sqrt((x.astype(float) ** 2).sum(1)).max())
        needed = tiles.where(F.col("longest") * most * (1 + _SLACK) + 1 >= float(marks.min())) if np.isfinite(
            marks.min()) else tiles
        found.append(store(needed.mapInArrow(_search(ids, x, marks, turn, k), "query_id long, vec_id long, score long")).path)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best = spark.read.schema("query_id long, vec_id long, score long").parquet(*found).withColumn("rank", rank)
    return best.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def scaled(embeddings: DataFrame, factor: float = 1024.0) -> DataFrame:
    """``vec_id, x``: components times ``factor``, rounded down; vectors with a null or non-finite component go."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform("embedding", lambda v: F.floor(F.lit(factor) * v.cast("double")).cast("long"))
    return embeddings.where(F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x"))

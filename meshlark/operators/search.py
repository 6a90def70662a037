"""Vector search, hybrid ranking, semantic neighbors and walks for many requests at once.

Nodes are scanned where they lie. Every task compares its Arrow batches with a bounded block of queries by matrix
products in single precision, computes in double precision what these cannot rule out, and keeps only the best k per
query, so no (query, node) pair leaves a task unless it is among the task's best. Ties rank the smaller node id first; similarities are compared at 12 decimals, so that equal
vectors tie whatever the order of additions was.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshlark.functions import vectors
from meshlark.graph import OUTGOING, PropertyGraph, check_alpha, check_at_least, check_columns
from meshlark.operators.traverse import bfs, neighbors, scanned_links
from meshlark.plans.lineage import shared_folder, store
from meshlark.plans.topk import top_k

QUERY_BLOCK_BYTES = 32 << 20
CELL_BYTES = 64 << 20
COMPARE_DECIMALS = 12
#: Pairs that are computed in double precision at a time.
EXACT_ROWS = 16_384
HITS = "query_id long, node_id long, similarity double"


# ---- numeric kernel, runs inside tasks ------------------------------------------------------------------


def _unit_vectors(ids: pa.Array, lists: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Comparable vectors by size: ``{size: (ids, unit rows)}``. Zero length, NULL or NaN parts drop out."""
    if isinstance(lists, pa.ChunkedArray):
        ids, lists = ids.combine_chunks(), lists.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    found = {}
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        flat = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        matrix = np.asarray(flat, dtype=np.float64).reshape(len(rows), size)
        length = np.sqrt((matrix * matrix).sum(axis=1))
        fit = np.isfinite(length) & (length > 0)
        if fit.any():
            kept = np.asarray(ids.take(pa.array(rows[fit])).to_numpy(zero_copy_only=False), dtype=np.int64)
            found[int(size)] = (kept, matrix[fit] / length[fit, None])
    return found


def _best(query: np.ndarray, node: np.ndarray, similarity: np.ndarray, k: int, scale: float):
    """Best k rows per query by scaled similarity, then node id."""
    score = np.round(similarity * scale, COMPARE_DECIMALS) + 0.0
    order = np.lexsort((node, -score, query))
    query, node, similarity = query[order], node[order], similarity[order]
    begins = np.r_[True, query[1:] != query[:-1]] if len(query) else np.zeros(0, bool)
    starts = np.flatnonzero(begins)
    place = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
    keep = place < k
    return query[keep], node[keep], similarity[keep]


class _Tile:
    """Best k of some queries so far.

    All pairs are compared in single precision; what that cannot rule out by its bound on rounding, a sum of products
    of unit vectors being off by 2 ** -24 a part and little more, is computed in double precision.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int, scale: float):
        self.ids, self.exact, self.coarse, self.k, self.scale = ids, rows, rows.astype(np.float32), k, scale
        self.rows = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        self.least = np.full(len(ids), -np.inf)
        self.slack = 2 * (rows.shape[1] + 4) * 2.0**-24

    def add(self, node_ids: np.ndarray, rows: np.ndarray, coarse: np.ndarray) -> None:
        found = self.coarse @ coarse.T
        bound = np.full(len(self.ids), -np.inf)
        if self.scale > 0:
            tie = 2 * 10.0**-COMPARE_DECIMALS / self.scale
            bound = self.least / self.scale - tie - self.slack
            if len(node_ids) > self.k and np.isinf(bound).any():
                at = len(node_ids) - self.k
                bound = np.maximum(bound, np.partition(found, at, axis=1)[:, at] - tie - 2 * self.slack)
        bound = np.nextafter(bound.astype(np.float32), np.float32(-np.inf))
        query, node = np.divmod(np.flatnonzero(found >= bound[:, None]), len(node_ids))
        if not len(query):
            return
        similarity = np.concatenate([
            np.einsum("ij,ij->i", self.exact[query[at:at + EXACT_ROWS]], rows[node[at:at + EXACT_ROWS]])
            for at in range(0, len(query), EXACT_ROWS)])
        own = (query, node_ids[node], similarity)
        self.rows = _best(*(np.concatenate(c) for c in zip(self.rows, own)), self.k, self.scale)
        query, _, similarity = self.rows
        last = np.flatnonzero(np.append(query[1:] != query[:-1], True))
        full = last[np.diff(np.append(-1, last)) == self.k]
        self.least[query[full]] = np.round(similarity[full] * self.scale, COMPARE_DECIMALS)


class _Running:
    """Best k per query seen so far in a task; the queries are the same each time."""

    def __init__(self, k: int, scale: float, step: int = 512, nodes: int = 2048):
        self.k, self.scale, self.step, self.nodes = k, scale, step, nodes
        self.tiles: dict[int, list[_Tile]] = {}

    def add(self, nodes: dict, queries: dict) -> None:
        for size, (node_ids, node_rows) in nodes.items():
            if size not in queries:
                continue
            if size not in self.tiles:
                ids, rows = queries[size]
                self.tiles[size] = [_Tile(ids[at:at + self.step], rows[at:at + self.step], self.k, self.scale)
                                    for at in range(0, len(ids), self.step)]
            for at in range(0, len(node_ids), self.nodes):
                rows = node_rows[at:at + self.nodes]
                coarse = rows.astype(np.float32)
                for tile in self.tiles[size]:
                    tile.add(node_ids[at:at + self.nodes], rows, coarse)

    def batch(self) -> pa.RecordBatch:
        parts = [(tile.ids[tile.rows[0]], *tile.rows[1:]) for tiles in self.tiles.values() for tile in tiles]
        parts.append((np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)))
        rows = _best(*(np.concatenate(c) for c in zip(*parts)), self.k, self.scale)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in rows], names=["query_id", "node_id", "similarity"])


# ---- exact search ---------------------------------------------------------------------------------------


def _vectors_of(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("embedding").isNotNull()).select(
        F.col("node_id").cast("long"), F.col("embedding").cast("array<double>"))


def _queries_of(queries: DataFrame) -> DataFrame:
    check_columns(queries, "query_id", "vector")
    return queries.where(F.col("vector").isNotNull()).select(
        F.col("query_id").cast("long"), F.col("vector").cast("array<double>"))


def _bytes(rows: DataFrame, vector: str) -> int:
    """Size of a table of ids and vectors."""
    return rows.agg(F.sum(F.size(vector).cast("long") * 8 + 8)).first()[0] or 0


def _scan_with_block(nodes: DataFrame, queries: DataFrame, k: int, scale: float) -> DataFrame:
    """Queries proven small: send them to every task, read the nodes once, shuffle nothing but hits."""
    table = queries.toArrow()
    block = nodes.sparkSession.sparkContext.broadcast(_unit_vectors(table["query_id"], table["vector"]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Running(k, scale)
        for batch in batches:
            best.add(_unit_vectors(batch.column(0), batch.column(1)), block.value)
        yield best.batch()

    return nodes.mapInArrow(scan, HITS)


def _grid(nodes: DataFrame, queries: DataFrame, k: int, scale: float, size: int) -> DataFrame:
    """Queries of any number: cut both sides by hash and compare every node cell with every query block.

    Each side is repeated once per cut of the other; a task holds one cell and one block, both bounded.
    """
    cells = max(1, -(-_bytes(nodes, "embedding") // CELL_BYTES))
    blocks = max(1, -(-size // QUERY_BLOCK_BYTES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = (nodes.withColumn("cell", F.pmod(F.xxhash64("node_id"), F.lit(cells)).cast("int"))
            .withColumn("block", every(blocks)))
    right = (queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
             .withColumn("cell", every(cells)))
    return _compare_groups(left, right, ["cell", "block"], k, scale)


def _compare_groups(left: DataFrame, right: DataFrame, keys: list[str], k: int, scale: float) -> DataFrame:
    def compare(some_nodes: pa.Table, some_queries: pa.Table) -> pa.Table:
        best = _Running(k, scale)
        if some_nodes.num_rows and some_queries.num_rows:
            best.add(_unit_vectors(some_nodes["node_id"], some_nodes["embedding"]),
                     _unit_vectors(some_queries["query_id"], some_queries["vector"]))
        return pa.Table.from_batches([best.batch()])

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, HITS)


def _nearest(nodes: DataFrame, queries: DataFrame, k: int, scale: float = 1.0) -> DataFrame:
    size = _bytes(queries, "vector")
    if size <= QUERY_BLOCK_BYTES:
        return _scan_with_block(nodes, queries, k, scale)
    return _grid(nodes, queries, k, scale, size)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = [F.round("similarity", COMPARE_DECIMALS).desc(), F.col("node_id")]
    return top_k(hits, ["query_id"], order, k).select("query_id", "rank", "node_id", "similarity")


def vector_search(graph: PropertyGraph, queries: DataFrame, k: int = 10) -> DataFrame:
    """Exact k nodes most similar (cosine) to each ``queries(query_id, vector)``:
    ``query_id, rank, node_id, similarity``.
    """
    check_at_least("k", k, 1)
    return _ranked(_nearest(_vectors_of(graph.nodes), _queries_of(queries), k), k)


# ---- approximate search over a cell index ---------------------------------------------------------------


@dataclass
class VectorIndex:
    """Node vectors laid out in folders by their nearest centroids, one copy in each. Only vectors of one size are
    indexed."""

    path: str
    centroids: np.ndarray
    size: int

    def nodes(self, spark) -> DataFrame:
        return spark.read.parquet(self.path)

    def cells_of(self, rows: np.ndarray, probes: int) -> np.ndarray:
        """The ``probes`` best cells of each unit row, best first."""
        return np.argsort(-(rows @ self.centroids.T), axis=1, kind="stable")[:, :probes]


def build_vector_index(graph: PropertyGraph, size: int, cells: int = 16, path: str | None = None,
                       seed: int = 7, copies: int = 2) -> VectorIndex:
    """Cluster the unit vectors with k-means and write each to its ``copies`` nearest cells, so that a neighbour beyond
    the border of a cell is found in the other one. The centroids are sent to all tasks."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    check_at_least("cells", cells, 1)
    check_at_least("copies", copies, 1)
    unit = _vectors_of(graph.nodes).where(F.size("embedding") == size)
    length = vectors.norm(F.col("embedding"))
    unit = unit.withColumn("_length", length).where("_length > 0").select(
        "node_id", F.transform("embedding", lambda x: x / F.col("_length")).alias("embedding"))
    points = store(unit).df
    model = KMeans(k=cells, seed=seed, maxIter=8, initMode="random").fit(
        points.select(array_to_vector("embedding").alias("features")))
    centers = np.array(model.clusterCenters())
    centers = centers / np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)
    folder = path or f"{shared_folder(points.sparkSession)}/vectors/{uuid.uuid4().hex}"
    index = VectorIndex(folder, centers, size)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                cell = index.cells_of(flat.reshape(batch.num_rows, size), copies)
                for near in cell.T:
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near, pa.int32())],
                                                     names=["node_id", "embedding", "cell"])

    placed = points.mapInArrow(place, "node_id long, embedding array<double>, cell int")
    placed.write.partitionBy("cell").parquet(folder)
    return index


def _once(hits: DataFrame) -> DataFrame:
    """Hits of several copies of a node as one."""
    return hits.groupBy("query_id", "node_id").agg(F.max("similarity").alias("similarity"))


def approx_search(index: VectorIndex, queries: DataFrame, k: int = 10, probes: int = 4) -> DataFrame:
    """As ``vector_search``, reading only the ``probes`` cells nearest to each query; similarities are exact,
    a true neighbour in another cell may be missed.
    """
    check_at_least("k", k, 1)
    check_at_least("probes", probes, 1)
    spark = queries.sparkSession
    wanted = _queries_of(queries).where(F.size("vector") == index.size)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, rows in _unit_vectors(batch.column(0), batch.column(1)).values():
                cell = index.cells_of(rows, probes)
                n = cell.shape[1]
                flat = pa.array(list(np.repeat(rows, n, axis=0)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, n)), flat, pa.array(cell.ravel().astype(np.int32))],
                    names=["query_id", "vector", "cell"])

    probed = store(wanted.mapInArrow(probe, "query_id long, vector array<double>, cell int")).df
    # At most as many numbers as the index has cells: they prune the folders before any file is opened.
    cells = [row.cell for row in probed.select("cell").distinct().collect()]
    nodes = index.nodes(spark).where(F.col("cell").isin(cells)).select("node_id", "embedding", "cell")
    size = _bytes(probed, "vector")
    if size <= QUERY_BLOCK_BYTES:
        table = probed.toArrow()
        by_cell = {c: _unit_vectors(part["query_id"], part["vector"])
                   for c in cells for part in [table.filter(pc.equal(table["cell"], c))]}
        block = spark.sparkContext.broadcast(by_cell)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict[int, _Running] = {}  # by cell: a node is there once, and its copies take no other node's place
            for batch in batches:
                cell = batch.column(2).to_numpy()
                for c in np.unique(cell):
                    part = batch.filter(pa.array(cell == c))
                    best.setdefault(int(c), _Running(k, 1.0)).add(
                        _unit_vectors(part.column(0), part.column(1)), block.value[int(c)])
            for own in best.values():
                yield own.batch()

        return _ranked(_once(nodes.mapInArrow(scan, HITS)), k)
    counts = nodes.groupBy("cell").count()
    chunks = counts.select("cell", F.ceil(F.col("count") * (index.size * 8 + 8) / CELL_BYTES).cast("int").alias("chunks"))
    blocks = max(1, -(-size // QUERY_BLOCK_BYTES))
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = (nodes.join(F.broadcast(chunks), "cell")
            .withColumn("chunk", F.pmod(F.xxhash64("node_id"), F.col("chunks")).cast("int"))
            .withColumn("block", every(F.lit(blocks))).drop("chunks"))
    right = (probed.join(F.broadcast(chunks), "cell").withColumn("chunk", every(F.col("chunks")))
             .withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).drop("chunks"))
    return _ranked(_once(_compare_groups(left, right, ["cell", "chunk", "block"], k, 1.0)), k)


# ---- hybrid ranking -------------------------------------------------------------------------------------


def hybrid_search(graph: PropertyGraph, requests: DataFrame, max_hops: int = 3, k: int = 10,
                  alpha: float = 0.5, direction: str = OUTGOING) -> DataFrame:
    """Blend of similarity and graph proximity for ``requests(request_id, anchor, vector)``:
    ``request_id, rank, node_id, score, similarity, hops``.

    score = alpha * cosine + (1 - alpha) / (1 + hops); proximity is 0 beyond ``max_hops``, similarity 0
    without a comparable embedding. A node that was not reached can only rank among the best k if it is among
    the best k by similarity alone, so the candidates are the reached nodes and those k.
    """
    check_alpha(alpha)
    check_at_least("max_hops", max_hops, 1)
    check_at_least("k", k, 1)
    check_columns(requests, "request_id", "anchor", "vector")
    asked = store(requests.select(F.col("request_id").cast("long"), F.col("anchor").cast("long"),
                                  F.col("vector").cast("array<double>"))).df
    hops = bfs(graph, asked.select(F.col("anchor").alias("node_id")), max_hops, direction)
    reached = (hops.withColumnRenamed("start", "anchor").join(asked, "anchor")
               .join(graph.nodes.select("node_id", "embedding"), "node_id", "left")
               .select("request_id", "node_id", F.col("depth").alias("hops"),
                       vectors.cosine(F.col("embedding"), F.col("vector")).alias("similarity")))
    queries = asked.select(F.col("request_id").alias("query_id"), "vector").where(F.col("vector").isNotNull())
    similar = _nearest(_vectors_of(graph.nodes), queries, k, alpha).select(
        F.col("query_id").alias("request_id"), "node_id", F.lit(None).cast("int").alias("hops"), "similarity")
    near = F.coalesce(1.0 / (1 + F.col("hops")), F.lit(0.0))
    merged = (reached.unionByName(similar).groupBy("request_id", "node_id")
              .agg(F.min("hops").alias("hops"), F.max("similarity").alias("similarity"))
              .withColumn("score", alpha * F.coalesce("similarity", F.lit(0.0)) + (1 - alpha) * near))
    order = [F.round("score", COMPARE_DECIMALS).desc(), F.col("node_id")]
    return top_k(merged, ["request_id"], order, k).select(
        "request_id", "rank", "node_id", "score", "similarity", "hops")


# ---- semantic neighbors and walks -----------------------------------------------------------------------


def semantic_neighbors(graph: PropertyGraph, requests: DataFrame, direction: str = OUTGOING,
                       k: int = 10) -> DataFrame:
    """Neighbors ranked by similarity to a concept for ``requests(request_id, node_id, concept)``."""
    check_at_least("k", k, 1)
    check_columns(requests, "request_id", "node_id", "concept")
    # Written, so that Spark can send a short list of neighbors to the embeddings instead of shuffling those.
    near = store(neighbors(graph, requests, direction).select(
        F.col("request_id").alias("at"), "node_id").distinct()).df
    asked = requests.select("request_id", F.col("node_id").alias("at"), F.col("concept").alias("vector"))
    scored = (near.join(graph.nodes.select("node_id", "embedding"), "node_id").join(asked, "at")
              .withColumn("similarity", vectors.cosine(F.col("embedding"), F.col("vector")))
              .where("similarity is not null"))
    order = [F.round("similarity", COMPARE_DECIMALS).desc(), F.col("node_id")]
    return top_k(scored, ["request_id"], order, k).select("request_id", "rank", "node_id", "similarity")


def semantic_walk(graph: PropertyGraph, requests: DataFrame, max_hops: int = 3,
                  direction: str = OUTGOING) -> DataFrame:
    """Greedy walks for ``requests(request_id, start, concept)``: ``request_id, path``.

    Every step goes to the most similar neighbor not yet visited; a walk ends when none is left.
    """
    check_at_least("max_hops", max_hops, 1)
    check_columns(requests, "request_id", "start", "concept")
    links = scanned_links(graph, direction)
    known = graph.nodes.select(F.col("node_id").alias("start"))
    walks = store(requests.join(known, "start", "left_semi").select(
        "request_id", F.col("concept").alias("vector"), F.col("start").alias("node_id"),
        F.array("start").alias("path"), F.lit(True).alias("moving")), moving=F.count(F.lit(1)))
    targets = graph.nodes.select(F.col("node_id").alias("dst"), "embedding")
    for _ in range(max_hops):
        if not walks.measures["moving"]:
            break
        options = store(links.step(walks.df.where("moving").select("request_id", "node_id", "path"))
                        .where(~F.array_contains("path", F.col("dst"))).select("request_id", "dst")).df
        ahead = (options.join(targets, "dst").join(walks.df.select("request_id", "vector"), "request_id")
                 .withColumn("similarity", F.round(vectors.cosine(F.col("embedding"), F.col("vector")),
                                                   COMPARE_DECIMALS))
                 .where("similarity is not null"))
        chosen = ahead.groupBy("request_id").agg(
            F.max(F.struct("similarity", (-F.col("dst")).alias("minus"))).alias("best"))
        moved = walks.df.join(chosen, "request_id", "left")
        step = -F.col("best.minus")
        walks = store(moved.select(
            "request_id", "vector", F.coalesce(step, "node_id").alias("node_id"),
            F.when(step.isNotNull(), F.array_append("path", step)).otherwise(F.col("path")).alias("path"),
            step.isNotNull().alias("moving")), moving=F.count_if("moving"))
    return walks.df.select("request_id", "path")

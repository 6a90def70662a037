"""Neighbors, breadth-first reach and shortest paths for many requests at once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshlark.graph import (BOTH, INCOMING, OUTGOING, GraphError, PropertyGraph, check_at_least,
                            check_direction)
from meshlark.operators.temporal import graph_at
from meshlark.plans.lineage import Stored, forget, store
from meshlark.plans.skew import Split, laid_out
from meshlark.plans.topk import top_k
from meshlark.sources.adjacency import part_of

#: Rows of a counted key table (two ids each) that may be sent to all tasks.
SMALL_ROWS = 200_000
#: Improvements a search collects in tables of their own before they are merged into its base.
MERGE_EVERY = 12


def neighbors(graph: PropertyGraph, ids: DataFrame, direction: str = OUTGOING,
              edge_type: str | None = None) -> DataFrame:
    """One row per incident edge: ``request_id, node_id, edge_id, edge_type, direction``.

    With ``both``, a self-loop counts once.
    """
    check_direction(direction)
    edges = graph.edges if edge_type is None else graph.edges.where(F.col("edge_type") == edge_type)
    wanted = ids.select(F.col("node_id").alias("request_id")).distinct()

    def side(near: str, far: str, name: str) -> Column:
        return F.struct(F.col(near).alias("request_id"), F.col(far).alias("node_id"), F.lit(name).alias("direction"))

    out, back = side("src", "dst", OUTGOING), side("dst", "src", INCOMING)
    if direction == BOTH:
        # Both ends of a row come out of one scan of the edges.
        loop = F.col("src") == F.col("dst")
        ends = F.explode(F.when(loop, F.array(out)).otherwise(F.array(out, back))).alias("end")
        rows = edges.select("edge_id", "edge_type", ends)
    else:
        rows = edges.select("edge_id", "edge_type", (out if direction == OUTGOING else back).alias("end"))
    flat = rows.select("end.request_id", "end.node_id", "edge_id", "edge_type", "end.direction")
    return flat.join(wanted, "request_id")


def neighbors_at(graph: PropertyGraph, ids: DataFrame, timestamp: int, direction: str = OUTGOING,
                 edge_type: str | None = None) -> DataFrame:
    return neighbors(graph_at(graph, timestamp), ids, direction, edge_type)


# ---- one step over the links, shared by all loops -------------------------------------------------------


@dataclass
class Links:
    """Where a step finds the links ``(src, dst, weight)`` that leave a node.

    Either stored tables as they are, read again at every step (``tables``; with ``parts``, in walking order), or
    links merged and written once with hot sources cut into slices (``split``).
    """

    tables: list[DataFrame] = field(default_factory=list)
    parts: int | None = None
    split: Split | None = None
    rows: int = 0
    smallest_weight: float | None = None

    def step(self, frontier: DataFrame, key: str = "node_id") -> DataFrame:
        """Join frontier rows to the links that leave their node: adds ``dst`` and ``weight``.

        A small frontier is broadcast by its exact file size, so links do not move, and tables in walking order are
        read only in the frontier's parts. For a large frontier merged links that are bucketed stay where they are.
        """
        if self.split is not None:
            return self.split.joined(frontier, key)
        if self.parts is None:
            return _union([frontier.join(t.withColumnRenamed("src", key), key) for t in self.tables])
        # The comparison keeps every row; Spark prunes folders only by a side that it takes for filtered.
        placed = frontier.withColumn("part", part_of(F.col(key), self.parts)).where("part >= 0")
        return _union([placed.join(t.withColumnRenamed("src", key), [key, "part"]) for t in self.tables]).drop("part")


def _directed(edges: DataFrame, direction: str) -> DataFrame:
    """``src, dst, weight`` in walking direction; both directions come out of one scan."""
    if direction == OUTGOING:
        return edges.select("src", "dst", "weight")
    if direction == INCOMING:
        return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    way = lambda a, b: F.struct(F.col(a).alias("src"), F.col(b).alias("dst"))
    ends = F.explode(F.array(way("src", "dst"), way("dst", "src"))).alias("end")
    return edges.select(ends, "weight").select("end.src", "end.dst", "weight")


def _of_type(edges: DataFrame, edge_type: str | None) -> DataFrame:
    return edges if edge_type is None else edges.where(F.col("edge_type") == edge_type)


def links_of(edges: DataFrame, direction: str = OUTGOING, edge_type: str | None = None) -> Links:
    """Merge parallel edges (least weight), drop self-loops, store the result once for all rounds: for searches with
    many rounds over many origins."""
    check_direction(direction)
    kept = _of_type(edges, edge_type).where(F.col("src") != F.col("dst"))
    merged = _directed(kept, direction).groupBy("src", "dst").agg(F.min("weight").alias("weight"))
    stored = store(merged, smallest=F.min("weight"))
    return Links(split=laid_out(stored.df, stored.rows, "src", "dst"), rows=stored.rows, smallest_weight=stored.measures["smallest"])


def scanned_links(graph: PropertyGraph, direction: str = OUTGOING, edge_type: str | None = None) -> Links:
    """The stored edges themselves: the graph's walking order if it has one, else its edge table."""
    check_direction(direction)
    if graph.adjacency is None:
        return Links([_directed(_of_type(graph.edges, edge_type), direction)])
    tables = [_of_type(t, edge_type).select("src", "dst", "weight", "part") for t in graph.adjacency.tables(direction)]
    return Links(tables, graph.adjacency.parts)


def _turned(direction: str) -> str:
    return {OUTGOING: INCOMING, INCOMING: OUTGOING}.get(direction, BOTH)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _together(tables: list[Stored]) -> DataFrame:
    """Written tables of one schema as one scan."""
    first = tables[0].df
    return first.sparkSession.read.schema(first.schema).parquet(*[t.path for t in tables])


def _known(nodes: DataFrame, ids: DataFrame) -> DataFrame:
    """Which of the ids in ``ids(node_id)``, written, are nodes. A short list goes to the nodes, not the nodes to it."""
    return nodes.select("node_id").join(ids, "node_id", "left_semi").distinct()


def _unseen(reached: DataFrame, seen: list[Stored], keys: list[str]) -> DataFrame:
    """Rows of ``reached`` (distinct by ``keys``) that no table of ``seen`` has.

    A small seen set is sent to the tasks. Beyond that ``reached`` is written; if it is small, it is sent to the seen
    set to find what it has of it. Only two large sides meet in a shuffle.
    """
    known = _together(seen).select(*keys)
    if sum(t.rows for t in seen) <= SMALL_ROWS:
        return reached.join(F.broadcast(known), keys, "left_anti")
    reached = store(reached)
    if reached.rows <= SMALL_ROWS:
        known = F.broadcast(known.join(F.broadcast(reached.df.select(*keys)), keys, "left_semi"))
    return reached.df.join(known, keys, "left_anti")


# ---- breadth-first search -------------------------------------------------------------------------------


def bfs(graph: PropertyGraph, starts: DataFrame, max_depth: int = 3, direction: str = OUTGOING,
        edge_type: str | None = None, prepare: bool = False, most: int | None = None) -> DataFrame:
    """Nodes reached from each start with their least depth: ``start, node_id, depth``; a start has depth 0.

    One written frontier per level; unknown starts drop out. Stops when no start has a new node. Each level reads the
    stored edges where they are, pruned if the graph has a walking order. ``prepare`` merges and stores all links
    first: for edges that are costly to derive, or for large frontiers over many levels. ``most`` keeps the first nodes
    by (depth, id) of each start and walks no further than they need.
    """
    check_at_least("max_depth", max_depth, 0)
    seeds = store(starts.select("node_id").where("node_id IS NOT NULL").distinct())
    known = _known(graph.nodes, seeds.df)
    levels = [store(known.select(F.col("node_id").alias("start"), "node_id", F.lit(0).alias("depth")))]
    links = links_of(graph.edges, direction, edge_type) if prepare and max_depth else scanned_links(graph, direction, edge_type)
    for depth in range(1, max_depth + 1):
        if not levels[-1].rows:
            break
        frontier = levels[-1].df
        if most is not None:
            frontier = frontier.join(_room(levels, most).where("room > 0").select("start"), "start", "left_semi")
        reached = links.step(frontier.select("start", "node_id")).select("start", F.col("dst").alias("node_id")).distinct()
        # Without directions a neighbor of a level lies in it or in the ones beside it.
        fresh = _unseen(reached, levels[-2:] if direction == BOTH else levels, ["start", "node_id"])
        if most is not None:
            first = top_k(fresh, ["start"], [F.col("node_id")], most, "_rank")
            fresh = first.join(_room(levels, most), "start").where("_rank <= room")
        levels.append(store(fresh.select("start", "node_id", F.lit(depth).alias("depth"))))
    return _together(levels)


def _room(levels: list[Stored], most: int) -> DataFrame:
    return _together(levels).groupBy("start").agg((F.lit(most) - F.count(F.lit(1))).alias("room"))


def bfs_at(graph: PropertyGraph, starts: DataFrame, timestamp: int, max_depth: int = 3,
           direction: str = OUTGOING, edge_type: str | None = None, prepare: bool = False) -> DataFrame:
    return bfs(graph_at(graph, timestamp), starts, max_depth, direction, edge_type, prepare)


# ---- shortest paths -------------------------------------------------------------------------------------


def shortest_path(graph: PropertyGraph, pairs: DataFrame, weighted: bool = False,
                  direction: str = OUTGOING) -> DataFrame:
    """Best path per ``pairs(from_node, to_node)``: ``from_node, to_node, path, length, cost``.

    Fewest hops, or least total weight with ``weighted``. Ties: fewest hops, then the smallest id sequence.
    No path or an unknown node: ``path`` NULL. Hops are searched from both ends. Weights are searched backward from the
    targets; a forward walk over the distances then picks the smallest next node, so no predecessors are kept.
    """
    check_direction(direction)
    wanted = store(pairs.select("from_node", "to_node").distinct()).df
    ends = store(wanted.select(F.explode(F.array("from_node", "to_node")).alias("node_id")).where("node_id IS NOT NULL").distinct())
    ids = _known(graph.nodes, ends.df)
    sound = store(wanted.join(ids.toDF("from_node"), "from_node", "left_semi")
                  .join(ids.toDF("to_node"), "to_node", "left_semi").select("from_node", "to_node"))
    forward, back = scanned_links(graph, direction), scanned_links(graph, _turned(direction))
    if weighted:
        if (graph.edges.agg(F.min("weight")).first()[0] or 0.0) < 0:
            raise GraphError("weighted search needs weights >= 0")
        paths = _walk(forward, sound.df, _least_cost(back, sound))
    else:
        paths = _two_sided(forward, back, sound)
    return wanted.join(paths, ["from_node", "to_node"], "left").select(
        "from_node", "to_node", "path", "length", "cost")


def shortest_path_at(graph: PropertyGraph, pairs: DataFrame, timestamp: int, weighted: bool = False,
                     direction: str = OUTGOING) -> DataFrame:
    return shortest_path(graph_at(graph, timestamp), pairs, weighted, direction)


class _Side:
    """Levels around the origins of one side of a two-sided search.

    Only the newest level carries paths: of all shortest ones to a node the smallest id sequence.
    """

    def __init__(self, links: Links, origins: DataFrame, ahead: bool):
        self.links, self.ahead = links, ahead
        self.level = store(origins.distinct().select("origin", F.col("origin").alias("node_id"), F.array("origin").alias("path")))
        self.seen = [self.level]

    def grow(self, wanted: DataFrame) -> None:
        """One level further from the origins in ``wanted(origin)``."""
        active = self.level.df.join(wanted, "origin", "left_semi")
        longer = F.array_append("path", F.col("dst")) if self.ahead else F.array_prepend("path", F.col("dst"))
        reached = self.links.step(active).groupBy("origin", F.col("dst").alias("node_id")).agg(F.min(longer).alias("path"))
        self.level = store(_unseen(reached, self.seen, ["origin", "node_id"]).select("origin", "node_id", "path"))
        self.seen.append(self.level)


def _two_sided(forward: Links, back: Links, pairs: Stored) -> DataFrame:
    """Shortest paths by hops: the smaller of the two newest levels grows until they meet.

    A pair's levels i and j first share a node when its distance is i + j; the shared nodes are then the i-th nodes
    of all its shortest paths. A side that finds nothing new ends the search for all pairs still open.
    """
    origins = lambda df, name: df.select(F.col(name).alias("origin"))
    left, right = _Side(forward, origins(pairs.df, "from_node"), True), _Side(back, origins(pairs.df, "to_node"), False)
    still, rows, found = pairs.df, pairs.rows, []
    while rows:
        ahead = left.level.df.select(F.col("origin").alias("from_node"), "node_id", F.col("path").alias("_ahead"))
        behind = right.level.df.select(F.col("origin").alias("to_node"), "node_id", F.col("path").alias("_behind"))
        whole = F.concat("_ahead", F.slice("_behind", F.lit(2), F.size("_behind")))
        met = store(still.join(ahead, "from_node").join(behind, ["to_node", "node_id"])
                    .groupBy("from_node", "to_node").agg(F.min(whole).alias("path")))
        if met.rows:
            found.append(met)
            rows -= met.rows
            still = pairs.df.join(_together(found), ["from_node", "to_node"], "left_anti")
        if not (rows and left.level.rows and right.level.rows):
            break
        side, name = (left, "from_node") if left.level.rows <= right.level.rows else (right, "to_node")
        side.grow(origins(still, name).distinct())
    whole = _together(found) if found else pairs.df.select("*", F.array(F.col("from_node")).alias("path")).where(F.lit(False))
    hops = F.size("path") - 1
    return whole.select("from_node", "to_node", "path", hops.alias("length"), hops.cast("double").alias("cost"))


def _least_cost(back: Links, pairs: Stored) -> DataFrame:
    """Least (cost, hops) to each target.

    A row dearer than the worst current source cost of its target cannot help any pair and is not extended.
    """

    def useful(active: DataFrame, state: DataFrame) -> DataFrame:
        known = state.select(F.col("origin").alias("to_node"), F.col("node_id").alias("from_node"), "best.cost")
        bound = (wanted.join(known.join(F.broadcast(wanted) if small else wanted, ["from_node", "to_node"], "left_semi"),
                             ["from_node", "to_node"], "left")
                 .groupBy("from_node", "to_node").agg(F.coalesce(F.min("cost"), F.lit(float("inf"))).alias("cost"))
                 .groupBy(F.col("to_node").alias("origin")).agg(F.max("cost").alias("bound")))
        return active.join(bound, "origin").where(F.col("best.cost") <= F.col("bound")).drop("bound")

    wanted, small = pairs.df, pairs.rows <= SMALL_ROWS
    found = relax(back, wanted.select(F.col("to_node").alias("origin")).distinct(), useful)
    return found.withColumnRenamed("origin", "target")


def relax(links: Links, origins: DataFrame, useful: Callable | None = None, hops: bool = True) -> DataFrame:
    """``origin, node_id, cost[, hops]``: least (cost, hops) from every origin along the links.

    A round extends only the rows that the last one improved, and writes only what it improves: the state is a base
    and the improvements since, merged when they outgrow it. ``useful(active, state)`` may drop rows that need no
    extension; ``state`` may still list rows that were improved later. Without ``hops`` the offers are plain numbers,
    which Spark aggregates by hash instead of by sorting.
    """
    keys = ["origin", "node_id"]
    start = F.struct(F.lit(0.0).alias("cost"), F.lit(0).alias("hops")) if hops else F.lit(0.0)
    dearer = (F.struct((F.col("best.cost") + F.col("weight")).alias("cost"), (F.col("best.hops") + 1).alias("hops"))
              if hops else F.col("best") + F.col("weight"))
    tables = [store(origins.select("origin", F.col("origin").alias("node_id"), start.alias("best")))]
    while tables[-1].rows:
        active = tables[-1].df
        if useful is not None:
            active = useful(active, _together(tables))
        offers = links.step(active).groupBy("origin", F.col("dst").alias("node_id")).agg(F.min(dearer).alias("offer"))
        state = _together(tables)
        if sum(t.rows for t in tables) > SMALL_ROWS:
            written = store(offers)
            offers = written.df
            if written.rows <= SMALL_ROWS:  # the few keys go to the state, not the state to them
                state = state.join(F.broadcast(offers.select(*keys)), keys, "left_semi")
        known = state.groupBy(*keys).agg(F.min("best").alias("best"))
        better = F.col("best").isNull() | (F.col("offer") < F.col("best"))
        tables.append(store(offers.join(known, keys, "left").where(better).select(*keys, F.col("offer").alias("best"))))
        if len(tables) > MERGE_EVERY and 2 * sum(t.rows for t in tables[1:]) > tables[0].rows and tables[-1].rows:
            last = tables[-1]
            merged = store(_together(tables).groupBy(*keys).agg(F.min("best").alias("best")))
            for t in tables[:-1]:
                forget(t)
            tables = [merged, last]
    whole = _together(tables).groupBy(*keys).agg(F.min("best").alias("best"))
    found = ["best.cost", "best.hops"] if hops else [F.col("best").alias("cost")]
    return whole.select("origin", "node_id", *found)


def _walk(forward: Links, pairs: DataFrame, distances: DataFrame) -> DataFrame:
    """Follow the distances from every source to its target, always to the smallest fitting node."""
    known = store(distances.select(F.col("target").alias("to_node"), "node_id", "cost", "hops")).df
    at = store(pairs.withColumn("node_id", F.col("from_node")).join(known, ["to_node", "node_id"])
               .select("from_node", "to_node", "node_id", "cost", "hops", F.col("cost").alias("total"),
                       F.col("hops").alias("length"), F.array("node_id").alias("path")),
               longest=F.max("hops"))
    for _ in range(at.measures["longest"] or 0):
        moving = at.df.where("hops > 0")
        ahead = known.select("to_node", F.col("node_id").alias("dst"), F.col("cost").alias("_cost"),
                             F.col("hops").alias("_hops"))
        # The same two numbers were added when the distance was found, so equality is exact.
        fitting = (forward.step(moving).join(ahead, ["to_node", "dst"])
                   .where((F.col("_hops") == F.col("hops") - 1)
                          & (F.col("_cost") + F.col("weight") == F.col("cost"))))
        nearest = fitting.groupBy("from_node", "to_node").agg(
            F.min(F.struct("dst", "_cost", "_hops")).alias("next"))
        moved = moving.join(nearest, ["from_node", "to_node"]).select(
            "from_node", "to_node", F.col("next.dst").alias("node_id"), F.col("next._cost").alias("cost"),
            F.col("next._hops").alias("hops"), "total", "length",
            F.array_append("path", F.col("next.dst")).alias("path"))
        at = store(at.df.where("hops = 0").unionByName(moved))
    return at.df.select("from_node", "to_node", "path", "length", F.col("total").alias("cost"))


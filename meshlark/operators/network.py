"""Network analytics over edges ``src, dst, weight`` (optionally protocol, total_bytes, num_flows).

Vertices are rows ``id``; ids may be numbers or texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshlark.graph import GraphError, PropertyGraph, check_at_least
from meshlark.operators.traverse import Links, bfs, links_of, relax, shortest_path
from meshlark.plans.lineage import Stored, forget, scratch, store
from meshlark.plans.skew import Split, laid_out

c = F.col
#: Relative difference of path lengths below which they count as equal.
TIE = 1e-12
#: Betweenness sends the links that paths can take after their first one to all tasks, up to so many links and vertices;
#: beyond, paths are rows of tables, for so many pairs of a source and a link at a time.
CORE_LINKS, TABLE_PAIRS = 1_000_000, 200_000_000
#: Pairs of a source and a link that a task handles at a time.
TASK_PAIRS = 1_000_000


def _ends(edges: DataFrame, *keep: str) -> DataFrame:
    """Both ends of every edge from one scan: ``id, entering`` and the kept columns."""
    end = lambda name, entering: F.struct(c(name).alias("id"), F.lit(entering).alias("entering"))
    both = F.explode(F.array(end("dst", True), end("src", False))).alias("end")
    return edges.select(both, *keep).select("end.id", "end.entering", *keep)


def degrees(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """``id, degree_in, degree_out, degree_total``; a loop counts in and out, a vertex without edges has 0."""
    counted = _ends(edges).groupBy("id").agg(
        F.count_if("entering").alias("degree_in"), F.count_if(~c("entering")).alias("degree_out"))
    return (vertices.select("id").join(counted, "id", "left").fillna(0, ["degree_in", "degree_out"])
            .withColumn("degree_total", c("degree_in") + c("degree_out")))


def degree_frequency(degree: DataFrame) -> DataFrame:
    """Number of vertices per total degree above 0."""
    return (degree.where("degree_total > 0").groupBy(c("degree_total").alias("degree"))
            .agg(F.count(F.lit(1)).alias("n")))


def degree_histogram(degree: DataFrame, bins: int = 30) -> DataFrame:
    """Vertices per equal-width bin of the total degree: ``bin`` (from 1), ``n``."""
    check_at_least("bins", bins, 1)
    low = degree.agg(F.min("degree_total")).scalar()
    width = (degree.agg(F.max("degree_total")).scalar() - low) / F.lit(float(bins))
    place = F.when(width > 0, F.least(F.floor((c("degree_total") - low) / width) + 1, F.lit(bins))).otherwise(1)
    return degree.groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def _merged(edges: DataFrame) -> list:
    """Sums of the measures, and the protocol of the first edge (the least name where no order is known)."""
    merged = [F.sum(n).alias(n) for n in ("weight", "total_bytes", "num_flows") if n in edges.columns]
    if "protocol" in edges.columns and "first_edge" in edges.columns:
        merged += [F.min_by("protocol", "first_edge").alias("protocol"), F.min("first_edge").alias("first_edge")]
    elif "protocol" in edges.columns:
        merged.append(F.min("protocol").alias("protocol"))
    return merged


def simplify(edges: DataFrame) -> DataFrame:
    """Merge parallel edges and drop loops."""
    return edges.where(c("src") != c("dst")).groupBy("src", "dst").agg(*_merged(edges))


def collapse(edges: DataFrame) -> DataFrame:
    """Undirected edges ``src <= dst``: both directions merged."""
    return edges.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(
        *_merged(edges))


def strength(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """``id, strength``: weight of all edges that leave or enter a vertex."""
    summed = _ends(edges, "weight").groupBy("id").agg(F.sum("weight").cast("double").alias("strength"))
    return vertices.select("id").join(summed, "id", "left").fillna(0.0, ["strength"])


# ---- PageRank -------------------------------------------------------------------------------------------


def pagerank(edges: DataFrame, vertices: DataFrame, damping: float = 0.85, tol: float = 1e-9,
             max_rounds: int | None = None) -> DataFrame:
    """``id, pagerank`` (sums to 1) on directed weighted edges; edges without a weight above 0 do not count.

    Every round spreads the newest mass ``fresh`` over the out-links; ``settled`` collects it. Mass at a vertex
    without out-links is lost on the way and the final scaling restores it, which equals spreading it evenly,
    so no round needs a global sum before it can start. Stops when a round changes less than ``tol`` in all, which
    it must, since what moves shrinks by ``damping`` or more each round; ``max_rounds`` raises if that takes longer.
    After the first round only vertices that a link enters can hold fresh mass: the others are settled, and neither they nor
    their links are read again. Large links are bucketed once, hot sources in slices; only the mass table moves.
    """
    if not 0.0 < damping < 1.0:
        raise GraphError("damping must lie between 0 and 1")
    links = edges.where("weight > 0")
    out = links.groupBy("src").agg(F.sum("weight").alias("_out"))
    flow = store(links.join(out, "src").select(
        "src", "dst", (c("weight") / c("_out") * damping).alias("share")))
    n = vertices.select("id").distinct().count()
    if not n:
        return vertices.select("id", F.lit(None).cast("double").alias("pagerank"))
    state = store(vertices.select("id").distinct().select(
        "id", F.lit(0.0).alias("settled"), F.lit(1.0 / n).alias("fresh")))
    arrows, rest = Split(flow.df, "src", None), None
    rounds = 0
    while True:
        if rounds == max_rounds:
            raise GraphError(f"PageRank has not converged to {tol} in {max_rounds} rounds")
        rounds += 1
        mass = state.df.where("fresh > 0").select(c("id").alias("src"), "fresh")
        sent = (arrows.joined(mass, "src").groupBy(c("dst").alias("id"))
                .agg(F.sum(c("fresh") * c("share")).alias("got")))
        got = F.coalesce("got", F.lit(0.0))
        after = store(
            state.df.join(sent, "id", "left").select(
                "id", (c("settled") + (1 - damping) * c("fresh")).alias("settled"), got.alias("fresh"),
                F.abs(got - damping * c("fresh")).alias("moved")),
            moved=F.sum("moved"))
        forget(state)
        state = after
        if (after.measures["moved"] or 0.0) < tol:
            break
        if rest is None:
            rest, state = after.df.where("fresh = 0"), store(after.df.where("fresh > 0"))
            kept = store(flow.df.join(state.df.select(c("id").alias("src")), "src", "left_semi"))
            arrows = laid_out(kept.df, kept.rows, "src", "dst")
            forget(flow)
    whole = state.df if rest is None else state.df.unionByName(rest)
    whole = whole.select("id", (c("settled") + c("fresh")).alias("mass"))
    total = whole.agg(F.sum("mass")).first()[0]
    return whole.select("id", (c("mass") / total).alias("pagerank"))


# ---- betweenness ----------------------------------------------------------------------------------------


def betweenness(edges: DataFrame, vertices: DataFrame, normalized: bool = True,
                pivots: DataFrame | None = None) -> DataFrame:
    """``id, betweenness`` on directed edges; weights are lengths and must be above 0. Lengths that differ by less
    than ``TIE``, relatively, are equal.

    Exact. After its first link a path only meets vertices that some link enters, so the links between those, the core,
    decide all distances. If they are few, they are sent to all tasks, which follow the paths of some sources at a
    time and pass on nothing but sums by vertex. Otherwise paths are rows of tables, for a part of the sources at a
    time. ``pivots(id)`` restricts the sources for an estimate, scaled up to all vertices.
    """
    ids = store(vertices.select("id").distinct())
    sources = ids.df if pivots is None else ids.df.join(pivots.select("id").distinct(), "id", "left_semi")
    n_sources = sources.count()
    links = store(edges.where(c("src") != c("dst")).groupBy("src", "dst").agg(F.min(c("weight").cast("double")).alias("weight"))
                  .where("weight IS NOT NULL"), smallest=F.min("weight"))
    if links.measures["smallest"] is not None and links.measures["smallest"] <= 0:
        raise GraphError("betweenness needs weights above 0")
    inner = store(links.df.select(c("dst").alias("id")).distinct())
    core = store(links.df.join(inner.df.withColumnRenamed("id", "src"), "src", "left_semi"))
    if max(core.rows, inner.rows) <= CORE_LINKS:
        summed = _followed(links, inner, core, sources)
    else:
        summed = _by_tables(links_of(links.df), sources, max(1, -(-n_sources * core.rows // TABLE_PAIRS)))
    n = ids.rows
    scale = 1.0 if not normalized else (1.0 / ((n - 1) * (n - 2)) if n > 2 else 0.0)
    if pivots is not None and n_sources:
        scale *= n / n_sources
    return ids.df.join(summed, "id", "left").select(
        "id", (F.coalesce("betweenness", F.lit(0.0)) * scale).alias("betweenness"))


def _followed(links: Stored, inner: Stored, core: Stored, sources: DataFrame) -> DataFrame:
    """``id, betweenness``: sums over the sources, by tasks that hold the core."""
    spark = links.df.sparkSession
    names = inner.df.toArrow().sort_by("id")
    numbers = pa.table({"id": names["id"], "at": pa.array(np.arange(names.num_rows, dtype=np.int32))})
    index = store(spark.createDataFrame(numbers)).df
    number = lambda name, to: index.select(c("id").alias(name), c("at").alias(to))
    arrows = core.df.join(number("src", "a"), "src").join(number("dst", "b"), "dst").select("a", "b", "weight").toArrow()
    shared = spark.sparkContext.broadcast(_Core(
        names.num_rows, *(arrows[n].to_numpy() for n in ("a", "b", "weight"))))
    origin = sources.withColumnRenamed("id", "origin")
    # A source in the core starts there, at 0; any other one at the ends of its links.
    starts = number("origin", "at").join(origin, "origin", "left_semi").select("origin", "at", F.lit(0.0).alias("cost")).unionByName(
        links.df.withColumnRenamed("src", "origin").join(number("origin", "_"), "origin", "left_anti")
        .join(origin, "origin", "left_semi").join(number("dst", "at"), "dst").select("origin", "at", c("weight").alias("cost")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, score = shared.value, None, np.zeros(shared.value.size)
        most = TASK_PAIRS // 8
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if held.num_rows >= most:
                begins = _begins(held["origin"])
                if len(begins) > 1:  # the last source may go on
                    own.add(held.slice(0, begins[-1]), begins[:-1], score)
                    held = held.slice(begins[-1]).combine_chunks()
                most = max(TASK_PAIRS // 8, 2 * held.num_rows)
        if held is not None and held.num_rows:
            own.add(held, _begins(held["origin"]), score)
        at = np.flatnonzero(score)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(score[at])], ["at", "part"])

    sums = starts.repartition(parts, "origin").sortWithinPartitions("origin").mapInArrow(follow, "at int, part double")
    return store(sums.groupBy("at").agg(F.sum("part").alias("betweenness")).join(index, "at").select("id", "betweenness")).df


def _begins(origin: pa.ChunkedArray) -> np.ndarray:
    """Rows at which another source begins."""
    new = pc.not_equal(origin.slice(1), origin.slice(0, len(origin) - 1)).to_numpy()
    return np.append(0, np.flatnonzero(new) + 1)


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[0], first[0] + 1, ...``, ``size[0]`` numbers, then those of the next."""
    return np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())


class _Core:
    """The links that paths can take after their first one, by the vertex they leave; vertices are numbers below ``size``."""

    def __init__(self, size: int, src: np.ndarray, dst: np.ndarray, weight: np.ndarray):
        order = np.argsort(src, kind="stable")
        self.size, self.dst, self.weight = size, dst[order].astype(np.int64), weight[order]
        self.degree = np.bincount(src, minlength=size)
        self.first = np.cumsum(self.degree) - self.degree

    def add(self, starts: pa.Table, begins: np.ndarray, score: np.ndarray) -> None:
        """Add what vertices owe to the sources that begin at the rows ``begins`` of ``starts``."""
        at, cost = starts["at"].to_numpy().astype(np.int64), starts["cost"].to_numpy()
        step = max(1, TASK_PAIRS // max(len(self.dst), self.size, 1))
        ends = np.append(begins, starts.num_rows)
        dist = np.full(step * self.size, np.inf)
        for k in range(0, len(begins), step):
            some = ends[k:k + step + 1]
            place = np.repeat(np.arange(len(some) - 1), np.diff(some)) * self.size + at[some[0]:some[-1]]
            self._follow(place, cost[some[0]:some[-1]], dist, score)

    def _steps(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The links that leave places (source * ``size`` + vertex): which place, where to, and how long."""
        vertex = place % self.size
        link = _ranges(self.first[vertex], self.degree[vertex])
        near = np.repeat(np.arange(len(place)), self.degree[vertex])
        return near, (place - vertex)[near] + self.dst[link], self.weight[link]

    def _follow(self, place: np.ndarray, cost: np.ndarray, dist: np.ndarray, score: np.ndarray) -> None:
        np.minimum.at(dist, place, cost)
        now = np.unique(place)
        seen = [now]
        while len(now):
            near, far, weight = self._steps(now)
            offer = dist[now][near] + weight
            less = offer < dist[far]
            far, offer = far[less], offer[less]
            np.minimum.at(dist, far, offer)
            now = np.unique(far[offer == dist[far]])
            seen.append(now)
        all_ = np.unique(np.concatenate(seen))
        lengths = dist[all_]
        start = place[np.abs(cost - dist[place]) <= TIE * dist[place]]
        near, far, weight = self._steps(all_)
        ends = dist[far]
        on_path = np.abs(lengths[near] + weight - ends) <= TIE * ends
        near, far = near[on_path], np.searchsorted(all_, far[on_path])
        dist[all_] = np.inf
        size = np.bincount(near, minlength=len(all_))
        first, left = np.cumsum(size) - size, np.bincount(far, minlength=len(all_))
        paths = np.bincount(np.searchsorted(all_, start), minlength=len(all_)).astype(float)
        now, rounds = np.flatnonzero(left == 0), []
        while len(now):  # places whose paths are all counted
            links = _ranges(first[now], size[now])
            if not len(links):
                break
            rounds.append(links)
            ahead = far[links]
            np.add.at(paths, ahead, paths[near[links]])
            np.subtract.at(left, ahead, 1)
            now = np.unique(ahead[left[ahead] == 0])
        owed = np.zeros(len(all_))
        for links in reversed(rounds):
            a, b = near[links], far[links]
            np.add.at(owed, a, paths[a] / paths[b] * (1 + owed[b]))
        owed[lengths == 0] = 0  # the source itself
        score += np.bincount(all_ % self.size, owed, len(score))


def _by_tables(links: Links, sources: DataFrame, blocks: int) -> DataFrame:
    """``id, betweenness``: state per (source, vertex), for one of ``blocks`` parts of the sources after the other; what a
    part has written goes when its sums are there. Path counts run forward and dependencies backward over the links
    that lie on a shortest path, one round per hop."""
    sums = []
    for k in range(blocks):
        with scratch() as written:
            own = store(sources.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k)).df
            sums.append(store(_table_sums(links, own)))
            written.pop()
    return sources.sparkSession.read.schema(sums[0].df.schema).parquet(*[s.path for s in sums]).groupBy("id").agg(
        F.sum("betweenness").alias("betweenness"))


def _table_sums(links: Links, sources: DataFrame) -> DataFrame:
    cost = relax(links, sources.withColumnRenamed("id", "origin"), hops=False)
    ahead = cost.select("origin", c("node_id").alias("dst"), c("cost").alias("cost_dst"))
    on_path = store(links.step(cost).join(ahead, ["origin", "dst"])
                    .where(F.abs(c("cost") + c("weight") - c("cost_dst")) <= TIE * c("cost_dst"))
                    .select("origin", "node_id", "dst")).df
    first = store(sources.select(c("id").alias("origin"), c("id").alias("node_id"), F.lit(1.0).alias("paths")))
    counts = _spread(on_path, first.df, "paths", forward=True)
    paths = store(counts.unionByName(first.df).groupBy("origin", "node_id").agg(F.sum("paths").alias("paths"))).df
    ends = paths.select("origin", c("node_id").alias("dst"), c("paths").alias("paths_dst"))
    shared = store(on_path.join(paths, ["origin", "node_id"]).join(ends, ["origin", "dst"]).select(
        "origin", "node_id", "dst", (c("paths") / c("paths_dst")).alias("part"))).df
    ones = cost.select("origin", "node_id", F.lit(1.0).alias("part_sum"))
    owed = _spread(shared, ones, "part_sum", forward=False)
    return (owed.where(c("origin") != c("node_id")).groupBy(c("node_id").alias("id"))
            .agg(F.sum("part_sum").alias("betweenness")))


def _spread(links: DataFrame, start: DataFrame, value: str, forward: bool) -> DataFrame:
    """Repeatedly push ``value`` along ``links`` and return all later rounds together, summed."""
    near, far = ("node_id", "dst") if forward else ("dst", "node_id")
    part = c("part") if "part" in links.columns else F.lit(1.0)
    arrows = links.select("origin", c(near).alias("_near"), c(far).alias("_far"), part.alias("_part"))
    wave, rounds = start, []
    while True:
        step = (arrows.join(wave.withColumnRenamed("node_id", "_near"), ["origin", "_near"])
                .groupBy("origin", c("_far").alias("node_id")).agg(F.sum(c(value) * c("_part")).alias(value)))
        stored = store(step)
        if not stored.rows:
            break
        wave = stored.df
        rounds.append(wave)
    if not rounds:
        return start.where(F.lit(False))
    whole = rounds[0]
    for other in rounds[1:]:
        whole = whole.unionByName(other)
    return whole.groupBy("origin", "node_id").agg(F.sum(value).alias(value))


def centralities(edges: DataFrame, vertices: DataFrame, n: int = 20, pivots: DataFrame | None = None) -> DataFrame:
    """The top ``n`` by PageRank with degrees, strength and betweenness of the simplified network; ``pivots`` as for
    ``betweenness``."""
    simple = store(simplify(edges)).df
    rank = pagerank(simple, vertices).select("id", F.round("pagerank", 6).alias("pagerank"))
    between = betweenness(simple, vertices, pivots=pivots).select("id", F.round("betweenness", 6).alias("betweenness"))
    degree = degrees(simple, vertices).select(
        "id", c("degree_total").alias("degree"), c("degree_in").alias("in_degree"), c("degree_out").alias("out_degree"))
    return (degree.join(strength(simple, vertices), "id").join(between, "id").join(rank, "id")
            .orderBy(c("pagerank").desc(), "id").limit(n))


# ---- partitions of the network --------------------------------------------------------------------------


def modularity(edges: DataFrame, membership: DataFrame) -> DataFrame:
    """One row ``modularity`` of ``membership(id, community)`` on undirected weighted edges (each stored once)."""
    ends = lambda name: membership.select(c("id").alias(name), c("community").alias(f"{name}_community"))
    joined = edges.select("src", "dst", "weight").join(ends("src"), "src").join(ends("dst"), "dst")
    sides = joined.select(
        F.explode(F.array(
            F.struct(c("src_community").alias("community"), "weight",
                     (c("src_community") == c("dst_community")).alias("inner")),
            F.struct(c("dst_community").alias("community"), "weight", F.lit(False).alias("inner")))).alias("x"))
    per = sides.groupBy("x.community").agg(
        F.sum("x.weight").alias("tot"), F.sum(F.when(c("x.inner"), c("x.weight")).otherwise(0)).alias("within"))
    parts = per.agg(F.sum("within").alias("w"), F.sum(c("tot") * c("tot")).alias("sq"), F.sum("tot").alias("two_m"))
    m = c("two_m") / 2
    return parts.select((c("w") / m - c("sq") / (4 * m * m)).alias("modularity"))


def community_sizes(membership: DataFrame) -> DataFrame:
    return (membership.groupBy("community").agg(F.count(F.lit(1)).alias("members"))
            .orderBy(c("members").desc(), "community"))


# ---- tables of the network map --------------------------------------------------------------------------


def map_nodes(simple: DataFrame, vertices: DataFrame, membership: DataFrame | None = None) -> DataFrame:
    """``id, label, value, group``: size by strength, colour by community."""
    sized = strength(simple, vertices).select("id", c("id").cast("string").alias("label"), c("strength").alias("value"))
    if membership is None:
        return sized.withColumn("group", F.lit(None).cast("string"))
    groups = membership.select("id", c("community").cast("string").alias("group"))
    return sized.join(groups, "id", "left")


def map_edges(simple: DataFrame) -> DataFrame:
    """``from, to, value, title, arrows`` with a readable title."""
    title = F.concat(c("protocol"), F.lit(" — "), F.format_number("weight", 0), F.lit(" packets, "),
                     F.format_number("total_bytes", 0), F.lit(" bytes"))
    return simple.select(c("src").alias("from"), c("dst").alias("to"), c("weight").alias("value"),
                         title.alias("title"), F.lit("to").alias("arrows"))


# ---- reach from the top-ranked vertex -------------------------------------------------------------------


def _best(ranks: DataFrame, n: int) -> DataFrame:
    return ranks.orderBy(F.round("pagerank", 6).desc(), "id").limit(n)


def reach_from_top(graph: PropertyGraph, ranks: DataFrame, max_depth: int = 2) -> DataFrame:
    """Breadth-first reach from the node with the best rank; ``ranks(id, pagerank)`` is keyed by node id."""
    return bfs(graph, _best(ranks, 1).select(c("id").alias("node_id")), max_depth)


def path_between_top_two(graph: PropertyGraph, ranks: DataFrame) -> DataFrame:
    """Shortest path from the best-ranked node to the second best."""
    top = _best(ranks, 2).withColumn("r", F.round("pagerank", 6))
    ends = top.agg(F.max_by("id", F.struct("r", -c("id"))).alias("from_node"),
                   F.min_by("id", F.struct("r", -c("id"))).alias("to_node"), F.count(F.lit(1)).alias("n"))
    return shortest_path(graph, ends.where("n = 2").select("from_node", "to_node"))


def named_path(paths: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
    """``paths`` with ``names``: the property ``name`` of the nodes along ``path``, null where a node lacks it."""
    steps = paths.select("from_node", "to_node", F.posexplode("path").alias("at", "node_id"))
    labels = nodes.join(steps.select("node_id").distinct(), "node_id", "left_semi").select(
        "node_id", c("properties")[name].alias("name"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "name")))
    named = steps.join(labels, "node_id", "left").groupBy("from_node", "to_node").agg(
        F.transform(ordered, lambda x: x["name"]).alias("names"))
    return paths.join(named, ["from_node", "to_node"], "left")

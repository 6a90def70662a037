import heapq
import itertools
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.conftest import graph_of, ids_of, ms
from meshlark.functions.scalars import epoch_ms
from meshlark.graph import GraphError
from meshlark.operators import temporal, traverse
from meshlark.operators.pattern import Edge, Node, match
from meshlark.plans.lineage import store
from meshlark.sources.adjacency import read_adjacency, write_adjacency


def friends(spark):
    rows = [(2, "2020-01-01", "2022-01-01"), (3, "2021-06-01", None), (4, "2023-01-01", None)]
    graph = graph_of(spark, [(1, dst) for dst, _, _ in rows])
    windows = spark.createDataFrame([(i, ms(a), ms(b) if b else None) for i, (_, a, b) in enumerate(rows)],
                                    "edge_id long, valid_from long, valid_to long")
    return graph.with_edges(graph.edges.drop("valid_from", "valid_to").join(windows, "edge_id"))


def test_neighbors_at(spark):
    got = traverse.neighbors_at(friends(spark), ids_of(spark, 1), ms("2021-07-01"))
    assert {r.node_id for r in got.collect()} == {2, 3}


@pytest.mark.parametrize("at,closed,seen", [("2022-01-01", "both", {2, 3}), ("2022-01-01", "left", {3}),
                                            ("2020-01-01", "both", {2}), ("2019-12-31", "both", set())])
def test_window_ends(spark, at, closed, seen):
    assert {r.dst for r in temporal.edges_at(friends(spark).edges, ms(at), closed).collect()} == seen


def test_path_at(spark):
    pair = spark.createDataFrame([(1, 4)], "from_node long, to_node long")
    assert traverse.shortest_path_at(friends(spark), pair, ms("2024-01-15")).first().length == 1
    assert traverse.shortest_path_at(friends(spark), pair, ms("2021-01-15")).first().path is None


def test_sweep(spark):
    points = spark.createDataFrame([(ms(t),) for t in ("2020-06-01", "2021-07-01", "2024-01-01", "2018-01-01")], "timestamp long")
    got = temporal.sweep(friends(spark).edges, points, lambda e: e.groupBy("timestamp").agg(F.collect_set("dst").alias("d")))
    assert {r.timestamp: set(r.d) for r in got.collect()} == {
        ms("2020-06-01"): {2}, ms("2021-07-01"): {2, 3}, ms("2024-01-01"): {3, 4}}
    assert temporal.edges_over(friends(spark).edges, points.where("false")).count() == 0


def test_sweep_open_edges_and_one_point(spark):
    graph = graph_of(spark, [(0, 1), (1, 2)])
    points = spark.createDataFrame([(5,)], "timestamp long")
    assert temporal.edges_over(graph.edges, points).count() == 2


@pytest.mark.parametrize("closed", ["both", "left"])
def test_sweep_totals_brute_force(spark, closed):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, rnd.randrange(20)]), rnd.choice([None, rnd.randrange(20)]), float(rnd.randrange(9))) for _ in range(60)]
    edges = spark.createDataFrame([*rows, rows[0], (3, 3, 1.0), (9, 2, 5.0)], "valid_from long, valid_to long, weight double")
    points = spark.createDataFrame([(t,) for t in (-5, *range(0, 22, 3), 3, 100)] + [(None,)], "timestamp long")
    got = temporal.sweep_totals(edges, points, {"n": F.lit(1), "w": F.col("weight")}, closed).collect()
    assert sorted(r.timestamp for r in got) == [-5, *range(0, 22, 3), 100]
    for r in got:
        seen = [w for a, b, w in [*rows, rows[0], (3, 3, 1.0), (9, 2, 5.0)]
                if (a is None or a <= r.timestamp) and (b is None or r.timestamp < b or closed == "both" and r.timestamp == b)
                and (a is None or b is None or a <= b)]
        assert (r.n, r.w) == (len(seen), sum(seen)), r
    assert temporal.sweep_totals(edges, points.where("false"), {"n": F.lit(1)}).count() == 0


def test_epoch_ms_ignores_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = spark.createDataFrame([("2020-01-01",), ("nope",)], "t string").select(epoch_ms(F.col("t"))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r[0] for r in got] == [ms("2020-01-01"), None]


def test_neighbors_both_and_loops(spark):
    graph = graph_of(spark, [(0, 1), (0, 1), (2, 0), (0, 0)])
    rows = traverse.neighbors(graph, ids_of(spark, 0), "both").collect()
    assert sorted((r.edge_id, r.node_id, r.direction) for r in rows) == [
        (0, 1, "outgoing"), (1, 1, "outgoing"), (2, 2, "incoming"), (3, 0, "outgoing")]
    with pytest.raises(GraphError):
        traverse.neighbors(graph, ids_of(spark, 0), "sideways")


# ---- against plain Python -------------------------------------------------------------------------------


def random_edges(seed, n=14, m=40, whole=True):
    rnd = random.Random(seed)
    hub = [(0, rnd.randrange(n), rnd.randint(1, 4)) for _ in range(m // 3)]  # one source owns a third
    return hub + [(rnd.randrange(n), rnd.randrange(n), rnd.randint(1, 4) if whole else rnd.random()) for _ in range(m)]


def depths(edges, start, most=10 ** 9, both=False):
    near = {}
    for a, b, _ in edges:
        near.setdefault(a, set()).add(b)
        if both:
            near.setdefault(b, set()).add(a)
    found, front, level = {start: 0}, {start}, 0
    while front and level < most:
        level += 1
        front = {b for a in front for b in near.get(a, ())} - set(found)
        found.update(dict.fromkeys(front, level))
    return found


def best_path(edges, start, goal, weighted):
    """Least (cost, hops, id sequence) by exhaustive best-first search over simple paths."""
    near = {}
    for a, b, w in edges:
        if a != b:
            near.setdefault(a, {})[b] = min(w, near.get(a, {}).get(b, w))
    heap = [((0, 0, (start,)))]
    while heap:
        cost, hops, path = heapq.heappop(heap)
        if path[-1] == goal:
            return cost, hops, list(path)
        for b, w in near.get(path[-1], {}).items():
            if b not in path:
                heapq.heappush(heap, (cost + (w if weighted else 1), hops + 1, path + (b,)))
    return None


@pytest.mark.parametrize("both", [False, True])
@pytest.mark.parametrize("hot", [False, True])
def test_bfs_brute_force(spark, both, hot, request):
    if hot:
        request.getfixturevalue("hot_keys")
    edges = random_edges(3)
    graph = graph_of(spark, edges, n=14)
    got = traverse.bfs(graph, ids_of(spark, 0, 5, 99), 2, "both" if both else "outgoing")
    want = {(s, v, d) for s in (0, 5) for v, d in depths(edges, s, 2, both).items()}
    assert {(r.start, r.node_id, r.depth) for r in got.collect()} == want
    prepared = traverse.bfs(graph, ids_of(spark, 0, 5), 2, "both" if both else "outgoing", prepare=True)
    assert {(r.start, r.node_id, r.depth) for r in prepared.collect()} == want


def test_bfs_zero_depth_and_long_chain(spark):
    chain = graph_of(spark, [(i, i + 1) for i in range(12)])
    assert traverse.bfs(chain, ids_of(spark, 0), 0).count() == 1
    got = traverse.bfs(chain, ids_of(spark, 0), 50)
    assert {(r.node_id, r.depth) for r in got.collect()} == {(i, i) for i in range(13)}


@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_paths_brute_force(spark, weighted, seed, request):
    if seed == 2:
        request.getfixturevalue("hot_keys")
    edges = random_edges(seed)
    graph = graph_of(spark, edges, n=15)
    pairs = [(a, b) for a, b in itertools.product((0, 3, 7, 14), (2, 5, 9, 3, 14))] + [(0, 500)]
    rows = traverse.shortest_path(graph, spark.createDataFrame(pairs, "from_node long, to_node long"), weighted).collect()
    assert len(rows) == len(set(pairs))
    for r in rows:
        want = best_path(edges, r.from_node, r.to_node, weighted) if r.to_node < 500 else None
        assert (r.cost, r.length, r.path) == (want or (None, None, None)), (r, want)


def test_topics_path(spark):
    graph = graph_of(spark, [(1, 2, .9), (2, 4, .8), (3, 4, .85), (1, 3, .7)])
    row = traverse.shortest_path(graph, spark.createDataFrame([(1, 4)], "from_node long, to_node long"), True).first()
    assert row.path == [1, 3, 4] and row.cost == pytest.approx(1.55)


def test_negative_weight(spark):
    graph = graph_of(spark, [(0, 1, -1.0)])
    with pytest.raises(GraphError):
        traverse.shortest_path(graph, spark.createDataFrame([(0, 1)], "from_node long, to_node long"), True)


# ---- pattern match --------------------------------------------------------------------------------------


def test_match(spark):
    graph = graph_of(spark, [(0, 1), (1, 2), (2, 0), (0, 2), (2, 2)])
    hop = match(graph, [Node("a"), Edge("r"), Node("b")]).select("a.node_id", "b.node_id")
    assert {tuple(r) for r in hop.collect()} == {(0, 1), (1, 2), (2, 0), (0, 2), (2, 2)}
    triangle = match(graph, [Node("a", where=F.col("node_id") == 0), Edge("x"), Node("b"), Edge("y"), Node("c"),
                             Edge("z"), Node("a")])
    assert {(r.b.node_id, r.c.node_id) for r in triangle.collect()} == {(1, 2), (2, 2)}
    back = match(graph, [Node("a"), Edge("r", direction="incoming"), Node("b")])
    assert {(r.a.node_id, r.b.node_id) for r in back.collect()} == {(1, 0), (2, 1), (0, 2), (2, 0), (2, 2)}
    assert match(graph, [Node("a"), Edge("r", direction="both"), Node("b")]).count() == 9
    assert match(graph, [Node("a", "Nope")]).count() == 0
    for bad in ([], [Node("a"), Edge("r")], [Node("a"), Edge("a"), Node("b")]):
        with pytest.raises(GraphError):
            match(graph, bad)


def test_match_reads_only_used_columns(spark, tmp_path):
    graph = graph_of(spark, [(0, 1)])
    graph.edges.write.parquet(str(tmp_path / "e"))
    stored = graph.with_edges(spark.read.parquet(str(tmp_path / "e")))
    plan = match(stored, [Node("a"), Edge("r", "E"), Node("b")]).select("r.edge_id", "b.node_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(edge_type), EqualTo(edge_type,E)" in text
    assert "ReadSchema: struct<edge_id:bigint,src:bigint,dst:bigint,edge_type:string>" in text


# ---- over the stored walking order ----------------------------------------------------------------------


@pytest.fixture()
def laid(spark, tmp_path):
    """A random graph of two edge types with its walking order in five parts."""
    edges = random_edges(7, n=40, m=160)
    graph = graph_of(spark, edges, n=41)
    graph = graph.with_edges(graph.edges.withColumn("edge_type", F.when(F.col("edge_id") % 3 == 0, "F").otherwise("E"))
                             .withColumn("valid_from", F.col("edge_id")))
    write_adjacency(graph.edges, str(tmp_path / "a"), parts=5)
    return edges, replace(graph, adjacency=read_adjacency(spark, str(tmp_path / "a")))


@pytest.mark.parametrize("direction,small", [("outgoing", 0), ("outgoing", 3), ("incoming", 200_000), ("both", 3)])
def test_bfs_over_walking_order(spark, laid, direction, small, monkeypatch):
    monkeypatch.setattr(traverse, "SMALL_ROWS", small)
    edges, graph = laid
    walk = [(b, a, w) for a, b, w in edges] if direction == "incoming" else edges
    got = traverse.bfs(graph, ids_of(spark, 1, 9, 40, 77), 6, direction)
    want = {(s, v, d) for s in (1, 9, 40) for v, d in depths(walk, s, 6, direction == "both").items()}
    assert {tuple(r) for r in got.collect()} == want
    typed = traverse.bfs(graph, ids_of(spark, 1), 6, edge_type="F")
    assert {(r.node_id, r.depth) for r in typed.collect()} == set(depths([e for i, e in enumerate(edges) if i % 3 == 0], 1, 6).items())
    early = traverse.bfs_at(graph, ids_of(spark, 1), 60, 6)
    assert {(r.node_id, r.depth) for r in early.collect()} == set(depths(edges[:61], 1, 6).items())


@pytest.mark.parametrize("most", [1, 7])
def test_bfs_keeps_the_first_nodes(spark, laid, most):
    edges, graph = laid
    got = traverse.bfs(graph, ids_of(spark, 1, 9, 40), 3, "both", most=most)
    want = set()
    for s in (1, 9, 40):
        ordered = sorted((d, v) for v, d in depths(edges, s, 3, True).items())
        want |= {(s, v, d) for d, v in ordered[:most]}
    assert {tuple(r) for r in got.collect()} == want


@pytest.mark.parametrize("weighted,small", [(False, 0), (False, 200_000), (True, 4)])
def test_paths_over_walking_order(spark, laid, weighted, small, monkeypatch):
    monkeypatch.setattr(traverse, "SMALL_ROWS", small)
    monkeypatch.setattr(traverse, "MERGE_EVERY", 2)
    edges, graph = laid
    pairs = [(a, b) for a, b in itertools.product((1, 9, 40), (2, 5, 33, 1))] + [(1, 500), (None, 1)]
    rows = traverse.shortest_path(graph, spark.createDataFrame(pairs, "from_node long, to_node long"), weighted).collect()
    assert len(rows) == len(pairs)
    for r in rows:
        known = r.from_node is not None and r.to_node < 500
        want = best_path(edges, r.from_node, r.to_node, weighted) if known else None
        assert (r.cost, r.length, r.path) == (want or (None, None, None)), (r, want)


def test_two_sided_search_needs_half_the_levels(spark, monkeypatch):
    """A long chain beside a large star: no side may walk into the star beyond the first level."""
    chain = [(i, i + 1) for i in range(20)]
    graph = graph_of(spark, chain + [(21, 100 + i) for i in range(50)] + [(20, 21)], n=200)
    grown = []
    grow = traverse._Side.grow
    monkeypatch.setattr(traverse._Side, "grow", lambda self, wanted: (grow(self, wanted), grown.append(self.level.rows)))
    row = traverse.shortest_path(graph, spark.createDataFrame([(0, 20)], "from_node long, to_node long")).first()
    assert row.path == list(range(21)) and len(grown) == 20 and max(grown) == 1


def test_a_step_reads_only_the_frontiers_parts(spark, laid):
    _, graph = laid
    frontier = store(ids_of(spark, 1, 9))
    step = traverse.scanned_links(graph, "outgoing", "F").step(frontier.df)
    plan = step._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "(edge_type#" in plan and "hashpartitioning" not in plan
    step.collect()
    final = step._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final
    # Without a walking order the edges are scanned where they lie.
    plain = traverse.scanned_links(replace(graph, adjacency=None)).step(frontier.df)
    assert "hashpartitioning" not in plain._jdf.queryExecution().executedPlan().toString()


def test_search_writes_only_improvements(spark, monkeypatch):
    """Rows written by a weighted search on a chain: one improvement a round, not the state again."""
    graph = graph_of(spark, [(i, i + 1, 1) for i in range(15)])
    monkeypatch.setattr(traverse, "MERGE_EVERY", 100)
    written = []
    plain = traverse.store
    monkeypatch.setattr(traverse, "store", lambda df, **m: written.append(plain(df, **m)) or written[-1])
    found = traverse.relax(traverse.scanned_links(graph), ids_of(spark, 0, name="origin"))
    assert found.count() == 16 and [t.rows for t in written] == [1] * 16 + [0]

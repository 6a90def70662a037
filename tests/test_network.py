import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshlark.graph import GraphError
from meshlark.operators import communities, network
from meshlark.plans.lineage import store


def net(spark, rows):
    return spark.createDataFrame([(str(a), str(b), float(w)) for a, b, w in rows], "src string, dst string, weight double")


def ids(spark, n):
    return spark.createDataFrame([(str(i),) for i in range(n)], "id string")


def random_net(seed, n=12, m=40):
    rnd = random.Random(seed)
    rows = {}
    for i in range(m):
        a, b = (0 if i % 3 == 0 else rnd.randrange(n - 2)), rnd.randrange(n)  # two dead ends, one hub
        if a != b:
            rows[a, b] = rnd.randint(1, 3)
    return [(a, b, w) for (a, b), w in rows.items()]


@pytest.mark.parametrize("hot", [False, True])
def test_pagerank_fixed_point(spark, hot, request):
    if hot:
        request.getfixturevalue("hot_keys")
    rows, n = random_net(1), 12
    got = {int(r.id): r.pagerank for r in network.pagerank(net(spark, rows), ids(spark, n), tol=1e-12).collect()}
    m = np.zeros((n, n))
    for a, b, w in rows:
        m[b, a] = w
    for a in range(n):
        m[:, a] = m[:, a] / m[:, a].sum() if m[:, a].sum() else 1 / n
    want = np.linalg.solve(np.eye(n) - 0.85 * m, np.full(n, 0.15 / n))
    assert [got[i] for i in range(n)] == pytest.approx(want.tolist(), abs=1e-9)
    assert sum(got.values()) == pytest.approx(1.0)


def brute_betweenness(rows, n):
    near = {}
    for a, b, w in rows:
        near.setdefault(a, {})[b] = w
    score = [0.0] * n
    for s, t in itertools.permutations(range(n), 2):
        best, paths, stack = float("inf"), [], [(0, (s,))]
        while stack:
            cost, path = stack.pop()
            if cost > best:
                continue
            if path[-1] == t:
                if cost < best:
                    best, paths = cost, []
                paths.append(path)
                continue
            stack += [(cost + w, path + (b,)) for b, w in near.get(path[-1], {}).items() if b not in path and cost + w <= best]
        paths = [p for p in paths if sum(near[a][b] for a, b in zip(p, p[1:])) == best]
        for p in paths:
            for v in p[1:-1]:
                score[v] += 1 / len(paths)
    return [x / ((n - 1) * (n - 2)) for x in score]


@pytest.mark.parametrize("hot", [False, True])
def test_betweenness_brute_force(spark, hot, request):
    if hot:
        request.getfixturevalue("hot_keys")
    rows, n = random_net(2, 9, 26), 9
    got = {int(r.id): r.betweenness for r in network.betweenness(net(spark, rows), ids(spark, n)).collect()}
    assert [got[i] for i in range(n)] == pytest.approx(brute_betweenness(rows, n))
    every = network.betweenness(net(spark, rows), ids(spark, n), pivots=ids(spark, n)).collect()
    assert {int(r.id): pytest.approx(r.betweenness) for r in every} == got
    with pytest.raises(GraphError):
        network.betweenness(net(spark, [(0, 1, 0)]), ids(spark, 2))


@pytest.mark.parametrize("seed", [3, 4])
def test_betweenness_by_tables_in_parts(spark, seed, monkeypatch):
    """A core too large to be sent: paths as tables, for a part of the sources at a time, with the same result."""
    import os

    from meshlark.plans import lineage

    rows, n = random_net(seed, 8, 24), 8
    rows += [(8, 0, 2), (8, 3, 1), (9, 3, 1.5)]  # vertices that no link enters
    whole = {int(r.id): r.betweenness for r in network.betweenness(net(spark, rows), ids(spark, 10)).collect()}
    assert [whole[i] for i in range(10)] == pytest.approx(brute_betweenness(rows, 10))
    monkeypatch.setattr(network, "CORE_LINKS", 0)
    monkeypatch.setattr(network, "TABLE_PAIRS", 100)
    made, plain = [], network._table_sums
    monkeypatch.setattr(network, "_table_sums", lambda links, own: made.append(own.count()) or plain(links, own))
    folder = f"{lineage.shared_folder(spark)}/tables/{spark.sparkContext.applicationId}"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    got = {int(r.id): r.betweenness for r in network.betweenness(net(spark, rows), ids(spark, 10)).collect()}
    assert got == {k: pytest.approx(v) for k, v in whole.items()}
    assert len(made) > 1 and sum(made) == 10
    assert len(set(os.listdir(folder)) - before) < 8 + len(made)


def test_betweenness_writes_no_row_per_source_and_vertex(spark, monkeypatch):
    """Many sources around a few vertices: tables of links and vertices, none of all sources by all vertices."""
    rnd = random.Random(6)
    rows = {(a, b): rnd.randint(1, 3) for a in range(10) for b in range(10) if a != b}
    rows |= {(10 + i, rnd.randrange(10)): rnd.randint(1, 4) for i in range(500)}
    rows = [(a, b, w) for (a, b), w in rows.items()]
    written = []
    for module in (network, network.relax.__globals__):
        plain = module["store"] if isinstance(module, dict) else module.store

        def watched(df, _plain=plain, **measures):
            made = _plain(df, **measures)
            written.append(made.rows)
            return made

        monkeypatch.setitem(module if isinstance(module, dict) else vars(module), "store", watched)
    monkeypatch.setattr(network, "TASK_PAIRS", 2_000)  # several batches a task
    got = {int(r.id): r.betweenness for r in network.betweenness(net(spark, rows), ids(spark, 510), normalized=False).collect()}
    assert max(written) <= len(rows)
    # By the pair formula: which pairs have how much of their paths through which vertex.
    dist, paths = np.full((510, 510), np.inf), np.zeros((510, 510))
    w = np.full((510, 510), np.inf)
    for a, b, x in rows:
        w[a, b] = x
    np.fill_diagonal(dist, 0)
    for _ in range(30):
        dist = np.minimum(dist, (w[:, :10, None] + dist[None, :10, :]).min(1))
    order = np.arange(510)
    for s in range(510):
        paths[s, s] = 1
        for t in sorted((t for t in range(510) if t != s and np.isfinite(dist[s, t])), key=lambda t: dist[s, t]):
            at = order[np.isfinite(w[:, t]) & np.isclose(dist[s] + w[:, t], dist[s, t])]
            paths[s, t] = paths[s, at].sum()
    for v in range(510):
        want = 0.0
        if v < 10:
            for t in range(10):
                if t != v:
                    on = np.isfinite(dist[:, v]) & (dist[:, v] + dist[v, t] == dist[:, t]) & (order != v) & (order != t)
                    want += (paths[on, v] * paths[v, t] / paths[on, t]).sum()
        assert got[v] == pytest.approx(want)


def test_pagerank_reads_settled_vertices_once(spark, monkeypatch):
    """Vertices that no link enters give their mass away in the first round; later rounds have rows of the others only."""
    rows = [(a, b, 1 + (a + b) % 3) for a in range(6) for b in range(6) if a != b] + [(6 + i, i % 6, 1) for i in range(200)]
    written, plain = [], network.store

    def watched(df, **measures):
        made = plain(df, **measures)
        written.append(made.rows)
        return made

    monkeypatch.setattr(network, "store", watched)
    got = {int(r.id): r.pagerank for r in network.pagerank(net(spark, rows), ids(spark, 210)).collect()}
    assert written[-1] == 6 and sum(n > 6 for n in written) <= 4
    m = np.zeros((210, 210))
    for a, b, w in rows:
        m[b, a] = w
    for a in range(210):
        m[:, a] = m[:, a] / m[:, a].sum() if m[:, a].sum() else 1 / 210
    want = np.linalg.solve(np.eye(210) - 0.85 * m, np.full(210, 0.15 / 210))
    assert [got[i] for i in range(210)] == pytest.approx(want.tolist(), abs=1e-8)
    alone = network.pagerank(net(spark, [(0, 1, 0)]), ids(spark, 3)).collect()
    assert [r.pagerank for r in alone] == pytest.approx([1 / 3] * 3)


def quality(rows, member):
    two_m = 2 * sum(w for *_, w in rows)
    tot, inner = {}, 0.0
    for a, b, w in rows:
        tot[member[a]] = tot.get(member[a], 0) + w
        tot[member[b]] = tot.get(member[b], 0) + w
        inner += 2 * w * (member[a] == member[b])
    return inner / two_m - sum(t * t for t in tot.values()) / two_m ** 2


@pytest.mark.parametrize("hot", [False, True])
def test_louvain_cliques(spark, hot, request):
    if hot:
        request.getfixturevalue("hot_keys")
    cliques = [range(0, 5), range(5, 10), range(10, 15)]
    rows = [(a, b, 1) for q in cliques for a, b in itertools.combinations(q, 2)] + [(4, 5, 1), (9, 10, 1), (14, 0, 1)]
    edges = net(spark, rows)
    found = communities.louvain(edges, ids(spark, 16))
    member = {int(r.id): r.community for r in found.collect()}
    assert len(member) == 16 and len({member[i] for i in range(15)}) == 3
    assert all(len({member[i] for i in q}) == 1 for q in cliques)
    assert sorted(set(member.values())) == [1, 2, 3, 4]
    assert network.modularity(edges, found).first().modularity == pytest.approx(quality(rows, member))
    assert [r.members for r in network.community_sizes(found).collect()] == [5, 5, 5, 1]


def test_louvain_quality_on_random_net(spark):
    rows = [(min(a, b), max(a, b), w) for a, b, w in random_net(7, 20, 60)]
    merged = {}
    for a, b, w in rows:
        merged[a, b] = merged.get((a, b), 0) + w
    rows = [(a, b, w) for (a, b), w in merged.items()]
    member = {int(r.id): r.community for r in communities.louvain(net(spark, rows), ids(spark, 20)).collect()}
    assert quality(rows, member) > max(0.0, quality(rows, {i: i for i in range(20)}))
    # A dense network, where vertices that move all at once only crowd together.
    rnd = random.Random(3)
    dense = [(a, b, rnd.randint(1, 3) + 4 * (a % 4 == b % 4)) for a, b in itertools.combinations(range(40), 2)]
    member = {int(r.id): r.community for r in communities.louvain(net(spark, dense), ids(spark, 40)).collect()}
    assert quality(dense, member) >= 0.95 * quality(dense, {i: i % 4 for i in range(40)})
    with pytest.raises(GraphError):
        communities.louvain(net(spark, rows), ids(spark, 2))


def best_move(rows, member, v):
    """What the best move of ``v`` adds to modularity."""
    others = {member[b if a == v else a] for a, b, _ in rows if v in (a, b)} - {member[v]}
    return max((quality(rows, member | {v: o}) - quality(rows, member) for o in others), default=0.0)


@pytest.mark.parametrize("seed", [1])
def test_louvain_ends_where_no_vertex_gains(spark, seed):
    rnd = random.Random(seed)
    weights = {}
    for _ in range(150):
        a, b = sorted(rnd.sample(range(40), 2))
        weights[a, b] = weights.get((a, b), 0) + rnd.choice([0.5, 1, 7])
    rows = [(a, b, w) for (a, b), w in weights.items()]
    found = communities.louvain(net(spark, rows), ids(spark, 40), tolerance=1e-9)
    member = {int(r.id): r.community for r in found.collect()}
    # Contraction moves whole communities, so single vertices are tried at the end of the last level only by the groups
    # they came in; what is left to gain must be little, and no whole community may gain by joining another.
    assert quality(rows, member) > 0.25
    groups = sorted(set(member.values()))
    for g in groups:
        for h in groups:
            joined = {v: h if m == g else m for v, m in member.items()}
            assert quality(rows, joined) <= quality(rows, member) + 1e-9
    leads = [min(str(v) for v, m in member.items() if m == g) for g in groups]
    assert groups == list(range(1, len(groups) + 1)) and leads == sorted(leads)


def test_local_moving_leaves_no_gain(spark):
    """One level on its own: afterwards no single vertex gains by any move."""
    rnd = random.Random(11)
    rows = [(a, b, float(rnd.choice([1, 2, 9]))) for a, b in itertools.combinations(range(24), 2) if rnd.random() < 0.25]
    arcs = [(a, b, w) for a, b, w in rows] + [(b, a, w) for a, b, w in rows]
    level = store(spark.createDataFrame(arcs, "src long, dst long, weight double"))
    found, moved = communities._local_moving(level, sum(w for _, _, w in arcs), 1e-9, communities._Rounds(None))
    member = {r.node: r.community for r in found.collect()}
    assert moved and all(best_move(rows, member, v) < 1e-8 for v in member)


def test_louvain_says_when_it_is_cut_short(spark):
    rows = [(a, b, 1) for a, b in itertools.combinations(range(6), 2)]
    with pytest.raises(GraphError):
        communities.louvain(net(spark, rows), ids(spark, 6), max_rounds=1)
    with pytest.raises(GraphError):
        communities.louvain(net(spark, rows), ids(spark, 6), tolerance=0.0)


def test_louvain_rates_only_what_moved(spark, monkeypatch):
    """Separate groups: rounds after the first rate fewer and fewer vertices."""
    rated = []
    plain = communities._rated

    def counted(between, assigned, active, *rest):
        rated.append(None if active is None else active.count())
        return plain(between, assigned, active, *rest)

    monkeypatch.setattr(communities, "_rated", counted)
    rows = [(10 * g, 10 * g + k, 1 + k) for g in range(6) for k in range(1, 6)]
    member = {int(r.id): r.community for r in communities.louvain(net(spark, rows), ids(spark, 60)).collect()}
    assert all(member[10 * g + k] == member[10 * g] for g in range(6) for k in range(6))
    later = [n for n in rated if n is not None]
    assert rated[0] is None and later and later[-1] < later[0]


def test_named_path(spark):
    nodes = spark.createDataFrame([(1, {"ip": "a"}), (2, {"ip": "b"}), (3, {})], "node_id long, properties map<string,string>")
    paths = spark.createDataFrame([(1, 3, [1, 2, 3]), (2, 1, None)], "from_node long, to_node long, path array<long>")
    got = {(r.from_node, r.to_node): r.names for r in network.named_path(paths, nodes, "ip").collect()}
    assert got == {(1, 3): ["a", "b", None], (2, 1): None}


def test_simplify_keeps_first_protocol(spark):
    rows = spark.createDataFrame([("a", "b", "UDP", 1, 3.0, 1, 5), ("a", "b", "TCP", 2, 4.0, 1, 9), ("a", "a", "TCP", 9, 1.0, 1, 1)],
                                 "src string, dst string, protocol string, weight long, total_bytes double, num_flows long, first_edge long")
    row = network.simplify(rows).collect()
    assert [(r.weight, r.total_bytes, r.num_flows, r.protocol) for r in row] == [(3, 7.0, 2, "UDP")]
    assert network.simplify(rows.drop("first_edge")).first().protocol == "TCP"
    loops = {r.id: (r.degree_in, r.degree_out, r.degree_total) for r in network.degrees(
        rows, spark.createDataFrame([("a",), ("b",), ("c",)], "id string")).collect()}
    assert loops == {"a": (1, 3, 4), "b": (2, 0, 2), "c": (0, 0, 0)}
    titles = network.map_edges(network.simplify(rows).withColumn("weight", F.lit(1234))).first().title
    assert titles == "UDP — 1,234 packets, 7 bytes"

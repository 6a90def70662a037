import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshlark.functions import vectors
from meshlark.graph import GraphError, PropertyGraph, as_nodes
from meshlark.operators import anomaly, context, search
from tests.conftest import graph_of, ids_of

DOCS = {1: [.9, .1, .2, .05], 2: [.1, .85, .3, .1], 3: [.15, .8, .9, .7], 4: [.85, .2, .25, .1]}
TOPICS = {1: [.1, .8, .9, .7], 2: [.2, .9, .7, .6], 3: [.85, .2, .25, .1], 4: [.6, .7, .5, .4]}


def queries_of(spark, rows):
    return spark.createDataFrame(rows, "query_id long, vector array<double>")


def docs(spark):
    return graph_of(spark, [(1, 2), (1, 3), (1, 4)], embeddings=DOCS)


def test_documents(spark):
    got = search.vector_search(docs(spark), queries_of(spark, [(0, [.88, .15, .2, .08])]), 3).orderBy("rank").collect()
    assert [r.node_id for r in got] == [1, 4, 3]
    assert [round(r.similarity, 4) for r in got] == [.9978, .9963, .3793]


def test_not_comparable_vectors(spark):
    graph = graph_of(spark, [(0, 1), (2, 3), (4, 5)], embeddings={
        0: [1.0, 0.0], 1: [0.0, 0.0], 2: [1.0, 2.0, 3.0], 3: None, 4: [1.0, None], 5: [1.0, 1.0]})
    got = search.vector_search(graph, queries_of(spark, [(7, [1.0, 0.0]), (8, [0.0, 0.0]), (9, None)]), 10).collect()
    assert [(r.query_id, r.rank, r.node_id) for r in sorted(got)] == [(7, 1, 0), (7, 2, 5)]
    assert spark.range(1).select(vectors.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0)))).first()[0] is None
    assert spark.range(1).select(vectors.dot(F.array(F.lit(1.0)), F.array(F.lit(1.0), F.lit(2.0)))).first()[0] is None


def many(spark, n=600, size=8, copies=200):
    """Random vectors; a third of them are copies of one vector."""
    rnd = np.random.default_rng(5)
    rows = [(i, ["N"], rnd.normal(size=size).tolist() if i >= copies else [1.0] * size) for i in range(n)]
    nodes = spark.createDataFrame(rows, "node_id long, labels array<string>, embedding array<double>").repartition(5)
    return PropertyGraph(as_nodes(nodes), graph_of(spark, [(0, 1)]).edges), {r[0]: np.array(r[2]) for r in rows}


def exact(vectors_, query, k):
    q = np.array(query)
    ranked = sorted((-round(float(v @ q / np.linalg.norm(v) / np.linalg.norm(q)), 12), i) for i, v in vectors_.items())
    return [i for _, i in ranked[:k]]


def asked(spark, n=20, size=8):
    rnd = np.random.default_rng(6)
    rows = [(i, rnd.normal(size=size).tolist()) for i in range(n)] + [(99, [2.0] * size)]
    return rows, queries_of(spark, rows)


@pytest.mark.parametrize("grid", [False, True])
def test_scan_and_grid_are_exact(spark, grid, monkeypatch):
    if grid:
        monkeypatch.setattr(search, "QUERY_BLOCK_BYTES", 400)
        monkeypatch.setattr(search, "CELL_BYTES", 7200)
    graph, known = many(spark)
    rows, queries = asked(spark)
    got = search.vector_search(graph, queries, 7).orderBy("query_id", "rank").collect()
    for query_id, vector in rows:
        assert [r.node_id for r in got if r.query_id == query_id] == exact(known, vector, 7)


@pytest.mark.parametrize("large", [False, True])
def test_approximate_search(spark, large, monkeypatch):
    graph, known = many(spark)
    rows, queries = asked(spark)
    index = search.build_vector_index(graph, size=8, cells=6)
    if large:
        monkeypatch.setattr(search, "QUERY_BLOCK_BYTES", 400)
        monkeypatch.setattr(search, "CELL_BYTES", 7200)
    want = {(q, i) for q, v in rows for i in exact(known, v, 5)}
    full = {(r.query_id, r.node_id) for r in search.approx_search(index, queries, 5, probes=6).collect()}
    assert full == want
    some = {(r.query_id, r.node_id) for r in search.approx_search(index, queries, 5, probes=3).collect()}
    assert len(some & want) / len(want) > 0.6


def test_recall_reaches_nine_tenths_at_sf_0_01(spark):
    from registry.search_queries import v02_recall

    assert [tuple(r) for r in v02_recall(spark, "/root/testdata/sf0.01").collect()] == [(100, True)]


def test_hybrid_brute_force(spark):
    rnd = random.Random(4)
    emb = {i: [rnd.gauss(0, 1) for _ in range(3)] for i in range(20) if i % 5}
    edges = [(rnd.randrange(20), rnd.randrange(20)) for _ in range(25)]
    graph = graph_of(spark, edges, n=20, embeddings=emb)
    hops, front = {0: 0}, {0}
    for level in (1, 2):
        front = {b for a, b in edges if a in front} - set(hops)
        hops.update(dict.fromkeys(front, level))
    q = [0.3, -1.0, 0.5]
    cos = lambda v: sum(a * b for a, b in zip(v, q)) / math.hypot(*v) / math.hypot(*q)
    request = spark.createDataFrame([(1, 0, q)], "request_id long, anchor long, vector array<double>")
    for alpha in (0.0, 0.3, 1.0):
        score = {i: alpha * (cos(emb[i]) if i in emb else 0) + (1 - alpha) * (1 / (1 + hops[i]) if i in hops else 0)
                 for i in range(20) if i in emb or i in hops}
        want = sorted(score, key=lambda i: (-round(score[i], 12), i))[:8]
        got = search.hybrid_search(graph, request, 2, 8, alpha).orderBy("rank").collect()
        assert [r.node_id for r in got] == want, alpha
        assert all(abs(r.score - score[r.node_id]) < 1e-9 for r in got)
    with pytest.raises(GraphError):
        search.hybrid_search(graph, request, alpha=2)


def test_semantic_neighbors_and_walk(spark):
    graph = docs(spark)
    concept = [.1, .9, .3, .1]
    near = spark.createDataFrame([(0, 1, concept)], "request_id long, node_id long, concept array<double>")
    got = search.semantic_neighbors(graph, near, k=2).orderBy("rank").collect()
    assert [r.node_id for r in got] == [2, 3]
    topics = graph_of(spark, [(1, 2), (2, 4), (3, 4), (1, 3), (4, 1)], embeddings=TOPICS)
    walks = spark.createDataFrame([(0, 1, TOPICS[1]), (1, 3, TOPICS[3]), (2, 50, TOPICS[1])],
                                  "request_id long, start long, concept array<double>")
    got = {r.request_id: r.path for r in search.semantic_walk(topics, walks, 10).collect()}
    assert got == {0: [1, 2, 4], 1: [3, 4, 1, 2]}


# ---- context --------------------------------------------------------------------------------------------


def test_subgraph_and_texts(spark):
    graph = graph_of(spark, [(0, 1), (0, 1), (1, 2), (2, 3), (3, 4), (5, 0)], n=7)
    found = context.extract_subgraph(graph, ids_of(spark, 0, 6), 2, 4)
    assert {r.node_id for r in found.nodes.where("center = 0").collect()} == {0, 1, 2, 5}
    counts = {r.center: (r.node_count, r.edge_count) for r in found.counts().collect()}
    assert counts == {0: (4, 4), 6: (1, 0)}
    capped = context.extract_subgraph(graph, ids_of(spark, 0), 2, 2)
    assert {r.node_id for r in capped.nodes.collect()} == {0, 1} and capped.edges.count() == 2
    text = {fmt: {r.center: r.text for r in context.linearize(graph, found, fmt).collect()} for fmt in context.FORMATS}
    assert text["triples"][0] == "(0, E, 1)\n(1, E, 2)\n(5, E, 0)" and text["triples"][6] == ""
    parsed = json.loads(text["json"][0])
    assert [n["id"] for n in parsed["nodes"]] == [0, 1, 2, 5] and parsed["edges"][0] == {
        "src": 0, "type": "E", "dst": 1, "times": 2}
    assert json.loads(text["json"][6])["edges"] == []
    assert text["structured"][0].startswith("Nodes:\n  0 [N] name=n0\n") and "0 -[E]-> 1 x2" in text["structured"][0]
    assert "Node 0 is linked by E to node 1 2 times." in text["prose"][0]
    with pytest.raises(GraphError):
        context.linearize(graph, found, "xml")


def test_rag_with_answers(spark):
    graph = docs(spark)
    rows = spark.createDataFrame([(1, "who?", 2, [.9, .1, .2, .05]), (2, "what?", None, [.85, .2, .25, .1]), (3, "?", None, None)],
                                 "question_id long, question string, anchor long, embedding array<double>")
    got = {r.question_id: r for r in context.rag_contexts(graph, rows, 1, 10).collect()}
    assert (got[1].anchor, got[2].anchor) == (2, 4) and 3 not in got

    def generate(frames):
        for frame in frames:
            yield frame.assign(answer=frame.question + " " + frame.node_count.astype(str))[["question_id", "answer"]]

    answers = context.rag_contexts(graph, rows, 1, 10, generate=generate, answer_schema="question_id long, answer string")
    assert {r.answer for r in answers.collect()} == {"who? 2", "what? 2"}


# ---- anomaly --------------------------------------------------------------------------------------------


def test_anomaly_states(spark):
    rule = anomaly.Baseline(bucket_ms=10)
    calm = [(1, True, b * 10) for b in range(8)]
    burst = [(2, True, b * 10) for b in range(8)] + [(2, True, 85)] * 9
    gap = [(3, True, 0), (3, True, 55)]
    young = [(4, True, 0), (4, True, 10)]
    rows = spark.createDataFrame(calm + burst + gap + young + [(2, False, 0)], "entity_id long, is_node boolean, at_ms long")
    profile = anomaly.activity_profile(anomaly.bucket_counts(rows.where("entity_id = 3"), rule))
    assert [r.activity for r in profile.orderBy("bucket").collect()] == [1, 0, 0, 0, 0, 1]
    got = {r.entity_id: r.status for r in anomaly.anomaly_check(rows, ids_of(spark, 1, 2, 4, 9, name="entity_id"), True, rule).collect()}
    assert got == {1: "normal", 2: "anomalous", 4: "no_data", 9: "no_data"}
    alert = anomaly.anomaly_alerts(rows, rule).collect()
    assert [(r.entity_id, r.is_node, r.score) for r in alert] == [(2, True, 8.0)]
    assert anomaly.anomaly_stats(rows, ids_of(spark, 2, name="entity_id"), False, rule).count() == 1


def activity_rows(seed=4):
    rnd = random.Random(seed)
    rows = [(e, True, rnd.randrange(300)) for e in range(6) for _ in range(rnd.randint(1, 60))]
    rows += [(7, True, 3), (7, True, 4), (8, True, 250), (9, True, 5)] + [(9, True, 123)] * 5
    return rows


def plain_score(times, bucket, rule):
    """``score`` of a bucket by listing all buckets, or None."""
    counts = [sum(t // rule.bucket_ms == b for t in times) for b in range(min(times) // rule.bucket_ms, bucket + 1)]
    before = counts[:-1][-rule.width:]
    if len(before) < rule.least or not before:
        return None
    mean = sum(before) / len(before)
    std = (sum((x - mean) ** 2 for x in before) / (len(before) - 1)) ** 0.5 if len(before) > 1 else 0.0
    return (counts[-1] - mean) / max(std, rule.floor)


@pytest.mark.parametrize("as_of", [None, 0, 57, 123, 299, 5_000])
@pytest.mark.parametrize("least", [0, 1, 3])
def test_latest_scores_brute_force(spark, as_of, least):
    rule = anomaly.Baseline(bucket_ms=10, least=least)
    rows = activity_rows()
    activity = spark.createDataFrame(rows, "entity_id long, is_node boolean, at_ms long")
    got = {r.entity_id: (r.bucket, r.score) for r in anomaly.latest_scores(activity, rule, as_of).collect()}
    want = {}
    for e in {r[0] for r in rows}:
        times = [t for x, _, t in rows if x == e and (as_of is None or t // 10 <= as_of // 10)]
        if times:
            bucket = max(times) // 10 if as_of is None else as_of // 10
            want[e] = (bucket, plain_score(times, bucket, rule))
    assert got.keys() == want.keys()
    for e, (bucket, score) in want.items():
        assert got[e][0] == bucket and got[e][1] == (None if score is None else pytest.approx(score, abs=1e-9)), e
    if as_of is not None:
        firsts = anomaly.first_buckets(activity, rule)
        again = anomaly.latest_scores(activity, rule, as_of, firsts)
        assert {r.entity_id: (r.bucket, r.score) for r in again.collect()} == got


def test_long_gaps_need_no_calendar(spark):
    rule = anomaly.Baseline(bucket_ms=1)
    rows = [(1, True, 0), *[(1, True, 40_000_000_000)] * 6, (2, True, 5)]
    activity = spark.createDataFrame(rows, "entity_id long, is_node boolean, at_ms long")
    assert {(r.entity_id, r.bucket, r.score) for r in anomaly.anomaly_alerts(activity, rule).collect()} == {(1, 40_000_000_000, 6.0)}
    assert anomaly.anomaly_alerts(activity, rule, as_of=40_000_000_001).count() == 0
    history = anomaly.anomaly_stats(activity, ids_of(spark, 1, name="entity_id"), True, rule, empty_buckets=False).collect()
    assert [(r.bucket, r.activity, r.score) for r in sorted(history, key=lambda r: r.bucket)] == [(0, 1, None), (40_000_000_000, 6, 6.0)]
    wide = spark.createDataFrame([(1, True, 0), (1, True, 250_000)], "entity_id long, is_node boolean, at_ms long")
    profile = anomaly.activity_profile(anomaly.bucket_counts(wide, rule))
    assert profile.count() == 250_001 and profile.agg(F.sum("activity")).first()[0] == 2


def test_as_of_reads_the_last_buckets_only(spark, tmp_path):
    rule = anomaly.Baseline(bucket_ms=10)
    spark.createDataFrame(activity_rows(), "entity_id long, is_node boolean, at_ms long").write.parquet(str(tmp_path / "a"))
    activity = spark.read.parquet(str(tmp_path / "a"))
    firsts = spark.createDataFrame(
        anomaly.first_buckets(activity, rule).collect(), "entity_id long, is_node boolean, first_bucket long")
    plan = anomaly.latest_scores(activity, rule, as_of=200, firsts=firsts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "LessThan(at_ms,210)" in plan and "GreaterThanOrEqual(at_ms,130)" in plan


def brute_nearest(nodes, queries, k, scale=1.0):
    """``(query, node)`` by all similarities in double precision."""
    unit = lambda rows: rows / np.sqrt((rows * rows).sum(1))[:, None]
    a, b = unit(np.array([v for _, v in queries], float)), unit(np.array([v for _, v in nodes], float))
    ids = np.array([i for i, _ in nodes])
    score = np.round(np.einsum("ij,kj->ik", a, b) * scale, search.COMPARE_DECIMALS)
    return {(q, int(ids[n])) for (q, _), row in zip(queries, score) for n in np.lexsort((ids, -row))[:k]}


@pytest.mark.parametrize("scale", [1.0, 1e-7, 0.0])
def test_nearest_below_single_precision(scale):
    """Vectors that single precision cannot tell apart, several batches, several tiles, repeated queries."""
    import pyarrow as pa

    rnd = np.random.default_rng(9)
    centers = rnd.normal(size=(5, 16))
    nodes = [(int(i), centers[i % 5] + rnd.normal(size=16) * 10.0 ** -(6 + i % 4)) for i in rnd.permutation(700)]
    nodes += [(700 + i, centers[0]) for i in range(40)]
    queries = [(i, centers[i % 5] + rnd.normal(size=16) * 1e-8) for i in range(23)]
    as_unit = lambda rows: search._unit_vectors(pa.array([i for i, _ in rows]), pa.array([v.tolist() for _, v in rows], pa.list_(pa.float64())))
    for k in (1, 7, 900):
        best = search._Running(k, scale, step=4, nodes=50)
        for at in range(0, len(nodes), 130):
            best.add(as_unit(nodes[at:at + 130]), as_unit(queries + queries[:2]))
        got = best.batch().to_pydict()
        assert {(q, n) for q, n in zip(got["query_id"], got["node_id"]) if q > 1} == {
            x for x in brute_nearest(nodes, queries, k, scale) if x[0] > 1}
        pairs = dict(zip(zip(got["query_id"], got["node_id"]), got["similarity"]))
        for (q, n), s in list(pairs.items())[::97]:
            a, b = dict(queries)[q], dict(nodes)[n]
            assert s == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-14)


def test_few_pairs_are_computed_in_double_precision(monkeypatch):
    rnd = np.random.default_rng(2)
    some = {16: (np.arange(6000), rnd.normal(size=(6000, 16)))}
    some = {16: (some[16][0], some[16][1] / np.linalg.norm(some[16][1], axis=1)[:, None])}
    rounded, plain = [], np.round
    monkeypatch.setattr(np, "round", lambda x, *rest: rounded.append(np.size(x)) or plain(x, *rest))
    best = search._Running(3, 1.0)
    best.add(some, {16: (some[16][0][:600], some[16][1][:600])})
    assert best.batch().num_rows == 1800 and sum(rounded) < 0.05 * 600 * 6000

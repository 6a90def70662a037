"""Empty and NULL inputs give empty results, not errors."""

import pytest
from pyspark.sql import functions as F

from meshlark.operators import anomaly, communities, context, flows, flowstats, indicators, network, search, temporal, traverse
from meshlark.plans.lineage import forget_all, shared_folder, store
from meshlark.sources import export, frames
from meshlark.sources.tables import PACKET_SCHEMA
from tests.conftest import graph_of, ids_of


@pytest.fixture()
def graph(spark):
    return graph_of(spark, [(0, 1), (1, 2)], embeddings={0: [1.0, 0.0], 1: [0.0, 1.0]})


def test_no_requests(spark, graph):
    none = ids_of(spark, 0).where("false")
    pairs = spark.createDataFrame([], "from_node long, to_node long")
    assert traverse.neighbors(graph, none, "both").count() == 0
    assert traverse.bfs(graph, none, 3).count() == 0
    assert traverse.bfs(graph, spark.createDataFrame([(None,)], "node_id long"), 2).count() == 0
    assert traverse.shortest_path(graph, pairs).count() == 0
    assert traverse.shortest_path(graph, pairs, weighted=True).count() == 0
    assert search.vector_search(graph, spark.createDataFrame([], "query_id long, vector array<double>")).count() == 0
    requests = spark.createDataFrame([], "request_id long, anchor long, vector array<double>")
    assert search.hybrid_search(graph, requests).count() == 0
    walks = spark.createDataFrame([], "request_id long, start long, concept array<double>")
    assert search.semantic_walk(graph, walks).count() == 0
    found = context.extract_subgraph(graph, none)
    assert context.linearize(graph, found, "json").count() == 0
    assert export.export_nodes(graph, none).count() == 0


def test_anchored_questions_need_no_vectors(spark, graph):
    rows = spark.createDataFrame([(1, "q", 0, None)], "question_id long, question string, anchor long, embedding array<double>")
    assert context.rag_contexts(graph, rows).first().node_count == 3


def test_no_edges(spark, graph):
    bare = graph.with_edges(graph.edges.where("false"))
    assert traverse.bfs(bare, ids_of(spark, 0), 3).count() == 1
    row = traverse.shortest_path(bare, spark.createDataFrame([(0, 1)], "from_node long, to_node long"), True).first()
    assert row.path is None
    net = spark.createDataFrame([], "src string, dst string, weight double")
    three = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    assert {round(r.pagerank, 9) for r in network.pagerank(net, three).collect()} == {round(1 / 3, 9)}
    assert {r.betweenness for r in network.betweenness(net, three).collect()} == {0.0}
    assert communities.louvain(net, three).select("community").distinct().count() == 3
    assert network.degrees(net, three).where("degree_total = 0").count() == 3
    points = spark.createDataFrame([(1,)], "timestamp long")
    assert temporal.edges_over(bare.edges, points).count() == 0


def test_no_packets(spark):
    none = spark.createDataFrame([], PACKET_SCHEMA)
    made = flows.packets_to_flows(none)
    assert made.count() == 0
    assert flows.chunk_totals(none, ["tv_sec"]).count() == 0
    assert {r.n for r in flows.run_totals(none, ["tv_sec"]).collect()} == {0}
    assert flowstats.size_histogram(made).count() == 0
    assert flowstats.size_by_protocol(made).count() == 0
    profile = indicators.address_profile(made)
    assert indicators.scanners(profile).count() == 0
    assert anomaly.anomaly_alerts(anomaly.node_activity(graph_of(spark, [(0, 1)]).edges)).count() == 0
    assert frames.import_nodes(spark.createDataFrame([], "label string, x int")).count() == 0


def test_loop_tables_lie_in_the_shared_folder(spark):
    kept = store(spark.range(5), most=F.max("id"))
    assert kept.path.startswith(shared_folder(spark)) and kept.rows == 5 and kept.measures["most"] == 4
    forget_all(spark)
    with pytest.raises(Exception):
        spark.read.parquet(kept.path).count()

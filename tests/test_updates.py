"""Updates that name an id more than once, and path lengths that differ in the last bit."""

import pytest
from pyspark.sql import functions as F

from meshlark.graph import GraphError
from meshlark.operators.maintenance import merge_node_properties
from meshlark.operators.network import betweenness
from tests.conftest import graph_of


def test_updates_of_one_id_apply_in_order(spark):
    graph = graph_of(spark, [(0, 1)])
    updates = spark.createDataFrame([(0, {"a": "x"}, 1), (0, {"b": "y", "a": "z"}, 2)], "node_id long, properties map<string,string>, t int")
    rows = {r.node_id: r.properties for r in merge_node_properties(graph, updates, "t").nodes.collect()}
    assert rows == {0: {"name": "n0", "a": "z", "b": "y"}, 1: {"name": "n1"}}
    with pytest.raises(GraphError):
        merge_node_properties(graph, updates)


def test_updates_at_one_place_of_the_order_must_agree(spark):
    graph = graph_of(spark, [(0, 1)])
    rows = [(0, {"a": "x"}, 1), (0, {"a": "y"}, 1), (0, {"a": "z"}, 2), (1, {"a": "k"}, None), (1, {"a": "k", "c": None}, None)]
    kind = "node_id long, properties map<string,string>, t int"
    settled = merge_node_properties(graph, spark.createDataFrame(rows, kind), "t")  # an earlier clash is overwritten
    assert {r.node_id: r.properties for r in settled.nodes.collect()} == {
        0: {"name": "n0", "a": "z"}, 1: {"name": "n1", "a": "k", "c": None}}
    for more in [(0, {"a": "w"}, 2), (1, {"a": None}, None), (1, {"a": "l"}, None)]:
        with pytest.raises(GraphError):
            merge_node_properties(graph, spark.createDataFrame([*rows, more], kind), "t")


def test_equal_lengths_up_to_rounding(spark):
    graph = graph_of(spark, [(0, 1, 0.1), (1, 2, 0.2), (0, 2, 0.3), (2, 3, 1.0)])
    edges, ids = graph.edges.select("src", "dst", "weight"), graph.nodes.select(F.col("node_id").alias("id"))
    found = {r.id: r.betweenness for r in betweenness(edges, ids, normalized=False).collect()}
    assert found == {0: 0.0, 1: 1.0, 2: 2.0, 3: 0.0}

"""Import, export, lookup, update, delete and checks."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import graph_of, ids_of
from meshlark.graph import (GraphError, PropertyGraph, as_edges, check_alpha, check_at_least, check_direction,
                            dangling_edges, edge_faults, node_faults, require_clean)
from meshlark.operators import maintenance
from meshlark.operators.pattern import Node, match
from meshlark.sources import export, frames, tables

PEOPLE = [("Person", "Dave", 40.0, "Chicago"), ("Person", "Eve", 28.0, "Boston"), ("Person", "Frank", 55.0, "Denver")]


def people(spark):
    return spark.createDataFrame(PEOPLE, "label string, name string, age double, city string")


def test_import_and_export_people(spark):
    nodes = frames.import_nodes(people(spark))
    assert [r.node_id for r in nodes.orderBy("node_id").collect()] == [0, 1, 2]
    graph = PropertyGraph(nodes, as_edges(spark.createDataFrame([], "edge_id long, src long, dst long, edge_type string")))
    flat = export.export_nodes(graph, ids_of(spark, 0, 1, 2, 99))
    assert set(flat.columns) == {"node_id", "labels", "name", "age", "city"}
    assert {(r.node_id, r.labels, r.name, float(r.age), r.city) for r in flat.collect()} == {
        (i, *p) for i, p in enumerate(PEOPLE)}
    wide = export.nodes_to_dataframe(graph, ids_of(spark, 1))
    assert wide.first().labels == ["Person"] and wide.first().id == 1
    typed = graph.with_typed_properties({"age": "double"})
    assert typed.nodes.where("properties.age > 30").count() == 2
    assert export.property_names(typed.nodes) == ["age"]


def test_import_embedded_documents(spark):
    rows = spark.createDataFrame([("Document", "Doc A", .1, .9, .3), ("Document", "Doc B", .4, .5, .8)],
                                 "label string, title string, e1 double, e2 double, e3 double")
    got = frames.import_nodes(rows, embedding_cols=["e1", "e2", "e3"], order=["title"]).orderBy("node_id").collect()
    assert got[1].embedding == [.4, .5, .8] and got[1].properties == {"title": "Doc B"}


def test_id_column_stays_a_property(spark):
    rows = spark.createDataFrame([("A", 7)], "label string, key int")
    assert frames.import_nodes(rows, id_col="key").first().properties == {"key": "7"}
    with pytest.raises(GraphError):
        frames.import_nodes(rows, id_col="nope")


def test_import_edges(spark):
    rows = spark.createDataFrame([(1, 2, "KNOWS", 2018), (1, 3, "MENTORS", 2021)],
                                 "source long, target long, type string, since int")
    got = frames.import_edges(rows, order=["target"]).orderBy("edge_id").collect()
    assert [(r.src, r.dst, r.edge_type, r.weight, r.properties["since"]) for r in got] == [
        (1, 2, "KNOWS", 1.0, "2018"), (1, 3, "MENTORS", 1.0, "2021")]
    assert got[0].valid_from is None


def test_create_in_input_order(spark):
    rows = spark.createDataFrame([(["B"],), (["A"],), (["C"],)], "labels array<string>").coalesce(1)
    existing = frames.import_nodes(people(spark))
    made = frames.create_nodes(rows, existing).orderBy("node_id").collect()
    assert [(r.node_id, r.labels) for r in made] == [(3, ["B"]), (4, ["A"]), (5, ["C"])]
    with pytest.raises(GraphError):
        frames.create_nodes(spark.createDataFrame([([],)], "labels array<string>"))


def test_create_edges_checks(spark):
    graph = graph_of(spark, [(0, 1)])
    rows = spark.createDataFrame([(0, 1, "X"), (0, 9, "X")], "src long, dst long, edge_type string")
    assert frames.create_edges(rows, graph).count() == 2
    with pytest.raises(GraphError):
        frames.create_edges(rows, graph, check_endpoints=True)
    assert dangling_edges(graph.with_edges(frames.create_edges(rows, graph))).count() == 1


def test_lookup(spark):
    graph = graph_of(spark, [(0, 1)])
    got = {r.node_id: r.found for r in maintenance.get_nodes(graph, ids_of(spark, 0, 5, 5)).collect()}
    assert got == {0: True, 5: False}
    with pytest.raises(GraphError):
        maintenance.get_nodes(graph, ids_of(spark, 5), on_missing="error")
    assert maintenance.get_edges(graph, ids_of(spark, 0, name="edge_id")).first().dst == 1


def test_merge_properties(spark):
    graph = graph_of(spark, [(0, 1)])
    updates = spark.createDataFrame([(0, {"name": "new", "age": "31"}), (1, {"name": None}), (77, {"x": "y"})],
                                    "node_id long, properties map<string,string>")
    got = {r.node_id: r.properties for r in maintenance.merge_node_properties(graph, updates).nodes.collect()}
    assert got == {0: {"name": "new", "age": "31"}, 1: {"name": None}}
    edge_updates = spark.createDataFrame([(0, {"since": "2018"})], "edge_id long, properties map<string,string>")
    edge = maintenance.merge_edge_properties(graph, edge_updates).edges.first()
    assert edge.properties == {"since": "2018"} and edge.weight == 1.0


def test_delete(spark):
    graph = graph_of(spark, [(0, 1), (1, 2), (2, 0), (2, 2)])
    left, deleted = maintenance.delete_nodes(graph, ids_of(spark, 0, 0, 99))
    assert deleted.first().deleted == 1 and left.nodes.count() == 2
    assert {(r.src, r.dst) for r in left.edges.collect()} == {(1, 2), (2, 2)}
    left, deleted = maintenance.delete_edges(graph, ids_of(spark, 1, 1, 50, name="edge_id"))
    assert deleted.first().deleted == 1 and left.edges.count() == 3


def test_get_or_create(spark):
    keys = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "ip string")
    first = maintenance.get_or_create(keys, "ip")
    assert {(r.ip, r.node_id) for r in first.collect()} == {("a", 0), ("b", 1)}
    again = maintenance.get_or_create(spark.createDataFrame([("0",), ("b",)], "ip string"), "ip", first)
    assert {(r.ip, r.node_id) for r in again.collect()} == {("a", 0), ("b", 1), ("0", 2)}


def test_argument_checks():
    for bad in [lambda: check_alpha(1.1), lambda: check_direction("up"), lambda: check_at_least("k", 0, 1),
                lambda: check_at_least("k", True, 1)]:
        with pytest.raises(GraphError):
            bad()


def test_data_checks(spark):
    graph = graph_of(spark, [(0, 1)])
    require_clean(node_faults(graph.nodes))
    require_clean(edge_faults(graph.edges))
    with pytest.raises(GraphError, match="no_type=1"):
        require_clean(edge_faults(graph.edges.withColumn("edge_type", F.lit(""))))


def test_round_trip_keeps_types(spark, tmp_path):
    graph = graph_of(spark, [(0, 1), (1, 2)])
    graph = graph.with_edges(graph.edges.withColumn("edge_type", F.lit("007")))
    tables.write_graph(graph, str(tmp_path / "g"))
    back = tables.read_graph(spark, str(tmp_path / "g"), edge_type="007", primary_label="N")
    assert back.edges.first().edge_type == "007" and back.edges.count() == 2
    assert back.nodes.orderBy("node_id").first().properties == {"name": "n0"}
    plan = back.edges._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(edge_type" in plan


def test_results_and_batches(spark):
    hits = spark.createDataFrame([(json.dumps([{"node_id": 1, "similarity": 0.95}, {"node_id": 2, "similarity": 0.8}]),),
                                  (json.dumps({"node_id": 3, "similarity": 0.5}),), ("[]",)], "r string")
    got = export.results_to_dataframe(hits, "r", "node_id bigint, similarity double")
    assert {tuple(r) for r in got.collect()} == {(1, 0.95), (2, 0.8), (3, 0.5)}
    assert export.results_to_dataframe(hits.where("false"), "r", "node_id bigint").columns == ["node_id"]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        sizes = export.query_batches(spark.range(95), lambda b: pa.record_batch([pa.array([b.num_rows])], ["n"]), "n bigint")
        found = [r.n for r in sizes.collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sum(found) == 95 and max(found) <= 10


def test_match_over_stored_tables_prunes(spark, tmp_path):
    kinds = "node_id long, labels array<string>, properties map<string,string>, embedding array<double>"
    rows = [(1, ["A"], {"age": "30"}, None), (2, ["B", "A"], {"age": "50"}, None), (3, ["C"], {"age": "60"}, None),
            (4, [], {}, None), (5, ["A", "C"], {}, None)]
    plain = PropertyGraph(spark.createDataFrame(rows, kinds), graph_of(spark, [(1, 2)]).edges)
    tables.write_graph(plain.with_typed_properties({"age": "int"}), str(tmp_path / "g"))
    back = tables.read_graph(spark, str(tmp_path / "g"))
    assert back.nodes.columns == plain.nodes.columns
    for label in ("A", "B", "C", "nope"):
        got = {r.n.node_id for r in match(back, [Node("n", label)]).collect()}
        assert got == {i for i, labels, _, _ in rows if label in labels}
    found = match(back, [Node("n", "A")]).where(F.col("n.properties.age") > 40).select("n.node_id")
    assert [r.node_id for r in found.collect()] == [2]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [primary_label#" in plan and "IN (" in plan
    assert "GreaterThan(properties.age,40)" in plan and "ReadSchema: struct<node_id:bigint,labels:array<string>,properties:struct<age:int>>" in plan
    assert match(back.with_nodes(plain.nodes), [Node("n", "C")]).count() == 2

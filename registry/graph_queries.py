"""Sources, maintenance, traversal and pattern queries."""

from __future__ import annotations

import uuid
from dataclasses import replace

import pyarrow as pa
from pyspark.sql import functions as F

from meshlark.functions.scalars import joined_labels, utc_millis
from meshlark.graph import PropertyGraph, edge_faults, node_faults
from meshlark.operators import maintenance, pattern, temporal, traverse
from meshlark.operators.flows import flows_to_edges, ip_nodes, packet_ips, packets_to_flows
from meshlark.plans.lineage import shared_folder
from meshlark.sources import derived, export, frames, tables
from meshlark.sources.adjacency import read_adjacency, with_adjacency, write_adjacency
from registry import base
from registry.base import EDGES, PAIRS, USERS, ctes, flow_ctes, links_cte, query, reach_cte

c = F.col
Node, Edge = pattern.Node, pattern.Edge
SNAPSHOT = 1705276800000  # 2024-01-15T00:00Z


def prop(name: str, kind: str = "string"):
    return c("properties")[name].cast(kind).alias(name)


# ---- sources --------------------------------------------------------------------------------------------


@query("s01_import_nodes", """
SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS node_id, c_mktsegment AS label, c_custkey, c_name,
  c_nationkey, c_acctbal FROM customer""")
def s01(spark, d):
    rows = derived.table(spark, d, "customer")
    made = frames.import_nodes(rows, label_col="c_mktsegment", id_col="c_custkey", order=["c_custkey"])
    return made.select("node_id", c("labels")[0].alias("label"), prop("c_custkey", "long"), prop("c_name"),
                       prop("c_nationkey", "int"), prop("c_acctbal", "double"))


@query("s01_import_embeddings", """
SELECT dense_rank() OVER (ORDER BY vec_id) - 1 AS node_id, CAST(label AS VARCHAR) AS label,
  CAST(vec_id AS VARCHAR) AS vec_id, place, CAST(embedding[place + 1] AS DOUBLE) AS x FROM embeddings, range(64) r(place)""")
def s01e(spark, d):
    names = [f"e{n}" for n in range(64)]
    rows = derived.table(spark, d, "embeddings").select("vec_id", "label", *[c("embedding")[n].alias(e) for n, e in enumerate(names)])
    made = frames.import_nodes(rows, embedding_cols=names, order=["vec_id"])
    return made.select("node_id", c("labels")[0].alias("label"), prop("vec_id"), F.posexplode("embedding").alias("place", "x")).withColumn(
        "place", c("place").cast("long"))


@query("s02_import_edges", """
SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS edge_id, o_custkey AS src, o_orderkey AS dst,
  o_orderstatus AS edge_type, o_totalprice AS weight, epoch_us(o_orderdate)//1000 AS valid_from,
  CAST(NULL AS BIGINT) AS valid_to, o_orderpriority FROM orders""")
def s02(spark, d):
    rows = derived.table(spark, d, "orders").withColumn("since", utc_millis(c("o_orderdate"))).drop("o_orderdate")
    made = frames.import_edges(rows, "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "since",
                               order=["o_orderkey"])
    return made.select("edge_id", "src", "dst", "edge_type", "weight", "valid_from", "valid_to",
                       prop("o_orderpriority"))


@query("s03_create_nodes", """
SELECT (SELECT count(*) FROM customer) + row_number() OVER (ORDER BY s_suppkey) - 1 AS node_id,
  'supplier' AS labels, s_name AS name FROM supplier""")
def s03(spark, d):
    existing = frames.import_nodes(derived.table(spark, d, "customer"), "c_mktsegment", order=["c_custkey"])
    rows = derived.table(spark, d, "supplier").select(
        "s_suppkey", F.array(F.lit("supplier")).alias("labels"),
        F.create_map(F.lit("name"), c("s_name")).alias("properties"))
    made = frames.create_nodes(rows, existing, order=["s_suppkey"])
    return made.select("node_id", joined_labels(c("labels")).alias("labels"), prop("name"))


@query("s04_create_edges", """
SELECT (SELECT count(*) FROM nation) + row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey) - 1 AS edge_id,
  l_orderkey AS src, l_partkey AS dst, 'CONTAINS' AS edge_type, CAST(1.0 AS DOUBLE) AS weight,
  0 AS properties, CAST(NULL AS BIGINT) AS valid_from FROM lineitem""")
def s04(spark, d):
    nation = derived.table(spark, d, "nation")
    first = frames.import_edges(nation.withColumn("type", F.lit("IN_REGION")), "n_nationkey", "n_regionkey",
                                order=["n_nationkey"])
    lines = derived.table(spark, d, "lineitem").select(
        "l_linenumber", c("l_orderkey").alias("src"), c("l_partkey").alias("dst"),
        F.lit("CONTAINS").alias("edge_type"))
    graph = PropertyGraph(nation, first)
    made = frames.create_edges(lines, graph, order=["src", "l_linenumber", "dst"])
    return made.select("edge_id", "src", "dst", "edge_type", "weight", F.size("properties").alias("properties"),
                       "valid_from")


ALL_NODES = """
SELECT 10000000000 + r_regionkey AS node_id, 'region' AS labels, r_name FROM region
UNION ALL BY NAME SELECT 20000000000 + n_nationkey AS node_id, 'nation' AS labels, n_name,
  CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation
UNION ALL BY NAME SELECT 30000000000 + c_custkey AS node_id, 'customer,' || c_mktsegment AS labels, c_name,
  CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL BY NAME SELECT 40000000000 + s_suppkey AS node_id, 'supplier' AS labels, s_name,
  CAST(s_nationkey AS VARCHAR) AS s_nationkey, s_acctbal FROM supplier
UNION ALL BY NAME SELECT 50000000000 + p_partkey AS node_id, 'part' AS labels, p_name, p_brand, p_type,
  CAST(p_size AS VARCHAR) AS p_size, p_retailprice FROM part
UNION ALL BY NAME SELECT 60000000000 + o_orderkey AS node_id, 'order' AS labels,
  CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
  o_orderpriority FROM orders"""
NUMBERS = ["c_acctbal", "s_acctbal", "p_retailprice", "o_totalprice"]


@query("s05_export_nodes", ALL_NODES)
def s05(spark, d):
    graph = derived.commerce_graph(spark, d)
    return export.export_nodes(graph, graph.nodes).withColumns({n: c(n).cast("double") for n in NUMBERS})


@query("s06_export_bfs", ctes(EDGES, USERS, PAIRS, links_cte(), reach_cte("hubs", 2), recursive=True) + """
SELECT r.start, r.node_id, r.depth, 'User' AS labels, u.name FROM reach r JOIN users u USING (node_id)""")
def s06(spark, d):
    return export.export_bfs(base.kept(derived.activity_graph(spark, d)), base.hubs(spark, d), 2)


@query("s07_nodes_to_dataframe", ctes(USERS) + """SELECT node_id AS id, 'User' AS labels, name FROM users""")
def s07(spark, d):
    graph = derived.activity_graph(spark, d)
    wide = export.nodes_to_dataframe(graph, graph.nodes)
    return wide.withColumn("labels", joined_labels(c("labels")))


@query("s08_results_to_dataframe", """
SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events""")
def s08(spark, d):
    rows = derived.table(spark, d, "events").select(
        F.to_json(F.struct("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))).alias("record"))
    return export.results_to_dataframe(rows, "record", "event_id bigint, k int")


@query("s09_query_df", """SELECT c_name AS name, c_acctbal AS balance FROM customer WHERE c_mktsegment = 'BUILDING'""")
def s09(spark, d):
    graph = derived.commerce_graph(spark, d)
    found = pattern.match(graph, [Node("p", "BUILDING")])
    return found.select(c("p.properties")["c_name"].alias("name"),
                        c("p.properties")["c_acctbal"].cast("double").alias("balance"))


@query("s10_query_batches", """SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag""")
def s10(spark, d):
    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        flags = batch.column(0).value_counts()
        return pa.RecordBatch.from_arrays([flags.field(0), flags.field(1)], names=["l_returnflag", "n"])

    lines = derived.table(spark, d, "lineitem").select("l_returnflag")
    parts = export.query_batches(lines, counted, "l_returnflag string, n bigint")
    return parts.groupBy("l_returnflag").agg(F.sum("n").alias("n"))


@query("s11_graph_tables", f"""
SELECT 'edges' AS kind, 'CONTAINS' AS name, count(*) AS n, round(sum(l_quantity), 2) AS weight FROM lineitem
UNION ALL SELECT 'edges', 'SUPPLIED_BY', count(*), round(sum(l_extendedprice), 2) FROM lineitem
UNION ALL SELECT 'edges', 'PLACED', count(*), round(sum(o_totalprice), 2) FROM orders
UNION ALL SELECT 'edges', 'IN_REGION', count(*), count(*) FROM nation
UNION ALL SELECT 'edges', 'LOCATED_IN', sum(n)::BIGINT, sum(n)::DOUBLE FROM (
  SELECT count(*) AS n FROM customer UNION ALL SELECT count(*) FROM supplier)
UNION ALL SELECT 'nodes', split_part(labels, ',', 1), count(*), sum(node_id)::DOUBLE FROM ({ALL_NODES}) GROUP BY ALL""")
def s11(spark, d):
    path = f"{shared_folder(spark)}/graphs/{uuid.uuid4().hex}"
    tables.write_graph(derived.commerce_graph(spark, d), path)
    back = tables.read_graph(spark, path)
    edges = back.edges.groupBy(F.lit("edges").alias("kind"), c("edge_type").alias("name")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("weight"), 2).alias("weight"))
    return edges.unionByName(back.nodes.groupBy(F.lit("nodes").alias("kind"), c("labels")[0].alias("name")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("node_id").cast("double").alias("weight")))


@query("s12_packet_source", ctes(base.PACKETS) + """
SELECT layer_2_id, layer_3_id, count(*) AS packets, CAST(sum(layer_1_size) AS BIGINT) AS bytes,
  min(tv_sec) AS first_sec, CAST(max(tv_usec) AS BIGINT) AS usec FROM pk GROUP BY ALL""")
def s12(spark, d):
    path = f"{shared_folder(spark)}/packets/{uuid.uuid4().hex}"
    derived.packets(spark, d).write.parquet(path)
    return tables.read_packets(spark, path).groupBy("layer_2_id", "layer_3_id").agg(
        F.count(F.lit(1)).alias("packets"), F.sum("layer_1_size").alias("bytes"),
        F.min("tv_sec").alias("first_sec"), F.max("tv_usec").alias("usec"))


def flow_graph(spark, d):
    packets = derived.packets(spark, d)
    registry = maintenance.get_or_create(packet_ips(packets), "ip")
    return PropertyGraph(ip_nodes(registry), flows_to_edges(packets_to_flows(packets), registry))


FLOW_EDGE_ID = ("row_number() OVER (ORDER BY src_ip, dst_ip, protocol, service_port NULLS FIRST) - 1 AS edge_id")


@query("s13_extract_flows", flow_ctes() + f"""
SELECT {FLOW_EDGE_ID}, src_ip, dst_ip, protocol, service_port, service_name, flow_count, total_bytes, valid_from,
  valid_to FROM flows""")
def s13(spark, d):
    return export.extract_flows(flow_graph(spark, d), "IPAddress")


# ---- maintenance ----------------------------------------------------------------------------------------


def vector_ids(spark, d, name="node_id"):
    return derived.table(spark, d, "embeddings").select(c("vec_id").alias(name))


@query("c01_get_nodes", ctes(USERS) + """
SELECT v.vec_id AS node_id, u.node_id IS NOT NULL AS found, u.name FROM embeddings v
LEFT JOIN users u ON u.node_id = v.vec_id""")
def c01(spark, d):
    found = maintenance.get_nodes(derived.activity_graph(spark, d), vector_ids(spark, d))
    return found.select("node_id", "found", prop("name"))


@query("c02_get_edges", ctes(EDGES) + """
SELECT v.event_id AS edge_id, e.edge_id IS NOT NULL AS found, src, dst, edge_type, valid_from, valid_to
FROM events v LEFT JOIN edges e ON e.edge_id = v.event_id""")
def c02(spark, d):
    ids = derived.table(spark, d, "events").select(c("event_id").alias("edge_id"))
    return maintenance.get_edges(derived.activity_graph(spark, d), ids).select(
        "edge_id", "found", "src", "dst", "edge_type", "valid_from", "valid_to")


@query("c03_merge_node_properties", ctes(USERS) + """
SELECT u.node_id, CASE WHEN v.label % 2 = 0 THEN 'vector-' || v.vec_id ELSE u.name END AS name,
  CAST(v.label AS VARCHAR) AS topic FROM users u LEFT JOIN embeddings v ON v.vec_id = u.node_id""")
def c03(spark, d):
    topic = F.create_map(F.lit("topic"), c("label").cast("string"))
    renamed = F.create_map(F.lit("topic"), c("label").cast("string"), F.lit("name"), F.concat(F.lit("vector-"), "vec_id"))
    updates = derived.table(spark, d, "embeddings").select(
        c("vec_id").alias("node_id"), F.when(c("label") % 2 == 0, renamed).otherwise(topic).alias("properties"))
    changed = maintenance.merge_node_properties(derived.activity_graph(spark, d), updates)
    return changed.nodes.select("node_id", prop("name"), prop("topic"))


@query("c04_merge_edge_properties", ctes(EDGES) + """
SELECT e.edge_id, v.props, e.weight, e.valid_from FROM edges e JOIN events v ON v.event_id = e.edge_id""")
def c04(spark, d):
    updates = derived.table(spark, d, "events").select(
        c("event_id").alias("edge_id"), F.create_map(F.lit("props"), c("props")).alias("properties"))
    changed = maintenance.merge_edge_properties(derived.activity_graph(spark, d), updates)
    return changed.edges.select("edge_id", prop("props"), "weight", "valid_from")


@query("c05_delete_nodes", ctes(EDGES, USERS, PAIRS) + """
SELECT (SELECT count(*) FROM users WHERE node_id IN (FROM hubs)) AS deleted,
  (SELECT count(*) FROM users WHERE node_id NOT IN (FROM hubs)) AS nodes_left,
  (SELECT count(*) FROM edges WHERE src NOT IN (FROM hubs) AND dst NOT IN (FROM hubs)) AS edges_left""")
def c05(spark, d):
    ids = base.hubs(spark, d).unionByName(base.hubs(spark, d).select((c("node_id") + 10 ** 9).alias("node_id")))
    left, deleted = maintenance.delete_nodes(derived.activity_graph(spark, d), ids)
    return deleted.select("deleted", left.nodes.agg(F.count(F.lit(1))).scalar().alias("nodes_left"),
                          left.edges.agg(F.count(F.lit(1))).scalar().alias("edges_left"))


@query("c06_delete_edges", ctes(EDGES) + """
SELECT count(*) FILTER (edge_type = 'error') AS deleted, count(*) FILTER (edge_type <> 'error') AS edges_left
FROM edges""")
def c06(spark, d):
    ids = derived.table(spark, d, "events").where("event_type = 'error'").select(c("event_id").alias("edge_id"))
    left, deleted = maintenance.delete_edges(derived.activity_graph(spark, d), ids)
    return deleted.select("deleted", left.edges.agg(F.count(F.lit(1))).scalar().alias("edges_left"))


@query("c07_node_faults", """
SELECT count(*) FILTER (vec_id IS NULL) AS null_id, count(*) FILTER (label % 3 = 0) AS no_label,
  count(*) FILTER (label % 4 = 1) AS bad_embedding FROM embeddings""")
def c07(spark, d):
    rows = derived.table(spark, d, "embeddings").select(
        c("vec_id").alias("node_id"),
        F.when(c("label") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("V"))).alias("labels"),
        F.when(c("label") % 4 == 1, F.array(F.lit(None).cast("double"))).otherwise(
            c("embedding").cast("array<double>")).alias("embedding"))
    return node_faults(rows)


@query("c07_edge_faults", ctes(EDGES) + """
SELECT 0::BIGINT AS null_endpoint, count(*) FILTER (edge_type = 'view') AS no_type, 0::BIGINT AS bad_weight FROM edges""")
def c07e(spark, d):
    edges = derived.activity_edges(spark, d)
    return edge_faults(edges.withColumn("edge_type", F.when(c("edge_type") != "view", c("edge_type"))))


@query("c08_get_or_create", ctes(base.PACKETS, base.IPS) + "SELECT node_id, ip FROM ips")
def c08(spark, d):
    return maintenance.get_or_create(packet_ips(derived.packets(spark, d)), "ip")


# ---- traversal ------------------------------------------------------------------------------------------

BOTH_NEIGHBORS = """
SELECT h.node_id AS request_id, dst AS node_id, edge_id, edge_type, 'outgoing' AS direction FROM edges
  JOIN hubs h ON h.node_id = src
UNION ALL SELECT h.node_id, src, edge_id, edge_type, 'incoming' FROM edges JOIN hubs h ON h.node_id = dst
  WHERE src <> dst"""


@query("t01_neighbors", ctes(EDGES, PAIRS) + BOTH_NEIGHBORS)
def t01(spark, d):
    return traverse.neighbors(derived.activity_graph(spark, d), base.hubs(spark, d), "both")


@query("t01_neighbors_typed", ctes(EDGES, PAIRS) + """
SELECT h.node_id AS request_id, dst AS node_id, edge_id, edge_type, 'outgoing' AS direction FROM edges
JOIN hubs h ON h.node_id = src WHERE edge_type = 'click'""")
def t01t(spark, d):
    return traverse.neighbors(derived.activity_graph(spark, d), base.hubs(spark, d), edge_type="click")


@query("t02_bfs", ctes(EDGES, PAIRS, links_cte(), reach_cte("hubs", 3), recursive=True) + "FROM reach")
def t02(spark, d):
    return traverse.bfs(base.kept(derived.activity_graph(spark, d)), base.hubs(spark, d), 3)


@query("t02_bfs_typed", ctes(EDGES, PAIRS, links_cte(where="edge_type = 'click'"), reach_cte("hubs", 3),
                             recursive=True) + "FROM reach")
def t02t(spark, d):
    return traverse.bfs(base.kept(derived.activity_graph(spark, d)), base.hubs(spark, d), 3, edge_type="click")


def path_sql(edges: str) -> str:
    """Level by level; of the paths that reach a node first, the smallest list of ids stays."""
    return ctes(EDGES, PAIRS, *([edges] if edges else []), links_cte("snapshot" if edges else "edges"), """
walk(start, node_id, length, path) USING KEY (start, node_id) AS (
  SELECT DISTINCT from_node, from_node, 0, [from_node] FROM pairs
  UNION SELECT w.start, l.dst, w.length + 1, min(list_append(w.path, l.dst)) FROM walk w JOIN links l ON l.src = w.node_id
    LEFT JOIN recurring.walk o ON o.start = w.start AND o.node_id = l.dst
    WHERE o.node_id IS NULL GROUP BY w.start, l.dst, w.length)""", recursive=True) + """
SELECT DISTINCT p.from_node, p.to_node, w.length, CAST(w.length AS DOUBLE) AS cost, array_to_string(w.path, '>') AS path
FROM pairs p LEFT JOIN walk w ON w.start = p.from_node AND w.node_id = p.to_node"""


def cost_sql(edges: str) -> str:
    """Rounds of improved nodes; a node keeps its least (cost, length, list of ids)."""
    return ctes(EDGES, PAIRS, *([edges] if edges else []), links_cte("snapshot" if edges else "edges"), """
best(start, node_id, b) USING KEY (start, node_id) AS (
  SELECT DISTINCT from_node, from_node, {'cost': CAST(0.0 AS DOUBLE), 'length': 0, 'path': [from_node]} FROM pairs
  UNION SELECT w.start, l.dst, min({'cost': w.b.cost + l.weight, 'length': w.b.length + 1, 'path': list_append(w.b.path, l.dst)})
    FROM best w JOIN links l ON l.src = w.node_id
    LEFT JOIN recurring.best o ON o.start = w.start AND o.node_id = l.dst GROUP BY w.start, l.dst, o.b
    HAVING o.b IS NULL
      OR min({'cost': w.b.cost + l.weight, 'length': w.b.length + 1, 'path': list_append(w.b.path, l.dst)}) < o.b)""",
                recursive=True) + """
SELECT DISTINCT p.from_node, p.to_node, w.b.length AS length, round(w.b.cost, 6) AS cost, array_to_string(w.b.path, '>') AS path
FROM pairs p LEFT JOIN best w ON w.start = p.from_node AND w.node_id = p.to_node"""


def joined_path():
    return F.array_join("path", ">").alias("path")


VISIBLE = "(valid_from IS NULL OR valid_from <= {t}) AND (valid_to IS NULL OR valid_to >= {t})"
AT = f"snapshot AS (SELECT * FROM edges WHERE {VISIBLE.format(t=SNAPSHOT)})"


@query("t03_shortest_path", path_sql(""))
def t03(spark, d):
    found = traverse.shortest_path(base.kept(derived.activity_graph(spark, d)), base.hub_pairs(spark, d))
    return found.select("from_node", "to_node", "length", "cost", joined_path())


@query("t04_shortest_path_weighted", cost_sql(""))
def t04(spark, d):
    found = traverse.shortest_path(base.kept(derived.activity_graph(spark, d)), base.hub_pairs(spark, d), weighted=True)
    return found.select("from_node", "to_node", "length", F.round("cost", 6).alias("cost"), joined_path())


@query("t03_shortest_path_both_ways", ctes(EDGES, PAIRS, base.both_ways(), """
walk(start, node_id, path) USING KEY (start, node_id) AS (
  SELECT DISTINCT from_node, from_node, [from_node] FROM pairs
  UNION SELECT w.start, l.dst, min(list_append(w.path, l.dst)) FROM walk w JOIN links l ON l.src = w.node_id
    LEFT JOIN recurring.walk o ON o.start = w.start AND o.node_id = l.dst WHERE o.node_id IS NULL GROUP BY w.start, l.dst)""",
    recursive=True) + """
SELECT DISTINCT p.from_node, p.to_node, array_to_string(w.path, '>') AS path FROM pairs p
LEFT JOIN walk w ON w.start = p.from_node AND w.node_id = p.to_node""")
def t03b(spark, d):
    """Over the stored walking order, against the edges' direction too."""
    graph = with_adjacency(derived.activity_graph(spark, d), f"{shared_folder(spark)}/graphs/{uuid.uuid4().hex}")
    found = traverse.shortest_path(graph, base.hub_pairs(spark, d), direction="both")
    return found.select("from_node", "to_node", joined_path())


@query("t02_bfs_stored", ctes(EDGES, PAIRS, links_cte(where="edge_type <> 'error'"), reach_cte("hubs", 2), recursive=True)
       + "FROM reach")
def t02s(spark, d):
    """Over the stored walking order, laid out in 16 parts, without the edges of one type."""
    path = f"{shared_folder(spark)}/graphs/{uuid.uuid4().hex}"
    graph = derived.activity_graph(spark, d)
    write_adjacency(graph.edges, path, parts=16)
    laid = read_adjacency(spark, path).where("edge_type <> 'error'")
    return traverse.bfs(replace(graph, adjacency=laid), base.hubs(spark, d), 2)


@query("t05_neighbors_at", ctes(EDGES, PAIRS, AT) + """
SELECT h.node_id AS request_id, dst AS node_id, edge_id, edge_type, 'outgoing' AS direction
FROM snapshot JOIN hubs h ON h.node_id = src""")
def t05(spark, d):
    return traverse.neighbors_at(derived.activity_graph(spark, d), base.hubs(spark, d), SNAPSHOT)


@query("t06_bfs_at", ctes(EDGES, PAIRS, AT, links_cte("snapshot"), reach_cte("hubs", 3), recursive=True) + "FROM reach")
def t06(spark, d):
    return traverse.bfs_at(base.kept(derived.activity_graph(spark, d)), base.hubs(spark, d), SNAPSHOT, 3)


@query("t07_shortest_path_at", path_sql(AT))
def t07(spark, d):
    found = traverse.shortest_path_at(base.kept(derived.activity_graph(spark, d)), base.hub_pairs(spark, d), SNAPSHOT)
    return found.select("from_node", "to_node", "length", "cost", joined_path())


@query("t07_shortest_path_at_weighted", cost_sql(AT))
def t07w(spark, d):
    found = traverse.shortest_path_at(base.kept(derived.activity_graph(spark, d)), base.hub_pairs(spark, d), SNAPSHOT, True)
    return found.select("from_node", "to_node", "length", F.round("cost", 6).alias("cost"), joined_path())


@query("t08_edges_at", ctes(EDGES, AT) + "SELECT edge_id, src, dst, edge_type, weight, valid_from, valid_to FROM snapshot")
def t08(spark, d):
    return temporal.edges_at(derived.activity_edges(spark, d), SNAPSHOT).drop("properties")


@query("t09_sweep", ctes(EDGES, "points AS (SELECT DISTINCT epoch_us(date_trunc('day', ts))//1000 AS timestamp FROM events)") + f"""
SELECT timestamp, count(*) AS edges, count(DISTINCT src) AS sources, round(sum(weight), 6) AS weight
FROM points JOIN edges ON {VISIBLE.format(t='timestamp')} GROUP BY timestamp""")
def t09(spark, d):
    days = derived.table(spark, d, "events").select(
        utc_millis(F.date_trunc("day", c("ts"))).alias("timestamp")).distinct()
    return temporal.sweep(derived.activity_edges(spark, d), days, lambda e: e.groupBy("timestamp").agg(
        F.count(F.lit(1)).alias("edges"), F.count_distinct("src").alias("sources"),
        F.round(F.sum("weight"), 6).alias("weight")))


@query("t09_sweep_totals", ctes(EDGES, "points AS (SELECT DISTINCT epoch_us(date_trunc('hour', ts))//1000 AS timestamp FROM events)") + f"""
SELECT timestamp, count(edge_id) AS edges, round(coalesce(sum(weight), 0), 4) AS weight
FROM points LEFT JOIN edges ON {VISIBLE.format(t='timestamp')} GROUP BY timestamp""")
def t09t(spark, d):
    """Every hour, by changes at window ends."""
    hours = derived.table(spark, d, "events").select(utc_millis(F.date_trunc("hour", c("ts"))).alias("timestamp"))
    found = temporal.sweep_totals(derived.activity_edges(spark, d), hours, {"edges": F.lit(1).cast("long"), "weight": c("weight")})
    return found.withColumn("weight", F.round("weight", 4) + F.lit(0.0))


# ---- pattern match --------------------------------------------------------------------------------------


def p(var: str, name: str, kind: str = "string"):
    return c(f"{var}.properties")[name].cast(kind)


@query("q01_all_nodes", f"SELECT node_id, labels FROM ({ALL_NODES})")
def q01(spark, d):
    found = pattern.match(derived.commerce_graph(spark, d), [Node("n")])
    return found.select("n.node_id", joined_labels(c("n.labels")).alias("labels"))


@query("q02_label", "SELECT 30000000000 + c_custkey AS node_id FROM customer")
def q02(spark, d):
    return pattern.match(derived.commerce_graph(spark, d), [Node("p", "customer")]).select("p.node_id")


@query("q03_where", "SELECT 30000000000 + c_custkey AS node_id, c_acctbal AS balance FROM customer WHERE c_acctbal > 2500")
def q03(spark, d):
    found = pattern.match(derived.commerce_graph(spark, d), [Node("p", "customer")])
    return found.where(p("p", "c_acctbal", "double") > 2500).select(
        "p.node_id", p("p", "c_acctbal", "double").alias("balance"))


@query("q03_where_stored", "SELECT 30000000000 + c_custkey AS node_id, c_acctbal AS balance FROM customer WHERE c_acctbal > 2500")
def q03s(spark, d):
    """Over stored tables with typed properties: only the label's folders are read, and the condition reaches the scan."""
    path = f"{shared_folder(spark)}/graphs/{uuid.uuid4().hex}"
    tables.write_graph(derived.commerce_graph(spark, d).with_typed_properties({"c_acctbal": "double", "c_name": "string"}), path)
    found = pattern.match(tables.read_graph(spark, path), [Node("p", "customer")])
    return found.where(c("p.properties.c_acctbal") > 2500).select("p.node_id", c("p.properties.c_acctbal").alias("balance"))


@query("q04_typed_hop", """
SELECT 30000000000 + o_custkey AS a, 60000000000 + o_orderkey AS b FROM orders JOIN customer ON c_custkey = o_custkey""")
def q04(spark, d):
    found = pattern.match(derived.commerce_graph(spark, d), [Node("a", "customer"), Edge("r", "PLACED"), Node("b", "order")])
    return found.select(c("a.node_id").alias("a"), c("b.node_id").alias("b"))


@query("q05_edge_variable", """
SELECT 30000000000 + c_custkey AS s, 'LOCATED_IN' AS kind, CAST(1.0 AS DOUBLE) AS weight, 20000000000 + c_nationkey AS d
FROM customer UNION ALL SELECT 30000000000 + o_custkey, 'PLACED', o_totalprice, 60000000000 + o_orderkey FROM orders""")
def q05(spark, d):
    found = pattern.match(derived.commerce_graph(spark, d), [Node("s", "customer"), Edge("e"), Node("d")])
    return found.select(c("s.node_id").alias("s"), c("e.edge_type").alias("kind"), "e.weight", c("d.node_id").alias("d"))


@query("q06_chain", """
SELECT c_name AS customer, s_name AS supplier, n_name AS nation, count(*) AS n FROM lineitem
JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL""")
def q06(spark, d):
    found = pattern.match(derived.commerce_graph(spark, d), [
        Node("c", "customer"), Edge("r1", "PLACED"), Node("o", "order"), Edge("r2", "SUPPLIED_BY"),
        Node("s", "supplier"), Edge("r3", "LOCATED_IN"), Node("n", "nation")])
    return found.groupBy(p("c", "c_name").alias("customer"), p("s", "s_name").alias("supplier"),
                         p("n", "n_name").alias("nation")).agg(F.count(F.lit(1)).alias("n"))


@query("q07_edge_id", """
SELECT 50000000000000 + l_orderkey * 10 + l_linenumber AS edge_id FROM lineitem""")
def q07(spark, d):
    found = pattern.match(derived.commerce_graph(spark, d), [Node("o", "order"), Edge("e"), Node("p", "part")])
    return found.select("e.edge_id")


@query("q08_edge_type", ctes(EDGES) + "SELECT edge_type AS kind, count(*) AS n FROM edges GROUP BY ALL")
def q08(spark, d):
    found = pattern.match(derived.activity_graph(spark, d), [Node("s", "User"), Edge("e"), Node("d", "User")])
    return found.select(c("e.edge_type").alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("q09_projection", "SELECT s_name AS name, n_name AS nation FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def q09(spark, d):
    found = pattern.match(derived.commerce_graph(spark, d), [Node("s", "supplier"), Edge("e", "LOCATED_IN"), Node("n")])
    return found.select(p("s", "s_name").alias("name"), p("n", "n_name").alias("nation"))


@query("q10_whole_node", "SELECT 40000000000 + s_suppkey AS node_id, 'supplier' AS labels, s_name, s_acctbal FROM supplier")
def q10(spark, d):
    found = pattern.match(derived.commerce_graph(spark, d), [Node("n", "supplier")]).select("n")
    return found.select("n.*").select("node_id", joined_labels(c("labels")).alias("labels"), prop("s_name"),
                                      prop("s_acctbal", "double"))


@query("q11_order_by", "SELECT p_name AS name, p_retailprice AS price FROM part ORDER BY p_retailprice DESC, p_name")
def q11(spark, d):
    found = pattern.match(derived.commerce_graph(spark, d), [Node("p", "part")])
    return found.select(p("p", "p_name").alias("name"), p("p", "p_retailprice", "double").alias("price")).orderBy(
        c("price").desc(), "name")


@query("q12_top", """
SELECT 60000000000 + o_orderkey AS node_id, o_totalprice AS price FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def q12(spark, d):
    graph = derived.commerce_graph(spark, d).with_typed_properties({"o_totalprice": "double"})
    found = pattern.match(graph, [Node("o", "order")])
    return found.select("o.node_id", c("o.properties.o_totalprice").alias("price")).orderBy(
        c("price").desc(), "node_id").limit(10)


"""Vector, hybrid and semantic search, subgraph context and anomaly queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from meshlark.functions import vectors
from meshlark.operators import anomaly, context, search
from meshlark.plans.lineage import store
from meshlark.sources import derived
from registry import base
from registry.base import (EDGES, HUB_VECTORS, LEADS, PAIRS, USERS, both_ways, ctes, links_cte, query, reach_cte)

c = F.col

COSINE = """
comparable AS (SELECT node_id, embedding FROM users WHERE embedding IS NOT NULL)"""
VECTOR_HITS = """
scored AS (SELECT query_id, node_id, list_cosine_similarity(embedding, vector) AS similarity FROM comparable, leads),
hits AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, node_id) AS rank FROM scored)"""


@query("v01_vector_search", ctes(USERS, LEADS, COSINE, VECTOR_HITS) + """
SELECT query_id, CAST(rank AS INTEGER) AS rank, node_id, round(similarity, 6) AS similarity FROM hits WHERE rank <= 10""")
def v01(spark, d):
    found = search.vector_search(derived.activity_graph(spark, d), base.label_leads(spark, d), 10)
    return found.withColumn("similarity", F.round("similarity", 6))


@query("v01_nearest_other_vectors", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS node_id, list_cosine_similarity(a.v, b.v) AS similarity FROM e a, e b)
SELECT query_id, node_id, round(similarity, 6) AS similarity FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, node_id) <= 3""")
def v01_all(spark, d):
    rows = derived.table(spark, d, "embeddings")
    nodes = rows.select(c("vec_id").alias("node_id"), c("embedding").cast("array<double>").alias("embedding"))
    graph = derived.activity_graph(spark, d).with_nodes(nodes)
    asked = rows.select(c("vec_id").alias("query_id"), c("embedding").cast("array<double>").alias("vector"))
    return search.vector_search(graph, asked, 3).select(
        "query_id", "node_id", F.round("similarity", 6).alias("similarity"))


@query("v02_approx_search")
def v02(spark, d):
    rows = derived.table(spark, d, "embeddings")
    nodes = rows.select(c("vec_id").alias("node_id"), c("embedding").cast("array<double>").alias("embedding"))
    graph = derived.activity_graph(spark, d).with_nodes(nodes)
    index = search.build_vector_index(graph, size=64, cells=16)
    return search.approx_search(index, base.label_leads(spark, d), 10, probes=6)


@query("v02_approx_search_all_cells", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
leads AS (SELECT vec_id, v FROM e JOIN embeddings USING (vec_id) QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS node_id, list_cosine_similarity(a.v, b.v) AS similarity FROM leads a, e b)
SELECT query_id, node_id, round(similarity, 6) AS similarity FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, node_id) <= 10""")
def v02_all(spark, d):
    """With every cell probed the index must give the exact answer."""
    rows = derived.table(spark, d, "embeddings")
    nodes = rows.select(c("vec_id").alias("node_id"), c("embedding").cast("array<double>").alias("embedding"))
    index = search.build_vector_index(derived.activity_graph(spark, d).with_nodes(nodes), size=64, cells=8)
    return search.approx_search(index, base.label_leads(spark, d), 10, probes=8).select(
        "query_id", "node_id", F.round("similarity", 6).alias("similarity"))


@query("v02_recall", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
leads AS (SELECT vec_id, v FROM e JOIN embeddings USING (vec_id) QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1),
exact AS (SELECT a.vec_id AS query_id, b.vec_id AS node_id FROM leads a, e b
  QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.v, b.v), 12) DESC, b.vec_id) <= 10)
SELECT count(*) AS exact_hits, TRUE AS recall_at_least_0_9 FROM exact""")
def v02_recall(spark, d):
    """Of the exact nearest ten of each lead, the share that 10 of 16 cells hold."""
    rows = derived.table(spark, d, "embeddings")
    nodes = rows.select(c("vec_id").alias("node_id"), c("embedding").cast("array<double>").alias("embedding"))
    graph = derived.activity_graph(spark, d).with_nodes(nodes)
    index = search.build_vector_index(graph, size=64, cells=16)
    near = search.approx_search(index, base.label_leads(spark, d), 10, probes=10).select("query_id", "node_id", F.lit(1).alias("found"))
    exact = search.vector_search(graph, base.label_leads(spark, d), 10).select("query_id", "node_id")
    both = exact.join(near, ["query_id", "node_id"], "left")
    return both.agg(F.count(F.lit(1)).alias("exact_hits"), (F.count("found") >= 0.9 * F.count(F.lit(1))).alias("recall_at_least_0_9"))


def requests(spark, d):
    return base.hub_vectors(spark, d).select(c("node_id").alias("request_id"), c("node_id").alias("anchor"), "vector")


def hybrid_sql(alpha: float, hops: int) -> str:
    return ctes(EDGES, USERS, PAIRS, HUB_VECTORS, links_cte(), reach_cte("hubs", hops), f"""
candidates AS (SELECT h.node_id AS request_id, u.node_id, r.depth,
    list_cosine_similarity(u.embedding, h.vector) AS similarity
  FROM hub_vectors h CROSS JOIN users u LEFT JOIN reach r ON r.start = h.node_id AND r.node_id = u.node_id
  WHERE u.embedding IS NOT NULL OR r.depth IS NOT NULL),
scored AS (SELECT *, {alpha} * coalesce(similarity, 0) + (1 - {alpha}) * coalesce(1.0 / (1 + depth), 0) AS score
  FROM candidates)""", recursive=True) + """
SELECT request_id, CAST(rank AS INTEGER) AS rank, node_id, round(score, 6) AS score, depth AS hops FROM (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY round(score, 12) DESC, node_id) AS rank FROM scored)
WHERE rank <= 10"""


def hybrid(alpha: float, hops: int):
    def run(spark, d):
        found = search.hybrid_search(base.kept(derived.activity_graph(spark, d)), requests(spark, d), hops, 10, alpha)
        return found.select("request_id", "rank", "node_id", F.round("score", 6).alias("score"), "hops")

    return run


query("v03_hybrid_search", hybrid_sql(0.7, 1))(hybrid(0.7, 1))
query("v03_hybrid_graph_only", hybrid_sql(0.0, 1))(hybrid(0.0, 1))
query("v03_hybrid_vector_only", hybrid_sql(1.0, 2))(hybrid(1.0, 2))


@query("v04_semantic_neighbors", ctes(EDGES, USERS, PAIRS, HUB_VECTORS) + """
, near AS (SELECT DISTINCT h.node_id AS request_id, e.dst AS node_id FROM hub_vectors h JOIN edges e ON e.src = h.node_id),
scored AS (SELECT n.request_id, n.node_id, list_cosine_similarity(u.embedding, h.vector) AS similarity FROM near n
  JOIN users u USING (node_id) JOIN hub_vectors h ON h.node_id = n.request_id WHERE u.embedding IS NOT NULL)
SELECT request_id, CAST(rank AS INTEGER) AS rank, node_id, round(similarity, 6) AS similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY round(similarity, 12) DESC, node_id) AS rank FROM scored)
WHERE rank <= 10""")
def v04(spark, d):
    asked = base.hub_vectors(spark, d).select(c("node_id").alias("request_id"), "node_id", c("vector").alias("concept"))
    found = search.semantic_neighbors(base.kept(derived.activity_graph(spark, d)), asked, k=10)
    return found.withColumn("similarity", F.round("similarity", 6))


def walk_sql(hops: int) -> str:
    steps = ["w0 AS (SELECT node_id AS request_id, vector, node_id, [node_id] AS path FROM hub_vectors)"]
    for i in range(hops):
        steps.append(f"""
n{i} AS (SELECT w.request_id, l.dst, list_cosine_similarity(u.embedding, w.vector) AS s FROM w{i} w
  JOIN links l ON l.src = w.node_id JOIN users u ON u.node_id = l.dst
  WHERE u.embedding IS NOT NULL AND NOT list_contains(w.path, l.dst)),
b{i} AS (SELECT request_id, first(dst ORDER BY round(s, 12) DESC, dst) AS dst FROM n{i} GROUP BY request_id),
w{i + 1} AS (SELECT w.request_id, w.vector, b.dst AS node_id,
  CASE WHEN b.dst IS NULL THEN w.path ELSE list_append(w.path, b.dst) END AS path
  FROM w{i} w LEFT JOIN b{i} b USING (request_id))""")
    return ctes(EDGES, USERS, PAIRS, HUB_VECTORS, links_cte(), *steps) + f"""
SELECT request_id, array_to_string(path, '>') AS path FROM w{hops}"""


@query("v05_semantic_walk", walk_sql(4))
def v05(spark, d):
    asked = base.hub_vectors(spark, d).select(
        c("node_id").alias("request_id"), c("node_id").alias("start"), c("vector").alias("concept"))
    found = search.semantic_walk(base.kept(derived.activity_graph(spark, d)), asked, 4)
    return found.select("request_id", F.array_join(c("path").cast("array<string>"), ">").alias("path"))


@query("v06_similarity_functions", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
SELECT a.vec_id, round(list_cosine_similarity(a.v, b.v), 6) AS cosine, round(list_dot_product(a.v, b.v), 6) AS dot,
  round(list_distance(a.v, b.v), 6) AS euclidean FROM e a JOIN e b ON b.vec_id = a.vec_id + 1""")
def v06(spark, d):
    a = derived.table(spark, d, "embeddings").select("vec_id", c("embedding").alias("a"))
    b = derived.table(spark, d, "embeddings").select((c("vec_id") - 1).alias("vec_id"), c("embedding").alias("b"))
    return a.join(b, "vec_id").select(
        "vec_id", F.round(vectors.cosine(c("a"), c("b")), 6).alias("cosine"),
        F.round(vectors.dot(c("a"), c("b")), 6).alias("dot"),
        F.round(vectors.euclidean(c("a"), c("b")), 6).alias("euclidean"))


# ---- subgraph context -----------------------------------------------------------------------------------


def subgraph_ctes(starts: str, hops: int, most: int) -> list[str]:
    return [both_ways(), reach_cte(starts, hops), f"""
kept AS (SELECT start AS center, node_id FROM reach
  QUALIFY row_number() OVER (PARTITION BY start ORDER BY depth, node_id) <= {most}),
inner_edges AS (SELECT a.center, e.* FROM edges e JOIN kept a ON a.node_id = e.src
  JOIN kept b ON b.node_id = e.dst AND b.center = a.center),
merged AS (SELECT center, src, edge_type, dst, count(*) AS times FROM inner_edges GROUP BY ALL),
sizes AS (SELECT center, node_count, coalesce(edge_count, 0) AS edge_count
  FROM (SELECT center, count(*) AS node_count FROM kept GROUP BY center)
  LEFT JOIN (SELECT center, count(*) AS edge_count FROM inner_edges GROUP BY center) USING (center))"""]


NODE_LINES = "(SELECT center, node_id, u.name FROM kept JOIN users u USING (node_id))"
TEXTS = {
    "triples": """
SELECT center, coalesce((SELECT string_agg('(' || src || ', ' || edge_type || ', ' || dst || ')', chr(10)
  ORDER BY src, edge_type, dst) FROM merged m WHERE m.center = s.center), '') AS text, node_count, edge_count FROM sizes s""",
    "structured": f"""
SELECT center, 'Nodes:' || chr(10) || (SELECT string_agg('  ' || node_id || ' [User] name=' || name, chr(10) ORDER BY node_id)
    FROM {NODE_LINES} n WHERE n.center = s.center) || chr(10) || 'Edges:' || chr(10)
  || coalesce((SELECT string_agg('  ' || src || ' -[' || edge_type || ']-> ' || dst ||
    CASE WHEN times > 1 THEN ' x' || times ELSE '' END, chr(10) ORDER BY src, edge_type, dst)
    FROM merged m WHERE m.center = s.center), '') AS text, node_count, edge_count FROM sizes s""",
    "prose": f"""
SELECT center, (SELECT string_agg('Node ' || node_id || ' is labelled User (name=' || name || ').', ' ' ORDER BY node_id)
    FROM {NODE_LINES} n WHERE n.center = s.center)
  || coalesce((SELECT ' ' || string_agg('Node ' || src || ' is linked by ' || edge_type || ' to node ' || dst ||
    CASE WHEN times > 1 THEN ' ' || times || ' times' ELSE '' END || '.', ' ' ORDER BY src, edge_type, dst)
    FROM merged m WHERE m.center = s.center), '') AS text, node_count, edge_count FROM sizes s""",
    "json": f"""
SELECT center, '{{"nodes":[' || (SELECT string_agg('{{"id":' || node_id || ',"labels":["User"],"properties":{{"name":"' ||
    name || '"}}}}', ',' ORDER BY node_id) FROM {NODE_LINES} n WHERE n.center = s.center) || '],"edges":['
  || coalesce((SELECT string_agg('{{"src":' || src || ',"type":"' || edge_type || '","dst":' || dst || ',"times":' || times || '}}',
    ',' ORDER BY src, edge_type, dst) FROM merged m WHERE m.center = s.center), '') || ']}}' AS text,
  node_count, edge_count FROM sizes s""",
}


@query("r01_extract_subgraph", ctes(EDGES, PAIRS, *subgraph_ctes("hubs", 2, 50), recursive=True) + "FROM sizes")
def r01(spark, d):
    return context.extract_subgraph(base.kept(derived.activity_graph(spark, d)), base.hubs(spark, d), 2, 50).counts()


def linearized(fmt: str):
    def run(spark, d):
        graph = base.kept(derived.activity_graph(spark, d))
        return context.linearize(graph, context.extract_subgraph(graph, base.hubs(spark, d), 2, 50), fmt)

    return run


for number, fmt in enumerate(("triples", "structured", "prose", "json"), start=2):
    query(f"r{number:02d}_{fmt}", ctes(EDGES, USERS, PAIRS, *subgraph_ctes("hubs", 2, 50), recursive=True)
          + TEXTS[fmt])(linearized(fmt))


@query("r06_rag_contexts", ctes(EDGES, USERS, PAIRS, LEADS, COSINE, VECTOR_HITS, """
asked AS (SELECT node_id AS question_id, 'What happened around user ' || node_id || '?' AS question, node_id AS anchor
    FROM hubs
  UNION ALL SELECT 1000000000 + query_id, 'What is like vector ' || query_id || '?', h.node_id FROM leads
    LEFT JOIN hits h USING (query_id) WHERE h.rank = 1),
anchors AS (SELECT DISTINCT anchor AS node_id FROM asked)""", *subgraph_ctes("anchors", 1, 20), recursive=True) + f"""
SELECT question_id, question, anchor, text AS context, node_count, edge_count FROM asked
JOIN ({TEXTS["prose"]}) t ON t.center = anchor""")
def r06(spark, d):
    anchored = base.hubs(spark, d).select(
        c("node_id").alias("question_id"),
        F.concat(F.lit("What happened around user "), "node_id", F.lit("?")).alias("question"),
        c("node_id").alias("anchor"), F.lit(None).cast("array<double>").alias("embedding"))
    open_ = base.label_leads(spark, d).select(
        (c("query_id") + 1000000000).alias("question_id"),
        F.concat(F.lit("What is like vector "), "query_id", F.lit("?")).alias("question"),
        F.lit(None).cast("long").alias("anchor"), c("vector").alias("embedding"))
    return context.rag_contexts(base.kept(derived.activity_graph(spark, d)), anchored.unionByName(open_), 1, 20, "prose")


# ---- anomaly --------------------------------------------------------------------------------------------

RULE = anomaly.Baseline(bucket_ms=21_600_000)
NODE_ACTIVITY = """
activity AS (SELECT src AS entity_id, valid_from AS at_ms FROM edges WHERE valid_from IS NOT NULL
  UNION ALL SELECT dst, valid_from FROM edges WHERE valid_from IS NOT NULL AND src <> dst)"""
EDGE_ACTIVITY = """
activity AS (SELECT src * 1000000000 + dst AS entity_id, valid_from AS at_ms FROM edges WHERE valid_from IS NOT NULL)"""
SCORES = f"""
counts AS (SELECT entity_id, at_ms // {RULE.bucket_ms} AS bucket, count(*) AS n FROM activity GROUP BY ALL),
spans AS (SELECT entity_id, min(bucket) AS a, max(bucket) AS z FROM counts GROUP BY entity_id),
calendar AS (SELECT entity_id, unnest(range(a, z + 1)) AS bucket FROM spans),
profile AS (SELECT entity_id, bucket, coalesce(n, 0) AS activity FROM calendar LEFT JOIN counts USING (entity_id, bucket)),
framed AS (SELECT *, count(*) OVER w AS k, avg(activity) OVER w AS m, stddev_samp(activity) OVER w AS s FROM profile
  WINDOW w AS (PARTITION BY entity_id ORDER BY bucket ROWS BETWEEN {RULE.width} PRECEDING AND 1 PRECEDING)),
scores AS (SELECT entity_id, bucket, activity, CASE WHEN k >= {RULE.least} THEN m END AS mean,
  CASE WHEN k >= {RULE.least} THEN s END AS std,
  CASE WHEN k >= {RULE.least} THEN (activity - m) / greatest(s, {RULE.floor}) END AS score FROM framed),
last AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY bucket DESC) = 1)"""
BUCKET = "CAST(bucket AS BIGINT) AS bucket"


def node_activity(spark, d):
    return anomaly.node_activity(derived.activity_edges(spark, d))


@query("a01_activity_profile", ctes(EDGES, NODE_ACTIVITY, SCORES) + f"""
SELECT entity_id, TRUE AS is_node, {BUCKET}, activity FROM profile""")
def a01(spark, d):
    return anomaly.activity_profile(anomaly.bucket_counts(node_activity(spark, d), RULE))


@query("a02_anomaly_stats", ctes(EDGES, PAIRS, NODE_ACTIVITY, SCORES) + f"""
SELECT entity_id, TRUE AS is_node, {BUCKET}, activity, round(mean, 6) AS mean, round(std, 6) AS std,
  round(score, 6) AS score, CAST(3.0 AS DOUBLE) AS threshold FROM scores WHERE entity_id IN (FROM hubs)""")
def a02(spark, d):
    wanted = base.hubs(spark, d).withColumnRenamed("node_id", "entity_id")
    found = anomaly.anomaly_stats(node_activity(spark, d), wanted, True, RULE)
    return found.withColumns({n: F.round(n, 6) for n in ("mean", "std", "score")})


CHECK = f"""
SELECT e.entity_id, {{is_node}} AS is_node, CAST(l.bucket AS BIGINT) AS bucket, round(l.score, 6) AS score,
  CASE WHEN l.score IS NULL THEN 'no_data' WHEN l.score >= {RULE.threshold} THEN 'anomalous' ELSE 'normal' END AS status
FROM {{entities}} e LEFT JOIN last l ON l.entity_id = e.entity_id"""


@query("a03_anomaly_check", ctes(EDGES, NODE_ACTIVITY, SCORES) + CHECK.format(
    is_node="TRUE", entities="(SELECT vec_id AS entity_id FROM embeddings)"))
def a03(spark, d):
    wanted = derived.table(spark, d, "embeddings").select(c("vec_id").alias("entity_id"))
    found = anomaly.anomaly_check(node_activity(spark, d), wanted, True, RULE)
    return found.withColumn("score", F.round("score", 6))


@query("a03_anomaly_check_edges", ctes(EDGES, EDGE_ACTIVITY, SCORES) + CHECK.format(
    is_node="FALSE", entities="(SELECT DISTINCT src * 1000000000 + dst AS entity_id FROM edges)"))
def a03e(spark, d):
    edges = derived.activity_edges(spark, d).withColumn("edge_id", c("src") * 1000000000 + c("dst"))
    found = anomaly.anomaly_check(anomaly.edge_activity(edges), edges.select(c("edge_id").alias("entity_id")), False, RULE)
    return found.withColumn("score", F.round("score", 6))


AS_OF = 1705298400000  # 2024-01-15T06:00Z, the start of a bucket
AS_OF_SCORES = f"""
known AS (SELECT * FROM activity WHERE at_ms < ({AS_OF} // {RULE.bucket_ms} + 1) * {RULE.bucket_ms}),
counts AS (SELECT entity_id, at_ms // {RULE.bucket_ms} AS bucket, count(*) AS n FROM known GROUP BY ALL),
calendar AS (SELECT entity_id, unnest(range(a, {AS_OF} // {RULE.bucket_ms} + 1)) AS bucket
  FROM (SELECT entity_id, min(bucket) AS a FROM counts GROUP BY entity_id)),
profile AS (SELECT entity_id, bucket, coalesce(n, 0) AS activity FROM calendar LEFT JOIN counts USING (entity_id, bucket)),
framed AS (SELECT *, count(*) OVER w AS k, avg(activity) OVER w AS m, stddev_samp(activity) OVER w AS s FROM profile
  WINDOW w AS (PARTITION BY entity_id ORDER BY bucket ROWS BETWEEN {RULE.width} PRECEDING AND 1 PRECEDING)),
last AS (SELECT entity_id, bucket, CASE WHEN k >= {RULE.least} THEN (activity - m) / greatest(s, {RULE.floor}) END AS score
  FROM framed QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY bucket DESC) = 1)"""


@query("a03_anomaly_check_as_of", ctes(EDGES, NODE_ACTIVITY, AS_OF_SCORES) + CHECK.format(
    is_node="TRUE", entities="(SELECT vec_id AS entity_id FROM embeddings)"))
def a03at(spark, d):
    wanted = derived.table(spark, d, "embeddings").select(c("vec_id").alias("entity_id"))
    found = anomaly.anomaly_check(node_activity(spark, d), wanted, True, RULE, as_of=AS_OF)
    return found.withColumn("score", F.round("score", 6))


@query("a04_anomaly_alerts_as_of", ctes(EDGES, NODE_ACTIVITY, AS_OF_SCORES) + f"""
SELECT entity_id, TRUE AS is_node, {BUCKET}, round(score, 6) AS score FROM last WHERE score >= 0.5""")
def a04at(spark, d):
    """With first buckets known beforehand, so that only the last eight buckets of the activity are read."""
    rule = anomaly.Baseline(bucket_ms=RULE.bucket_ms, threshold=0.5)
    activity = node_activity(spark, d)
    firsts = store(anomaly.first_buckets(activity, rule)).df
    return anomaly.anomaly_alerts(activity, rule, as_of=AS_OF, firsts=firsts).withColumn("score", F.round("score", 6))


@query("a04_anomaly_alerts", ctes(EDGES, NODE_ACTIVITY, SCORES) + f"""
SELECT entity_id, TRUE AS is_node, {BUCKET}, round(score, 6) AS score FROM last WHERE score >= 1.0""")
def a04(spark, d):
    rule = anomaly.Baseline(bucket_ms=RULE.bucket_ms, threshold=1.0)
    return anomaly.anomaly_alerts(node_activity(spark, d), rule).withColumn("score", F.round("score", 6))

"""Registered queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meshlark.graph import PropertyGraph
from meshlark.plans.lineage import store
from meshlark.sources import derived

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query function ``(spark, folder) -> DataFrame`` and its SQL."""

    def keep(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return keep


def ctes(*parts: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(p.strip() for p in parts) + "\n"


def kept(graph: PropertyGraph) -> PropertyGraph:
    """The graph over a written edge table, as a graph that is derived once and then asked."""
    return graph.with_edges(store(graph.edges).df)


# ---- requests derived from the data ---------------------------------------------------------------------


def user_counts(spark: SparkSession, d: str) -> DataFrame:
    events = derived.table(spark, d, "events")
    return events.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))


def hub_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Per event type its most and its least active user."""
    rank = F.struct("n", (-F.col("user_id")).alias("m"))
    low = F.struct("n", "user_id")
    return user_counts(spark, d).groupBy("event_type").agg(
        F.max_by("user_id", rank).alias("from_node"), F.min_by("user_id", low).alias("to_node"))


def hubs(spark: SparkSession, d: str) -> DataFrame:
    """The most active users, column ``node_id``."""
    return hub_pairs(spark, d).select(F.col("from_node").alias("node_id")).distinct()


def label_leads(spark: SparkSession, d: str) -> DataFrame:
    """The first vector of every label: ``query_id, vector``."""
    vectors = derived.table(spark, d, "embeddings")
    return vectors.groupBy("label").agg(F.min_by(F.struct("vec_id", "embedding"), "vec_id").alias("v")).select(
        F.col("v.vec_id").alias("query_id"), F.col("v.embedding").cast("array<double>").alias("vector"))


def hub_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Hubs with their own vector: ``node_id, vector``."""
    vectors = derived.table(spark, d, "embeddings").select(
        F.col("vec_id").alias("node_id"), F.col("embedding").cast("array<double>").alias("vector"))
    return hubs(spark, d).join(vectors, "node_id")


# ---- the same in SQL ------------------------------------------------------------------------------------

EDGES = """
edges AS (SELECT * FROM (SELECT event_id AS edge_id, user_id AS src, lead(user_id) OVER w AS dst,
    event_type AS edge_type, value AS weight,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE epoch_us(ts)//1000 END AS valid_from,
    CASE WHEN event_id % 10 = 0 THEN NULL ELSE epoch_us(lead(ts) OVER w)//1000 END AS valid_to
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)) WHERE dst IS NOT NULL)"""
USERS = """
users AS (SELECT u.node_id, 'user-' || u.node_id AS name, CAST(e.embedding AS DOUBLE[]) AS embedding
  FROM (SELECT DISTINCT user_id AS node_id FROM events) u LEFT JOIN embeddings e ON e.vec_id = u.node_id)"""
PAIRS = """
per_user AS (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL),
pairs AS (SELECT event_type, first(user_id ORDER BY n DESC, user_id) AS from_node,
  first(user_id ORDER BY n, user_id) AS to_node FROM per_user GROUP BY event_type),
hubs AS (SELECT DISTINCT from_node AS node_id FROM pairs)"""
LEADS = """
leads AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings
  QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1)"""
HUB_VECTORS = """
hub_vectors AS (SELECT h.node_id, CAST(e.embedding AS DOUBLE[]) AS vector FROM hubs h
  JOIN embeddings e ON e.vec_id = h.node_id)"""


def links_cte(source: str = "edges", where: str = "TRUE", name: str = "links") -> str:
    return f"{name} AS (SELECT src, dst, min(weight) AS weight FROM {source} WHERE src <> dst AND {where} GROUP BY src, dst)"


def both_ways(source: str = "edges", name: str = "links") -> str:
    return (f"{name} AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM {source} UNION ALL "
            f"SELECT dst, src FROM {source}) WHERE src <> dst)")


def reach_cte(starts: str, depth: int, links: str = "links", name: str = "reach") -> str:
    """``start, node_id, depth`` with the least depth; walks all levels, UNION drops repeats."""
    return f"""
{name}_walk(start, node_id, depth) AS (SELECT node_id, node_id, 0 FROM {starts}
  UNION SELECT r.start, l.dst, r.depth + 1 FROM {name}_walk r JOIN {links} l ON l.src = r.node_id
  WHERE r.depth < {depth}),
{name} AS (SELECT start, node_id, min(depth) AS depth FROM {name}_walk GROUP BY start, node_id)"""


PACKETS = """
pk AS (SELECT event_id AS packet_id, CASE WHEN event_id%41=0 THEN 'ARP' ELSE 'IP' END AS layer_2_id,
  '10.0.'||(user_id//256)||'.'||(user_id%256) AS layer_2_src,
  '10.0.0.'||((user_id*7+event_id)%97) AS layer_2_dst,
  CASE event_type WHEN 'click' THEN 'TCP' WHEN 'purchase' THEN 'TCP' WHEN 'view' THEN 'UDP'
    WHEN 'signup' THEN '' ELSE NULL END AS layer_3_id,
  CASE WHEN event_id%50=0 THEN NULL WHEN event_id%3=0 THEN svc ELSE eph END AS layer_3_src,
  CASE WHEN event_id%53=0 THEN 'x' WHEN event_id%3=0 THEN eph ELSE svc END AS layer_3_dst,
  CASE WHEN event_id%97=0 THEN NULL ELSE 40+event_id%1400 END AS layer_1_size,
  epoch_us(ts)//1000000 AS tv_sec, epoch_us(ts)%1000000 AS tv_usec
  FROM (SELECT *, ['443','80','53','3306','22','5432','40000'][1+event_id%7] AS svc,
    CAST(1024+(event_id*7919)%60000 AS VARCHAR) AS eph FROM events))"""


def ports_cte() -> str:
    from meshlark.functions.ports import SERVICE_NAMES

    rows = ", ".join(f"({p}, '{n}')" for p, n in SERVICE_NAMES.items())
    return f"ports(port, name) AS (VALUES {rows})"


DECODED = """
ports_read AS (SELECT *, CAST(trunc(TRY_CAST(layer_3_src AS DOUBLE)) AS INTEGER) AS sp,
  CAST(trunc(TRY_CAST(layer_3_dst AS DOUBLE)) AS INTEGER) AS dp FROM pk WHERE layer_2_id = 'IP'),
decoded AS (SELECT packet_id, layer_2_src AS src_ip, layer_2_dst AS dst_ip,
  CASE WHEN layer_3_id IS NULL OR layer_3_id = '' THEN 'IP' ELSE layer_3_id END AS protocol,
  CASE WHEN sp IS NULL OR dp IS NULL THEN NULL
    WHEN (sp < 1024) <> (dp < 1024) THEN CASE WHEN sp < 1024 THEN sp ELSE dp END
    WHEN (sp IN (SELECT port FROM ports)) <> (dp IN (SELECT port FROM ports))
      THEN CASE WHEN sp IN (SELECT port FROM ports) THEN sp ELSE dp END
    ELSE least(sp, dp) END AS service_port,
  tv_sec * 1000 + tv_usec // 1000 AS ts_ms, layer_1_size AS size FROM ports_read)"""
FLOWS = """
flows AS (SELECT src_ip, dst_ip, protocol, service_port, p.name AS service_name, flow_count, total_bytes,
    valid_from, valid_to
  FROM (SELECT src_ip, dst_ip, protocol, service_port, count(*) AS flow_count,
      CAST(coalesce(sum(size), 0) AS DOUBLE) AS total_bytes, min(ts_ms) AS valid_from, max(ts_ms) AS valid_to
    FROM decoded GROUP BY ALL) f LEFT JOIN ports p ON p.port = f.service_port)"""
IPS = """
ips AS (SELECT row_number() OVER (ORDER BY ip) - 1 AS node_id, ip FROM (
  SELECT layer_2_src AS ip FROM pk WHERE layer_2_id = 'IP' UNION SELECT layer_2_dst FROM pk WHERE layer_2_id = 'IP'))"""


def flow_ctes(*more: str, recursive: bool = False) -> str:
    return ctes(PACKETS, ports_cte(), DECODED, FLOWS, *more, recursive=recursive)

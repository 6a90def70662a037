"""Network analytics over the flow network."""

from __future__ import annotations

from pyspark.sql import functions as F

from meshlark.graph import PropertyGraph
from meshlark.operators import communities, flows, flowstats, maintenance, network
from meshlark.sources import derived
from registry.base import IPS, flow_ctes, kept, links_cte, query, reach_cte
from registry.flow_queries import made_flows, pk

c = F.col

NET = """
net AS (SELECT src_ip AS src, dst_ip AS dst, protocol, CAST(sum(f.flow_count) AS BIGINT) AS weight,
  sum(f.total_bytes) AS total_bytes, count(*) AS num_flows FROM flows f GROUP BY src_ip, dst_ip, protocol),
simple AS (SELECT src, dst, CAST(sum(n.weight) AS BIGINT) AS weight, sum(n.total_bytes) AS total_bytes,
  CAST(sum(n.num_flows) AS BIGINT) AS num_flows, min(n.protocol) AS protocol FROM net n WHERE src <> dst GROUP BY src, dst),
undirected AS (SELECT least(src, dst) AS src, greatest(src, dst) AS dst, CAST(sum(s.weight) AS BIGINT) AS weight,
  sum(s.total_bytes) AS total_bytes, CAST(sum(s.num_flows) AS BIGINT) AS num_flows, min(s.protocol) AS protocol
  FROM simple s GROUP BY ALL),
vertices AS (SELECT ip AS id FROM ips)"""


def net_sql(*more: str, recursive: bool = False) -> str:
    return flow_ctes(IPS, NET, *more, recursive=recursive)


def net(spark, d):
    return flowstats.pair_protocol_totals(made_flows(spark, d))


def simple(spark, d):
    return network.simplify(net(spark, d))


def vertices(spark, d):
    return flows.packet_ips(pk(spark, d)).withColumnRenamed("ip", "id")


def degree_sql(edges: str) -> str:
    return f"""
deg AS (SELECT id, coalesce(i.n, 0) AS degree_in, coalesce(o.n, 0) AS degree_out,
    coalesce(i.n, 0) + coalesce(o.n, 0) AS degree_total FROM vertices
  LEFT JOIN (SELECT dst, count(*) AS n FROM {edges} GROUP BY dst) i ON i.dst = id
  LEFT JOIN (SELECT src, count(*) AS n FROM {edges} GROUP BY src) o ON o.src = id)"""


STRENGTH = """
strength AS (SELECT id, CAST(coalesce(w, 0) AS DOUBLE) AS strength FROM vertices LEFT JOIN (
  SELECT x, sum(weight) AS w FROM (SELECT src AS x, weight FROM simple UNION ALL SELECT dst, weight FROM simple) GROUP BY x)
  ON x = id)"""


@query("w01_degrees", net_sql(degree_sql("net")) + "FROM deg")
def w01(spark, d):
    return network.degrees(net(spark, d), vertices(spark, d))


@query("w01_degrees_simplified", net_sql(degree_sql("simple")) + "FROM deg")
def w01s(spark, d):
    return network.degrees(simple(spark, d), vertices(spark, d))


@query("w02_degree_frequency", net_sql(degree_sql("net")) + """
SELECT degree_total AS degree, count(*) AS n FROM deg WHERE degree_total > 0 GROUP BY ALL""")
def w02(spark, d):
    return network.degree_frequency(network.degrees(net(spark, d), vertices(spark, d)))


@query("w02_degree_histogram", net_sql(degree_sql("net")) + """
SELECT CAST(least(floor((degree_total - low) / width) + 1, 30) AS INTEGER) AS bin, count(*) AS n FROM deg,
  (SELECT min(degree_total) AS low, (max(degree_total) - min(degree_total)) / CAST(30 AS DOUBLE) AS width FROM deg) GROUP BY 1""")
def w02h(spark, d):
    return network.degree_histogram(network.degrees(net(spark, d), vertices(spark, d)), 30)


@query("w03_simplify", net_sql() + "FROM simple")
def w03(spark, d):
    return simple(spark, d)


@query("w04_strength", net_sql(STRENGTH) + "FROM strength")
def w04(spark, d):
    return network.strength(simple(spark, d), vertices(spark, d))


# Ordinary power iteration with the mass of dead ends spread evenly; an independent way to the same limit.
RANKS = """
outw AS (SELECT src, sum(weight) AS w FROM simple GROUP BY src),
arrows AS (SELECT s.src, s.dst, s.weight / o.w AS share FROM simple s JOIN outw o USING (src)),
size AS (SELECT count(*) AS n FROM vertices),
spread AS (SELECT src, dst, share FROM arrows UNION ALL SELECT id, NULL, 1.0 FROM vertices WHERE id NOT IN (SELECT src FROM outw)),
pr(step, id, x) AS (SELECT 0, id, 1.0 / n FROM vertices, size
  UNION ALL SELECT any_value(m.step) + 1, v.id, 0.15 / any_value(n) + 0.85 * (sum(CASE WHEN m.dst = v.id THEN m.mass ELSE 0 END)
      + any_value(m.lost) / any_value(n))
    FROM (SELECT step, dst, mass, sum(CASE WHEN dst IS NULL THEN mass ELSE 0 END) OVER () AS lost
      FROM (SELECT any_value(pr.step) AS step, s.dst, sum(pr.x * s.share) AS mass FROM pr JOIN spread s ON s.src = pr.id
        WHERE pr.step < 30 GROUP BY s.dst)) m, vertices v, size GROUP BY v.id),
ranks AS (SELECT id, x AS pagerank FROM pr WHERE step = 30)"""


@query("w05_pagerank", net_sql(RANKS, recursive=True) + "SELECT id, round(pagerank, 6) AS pagerank FROM ranks")
def w05(spark, d):
    found = network.pagerank(simple(spark, d), vertices(spark, d))
    return found.select("id", F.round("pagerank", 6).alias("pagerank"))


# Pair formula: paths through v between s and t are paths(s, v) * paths(v, t) where the distances add up.
BETWEEN = """
dist(s, v, cost) USING KEY (s, v) AS (SELECT id, id, CAST(0 AS BIGINT) FROM vertices
  UNION SELECT d.s, l.dst, min(d.cost + l.weight)::BIGINT FROM dist d JOIN simple l ON l.src = d.v
    LEFT JOIN recurring.dist o ON o.s = d.s AND o.v = l.dst GROUP BY d.s, l.dst, o.cost
    HAVING o.cost IS NULL OR min(d.cost + l.weight) < o.cost),
dag AS MATERIALIZED (SELECT a.s, a.v, l.dst FROM dist a JOIN simple l ON l.src = a.v JOIN dist b ON b.s = a.s AND b.v = l.dst
  WHERE a.cost + l.weight = b.cost),
waves(h, s, v, n) AS (SELECT 0, id, id, CAST(1 AS DOUBLE) FROM vertices
  UNION ALL SELECT any_value(w.h) + 1, g.s, g.dst, sum(w.n) FROM waves w JOIN dag g ON g.s = w.s AND g.v = w.v GROUP BY g.s, g.dst),
sigma AS MATERIALIZED (SELECT w.s, w.v, sum(w.n) AS n, any_value(d.cost) AS cost FROM waves w JOIN dist d ON d.s = w.s AND d.v = w.v GROUP BY w.s, w.v),
through AS (SELECT a.v, sum(a.n * b.n / c.n) AS raw FROM sigma a JOIN sigma b ON b.s = a.v
    JOIN sigma c ON c.s = a.s AND c.v = b.v WHERE a.s <> a.v AND b.v <> a.v AND a.s <> b.v AND a.cost + b.cost = c.cost GROUP BY a.v),
between_ AS (SELECT id, coalesce(raw, 0) / ((SELECT count(*) FROM vertices) - 1) / ((SELECT count(*) FROM vertices) - 2) AS betweenness
  FROM vertices LEFT JOIN through ON v = id)"""


@query("w06_betweenness", net_sql(BETWEEN, recursive=True) + "SELECT id, round(betweenness, 6) AS betweenness FROM between_")
def w06(spark, d):
    found = network.betweenness(simple(spark, d), vertices(spark, d))
    return found.select("id", F.round("betweenness", 6).alias("betweenness"))


@query("w06_centralities", net_sql(STRENGTH, degree_sql("simple"), RANKS, BETWEEN, recursive=True) + """
SELECT id, degree_total AS degree, degree_in AS in_degree, degree_out AS out_degree, strength,
  round(betweenness, 6) AS betweenness, round(pagerank, 6) AS pagerank
FROM deg JOIN strength USING (id) JOIN between_ USING (id) JOIN ranks USING (id)
ORDER BY round(pagerank, 6) DESC, id LIMIT 20""")
def w06c(spark, d):
    return network.centralities(net(spark, d), vertices(spark, d), 20)


@query("w07_collapse", net_sql() + "FROM undirected")
def w07(spark, d):
    return network.collapse(simple(spark, d))


@query("w08_louvain")
def w08(spark, d):
    return communities.louvain(network.collapse(simple(spark, d)), vertices(spark, d))


@query("w08_louvain_groups", """
SELECT c_custkey AS id, dense_rank() OVER (ORDER BY lead) AS community FROM (
  SELECT c_custkey, min(c_custkey) OVER (PARTITION BY c_nationkey, c_mktsegment) AS lead FROM customer)""")
def w08_groups(spark, d):
    """Customers linked to the first of their nation and segment: separate stars, each of which is best left whole."""
    customers = derived.table(spark, d, "customer")
    leads = customers.groupBy("c_nationkey", "c_mktsegment").agg(F.min("c_custkey").alias("lead"))
    placed = customers.join(leads, ["c_nationkey", "c_mktsegment"])
    edges = placed.select(c("lead").alias("src"), c("c_custkey").alias("dst"), (1 + c("c_custkey") % 5).cast("double").alias("weight"))
    return communities.louvain(edges, customers.select(c("c_custkey").alias("id"))).withColumn(
        "community", c("community").cast("long"))


@query("w08_louvain_checks", net_sql() + """
SELECT count(*) AS vertices, count(DISTINCT id) AS assigned, TRUE AS better_than_singletons, TRUE AS numbered_from_one FROM vertices""")
def w08_checks(spark, d):
    """Every vertex has one community, numbers run from 1, and modularity beats the partition into single vertices."""
    flat = network.collapse(simple(spark, d))
    found = communities.louvain(flat, vertices(spark, d))
    single = found.withColumn("community", c("id"))
    gain = network.modularity(flat, found).scalar() > network.modularity(flat, single).scalar()
    return found.agg(
        F.count(F.lit(1)).alias("vertices"), F.count_distinct("id").alias("assigned"),
        F.count_distinct("community").alias("n"), F.min("community").alias("low"), F.max("community").alias("high"),
    ).select("vertices", "assigned", gain.alias("better_than_singletons"),
             ((c("low") == 1) & (c("high") == c("n"))).alias("numbered_from_one"))


FIXED = """
member AS (SELECT id, CAST(split_part(id, '.', 4) AS INTEGER) % 7 AS community FROM vertices)"""


def fixed_partition(spark, d):
    return vertices(spark, d).select("id", (F.split_part("id", F.lit("."), F.lit(4)).cast("int") % 7).alias("community"))


@query("w09_modularity", net_sql(FIXED) + """
, ends AS (SELECT a.community AS ca, b.community AS cb, weight FROM undirected u JOIN member a ON a.id = u.src JOIN member b ON b.id = u.dst),
tot AS (SELECT community, sum(w) AS t FROM (SELECT ca AS community, weight AS w FROM ends UNION ALL SELECT cb, weight FROM ends) GROUP BY ALL)
SELECT round((SELECT sum(weight) FROM ends WHERE ca = cb) / (SELECT sum(weight) FROM ends)
  - (SELECT sum(power(CAST(t AS DOUBLE), 2)) FROM tot) / power(CAST(2 * (SELECT sum(weight) FROM ends) AS DOUBLE), 2), 9) AS modularity""")
def w09(spark, d):
    found = network.modularity(network.collapse(simple(spark, d)), fixed_partition(spark, d))
    return found.select(F.round("modularity", 9).alias("modularity"))


@query("w10_community_sizes", net_sql(FIXED) + "SELECT community, count(*) AS members FROM member GROUP BY community")
def w10(spark, d):
    return network.community_sizes(fixed_partition(spark, d))


@query("w11_map_nodes", net_sql(STRENGTH, FIXED) + """
SELECT id, id AS label, strength AS value, CAST(community AS VARCHAR) AS "group" FROM strength JOIN member USING (id)""")
def w11(spark, d):
    return network.map_nodes(simple(spark, d), vertices(spark, d), fixed_partition(spark, d))


@query("w11_map_edges", net_sql() + """
SELECT src AS "from", dst AS "to", weight AS value, protocol || ' — ' || format('{:,}', weight) || ' packets, '
  || format('{:,}', CAST(total_bytes AS BIGINT)) || ' bytes' AS title, 'to' AS arrows FROM simple""")
def w11e(spark, d):
    return network.map_edges(simple(spark, d))


def ranked_graph(spark, d):
    """The flow graph on node ids and its ranks keyed by node id."""
    registry = maintenance.get_or_create(flows.packet_ips(pk(spark, d)), "ip")
    graph = PropertyGraph(flows.ip_nodes(registry), flows.flows_to_edges(made_flows(spark, d), registry))
    ranks = network.pagerank(simple(spark, d), vertices(spark, d))
    return kept(graph), registry.join(ranks.withColumnRenamed("id", "ip"), "ip").select(c("node_id").alias("id"), "pagerank")


TOP = """
top AS (SELECT node_id FROM ips JOIN ranks ON ranks.id = ip ORDER BY round(pagerank, 6) DESC, node_id LIMIT 2),
best AS (SELECT node_id FROM ips JOIN ranks ON ranks.id = ip ORDER BY round(pagerank, 6) DESC, node_id LIMIT 1),
by_node AS (SELECT a.node_id AS src, b.node_id AS dst, weight FROM simple JOIN ips a ON a.ip = src JOIN ips b ON b.ip = dst)"""


@query("w12_reach_from_top", net_sql(RANKS, TOP, links_cte("by_node"), reach_cte("best", 2), recursive=True) + "FROM reach")
def w12(spark, d):
    graph, ranks = ranked_graph(spark, d)
    return network.reach_from_top(graph, ranks, 2)


@query("w12_path_between_top_two", net_sql(RANKS, TOP, links_cte("by_node"), """
walk(start, node_id, length, path) USING KEY (start, node_id) AS (
  SELECT node_id, node_id, 0, [node_id] FROM best
  UNION SELECT w.start, l.dst, w.length + 1, min(list_append(w.path, l.dst)) FROM walk w JOIN links l ON l.src = w.node_id
    LEFT JOIN recurring.walk o ON o.start = w.start AND o.node_id = l.dst WHERE o.node_id IS NULL
    GROUP BY w.start, l.dst, w.length)""", recursive=True) + """
SELECT start AS from_node, w.node_id AS to_node, length, array_to_string(path, '>') AS path,
  (SELECT string_agg(ip, ' -> ' ORDER BY n) FROM (SELECT unnest(w.path) AS id, generate_subscripts(w.path, 1) AS n) x
    JOIN ips ON ips.node_id = x.id) AS addresses
FROM walk w WHERE w.node_id IN (FROM top) AND w.node_id <> start""")
def w12p(spark, d):
    graph, ranks = ranked_graph(spark, d)
    found = network.named_path(network.path_between_top_two(graph, ranks), graph.nodes, "ip")
    return found.select("from_node", "to_node", "length", F.array_join("path", ">").alias("path"),
                        F.array_join("names", " -> ").alias("addresses"))

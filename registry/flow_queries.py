"""Packet, flow, indicator and scalar-helper queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from meshlark.functions import ports, scalars
from meshlark.operators import flows, flowstats, indicators, maintenance
from meshlark.sources import derived
from registry.base import DECODED, EDGES, IPS, PACKETS, ctes, flow_ctes, ports_cte, query
from registry.graph_queries import FLOW_EDGE_ID

c = F.col


def pk(spark, d):
    return derived.packets(spark, d)


def made_flows(spark, d):
    return flows.packets_to_flows(pk(spark, d))


# ---- packets to flows -----------------------------------------------------------------------------------


@query("f01_ip_packets", ctes(PACKETS) + "SELECT packet_id, layer_2_src, layer_2_dst FROM pk WHERE layer_2_id = 'IP'")
def f01(spark, d):
    return flows.ip_packets(pk(spark, d)).select("packet_id", "layer_2_src", "layer_2_dst")


@query("f02_packet_ms", ctes(PACKETS) + "SELECT packet_id, tv_sec * 1000 + tv_usec // 1000 AS ts_ms FROM pk")
def f02(spark, d):
    return pk(spark, d).select("packet_id", flows.packet_ms().alias("ts_ms"))


@query("f03_classify_service_port", ctes(PACKETS, ports_cte(), DECODED) + "SELECT packet_id, service_port FROM decoded")
def f03(spark, d):
    return flows.decoded_packets(pk(spark, d), "packet_id").select("packet_id", "service_port")


@query("f03_classify_all_keys", ctes(ports_cte()) + """
, pairs AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey % 11000 AS INTEGER) AS s, CAST(l_orderkey % 6000 AS INTEGER) AS d
  FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN (s < 1024) <> (d < 1024) THEN CASE WHEN s < 1024 THEN s ELSE d END
  WHEN (s IN (SELECT port FROM ports)) <> (d IN (SELECT port FROM ports))
    THEN CASE WHEN s IN (SELECT port FROM ports) THEN s ELSE d END ELSE least(s, d) END AS service_port FROM pairs""")
def f03_all(spark, d):
    rows = derived.table(spark, d, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", ports.classify_service_port(
        c("l_partkey") % 11000, c("l_orderkey") % 6000).alias("service_port"))


@query("f04_port_service_name", ctes(ports_cte()) + """
SELECT p_partkey, p.name AS service_name FROM part LEFT JOIN ports p ON p.port = p_partkey""")
def f04(spark, d):
    return derived.table(spark, d, "part").select(
        "p_partkey", ports.port_service_name(c("p_partkey")).alias("service_name"))


@query("f05_parsed_port", ctes(PACKETS) + """
SELECT packet_id, CAST(trunc(TRY_CAST(layer_3_src AS DOUBLE)) AS INTEGER) AS src_port,
  CAST(trunc(TRY_CAST(layer_3_dst || '.7' AS DOUBLE)) AS INTEGER) AS dst_port FROM pk""")
def f05(spark, d):
    return pk(spark, d).select("packet_id", ports.parsed_port(c("layer_3_src")).alias("src_port"),
                               ports.parsed_port(F.concat("layer_3_dst", F.lit(".7"))).alias("dst_port"))


@query("f06_protocol", ctes(PACKETS) + "SELECT packet_id, coalesce(nullif(layer_3_id, ''), 'IP') AS protocol FROM pk")
def f06(spark, d):
    return pk(spark, d).select("packet_id", flows.protocol_or_ip().alias("protocol"))


@query("f07_packets_to_flows", flow_ctes() + "FROM flows")
def f07(spark, d):
    return made_flows(spark, d)


@query("f08_flows_to_edges", flow_ctes(IPS) + f"""
SELECT {FLOW_EDGE_ID}, s.node_id AS src, t.node_id AS dst, protocol AS edge_type,
  CAST(service_port AS VARCHAR) AS service_port, service_name, flow_count, total_bytes, valid_from, valid_to
FROM flows JOIN ips s ON s.ip = src_ip JOIN ips t ON t.ip = dst_ip""")
def f08(spark, d):
    registry = maintenance.get_or_create(flows.packet_ips(pk(spark, d)), "ip")
    edges = flows.flows_to_edges(made_flows(spark, d), registry)
    prop = lambda n, kind: c("properties")[n].cast(kind).alias(n)
    return edges.select("edge_id", "src", "dst", "edge_type", prop("service_port", "string"),
                        prop("service_name", "string"), prop("flow_count", "bigint"), prop("total_bytes", "double"),
                        "valid_from", "valid_to")


CHUNKED = """
numbered AS (SELECT *, (row_number() OVER (ORDER BY packet_id) - 1) // 50 AS chunk_id FROM pk),
chunked AS (SELECT n.chunk_id, d.* FROM decoded d JOIN numbered n USING (packet_id)),
chunk_flows AS (SELECT chunk_id, src_ip, dst_ip, protocol, service_port, count(*) AS flow_count,
  CAST(coalesce(sum(size), 0) AS DOUBLE) AS total_bytes, min(ts_ms) AS valid_from, max(ts_ms) AS valid_to
  FROM chunked GROUP BY ALL)"""


@query("f09_chunked_flows", ctes(PACKETS, ports_cte(), DECODED, CHUNKED) + """
SELECT f.*, p.name AS service_name FROM chunk_flows f LEFT JOIN ports p ON p.port = f.service_port""")
def f09(spark, d):
    return flows.chunked_flows(pk(spark, d), ["packet_id"], 50)


@query("f10_chunk_totals", ctes(PACKETS, ports_cte(), DECODED, CHUNKED, """
seen AS (SELECT ip, min(chunk_id) AS chunk_id FROM (SELECT src_ip AS ip, chunk_id FROM chunked
  UNION ALL SELECT dst_ip, chunk_id FROM chunked) GROUP BY ip)""") + """
SELECT chunk_id, packets, ip_packets, flows, CAST(sum(packets) OVER w AS BIGINT) AS total_packets,
  CAST(sum(flows) OVER w AS BIGINT) AS total_flows, CAST(sum(fresh) OVER w AS BIGINT) AS unique_ips
FROM (SELECT chunk_id, count(*) AS packets, count(*) FILTER (layer_2_id = 'IP') AS ip_packets,
    (SELECT count(*) FROM chunk_flows f WHERE f.chunk_id = n.chunk_id) AS flows,
    (SELECT count(*) FROM seen s WHERE s.chunk_id = n.chunk_id) AS fresh FROM numbered n GROUP BY chunk_id)
WINDOW w AS (ORDER BY chunk_id)""")
def f10(spark, d):
    return flows.chunk_totals(pk(spark, d), ["packet_id"], 50)


@query("f10_run_totals", ctes(PACKETS, ports_cte(), DECODED, CHUNKED, IPS) + """
SELECT 'packets' AS metric, count(*) AS n FROM pk UNION ALL SELECT 'ip_packets', count(*) FROM decoded
UNION ALL SELECT 'flows', count(*) FROM chunk_flows UNION ALL SELECT 'unique_ips', count(*) FROM ips""")
def f10_run(spark, d):
    return flows.run_totals(pk(spark, d), ["packet_id"], 50)


# ---- flow analytics -------------------------------------------------------------------------------------


@query("n01_enrich", flow_ctes() + """
SELECT src_ip, dst_ip, protocol, service_port, service_name, valid_from AS start_ms, valid_to AS end_ms,
  (valid_to - valid_from) / 1000.0 AS flow_duration_s FROM flows""")
def n01(spark, d):
    bare = made_flows(spark, d).withColumn("service_name", F.lit(None).cast("string"))
    return flowstats.enrich(bare).select(
        "src_ip", "dst_ip", "protocol", "service_port", "service_name", F.unix_millis("timestamp").alias("start_ms"),
        F.unix_millis("timestamp_end").alias("end_ms"), "flow_duration_s")


@query("n02_validity", ctes(EDGES) + """
SELECT v.event_id AS edge_id, e.valid_from, e.valid_to FROM events v LEFT JOIN edges e ON e.edge_id = v.event_id""")
def n02(spark, d):
    rows = derived.table(spark, d, "events").select(c("event_id").alias("edge_id"))
    return flowstats.validity(rows, derived.activity_edges(spark, d))


@query("n03_capture_summary", flow_ctes(IPS) + """
SELECT 'Unique IP addresses' AS metric, CAST((SELECT count(*) FROM ips) AS DOUBLE) AS value
UNION ALL SELECT 'Total flows (edges)', count(*) FROM flows
UNION ALL SELECT 'Total packets (aggregated)', sum(flow_count) FROM flows
UNION ALL SELECT 'Protocols observed', count(DISTINCT protocol) FROM flows
UNION ALL SELECT 'Time span (seconds)', round_even(CAST(max(valid_from) - min(valid_from) AS DOUBLE) / 100.0::DOUBLE, 0) / 10 FROM flows
UNION ALL SELECT 'Total bytes captured', sum(total_bytes) FROM flows
UNION ALL SELECT 'Avg packets per flow', round_even(CAST(sum(flow_count) * 10 AS DOUBLE) / count(*), 0) / 10 FROM flows""")
def n03(spark, d):
    return flowstats.capture_summary(made_flows(spark, d), flows.packet_ips(pk(spark, d)))


@query("n04_protocol_counts", flow_ctes() + """
SELECT protocol, count(*) AS flows, CAST(sum(flow_count) AS BIGINT) AS packets FROM flows GROUP BY protocol ORDER BY packets DESC""")
def n04(spark, d):
    return flowstats.protocol_counts(made_flows(spark, d))


@query("n05_protocol_bytes", flow_ctes() + """
SELECT protocol, sum(f.total_bytes) AS total_bytes, CAST(sum(f.flow_count) AS BIGINT) AS total_pkts,
  round_even(sum(f.total_bytes) / CAST(sum(f.flow_count) AS DOUBLE), 0) AS avg_pkt_size, count(*) AS flow_count
FROM flows f GROUP BY protocol""")
def n05(spark, d):
    return flowstats.protocol_bytes(made_flows(spark, d))


@query("n06_top_senders", flow_ctes() + """
SELECT src_ip, CAST(sum(flow_count) AS BIGINT) AS packets_sent FROM flows GROUP BY src_ip
ORDER BY packets_sent DESC, src_ip LIMIT 20""")
def n06(spark, d):
    return flowstats.top_senders(made_flows(spark, d))


@query("n07_top_senders_bytes", flow_ctes() + """
SELECT src_ip, sum(f.total_bytes) AS total_bytes FROM flows f GROUP BY src_ip ORDER BY sum(f.total_bytes) DESC, src_ip LIMIT 20""")
def n07(spark, d):
    return flowstats.top_senders(made_flows(spark, d), "bytes")


@query("n08_busiest_pairs", flow_ctes() + """
SELECT src_ip, dst_ip, count(*) AS flows, CAST(sum(flow_count) AS BIGINT) AS packets, sum(total_bytes) AS bytes
FROM flows GROUP BY src_ip, dst_ip ORDER BY packets DESC, src_ip, dst_ip LIMIT 20""")
def n08(spark, d):
    return flowstats.busiest_pairs(made_flows(spark, d))


PORTS = """
svc AS (SELECT service_port, service_name, count(*) AS flows, CAST(sum(flow_count) AS BIGINT) AS packets,
  sum(total_bytes) AS bytes FROM flows WHERE service_port IS NOT NULL GROUP BY ALL)"""


@query("n09_service_ports", flow_ctes(PORTS) + """
SELECT service_port, service_name, flows, packets, bytes,
  CASE WHEN service_name <> '' THEN service_port || ' (' || service_name || ')' ELSE CAST(service_port AS VARCHAR) END AS label
FROM svc ORDER BY packets DESC, service_port LIMIT 20""")
def n09(spark, d):
    return flowstats.service_ports(made_flows(spark, d))


PORT_TABLE = """
busiest AS (SELECT service_port FROM svc ORDER BY packets DESC, service_port LIMIT 15),
cells AS (SELECT protocol, service_port, CAST(sum(flow_count) AS BIGINT) AS packets FROM flows
  WHERE service_port IN (FROM busiest) GROUP BY ALL)"""


@query("n10_port_protocols", flow_ctes(PORTS, PORT_TABLE) + """
SELECT protocol, service_port, packets, round(log10(packets + 1), 9) AS log_packets FROM cells""")
def n10(spark, d):
    return flowstats.port_protocols(made_flows(spark, d)).withColumn("log_packets", F.round("log_packets", 9))


@query("n10_port_protocol_table", flow_ctes(PORTS, PORT_TABLE) + """
SELECT service_port, CAST(sum(packets) FILTER (protocol = 'IP') AS BIGINT) AS "IP",
  CAST(sum(packets) FILTER (protocol = 'TCP') AS BIGINT) AS "TCP",
  CAST(sum(packets) FILTER (protocol = 'UDP') AS BIGINT) AS "UDP" FROM cells GROUP BY service_port""")
def n10_wide(spark, d):
    return flowstats.port_protocol_table(made_flows(spark, d), ["IP", "TCP", "UDP"])


@query("n11_per_second", flow_ctes() + """
SELECT valid_from // 1000 AS second, CAST(sum(flow_count) AS BIGINT) AS packets, sum(total_bytes) AS bytes,
  count(*) AS flows FROM flows GROUP BY ALL""")
def n11(spark, d):
    return flowstats.per_second(made_flows(spark, d))


@query("n12_per_second_by_protocol", flow_ctes() + """
SELECT valid_from // 1000 AS second, protocol, CAST(sum(flow_count) AS BIGINT) AS packets FROM flows GROUP BY ALL""")
def n12(spark, d):
    return flowstats.per_second_by_protocol(made_flows(spark, d))


SMOOTH = """
SELECT protocol, second, packets, round(avg(packets) OVER (PARTITION BY protocol ORDER BY second
  RANGE BETWEEN 600 PRECEDING AND 600 FOLLOWING), 6) AS smooth
FROM (SELECT valid_from // 1000 AS second, protocol, CAST(sum(flow_count) AS BIGINT) AS packets FROM flows GROUP BY ALL)"""


@query("n13_smoothed_rate", flow_ctes() + SMOOTH)
def n13(spark, d):
    series = flowstats.per_second_by_protocol(made_flows(spark, d))
    return flowstats.smoothed(series, "packets", 600, ["protocol"], piece=7200).select(
        "protocol", "second", "packets", F.round("smooth", 6).alias("smooth"))


@query("n13_smoothed_arrivals", flow_ctes() + """
SELECT second, flows, round(avg(flows) OVER (ORDER BY second RANGE BETWEEN 1800 PRECEDING AND 1800 FOLLOWING), 6) AS smooth
FROM (SELECT valid_from // 1000 AS second, count(*) AS flows FROM flows GROUP BY ALL)""")
def n13_all(spark, d):
    series = flowstats.per_second(made_flows(spark, d)).select("second", "flows")
    return flowstats.smoothed(series, "flows", 1800).select("second", "flows", F.round("smooth", 6).alias("smooth"))


def histogram_sql(value: str, bins: int = 50) -> str:
    return f"""
, logs AS (SELECT log10(CAST({value} AS DOUBLE)) AS v FROM flows WHERE {value} > 0),
span AS (SELECT min(v) AS low, (max(v) - min(v)) / {bins} AS width FROM logs)
SELECT CAST(bin AS INTEGER) AS bin, round(low + (bin - 1) * width, 6) AS low, round(low + bin * width, 6) AS high,
  count(*) AS n FROM (SELECT low, width, CASE WHEN width > 0 THEN least(floor((v - low) / width) + 1, {bins}) ELSE 1 END AS bin
  FROM logs, span) GROUP BY bin, low, width"""


def rounded_bins(df):
    return df.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


@query("n14_duration_histogram", flow_ctes() + histogram_sql("((valid_to - valid_from) / 1000.0)"))
def n14(spark, d):
    return rounded_bins(flowstats.duration_histogram(made_flows(spark, d)))


@query("n15_size_histogram", flow_ctes() + histogram_sql("total_bytes"))
def n15(spark, d):
    return rounded_bins(flowstats.size_histogram(made_flows(spark, d)))


@query("n16_packet_count_histogram", flow_ctes() + histogram_sql("flow_count"))
def n16(spark, d):
    return rounded_bins(flowstats.packet_count_histogram(made_flows(spark, d)))


@query("n17_average_packet_size", flow_ctes() + """
SELECT src_ip, dst_ip, protocol, service_port, CASE WHEN flow_count > 0 THEN total_bytes / flow_count END AS avg_pkt_size
FROM flows""")
def n17(spark, d):
    return flowstats.average_packet_size(made_flows(spark, d)).select(
        "src_ip", "dst_ip", "protocol", "service_port", "avg_pkt_size")


@query("n18_size_by_protocol", flow_ctes() + """
SELECT protocol, round(min(x), 6) AS lowest, round(quantile_cont(x, 0.25), 6) AS q1,
  round(quantile_cont(x, 0.5), 6) AS median, round(quantile_cont(x, 0.75), 6) AS q3, round(max(x), 6) AS highest
FROM (SELECT protocol, total_bytes / flow_count AS x FROM flows WHERE flow_count > 0) GROUP BY protocol""")
def n18(spark, d):
    found = flowstats.size_by_protocol(made_flows(spark, d))
    return found.select("protocol", *[F.round(n, 6).alias(n) for n in found.columns[1:]])


@query("n19_pair_protocol_totals", flow_ctes() + """
SELECT src_ip AS src, dst_ip AS dst, protocol, CAST(sum(f.flow_count) AS BIGINT) AS weight,
  sum(f.total_bytes) AS total_bytes, count(*) AS num_flows FROM flows f GROUP BY src_ip, dst_ip, protocol""")
def n19(spark, d):
    return flowstats.pair_protocol_totals(made_flows(spark, d))


@query("n20_all_vertices", flow_ctes() + """
SELECT src_ip AS ip FROM flows UNION SELECT dst_ip FROM flows UNION SELECT layer_2_src FROM pk""")
def n20(spark, d):
    return flowstats.all_vertices(made_flows(spark, d), pk(spark, d).select(c("layer_2_src").alias("ip")))


# ---- indicators -----------------------------------------------------------------------------------------

PROFILE = """
sent AS (SELECT src_ip, count(DISTINCT dst_ip) AS unique_dst_ips, count(DISTINCT service_port) AS unique_svc_ports,
  CAST(sum(flow_count) AS BIGINT) AS packets_sent, sum(total_bytes) AS bytes_sent, count(*) AS flows_out
  FROM flows GROUP BY src_ip),
got AS (SELECT dst_ip, CAST(sum(flow_count) AS BIGINT) AS packets_received, sum(total_bytes) AS bytes_received,
  count(*) AS flows_in FROM flows GROUP BY dst_ip),
profile AS (SELECT s.*, coalesce(packets_received, 0) AS packets_received, coalesce(bytes_received, 0) AS bytes_received,
  coalesce(flows_in, 0) AS flows_in, CASE WHEN coalesce(packets_received, 0) > 0
    THEN round_even(packets_sent * CAST(100.0 AS DOUBLE) / packets_received, 0) / 100 ELSE CAST('inf' AS DOUBLE) END AS send_recv_ratio
  FROM sent s LEFT JOIN got ON got.dst_ip = s.src_ip)"""


def profiled(spark, d):
    return indicators.address_profile(made_flows(spark, d))


@query("i01_source_profile", flow_ctes(PROFILE) + "FROM sent")
def i01(spark, d):
    return indicators.source_profile(made_flows(spark, d))


@query("i02_incoming_profile", flow_ctes(PROFILE) + "FROM got")
def i02(spark, d):
    return indicators.incoming_profile(made_flows(spark, d))


@query("i03_address_profile", flow_ctes(PROFILE) + "SELECT * EXCLUDE send_recv_ratio FROM profile")
def i03(spark, d):
    return profiled(spark, d).drop("send_recv_ratio")


@query("i04_send_receive_ratio", flow_ctes(PROFILE) + "SELECT src_ip, send_recv_ratio FROM profile")
def i04(spark, d):
    return profiled(spark, d).select("src_ip", "send_recv_ratio")


@query("i04_asymmetry", flow_ctes(PROFILE) + """
SELECT src_ip, packets_sent, packets_received, send_recv_ratio FROM profile WHERE send_recv_ratio < 'inf'::DOUBLE
ORDER BY send_recv_ratio DESC""")
def i04a(spark, d):
    return indicators.asymmetry(profiled(spark, d)).select("src_ip", "packets_sent", "packets_received", "send_recv_ratio")


@query("i05_scanners", flow_ctes(PROFILE) + """
SELECT src_ip, unique_dst_ips FROM profile
WHERE unique_dst_ips >= greatest((SELECT quantile_cont(unique_dst_ips, 0.9) FROM profile), 3)""")
def i05(spark, d):
    return indicators.scanners(profiled(spark, d)).select("src_ip", "unique_dst_ips")


@query("i06_port_reconnaissance", flow_ctes(PROFILE) + """
SELECT src_ip, unique_svc_ports FROM profile
WHERE unique_svc_ports >= greatest((SELECT quantile_cont(unique_svc_ports, 0.9) FROM profile), 5)""")
def i06(spark, d):
    return indicators.port_reconnaissance(profiled(spark, d)).select("src_ip", "unique_svc_ports")


# ---- scalar helpers -------------------------------------------------------------------------------------


@query("h01_or_else", ctes(PACKETS) + "SELECT packet_id, coalesce(layer_3_src, layer_3_dst, '0') AS port FROM pk")
def h01(spark, d):
    return pk(spark, d).select("packet_id", scalars.or_else(c("layer_3_src"), c("layer_3_dst"), "0").alias("port"))


@query("h02_epoch_ms", """
SELECT o_orderkey, epoch_us(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) // 1000 AS day_ms,
  epoch_us(o_orderdate) // 1000 AS at_ms FROM orders""")
def h02(spark, d):
    rows = derived.table(spark, d, "orders")
    return rows.select("o_orderkey", scalars.epoch_ms(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day_ms"),
                       scalars.epoch_ms(c("o_orderdate").cast("string")).alias("at_ms"))


@query("h03_first_value", """
SELECT vec_id, CASE WHEN label % 2 = 0 THEN CAST(embedding[1] AS DOUBLE) END AS x FROM embeddings""")
def h03(spark, d):
    cell = F.when(c("label") % 2 == 0, c("embedding").cast("array<double>")).when(
        c("label") == 1, F.array().cast("array<double>"))
    return derived.table(spark, d, "embeddings").select("vec_id", scalars.first_value(cell).alias("x"))


@query("h04_joined_labels", """
SELECT 30000000000 + c_custkey AS node_id, 'customer,' || c_mktsegment AS labels FROM customer""")
def h04(spark, d):
    nodes = derived.commerce_graph(spark, d).nodes.where(F.array_contains("labels", "customer"))
    return nodes.select("node_id", scalars.joined_labels(c("labels")).alias("labels"))


@query("h05_coerced", ctes(PACKETS) + """
SELECT packet_id, TRY_CAST(layer_3_src AS INTEGER) AS layer_3_src, TRY_CAST(layer_3_dst AS DOUBLE) AS layer_3_dst FROM pk""")
def h05(spark, d):
    rows = pk(spark, d).select("packet_id", "layer_3_src", "layer_3_dst")
    return scalars.coerced(rows, {"layer_3_src": "int", "layer_3_dst": "double"})


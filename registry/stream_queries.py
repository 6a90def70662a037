"""Streams run to the end of the files that are there, compared with the same work on the whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from meshlark.operators import anomaly
from meshlark.plans.lineage import shared_folder
from meshlark.sources import derived
from meshlark.streaming import alerts, sinks
from meshlark.streaming import flows as stream_flows
from registry.base import DECODED, IPS, PACKETS, ctes, flow_ctes, ports_cte, query

c = F.col


def fresh_folder(spark) -> str:
    return f"{shared_folder(spark)}/streams/{uuid.uuid4().hex}"


def stream_packets(spark, d):
    return derived.event_packets(derived.stream_events(spark, d))


def finished(spark, rows):
    """Run a stream over all files that are there and read its sink."""
    folder = fresh_folder(spark)
    sinks.run_available(rows, f"{folder}/state", path=f"{folder}/rows")
    return spark.read.schema(rows.schema).parquet(f"{folder}/rows")


@query("x01_windowed_flows", ctes(PACKETS, ports_cte(), DECODED) + """
, mark AS (SELECT (max(tv_sec * 1000000 + tv_usec) // 1000 - 3600000) * 1000 AS us FROM pk WHERE layer_2_id = 'IP')
SELECT (ts_ms // 86400000) * 86400000 AS window_ms, src_ip, dst_ip, protocol, service_port, count(*) AS flow_count,
  CAST(coalesce(sum(size), 0) AS DOUBLE) AS total_bytes, min(ts_ms) AS valid_from, max(ts_ms) AS valid_to FROM decoded, mark
WHERE (ts_ms // 86400000 + 1) * 86400000000 <= mark.us GROUP BY ALL""")
def x01(spark, d):
    found = finished(spark, stream_flows.windowed_flows(stream_packets(spark, d), "1 day", "1 hour"))
    return found.select(F.unix_millis("window_start").alias("window_ms"), "src_ip", "dst_ip", "protocol",
                        "service_port", "flow_count", "total_bytes", "valid_from", "valid_to")


@query("x02_session_flows", ctes(PACKETS, ports_cte(), DECODED) + """
, mark AS (SELECT (max(tv_sec * 1000000 + tv_usec) // 1000 - 3600000) * 1000 AS us FROM pk WHERE layer_2_id = 'IP'),
timed AS (SELECT d.*, tv_sec * 1000000 + tv_usec AS us FROM decoded d JOIN pk USING (packet_id)),
flagged AS (SELECT *, CASE WHEN us - lag(us) OVER w < 21600000000 THEN 0 ELSE 1 END AS fresh FROM timed
  WINDOW w AS (PARTITION BY src_ip, dst_ip, protocol, service_port ORDER BY us)),
grouped AS (SELECT *, sum(fresh) OVER (PARTITION BY src_ip, dst_ip, protocol, service_port ORDER BY us) AS session FROM flagged)
SELECT min(grouped.us) AS session_us, src_ip, dst_ip, protocol, service_port, count(*) AS flow_count,
  CAST(coalesce(sum(size), 0) AS DOUBLE) AS total_bytes, min(ts_ms) AS valid_from, max(ts_ms) AS valid_to
FROM grouped, mark GROUP BY src_ip, dst_ip, protocol, service_port, session, mark.us
HAVING max(grouped.us) + 21600000000 <= mark.us""")
def x02(spark, d):
    found = finished(spark, stream_flows.session_flows(stream_packets(spark, d), "6 hours", "1 hour"))
    return found.select(F.unix_micros("session_start").alias("session_us"), "src_ip", "dst_ip", "protocol",
                        "service_port", "flow_count", "total_bytes", "valid_from", "valid_to")


@query("x03_ip_registry", ctes(PACKETS, IPS) + "SELECT node_id, ip FROM ips")
def x03(spark, d):
    folder = fresh_folder(spark)
    sinks.run_available(sinks.first_addresses(stream_packets(spark, d)), f"{folder}/state", sinks.number_first_addresses(folder))
    return sinks.read_registry(spark, folder)


@query("x04_graph_sink", flow_ctes(IPS) + """
SELECT s.ip AS src_ip, t.ip AS dst_ip, protocol AS edge_type, flow_count, valid_from, valid_to
FROM flows JOIN ips s ON s.ip = src_ip JOIN ips t ON t.ip = dst_ip""")
def x04(spark, d):
    folder = fresh_folder(spark)
    sinks.run_available(stream_packets(spark, d), f"{folder}/state", sinks.graph_sink(folder))
    graph = sinks.read_sink(spark, folder)
    ends = lambda node, ip: graph.nodes.select(c("node_id").alias(node), c("properties")["ip"].alias(ip))
    return graph.edges.join(ends("src", "src_ip"), "src").join(ends("dst", "dst_ip"), "dst").select(
        "src_ip", "dst_ip", "edge_type", c("properties")["flow_count"].cast("bigint").alias("flow_count"),
        "valid_from", "valid_to")


ALERT_RULE = anomaly.Baseline(bucket_ms=21_600_000, threshold=3.0)


ALERTS_SQL = f"""
WITH counts AS (SELECT user_id AS entity_id, epoch_us(ts) // {ALERT_RULE.bucket_ms * 1000} AS bucket, count(*) AS n
  FROM events GROUP BY ALL),
mark AS (SELECT max(epoch_us(ts)) // 1000 - 3600000 AS ms FROM events),
spans AS (SELECT entity_id, min(bucket) AS a, max(bucket) AS z FROM counts GROUP BY entity_id),
calendar AS (SELECT entity_id, unnest(range(a, z + 1)) AS bucket FROM spans),
profile AS (SELECT entity_id, bucket, coalesce(n, 0) AS activity FROM calendar LEFT JOIN counts USING (entity_id, bucket)),
framed AS (SELECT *, count(*) OVER w AS k, avg(activity) OVER w AS m, stddev_samp(activity) OVER w AS s FROM profile
  WINDOW w AS (PARTITION BY entity_id ORDER BY bucket ROWS BETWEEN {ALERT_RULE.width} PRECEDING AND 1 PRECEDING))
SELECT entity_id, TRUE AS is_node, CAST(bucket AS BIGINT) AS bucket, activity, round((activity - m) / greatest(s, 1.0), 6) AS score
FROM framed, mark WHERE k >= {ALERT_RULE.least} AND (activity - m) / greatest(s, 1.0) >= {ALERT_RULE.threshold}
  AND (bucket + 1) * {ALERT_RULE.bucket_ms} <= mark.ms"""


@query("x05_stream_alerts", ALERTS_SQL)
def x05(spark, d):
    folder = fresh_folder(spark)
    events = derived.stream_events(spark, d).select(
        c("user_id").alias("entity_id"), F.lit(True).alias("is_node"),
        derived.utc_millis(c("ts")).alias("at_ms"))
    closed = alerts.closed_buckets(events, ALERT_RULE, "1 hour")
    sinks.run_available(closed, f"{folder}/state", alerts.score_batches(folder, ALERT_RULE))
    return alerts.read_alerts(spark, folder).withColumn("score", F.round("score", 6))


@query("x05_keyed_alerts", ALERTS_SQL)
def x05k(spark, d):
    """The trailing buckets of each entity in the state store."""
    folder = fresh_folder(spark)
    events = derived.stream_events(spark, d).select(
        c("user_id").alias("entity_id"), F.lit(True).alias("is_node"), derived.utc_millis(c("ts")).alias("at_ms"))
    found = alerts.keyed_alerts(alerts.closed_buckets(events, ALERT_RULE, "1 hour"), ALERT_RULE)
    alerts.run_keyed(found, f"{folder}/state", f"{folder}/rows")
    return spark.read.schema(alerts.ALERTS).parquet(f"{folder}/rows").withColumn("score", F.round("score", 6))

"""Packets to flows to graph edges. The same functions serve batch and streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshlark.functions.ports import classify_service_port, parsed_port, with_service_name
from meshlark.graph import check_at_least
from meshlark.plans.ordered import dense_ids, running_totals

FLOW_KEY = ("src_ip", "dst_ip", "protocol", "service_port")


def ip_packets(packets: DataFrame) -> DataFrame:
    """Packets whose network layer is IP; an unknown layer is not IP."""
    return packets.where(F.col("layer_2_id") == "IP")


def packet_ms() -> Column:
    """Packet time in epoch milliseconds from seconds and microseconds."""
    return (F.col("tv_sec") * 1000 + F.floor(F.col("tv_usec") / 1000)).cast("long")


def protocol_or_ip() -> Column:
    return F.coalesce(F.nullif("layer_3_id", F.lit("")), F.lit("IP"))


def decoded_packets(packets: DataFrame, *keep: str) -> DataFrame:
    """IP packets with the flow key, time and size: one narrow step, no shuffle."""
    return ip_packets(packets).select(
        *keep,
        F.col("layer_2_src").alias("src_ip"),
        F.col("layer_2_dst").alias("dst_ip"),
        protocol_or_ip().alias("protocol"),
        classify_service_port(parsed_port(F.col("layer_3_src")), parsed_port(F.col("layer_3_dst"))).alias("service_port"),
        packet_ms().alias("ts_ms"),
        F.col("layer_1_size").alias("size"),
    )


def flow_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("flow_count"),
        F.coalesce(F.sum("size"), F.lit(0)).cast("double").alias("total_bytes"),
        F.min("ts_ms").alias("valid_from"),
        F.max("ts_ms").alias("valid_to"),
    ]


def packets_to_flows(packets: DataFrame, *extra_key: str) -> DataFrame:
    """One row per (source, target, protocol, service port): packets, bytes, first and last time, port name.

    An unknown port is a key of its own. ``extra_key`` adds packet columns to the key, such as a chunk number.
    Partial counts are taken before the shuffle and port names are looked up on flows, not on packets.
    """
    flows = decoded_packets(packets, *extra_key).groupBy(*extra_key, *FLOW_KEY).agg(*flow_measures())
    return with_service_name(flows)


def numbered_chunks(packets: DataFrame, order: list[str], chunk_size: int = 50) -> DataFrame:
    """Add ``chunk_id``: packets in ``order``, cut after every ``chunk_size``."""
    check_at_least("chunk_size", chunk_size, 1)
    numbered = dense_ids(packets, "_row", 0, order)
    return numbered.withColumn("chunk_id", F.floor(F.col("_row") / chunk_size)).drop("_row")


def chunked_flows(packets: DataFrame, order: list[str], chunk_size: int = 50) -> DataFrame:
    """Flows made per chunk of packets: one key gives one flow per chunk."""
    return packets_to_flows(numbered_chunks(packets, order, chunk_size), "chunk_id")


def packet_ips(packets: DataFrame) -> DataFrame:
    """Distinct addresses of IP packets, column ``ip``."""
    return ip_packets(packets).select(F.explode(F.array("layer_2_src", "layer_2_dst")).alias("ip")).distinct()


def ip_nodes(registry: DataFrame) -> DataFrame:
    """Node rows for a registry ``(node_id, ip)``."""
    return registry.select(
        "node_id", F.array(F.lit("IPAddress")).alias("labels"),
        F.create_map(F.lit("ip"), F.col("ip")).alias("properties"), F.lit(None).cast("array<double>").alias("embedding"))


def flows_to_edges(flows: DataFrame, registry: DataFrame, id_start: int = 0, typed: bool = False) -> DataFrame:
    """Flow rows as edges between address nodes; ids follow the flow key.

    A flow whose address is unknown (null, or not in the registry) is an edge whose end is null.
    The properties are an open map of the known values, or a struct with ``typed``.
    """
    ends = lambda ip, node: registry.select(F.col("ip").alias(ip), F.col("node_id").alias(node))
    linked = flows.join(ends("src_ip", "src"), "src_ip", "left").join(ends("dst_ip", "dst"), "dst_ip", "left")
    order = [c for c in ("chunk_id",) if c in flows.columns] + ["src_ip", "dst_ip", "protocol", "service_port"]
    names = ["service_port", "service_name", "flow_count", "total_bytes"]
    if typed:
        props = F.struct(*names)
    else:
        entries = F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).cast("string").alias("value")) for n in names])
        props = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    return dense_ids(linked, "edge_id", id_start, order).select(
        "edge_id", "src", "dst", F.col("protocol").alias("edge_type"), props.alias("properties"),
        F.lit(1.0).alias("weight"), "valid_from", "valid_to")


def chunk_totals(packets: DataFrame, order: list[str], chunk_size: int = 50) -> DataFrame:
    """Per chunk: packets, IP packets and flows, and the running totals of packets, flows and unique addresses.

    An address counts in the chunk that saw it first; all running totals are distributed prefix sums.
    """
    chunked = numbered_chunks(packets, order, chunk_size)
    counts = chunked.groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("packets"), F.count_if(F.col("layer_2_id") == "IP").alias("ip_packets"))
    keys = decoded_packets(chunked, "chunk_id").select("chunk_id", *FLOW_KEY).distinct()
    flows = keys.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("flows"))
    found = ip_packets(chunked)
    seen = found.select("chunk_id", F.explode(F.array("layer_2_src", "layer_2_dst")).alias("ip"))
    fresh = (seen.groupBy("ip").agg(F.min("chunk_id").alias("chunk_id")).groupBy("chunk_id")
             .agg(F.count(F.lit(1)).alias("new_ips")))
    rows = (counts.join(flows, "chunk_id", "left").join(fresh, "chunk_id", "left")
            .fillna(0, ["flows", "new_ips"]))
    return running_totals(rows, [], ["chunk_id"], {
        "total_packets": F.col("packets"), "total_flows": F.col("flows"), "unique_ips": F.col("new_ips"),
    }).drop("new_ips")


def run_totals(packets: DataFrame, order: list[str], chunk_size: int = 50) -> DataFrame:
    """One row for the whole run: packets, IP packets, flows (made per chunk) and unique addresses."""
    chunked = numbered_chunks(packets, order, chunk_size)
    flows = decoded_packets(chunked, "chunk_id").select("chunk_id", *FLOW_KEY).distinct()
    parts = [
        chunked.agg(F.count(F.lit(1)).alias("n")).select(F.lit("packets").alias("metric"), "n"),
        ip_packets(chunked).agg(F.count(F.lit(1)).alias("n")).select(F.lit("ip_packets").alias("metric"), "n"),
        flows.agg(F.count(F.lit(1)).alias("n")).select(F.lit("flows").alias("metric"), "n"),
        packet_ips(chunked).agg(F.count(F.lit(1)).alias("n")).select(F.lit("unique_ips").alias("metric"), "n"),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole

"""Graphs and packets built from the star-schema and event tables, for the registered queries and tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshlark.functions.scalars import utc_micros, utc_millis
from meshlark.graph import PropertyGraph
from meshlark.plans.ordered import lead_in_buckets
from meshlark.sources.frames import property_map

HOUR_US = 3_600_000_000
KIND_SPAN = 10_000_000_000
KINDS = {"region": 1, "nation": 2, "customer": 3, "supplier": 4, "part": 5, "order": 6}

# The service ports that the packet table cycles through.
SERVICE_CYCLE = ["443", "80", "53", "3306", "22", "5432", "40000"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def activity_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Each event links its user to the user of the next event of the same type."""
    events = table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", "value", utc_micros(F.col("ts")).alias("us"))
    linked = lead_in_buckets(events, ["event_type"], "us", HOUR_US, ["event_id"], ["us", "user_id"], "next")
    ms = lambda us: F.floor(us / 1000).cast("long")
    return linked.where("next.user_id is not null").select(
        F.col("event_id").alias("edge_id"),
        F.col("user_id").alias("src"),
        F.col("next.user_id").alias("dst"),
        F.col("event_type").alias("edge_type"),
        F.create_map().cast("map<string,string>").alias("properties"),
        F.col("value").alias("weight"),
        F.when(F.col("event_id") % 17 != 0, ms(F.col("us"))).alias("valid_from"),
        F.when(F.col("event_id") % 10 != 0, ms(F.col("next.us"))).alias("valid_to"),
    )


def activity_nodes(spark: SparkSession, folder: str) -> DataFrame:
    users = table(spark, folder, "events").select(F.col("user_id").alias("node_id")).distinct()
    vectors = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("node_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return users.join(vectors, "node_id", "left").select(
        "node_id", F.array(F.lit("User")).alias("labels"),
        F.create_map(F.lit("name"), F.concat(F.lit("user-"), F.col("node_id"))).alias("properties"), "embedding")


def activity_graph(spark: SparkSession, folder: str) -> PropertyGraph:
    return PropertyGraph(activity_nodes(spark, folder), activity_edges(spark, folder))


def node_id(kind: str, key: Column) -> Column:
    return key.cast("long") + F.lit(KINDS[kind] * KIND_SPAN)


def commerce_graph(spark: SparkSession, folder: str) -> PropertyGraph:
    """Regions, nations, customers, suppliers, parts and orders with typed edges."""
    keys = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey",
            "supplier": "s_suppkey", "part": "p_partkey", "order": "o_orderkey"}
    nodes = None
    for kind, key in keys.items():
        rows = table(spark, folder, "orders" if kind == "order" else kind)
        labels = [F.lit(kind)] + ([F.col("c_mktsegment")] if kind == "customer" else [])
        part = rows.select(node_id(kind, F.col(key)).alias("node_id"), F.array(*labels).alias("labels"),
                           property_map([c for c in rows.columns if c != key]).alias("properties"),
                           F.lit(None).cast("array<double>").alias("embedding"))
        nodes = part if nodes is None else nodes.unionByName(part)
    return PropertyGraph(nodes, commerce_edges(spark, folder))


def commerce_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Edge ids: type number * 10^13 + row key (order key * 10 + line number for line items, which repeats where
    the source table repeats a line number).
    """
    nation, customer, supplier, orders, lines = (
        table(spark, folder, t) for t in ("nation", "customer", "supplier", "orders", "lineitem"))

    def edges(rows, number, key, edge_type, src, dst, weight=F.lit(1.0), since=F.lit(None).cast("long")):
        return rows.select(
            (F.lit(number * 10 ** 13) + key.cast("long")).alias("edge_id"), src.alias("src"), dst.alias("dst"),
            F.lit(edge_type).alias("edge_type"), F.create_map().cast("map<string,string>").alias("properties"),
            weight.cast("double").alias("weight"), since.alias("valid_from"),
            F.lit(None).cast("long").alias("valid_to"))

    c = F.col
    line = c("l_orderkey") * 10 + c("l_linenumber")
    parts = [
        edges(nation, 1, c("n_nationkey"), "IN_REGION", node_id("nation", c("n_nationkey")),
              node_id("region", c("n_regionkey"))),
        edges(customer, 2, c("c_custkey"), "LOCATED_IN", node_id("customer", c("c_custkey")),
              node_id("nation", c("c_nationkey"))),
        edges(supplier, 3, c("s_suppkey"), "LOCATED_IN", node_id("supplier", c("s_suppkey")),
              node_id("nation", c("s_nationkey"))),
        edges(orders, 4, c("o_orderkey"), "PLACED", node_id("customer", c("o_custkey")),
              node_id("order", c("o_orderkey")), c("o_totalprice"), utc_millis(c("o_orderdate"))),
        edges(lines, 5, line, "CONTAINS", node_id("order", c("l_orderkey")), node_id("part", c("l_partkey")),
              c("l_quantity")),
        edges(lines, 6, line, "SUPPLIED_BY", node_id("order", c("l_orderkey")),
              node_id("supplier", c("l_suppkey")), c("l_extendedprice")),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _packets(rows: DataFrame, row_id: str, user: str, kind: Column, us: Column) -> DataFrame:
    at, who = F.col(row_id), F.col(user)
    div = lambda a, n: F.floor(a / n).cast("long")
    svc = F.element_at(F.array(*[F.lit(p) for p in SERVICE_CYCLE]), (at % 7 + 1).cast("int"))
    eph = (F.lit(1024) + (at * 7919) % 60000).cast("string")
    from_service = at % 3 == 0
    return rows.select(
        at.alias("packet_id"),
        F.when(at % 41 == 0, "ARP").otherwise("IP").alias("layer_2_id"),
        F.concat(F.lit("10.0."), div(who, 256), F.lit("."), who % 256).alias("layer_2_src"),
        F.concat(F.lit("10.0.0."), (who * 7 + at) % 97).alias("layer_2_dst"),
        kind.alias("layer_3_id"),
        F.when(at % 50 == 0, None).when(from_service, svc).otherwise(eph).alias("layer_3_src"),
        F.when(at % 53 == 0, "x").when(from_service, eph).otherwise(svc).alias("layer_3_dst"),
        F.when(at % 97 != 0, 40 + at % 1400).cast("long").alias("layer_1_size"),
        div(us, 1_000_000).alias("tv_sec"),
        (us % 1_000_000).cast("long").alias("tv_usec"),
    )


def event_packets(events: DataFrame) -> DataFrame:
    """One packet per event; works on a stream of events as well."""
    kind = (F.when(F.col("event_type").isin("click", "purchase"), "TCP").when(F.col("event_type") == "view", "UDP")
            .when(F.col("event_type") == "signup", ""))
    return _packets(events, "event_id", "user_id", kind, utc_micros(F.col("ts")))


def packets(spark: SparkSession, folder: str) -> DataFrame:
    return event_packets(table(spark, folder, "events"))


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    schema = table(spark, folder, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)

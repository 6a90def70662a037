"""Batch-wise sinks. Every batch owns one folder and overwrites it, so a repeated batch changes nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshlark.graph import EDGE_SCHEMA, NODE_SCHEMA, PropertyGraph
from meshlark.operators.flows import flows_to_edges, ip_nodes, packet_ips, packets_to_flows
from meshlark.operators.maintenance import get_or_create
from meshlark.plans.lineage import exists, forget, store
from meshlark.plans.ordered import dense_ids

REGISTRY_SCHEMA = T.StructType([T.StructField("node_id", T.LongType()), T.StructField("ip", T.StringType())])
BATCH = T.StructField("batch", T.LongType())
EDGE_IDS_PER_BATCH = 1 << 40


def write_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """All batches of a table, or those before a batch id; an absent table is empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    table = spark.read.schema(T.StructType([*schema.fields, BATCH])).parquet(path)
    if before is not None:
        table = table.where(F.col("batch") < before)
    return table.select(*schema.fieldNames())


def register_ips(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: give every address of the packets seen so far one node id, for good.

    Only the ids of earlier batches count as known, so a repeated batch assigns the same ids again.
    """

    def each(packets: DataFrame, batch_id: int) -> None:
        known = read_batches(packets.sparkSession, path, REGISTRY_SCHEMA, batch_id)
        seen = get_or_create(packet_ips(packets), "ip", known)
        write_batch(seen.join(known.select("ip"), "ip", "left_anti").select("node_id", "ip"), batch_id, path)

    return each


MARK_SCHEMA = T.StructType([T.StructField("next_id", T.LongType())])


def first_addresses(packets: DataFrame) -> DataFrame:
    """``ip`` of every address when it is first seen. What was seen lies in the state store, by address, so a batch costs
    what its own addresses cost, however many are known."""
    return packet_ips(packets).dropDuplicates(["ip"])


def number_first_addresses(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for ``first_addresses``: the next ids in address order, for good.

    A batch reads one number, where the batch before it ended, and no earlier ids; a repeated batch does the same.
    """

    def each(fresh: DataFrame, batch_id: int) -> None:
        spark = fresh.sparkSession
        marks = f"{path}/marks"
        last = f"{marks}/batch={batch_id - 1}"
        known = (spark.read.schema(MARK_SCHEMA).parquet(last) if exists(spark, last)
                 else read_batches(spark, marks, MARK_SCHEMA, batch_id))
        start = known.agg(F.max("next_id")).first()[0] or 0
        numbered = store(dense_ids(fresh.select("ip"), "node_id", start, ["ip"]).select("node_id", "ip"))
        write_batch(numbered.df, batch_id, f"{path}/ids")
        write_batch(spark.createDataFrame([(start + numbered.rows,)], MARK_SCHEMA).coalesce(1), batch_id, marks)
        forget(numbered)

    return each


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """``node_id, ip`` that ``number_first_addresses`` has written so far."""
    return read_batches(spark, f"{path}/ids", REGISTRY_SCHEMA)


def graph_sink(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: packets to address nodes and flow edges under ``path``.

    Edge ids start at ``batch * 2^40``, so they are unique and the same when a batch is repeated.
    """

    def each(packets: DataFrame, batch_id: int) -> None:
        spark = packets.sparkSession
        kept = store(packets)
        packets = kept.df
        register_ips(f"{path}/registry")(packets, batch_id)
        fresh = spark.read.schema(REGISTRY_SCHEMA).parquet(f"{path}/registry/batch={batch_id}")
        write_batch(ip_nodes(fresh), batch_id, f"{path}/nodes")
        registry = read_batches(spark, f"{path}/registry", REGISTRY_SCHEMA, batch_id + 1)
        edges = flows_to_edges(packets_to_flows(packets), registry, batch_id * EDGE_IDS_PER_BATCH)
        write_batch(edges, batch_id, f"{path}/edges")
        forget(kept)

    return each


def read_sink(spark: SparkSession, path: str) -> PropertyGraph:
    """The graph that ``graph_sink`` has written so far."""
    return PropertyGraph(read_batches(spark, f"{path}/nodes", NODE_SCHEMA),
                         read_batches(spark, f"{path}/edges", EDGE_SCHEMA))


def run_totals(packets: DataFrame, name: str = "totals") -> DataFrame:
    """Attach packet and IP-packet counts to a stream; a ``StreamingQueryListener`` reads them per batch."""
    return packets.observe(name, F.count(F.lit(1)).alias("packets"),
                           F.count_if(F.col("layer_2_id") == "IP").alias("ip_packets"))


def run_available(rows: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None] | None = None,
                  path: str | None = None) -> None:
    """Process all rows that are there now, in append mode, into ``each`` or into Parquet files at ``path``."""
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = writer.foreachBatch(each).start() if each else writer.format("parquet").option("path", path).start()
    query.awaitTermination()

"""Flat tables out of the graph, and bounded batches out of a result."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshlark.functions.scalars import joined_labels
from meshlark.graph import PropertyGraph


def property_names(nodes: DataFrame) -> list[str]:
    """All property names of a node or edge table, sorted."""
    kind = nodes.schema["properties"].dataType
    if isinstance(kind, T.StructType):
        return sorted(kind.fieldNames())
    names = nodes.select(F.explode(F.map_keys("properties")).alias("name")).distinct()
    return sorted(row.name for row in names.collect())


def flat_properties(df: DataFrame, keep: list[str], names: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` and one column per property; a property that a row lacks is NULL.

    ``names`` skips the pass over the table that finds the property names.
    """
    names = property_names(df) if names is None else names
    return df.select(*keep, *[F.col("properties")[n].alias(n) for n in names])


def export_nodes(graph: PropertyGraph, ids: DataFrame, names: list[str] | None = None) -> DataFrame:
    """``node_id``, comma-joined ``labels`` and one column per property for the requested ids."""
    found = graph.nodes.join(ids.select("node_id").distinct(), "node_id", "left_semi")
    return flat_properties(found.withColumn("labels", joined_labels(F.col("labels"))),
                           ["node_id", "labels"], names)


def nodes_to_dataframe(graph: PropertyGraph, ids: DataFrame, names: list[str] | None = None) -> DataFrame:
    """As ``export_nodes`` with column ``id`` and the labels kept as a list."""
    found = graph.nodes.join(ids.select("node_id").distinct(), "node_id", "left_semi")
    return flat_properties(found.withColumnRenamed("node_id", "id"), ["id", "labels"], names)


def export_bfs(graph: PropertyGraph, starts: DataFrame, max_depth: int = 3,
               names: list[str] | None = None) -> DataFrame:
    """Reached nodes with depth, labels and properties."""
    from meshlark.operators.traverse import bfs

    reached = bfs(graph, starts, max_depth).join(graph.nodes, "node_id")
    return flat_properties(reached.withColumn("labels", joined_labels(F.col("labels"))),
                           ["start", "node_id", "depth", "labels"], names)


def results_to_dataframe(results: DataFrame, column: str, schema: str) -> DataFrame:
    """A column of JSON records, or of JSON lists of records, as a table; no record gives an empty table."""
    listed = F.when(F.ltrim(column).startswith("["), F.col(column)).otherwise(
        F.concat(F.lit("["), F.col(column), F.lit("]")))
    records = results.select(F.explode(F.from_json(listed, f"array<struct<{schema}>>")).alias("record"))
    return records.select("record.*")


def query_batches(result: DataFrame, callback: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Run ``callback`` on every Arrow batch of the result where it lies; a batch never exceeds
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows. What the callback returns is the output.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield callback(batch)

    return result.mapInArrow(each, schema)


def extract_flows(graph: PropertyGraph, label: str) -> DataFrame:
    """All edges between nodes of a label with the endpoints' address, typed flow properties and window.

    A missing type reads as ``IP`` and a missing packet count as 1.
    """
    from meshlark.operators.pattern import Edge, Node, match

    found = match(graph, [Node("s", label), Edge("e"), Node("d", label)])
    prop = lambda name, kind: F.col("e.properties")[name].try_cast(kind).alias(name)
    return found.select(
        F.col("e.edge_id").alias("edge_id"),
        F.col("s.properties")["ip"].alias("src_ip"),
        F.col("d.properties")["ip"].alias("dst_ip"),
        F.coalesce("e.edge_type", F.lit("IP")).alias("protocol"),
        prop("service_port", "int"),
        prop("service_name", "string"),
        F.coalesce(prop("flow_count", "bigint"), F.lit(1)).alias("flow_count"),
        prop("total_bytes", "double"),
        F.col("e.valid_from").alias("valid_from"),
        F.col("e.valid_to").alias("valid_to"),
    )

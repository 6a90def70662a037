"""The graph: two DataFrames.

nodes(node_id long, labels array<string>, properties map<string,string> or struct, embedding array<double>)
edges(edge_id long, src long, dst long, edge_type string, properties map or struct, weight double,
      valid_from long, valid_to long)            -- epoch milliseconds, NULL = open end
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OUTGOING, INCOMING, BOTH = "outgoing", "incoming", "both"
DIRECTIONS = (OUTGOING, INCOMING, BOTH)

NODE_COLUMNS = ("node_id", "labels", "properties", "embedding")
EDGE_COLUMNS = ("edge_id", "src", "dst", "edge_type", "properties", "weight", "valid_from", "valid_to")

NODE_SCHEMA = T.StructType([
    T.StructField("node_id", T.LongType()),
    T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("embedding", T.ArrayType(T.DoubleType())),
])
EDGE_SCHEMA = T.StructType([
    T.StructField("edge_id", T.LongType()),
    T.StructField("src", T.LongType()),
    T.StructField("dst", T.LongType()),
    T.StructField("edge_type", T.StringType()),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("weight", T.DoubleType()),
    T.StructField("valid_from", T.LongType()),
    T.StructField("valid_to", T.LongType()),
])


def no_properties() -> Column:
    return F.create_map().cast("map<string,string>")


def as_nodes(df: DataFrame) -> DataFrame:
    """Fill the node envelope: missing optional columns get their defaults."""
    have = set(df.columns)
    return df.select(
        F.col("node_id").cast("long"),
        "labels",
        "properties" if "properties" in have else no_properties().alias("properties"),
        (F.col("embedding").cast("array<double>") if "embedding" in have
         else F.lit(None).cast("array<double>").alias("embedding")),
    )


def as_edges(df: DataFrame) -> DataFrame:
    """Fill the edge envelope: empty properties, weight 1.0 and open ends by default."""
    have = set(df.columns)

    def bound(name: str) -> Column:
        return (F.col(name) if name in have else F.lit(None)).cast("long").alias(name)

    weight = F.coalesce(F.col("weight").cast("double"), F.lit(1.0)) if "weight" in have else F.lit(1.0)
    return df.select(
        F.col("edge_id").cast("long"), F.col("src").cast("long"), F.col("dst").cast("long"), "edge_type",
        "properties" if "properties" in have else no_properties().alias("properties"),
        weight.alias("weight"), bound("valid_from"), bound("valid_to"),
    )


@dataclass(frozen=True)
class PropertyGraph:
    """Nodes and edges; ``adjacency`` may hold the same edges in walking order (``sources.adjacency``), ``folders`` the
    same nodes with the folders that each label lies in (``sources.tables``)."""

    nodes: DataFrame
    edges: DataFrame
    adjacency: object | None = None
    folders: object | None = None

    @classmethod
    def of(cls, nodes: DataFrame, edges: DataFrame) -> PropertyGraph:
        return cls(as_nodes(nodes), as_edges(edges))

    def with_edges(self, edges: DataFrame) -> PropertyGraph:
        return replace(self, edges=edges, adjacency=None)

    def with_nodes(self, nodes: DataFrame) -> PropertyGraph:
        return replace(self, nodes=nodes, folders=None)

    def with_typed_properties(self, node_types: dict[str, str] | None = None,
                              edge_types: dict[str, str] | None = None) -> PropertyGraph:
        """Move the named map keys to typed struct fields, so that scans read only the fields in use."""
        return PropertyGraph(typed_properties(self.nodes, node_types), typed_properties(self.edges, edge_types))


def typed_properties(df: DataFrame, types: dict[str, str] | None) -> DataFrame:
    if not types:
        return df
    fields = [F.col("properties")[key].try_cast(kind).alias(key) for key, kind in types.items()]
    return df.withColumn("properties", F.struct(*fields))


# ---- argument and data checks -------------------------------------------------------------------------


class GraphError(ValueError):
    """A request or a table that breaks the rules of the model."""


def check_direction(direction: str) -> str:
    if direction not in DIRECTIONS:
        raise GraphError(f"direction must be one of {', '.join(DIRECTIONS)}")
    return direction


def check_at_least(name: str, value: int, least: int) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < least:
        raise GraphError(f"{name} must be a whole number >= {least}")
    return value


def check_alpha(alpha: float) -> float:
    if not 0.0 <= float(alpha) <= 1.0:
        raise GraphError("alpha must lie in [0, 1]")
    return float(alpha)


def check_columns(df: DataFrame, *names: str | None) -> None:
    missing = [n for n in names if n is not None and n not in df.columns]
    if missing:
        raise GraphError(f"missing columns: {', '.join(missing)}")


def node_faults(nodes: DataFrame) -> DataFrame:
    """One row with the number of broken nodes per rule."""
    return nodes.agg(
        F.count_if(F.col("node_id").isNull()).alias("null_id"),
        F.count_if(F.coalesce(F.size("labels"), F.lit(0)) < 1).alias("no_label"),
        F.count_if(F.exists("embedding", lambda x: x.isNull() | F.isnan(x))).alias("bad_embedding"),
    )


def edge_faults(edges: DataFrame) -> DataFrame:
    """One row with the number of broken edges per rule."""
    return edges.agg(
        F.count_if(F.col("src").isNull() | F.col("dst").isNull()).alias("null_endpoint"),
        F.count_if(F.coalesce(F.length("edge_type"), F.lit(0)) < 1).alias("no_type"),
        F.count_if(F.col("weight").isNull() | F.isnan("weight")).alias("bad_weight"),
    )


def dangling_edges(graph: PropertyGraph) -> DataFrame:
    """Edges with an endpoint that is not a node."""
    ids = graph.nodes.select("node_id")
    kept = (graph.edges.join(ids.withColumnRenamed("node_id", "src"), "src", "left_semi")
            .join(ids.withColumnRenamed("node_id", "dst"), "dst", "left_semi").select("edge_id"))
    return graph.edges.join(kept, "edge_id", "left_anti")


def require_clean(faults: DataFrame) -> None:
    """Raise when a fault table has any count above zero."""
    found = {name: n for name, n in faults.first().asDict().items() if n}
    if found:
        raise GraphError("broken rows: " + ", ".join(f"{k}={v}" for k, v in found.items()))

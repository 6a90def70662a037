"""Build node and edge tables from ordinary DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshlark.graph import (EDGE_COLUMNS, NODE_COLUMNS, GraphError, as_edges, as_nodes, check_columns,
                            dangling_edges, edge_faults, node_faults, require_clean, PropertyGraph)
from meshlark.plans.ordered import dense_ids


def property_map(names: Sequence[str]) -> Column:
    """Open properties: the named columns as text; a NULL value is kept under its key."""
    if not names:
        return F.create_map().cast("map<string,string>")
    return F.map_from_arrays(F.array(*[F.lit(n) for n in names]),
                             F.array(*[F.col(n).cast("string") for n in names]))


def next_id(table: DataFrame | None, id_col: str) -> int:
    """First free id of an existing table (0 without one)."""
    if table is None:
        return 0
    top = table.agg(F.max(id_col)).first()[0]
    return 0 if top is None else top + 1


def import_nodes(df: DataFrame, label_col: str = "label", id_col: str | None = None,
                 embedding_cols: Sequence[str] = (), id_start: int = 0,
                 order: Sequence[str] = ()) -> DataFrame:
    """One node per row. Columns other than the label and the embedding become properties.

    ``id_col`` must exist and stays a property; ids are ``id_start`` plus the row's place in ``order`` (input
    order by default).
    """
    check_columns(df, label_col, id_col, *embedding_cols)
    props = [c for c in df.columns if c != label_col and c not in embedding_cols]
    shaped = df.select(
        *[F.col(c).alias(f"_order_{c}") for c in order],
        F.array(F.col(label_col).cast("string")).alias("labels"),
        property_map(props).alias("properties"),
        (F.array(*[F.col(c).cast("double") for c in embedding_cols]) if embedding_cols
         else F.lit(None).cast("array<double>")).alias("embedding"),
    )
    return dense_ids(shaped, "node_id", id_start, [f"_order_{c}" for c in order]).select(*NODE_COLUMNS)


def import_edges(df: DataFrame, source_col: str = "source", target_col: str = "target", type_col: str = "type",
                 weight_col: str | None = None, valid_from_col: str | None = None,
                 valid_to_col: str | None = None, id_start: int = 0, order: Sequence[str] = ()) -> DataFrame:
    """One edge per row. Unmapped columns become properties; the weight is 1.0 unless a column is named."""
    mapped = [source_col, target_col, type_col, weight_col, valid_from_col, valid_to_col]
    check_columns(df, *mapped)
    props = [c for c in df.columns if c not in mapped]

    def optional(name: str | None, kind: str) -> Column:
        return (F.col(name) if name else F.lit(None)).cast(kind)

    shaped = df.select(
        *[F.col(c).alias(f"_order_{c}") for c in order],
        F.col(source_col).cast("long").alias("src"),
        F.col(target_col).cast("long").alias("dst"),
        F.col(type_col).cast("string").alias("edge_type"),
        property_map(props).alias("properties"),
        F.coalesce(optional(weight_col, "double"), F.lit(1.0)).alias("weight"),
        optional(valid_from_col, "long").alias("valid_from"),
        optional(valid_to_col, "long").alias("valid_to"),
    )
    return dense_ids(shaped, "edge_id", id_start, [f"_order_{c}" for c in order]).select(*EDGE_COLUMNS)


def create_nodes(nodes: DataFrame, existing: DataFrame | None = None, order: Sequence[str] = ()) -> DataFrame:
    """New nodes with ids after those of ``existing``, in input order (or in ``order``).

    Expects ``labels`` and optionally ``properties`` and ``embedding``. Append with ``unionByName``.
    """
    check_columns(nodes, "labels")
    made = as_nodes(dense_ids(nodes, "node_id", next_id(existing, "node_id"), order))
    require_clean(node_faults(made))
    return made


def create_edges(edges: DataFrame, graph: PropertyGraph | None = None, order: Sequence[str] = (),
                 check_endpoints: bool = False) -> DataFrame:
    """New edges with ids after those of the graph. Expects ``src``, ``dst``, ``edge_type``; the rest defaults."""
    check_columns(edges, "src", "dst", "edge_type")
    start = next_id(graph.edges, "edge_id") if graph else 0
    made = as_edges(dense_ids(edges, "edge_id", start, order))
    require_clean(edge_faults(made))
    if check_endpoints:
        if graph is None:
            raise GraphError("an endpoint check needs the graph")
        if not dangling_edges(graph.with_edges(made)).isEmpty():
            raise GraphError("edges with an endpoint that is not a node")
    return made

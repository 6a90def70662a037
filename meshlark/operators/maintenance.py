"""Lookup, update and delete as set operations that return new tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshlark.graph import GraphError, PropertyGraph
from meshlark.plans.ordered import dense_ids


def _lookup(table: DataFrame, ids: DataFrame, key: str, on_missing: str) -> DataFrame:
    wanted = ids.select(key).distinct()
    if on_missing == "error":
        lost = wanted.join(table.select(key), key, "left_anti").limit(1).collect()
        if lost:
            raise GraphError(f"no {key} {lost[0][0]}")
    elif on_missing != "flag":
        raise GraphError("on_missing must be 'flag' or 'error'")
    present = table.withColumn("_present", F.lit(True))
    return (wanted.join(present, key, "left")
            .withColumn("found", F.coalesce("_present", F.lit(False))).drop("_present"))


def get_nodes(graph: PropertyGraph, ids: DataFrame, on_missing: str = "flag") -> DataFrame:
    """One row per requested node id with a ``found`` flag; ``on_missing="error"`` raises instead."""
    return _lookup(graph.nodes, ids, "node_id", on_missing)


def get_edges(graph: PropertyGraph, ids: DataFrame, on_missing: str = "flag") -> DataFrame:
    """One row per requested edge id with a ``found`` flag."""
    return _lookup(graph.edges, ids, "edge_id", on_missing)


def merged(old: Column, new: Column) -> Column:
    """Merge two property maps: keys named in ``new`` win, others stay."""
    both = F.map_zip_with(
        F.coalesce(old, F.create_map().cast("map<string,string>")), new,
        lambda key, before, after: F.when(F.array_contains(F.map_keys(new), key), after).otherwise(before))
    return F.when(new.isNull(), old).otherwise(both)


def _merge(table: DataFrame, updates: DataFrame, key: str, order: str | None) -> DataFrame:
    """Apply the updates of an id in ``order``, so that the last one that names a property sets it.

    The updates become one row per (id, property) before they meet the table. Two updates that give one property of
    one id different values are refused if they stand at the same place in the order; without ``order`` all do.
    """
    entries = updates.select(key, (F.col(order) if order else F.lit(0)).alias("_at"), F.explode("properties").alias("_name", "_value"))
    value = F.struct("_value")  # so that a null counts as a value
    at_once = entries.groupBy(key, "_name", "_at").agg(F.min(value).alias("a"), F.max(value).alias("b"))
    last = at_once.groupBy(key, "_name").agg(F.max(F.struct("_at", "a", "b")).alias("_last"))
    clash = last.where("NOT (_last.a <=> _last.b)").limit(1).collect()
    if clash:
        where = f"at the same {order}" if order else "; name an order column"
        raise GraphError(f"updates of {key} {clash[0][0]} disagree on {clash[0][1]} {where}")
    changes = last.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_name", "_last.a._value"))).alias("_new"))
    old = table.schema["properties"].dataType
    if isinstance(old, T.StructType):
        values = [F.when(F.array_contains(F.map_keys("_new"), f.name), F.col("_new")[f.name].cast(f.dataType))
                  .otherwise(F.col("properties")[f.name]).alias(f.name) for f in old]
        now = F.when(F.col("_new").isNull(), F.col("properties")).otherwise(F.struct(*values))
    else:
        now = merged(F.col("properties"), F.col("_new"))
    return table.join(changes, key, "left").withColumn("properties", now).select(*table.columns)


def merge_node_properties(graph: PropertyGraph, updates: DataFrame, order: str | None = None) -> PropertyGraph:
    """``updates(node_id, properties)``, applied in the order of column ``order``. Unknown ids change nothing. Typed
    properties take the fields they have; other names change nothing."""
    return graph.with_nodes(_merge(graph.nodes, updates, "node_id", order))


def merge_edge_properties(graph: PropertyGraph, updates: DataFrame, order: str | None = None) -> PropertyGraph:
    """``updates(edge_id, properties)``, as for nodes. Weight and window stay as they are."""
    return graph.with_edges(_merge(graph.edges, updates, "edge_id", order))


def delete_nodes(graph: PropertyGraph, ids: DataFrame) -> tuple[PropertyGraph, DataFrame]:
    """The graph without the nodes and their edges, and one row ``deleted`` (nodes really removed)."""
    gone = ids.select("node_id").distinct()
    edges = (graph.edges.join(gone.withColumnRenamed("node_id", "src"), "src", "left_anti")
             .join(gone.withColumnRenamed("node_id", "dst"), "dst", "left_anti").select(*graph.edges.columns))
    removed = graph.nodes.join(gone, "node_id", "left_semi")
    return (PropertyGraph(graph.nodes.join(gone, "node_id", "left_anti"), edges),
            removed.agg(F.count(F.lit(1)).alias("deleted")))


def delete_edges(graph: PropertyGraph, ids: DataFrame) -> tuple[PropertyGraph, DataFrame]:
    """The graph without the edges, and one row ``deleted``."""
    gone = ids.select("edge_id").distinct()
    removed = graph.edges.join(gone, "edge_id", "left_semi")
    return (graph.with_edges(graph.edges.join(gone, "edge_id", "left_anti")),
            removed.agg(F.count(F.lit(1)).alias("deleted")))


def get_or_create(keys: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """``(node_id, key)`` for every key: known ones keep their id, new ones get the next ids in key order."""
    wanted = keys.select(key).where(F.col(key).isNotNull()).distinct()
    if known is None:
        return dense_ids(wanted, "node_id", 0, [key])
    top = known.agg(F.max("node_id")).first()[0]
    fresh = dense_ids(wanted.join(known, key, "left_anti"), "node_id", 0 if top is None else top + 1, [key])
    return known.select("node_id", key).unionByName(fresh)

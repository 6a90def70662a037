"""The graph as of a point in time, and along a series of points."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshlark.graph import GraphError, PropertyGraph
from meshlark.plans.ordered import running_totals


def visible(timestamp: Column, closed: str = "both") -> Column:
    """Whether an edge's window holds ``timestamp``. NULL ends are open; both ends count by default."""
    if closed not in ("both", "left"):
        raise GraphError("closed must be 'both' or 'left'")
    upper = F.col("valid_to") >= timestamp if closed == "both" else F.col("valid_to") > timestamp
    return ((F.col("valid_from").isNull() | (F.col("valid_from") <= timestamp))
            & (F.col("valid_to").isNull() | upper))


def edges_at(edges: DataFrame, timestamp: int, closed: str = "both") -> DataFrame:
    """Edges visible at an epoch-millisecond time. The filter reaches a Parquet scan."""
    return edges.where(visible(F.lit(int(timestamp)), closed))


def graph_at(graph: PropertyGraph, timestamp: int, closed: str = "both") -> PropertyGraph:
    """The graph with the edges visible at a time, also in its walking order."""
    laid = graph.adjacency and graph.adjacency.where(visible(F.lit(int(timestamp)), closed))
    return replace(graph, edges=edges_at(graph.edges, timestamp, closed), adjacency=laid)


def edges_over(edges: DataFrame, timestamps: DataFrame, closed: str = "both") -> DataFrame:
    """Every (timestamp, visible edge) combination for the sweep points in ``timestamps(timestamp)``.

    An equi-join on time buckets, then the exact test. There are never more buckets than sweep points, so an
    edge is repeated no more often than about the number of rows it produces.
    """
    points = timestamps.select(F.col("timestamp").cast("long")).where("timestamp is not null").distinct()
    low, high, n = points.agg(F.min("timestamp"), F.max("timestamp"), F.count(F.lit(1))).first()
    if not n:
        return edges.select(F.lit(None).cast("long").alias("timestamp"), "*").where(F.lit(False))
    width = (high - low) // n + 1

    def bucket(moment: Column) -> Column:
        return F.floor((moment - low) / width).cast("int")

    first = F.greatest(F.coalesce("valid_from", F.lit(low)), F.lit(low))
    last = F.least(F.coalesce("valid_to", F.lit(high)), F.lit(high))
    touching = edges.where((F.coalesce("valid_from", F.lit(low)) <= high)
                           & (F.coalesce("valid_to", F.lit(high)) >= low)).where(first <= last)
    spread = touching.withColumn("_bucket", F.explode(F.sequence(bucket(first), bucket(last))))
    pairs = spread.join(points.withColumn("_bucket", bucket(F.col("timestamp"))), "_bucket")
    return pairs.where(visible(F.col("timestamp"), closed)).select("timestamp", *edges.columns)


def sweep(edges: DataFrame, timestamps: DataFrame, op: Callable[[DataFrame], DataFrame],
          closed: str = "both") -> DataFrame:
    """Apply ``op`` to the visible edges of all sweep points at once; ``op`` keeps ``timestamp`` as a key."""
    return op(edges_over(edges, timestamps, closed))


def sweep_totals(edges: DataFrame, timestamps: DataFrame, totals: dict[str, Column], closed: str = "both") -> DataFrame:
    """``timestamp`` and the sums of ``totals`` over the edges visible then, for every sweep point.

    An edge is added when its window begins and taken off after it ends, so the work grows with edges plus points and
    not with their combinations: changes at one moment are summed, and running totals over the moments give each point
    its sums. Windows that end before they begin hold no point. Sums of fractions carry the rounding of a running sum.
    """
    visible(F.lit(0), closed)  # checks ``closed``
    points = timestamps.select(F.col("timestamp").cast("long").alias("_time")).where("_time IS NOT NULL").distinct()
    values = edges.select("valid_from", "valid_to", *[column.alias(name) for name, column in totals.items()])
    holds = values.where("valid_from IS NULL OR valid_to IS NULL OR valid_from <= valid_to")
    begins = holds.select(F.coalesce("valid_from", F.lit(-(1 << 63))).alias("_time"), F.lit(0).alias("_turn"), *totals)
    # At an equal moment a window begins before the point and ends after it, or before it if its end is open.
    ends = holds.where("valid_to IS NOT NULL").select(
        F.col("valid_to").alias("_time"), F.lit(2 if closed == "both" else 0).alias("_turn"), *[(-F.col(n)).alias(n) for n in totals])
    changes = begins.unionByName(ends).groupBy("_time", "_turn").agg(*[F.sum(n).alias(n) for n in totals])
    asked = points.select("_time", F.lit(1).alias("_turn"), *[F.lit(0).alias(n) for n in totals])
    summed = running_totals(changes.unionByName(asked), [], ["_time", "_turn"], {f"_run_of_{n}": F.coalesce(n, F.lit(0)) for n in totals})
    return summed.where("_turn = 1").select(F.col("_time").alias("timestamp"), *[F.col(f"_run_of_{n}").alias(n) for n in totals])

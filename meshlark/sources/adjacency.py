"""Edges stored in walking order, so that a step from a few nodes reads only their part of the table.

``out`` holds every edge under a part of its source, ``back`` under a part of its target with both ends swapped. Both
lie in folders by edge type and part; a step joins on the part too, and Spark prunes the folders by the frontier.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshlark.graph import BOTH, OUTGOING, PropertyGraph

#: Edges of a part, about.
PART_ROWS = 2_000_000
MOST_PARTS = 4_096


def part_of(node: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(parts)).cast("int")


@dataclass(frozen=True)
class Adjacency:
    """``src, dst, weight, edge_id, edge_type, valid_from, valid_to, part``, where ``src`` is the node walked from."""

    out: DataFrame
    back: DataFrame
    parts: int

    def where(self, condition: Column | str) -> Adjacency:
        """Only the edges that fit, in both tables; ``condition`` must not name the ends."""
        return replace(self, out=self.out.where(condition), back=self.back.where(condition))

    def tables(self, direction: str) -> list[DataFrame]:
        return [self.out, self.back] if direction == BOTH else [self.out if direction == OUTGOING else self.back]


def write_adjacency(edges: DataFrame, path: str, fmt: str = "parquet", parts: int | None = None) -> None:
    """Write ``path/out`` and ``path/back``. Without ``parts`` their number follows the number of edges.

    The rows are dealt by type and part; those of a hot source are more than one task's and stay so.
    """
    if parts is None:
        parts = min(MOST_PARTS, max(1, -(-edges.count() // PART_ROWS)))
    turned = {"src": F.col("dst"), "dst": F.col("src")}
    for name, rows in (("out", edges), ("back", edges.withColumns(turned))):
        laid = rows.select("src", "dst", "weight", "edge_id", "valid_from", "valid_to", "edge_type",
                           part_of(F.col("src"), parts).alias("part"))
        (laid.hint("rebalance", "edge_type", "part").sortWithinPartitions("edge_type", "part", "src")
         .write.format(fmt).partitionBy("edge_type", "part").save(f"{path}/{name}"))
    edges.sparkSession.createDataFrame([(parts,)], "parts int").coalesce(1).write.format(fmt).save(f"{path}/layout")


def read_adjacency(spark: SparkSession, path: str, fmt: str = "parquet") -> Adjacency:
    kinds = "src long, dst long, weight double, edge_id long, valid_from long, valid_to long, edge_type string, part int"
    read = lambda name: spark.read.format(fmt).schema(kinds).load(f"{path}/{name}")
    return Adjacency(read("out"), read("back"), spark.read.format(fmt).load(f"{path}/layout").first()[0])


def with_adjacency(graph: PropertyGraph, path: str, fmt: str = "parquet") -> PropertyGraph:
    """The graph with the stored walking order at ``path``, written there from its edges; traversals then use it."""
    write_adjacency(graph.edges, path, fmt)
    return replace(graph, adjacency=read_adjacency(graph.edges.sparkSession, path, fmt))

"""Pattern match as joins. The result is a DataFrame with one struct column per variable."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshlark.graph import BOTH, INCOMING, OUTGOING, GraphError, PropertyGraph, check_direction


@dataclass(frozen=True)
class Node:
    """A node of the pattern. ``where`` is a condition on node columns, e.g. ``col("properties")["age"] > 25``."""

    var: str
    label: str | None = None
    where: Column | None = None


@dataclass(frozen=True)
class Edge:
    """A hop between the neighbouring nodes of the pattern."""

    var: str
    edge_type: str | None = None
    direction: str = OUTGOING
    where: Column | None = None


def _flat(df: DataFrame, var: str) -> DataFrame:
    """Prefix the columns, so that joins carry flat columns and Spark can prune each one alone."""
    return df.select(*[F.col(c).alias(f"{var}__{c}") for c in df.columns])


def _nodes(graph: PropertyGraph, node: Node) -> DataFrame:
    found = graph.nodes
    if node.label is not None and graph.folders is not None:
        found = graph.folders.holding(node.label)
    if node.label is not None:
        found = found.where(F.array_contains("labels", node.label))
    return found if node.where is None else found.where(node.where)


def _edges(graph: PropertyGraph, edge: Edge) -> DataFrame:
    found = graph.edges
    if edge.edge_type is not None:
        found = found.where(F.col("edge_type") == edge.edge_type)
    return found if edge.where is None else found.where(edge.where)


def match(graph: PropertyGraph, pattern: list[Node | Edge]) -> DataFrame:
    """Match ``[Node, Edge, Node, ...]``; a variable that comes again must bind the same node.

    NULL properties fail a comparison, so such rows drop out. Two edge variables may bind the same edge.
    """
    nodes, hops = pattern[0::2], pattern[1::2]
    if not pattern or len(pattern) % 2 == 0 or not all(isinstance(n, Node) for n in nodes) \
            or not all(isinstance(e, Edge) for e in hops):
        raise GraphError("a pattern alternates Node, Edge, Node, ... and begins and ends with a Node")
    edge_vars = [e.var for e in hops]
    if len(set(edge_vars)) < len(edge_vars) or set(edge_vars) & {n.var for n in nodes}:
        raise GraphError("edge variables must differ from each other and from node variables")
    for hop in hops:
        check_direction(hop.direction)

    fields = {n.var: graph.nodes.columns for n in nodes} | {e.var: graph.edges.columns for e in hops}
    rows = _flat(_nodes(graph, nodes[0]), nodes[0].var)
    bound = {nodes[0].var}
    for here, hop, there in zip(nodes, hops, nodes[1:]):
        rows = _hop(graph, rows, here, hop, there, there.var in bound)
        bound.add(there.var)
    order = list(dict.fromkeys(step.var for step in pattern))
    return rows.select(*[F.struct(*[F.col(f"{v}__{c}").alias(c) for c in fields[v]]).alias(v) for v in order])


def _hop(graph: PropertyGraph, rows: DataFrame, here: Node, hop: Edge, there: Node, known: bool) -> DataFrame:
    edges = _flat(_edges(graph, hop), hop.var)
    src, dst = F.col(f"{hop.var}__src"), F.col(f"{hop.var}__dst")
    if hop.direction == OUTGOING:
        edges = edges.withColumns({"_near": src, "_far": dst})
    elif hop.direction == INCOMING:
        edges = edges.withColumns({"_near": dst, "_far": src})
    else:
        assert hop.direction == BOTH
        edges = edges.withColumns({"_near": src, "_far": dst}).unionByName(
            edges.where(src != dst).withColumns({"_near": dst, "_far": src}))
    joined = rows.join(edges, F.col(f"{here.var}__node_id") == F.col("_near"))
    if known:
        joined = joined.where(F.col(f"{there.var}__node_id") == F.col("_far"))
        if there.label is not None:
            joined = joined.where(F.array_contains(f"{there.var}__labels", there.label))
        if there.where is not None:
            raise GraphError("put the condition on the first use of a variable")
    else:
        joined = joined.join(_flat(_nodes(graph, there), there.var),
                             F.col("_far") == F.col(f"{there.var}__node_id"))
    return joined.drop("_near", "_far")

"""Property graph, vector and network-flow analytics on Spark DataFrames."""

from meshlark.graph import GraphError, PropertyGraph, as_edges, as_nodes

__all__ = ["GraphError", "PropertyGraph", "as_edges", "as_nodes"]

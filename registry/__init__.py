"""All registered queries."""

from registry import flow_queries, graph_queries, network_queries, search_queries, stream_queries  # noqa: F401
from registry.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

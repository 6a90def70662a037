"""Subgraphs around centers, and their text forms."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshlark.graph import BOTH, GraphError, PropertyGraph, check_at_least, check_columns
from meshlark.operators.search import vector_search
from meshlark.operators.traverse import bfs
from meshlark.plans.lineage import store

FORMATS = ("structured", "prose", "triples", "json")


@dataclass
class Subgraphs:
    """``nodes(center, node_id, depth)`` and ``edges(center, ...edge columns)``."""

    nodes: DataFrame
    edges: DataFrame

    def counts(self) -> DataFrame:
        """``center, node_count, edge_count``."""
        n = self.nodes.groupBy("center").agg(F.count(F.lit(1)).alias("node_count"))
        e = self.edges.groupBy("center").agg(F.count(F.lit(1)).alias("edge_count"))
        return n.join(e, "center", "left").fillna(0, ["edge_count"])


def extract_subgraph(graph: PropertyGraph, centers: DataFrame, hops: int = 2, max_nodes: int = 50) -> Subgraphs:
    """Nodes within an undirected radius, the first ``max_nodes`` by (depth, id), and all edges among them."""
    check_at_least("hops", hops, 1)
    check_at_least("max_nodes", max_nodes, 1)
    kept = bfs(graph, centers, hops, BOTH, most=max_nodes).withColumnRenamed("start", "center")
    # First keep the edges whose ends are in any subgraph; only those meet the keyed joins.
    inside = kept.select("node_id").distinct()
    edges = (graph.edges.join(inside.withColumnRenamed("node_id", "src"), "src", "left_semi")
             .join(inside.withColumnRenamed("node_id", "dst"), "dst", "left_semi"))
    ends = lambda name: kept.select("center", F.col("node_id").alias(name))
    induced = edges.join(ends("src"), "src").join(ends("dst"), ["center", "dst"])
    return Subgraphs(kept, induced.select("center", *graph.edges.columns))


def _property_text(nodes: DataFrame) -> Column:
    if isinstance(nodes.schema["properties"].dataType, T.StructType):
        entries = F.map_entries(F.from_json(F.to_json("properties"), "map<string,string>"))
    else:
        entries = F.map_entries("properties")
    return F.array_join(F.array_sort(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ", ")


def _lines(rows: DataFrame, order: list[str], line: Column, name: str) -> DataFrame:
    """One sorted list of lines per center. A group is bounded by max_nodes (squared, for merged edges)."""
    ordered = F.array_sort(F.collect_list(F.struct(*order, line.alias("line"))))
    return rows.groupBy("center").agg(F.transform(ordered, lambda x: x["line"]).alias(name))


def linearize(graph: PropertyGraph, found: Subgraphs, fmt: str = "structured") -> DataFrame:
    """``center, text, node_count, edge_count`` in one of the formats.

    Parallel edges of one type become one line with a count, so a text never grows with their number.
    """
    if fmt not in FORMATS:
        raise GraphError(f"format must be one of {', '.join(FORMATS)}")
    nodes = found.nodes.join(graph.nodes.select("node_id", "labels", "properties"), "node_id")
    edges = found.edges.groupBy("center", "src", "edge_type", "dst").agg(F.count(F.lit(1)).alias("times"))
    c = F.col
    many = F.when(c("times") > 1, F.concat(F.lit(" x"), c("times"))).otherwise("")
    props = _property_text(nodes)
    labels = F.array_join("labels", "|")
    edge_order = ["src", "edge_type", "dst"]
    if fmt == "triples":
        line = F.concat(F.lit("("), c("src"), F.lit(", "), c("edge_type"), F.lit(", "), c("dst"), F.lit(")"))
        body = _lines(edges, edge_order, line, "e")
        text = F.array_join("e", "\n")
        whole = found.nodes.select("center").distinct().join(body, "center", "left")
    elif fmt == "json":
        node = F.struct(c("node_id").alias("id"), "labels", "properties")
        edge = F.struct("src", c("edge_type").alias("type"), "dst", "times")
        n = nodes.groupBy("center").agg(F.transform(
            F.array_sort(F.collect_list(F.struct("node_id", F.to_json(node).alias("line")))), lambda x: x["line"]).alias("n"))
        e = _lines(edges, edge_order, F.to_json(edge), "e")
        whole = n.join(e, "center", "left")
        listed = lambda name: F.concat(F.lit("["), F.coalesce(F.array_join(name, ","), F.lit("")), F.lit("]"))
        text = F.concat(F.lit('{"nodes":'), listed("n"), F.lit(',"edges":'), listed("e"), F.lit("}"))
    elif fmt == "structured":
        n = _lines(nodes, ["node_id"], F.rtrim(F.concat(
            F.lit("  "), c("node_id"), F.lit(" ["), labels, F.lit("] "), props)), "n")
        e = _lines(edges, edge_order, F.concat(
            F.lit("  "), c("src"), F.lit(" -["), c("edge_type"), F.lit("]-> "), c("dst"), many), "e")
        whole = n.join(e, "center", "left")
        text = F.concat(F.lit("Nodes:\n"), F.array_join("n", "\n"), F.lit("\nEdges:\n"),
                        F.coalesce(F.array_join("e", "\n"), F.lit("")))
    else:
        about = F.when(props != "", F.concat(F.lit(" ("), props, F.lit(")"))).otherwise("")
        often = F.when(c("times") > 1, F.concat(F.lit(" "), c("times"), F.lit(" times"))).otherwise("")
        n = _lines(nodes, ["node_id"], F.concat(
            F.lit("Node "), c("node_id"), F.lit(" is labelled "), labels, about, F.lit(".")), "n")
        e = _lines(edges, edge_order, F.concat(
            F.lit("Node "), c("src"), F.lit(" is linked by "), c("edge_type"), F.lit(" to node "), c("dst"),
            often, F.lit(".")), "e")
        whole = n.join(e, "center", "left")
        text = F.array_join(F.concat(c("n"), F.coalesce("e", F.array().cast("array<string>"))), " ")
    texts = whole.select("center", F.coalesce(text, F.lit("")).alias("text"))
    return texts.join(found.counts(), "center")


def rag_contexts(graph: PropertyGraph, questions: DataFrame, hops: int = 2, max_nodes: int = 50,
                 fmt: str = "structured", generate: Callable | None = None,
                 answer_schema: str | None = None) -> DataFrame:
    """Context rows for ``questions(question_id, question, anchor, embedding)``:
    ``question_id, question, anchor, context, node_count, edge_count``.

    A given anchor wins; otherwise the node nearest to the embedding is taken. ``generate`` is an optional
    batch function (an iterator of pandas frames in and out) that turns the rows into answers.
    """
    check_columns(questions, "question_id", "question", "anchor", "embedding")
    asked = store(questions.select(F.col("question_id").cast("long"), "question", F.col("anchor").cast("long"),
                                   F.col("embedding").cast("array<double>"))).df
    open_ = asked.where(F.col("anchor").isNull()).select(
        F.col("question_id").alias("query_id"), F.col("embedding").alias("vector"))
    nearest = vector_search(graph, open_, 1).select(F.col("query_id").alias("question_id"),
                                                   F.col("node_id").alias("nearest"))
    placed = store(asked.join(nearest, "question_id", "left").select(
        "question_id", "question", F.coalesce("anchor", "nearest").alias("anchor"))).df
    found = extract_subgraph(graph, placed.where("anchor is not null").select(F.col("anchor").alias("node_id")),
                             hops, max_nodes)
    texts = linearize(graph, found, fmt).withColumnsRenamed({"center": "anchor", "text": "context"})
    rows = placed.join(texts, "anchor").select("question_id", "question", "anchor", "context", "node_count",
                                               "edge_count")
    return rows if generate is None else rows.mapInPandas(generate, answer_schema)

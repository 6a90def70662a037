"""Read and write graph and packet tables in any Spark format."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshlark.graph import EDGE_COLUMNS, NODE_COLUMNS, PropertyGraph
from meshlark.plans.lineage import exists

#: Pairs of folder and label that are kept in memory; a graph with more is read without pruning by label.
MOST_FOLDERS = 10_000


@dataclass(frozen=True)
class LabelFolders:
    """Stored nodes, and the folders (first labels) under which nodes with a label lie."""

    nodes: DataFrame
    folders: dict[str, tuple[str, ...]]

    def holding(self, label: str) -> DataFrame:
        """The nodes of all folders that hold the label: its own, and those of nodes that carry it as a further label."""
        wanted = self.folders.get(label, ())
        return self.nodes.where(F.col("primary_label").isin(*wanted) if wanted else F.lit(False)).select(*NODE_COLUMNS)

PACKET_SCHEMA = T.StructType([
    T.StructField("layer_2_id", T.StringType()),
    T.StructField("layer_2_src", T.StringType()),
    T.StructField("layer_2_dst", T.StringType()),
    T.StructField("layer_3_id", T.StringType()),
    T.StructField("layer_3_src", T.StringType()),
    T.StructField("layer_3_dst", T.StringType()),
    T.StructField("layer_1_size", T.LongType()),
    T.StructField("tv_sec", T.LongType()),
    T.StructField("tv_usec", T.LongType()),
])


def write_graph(graph: PropertyGraph, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Write ``path/nodes`` by primary label and ``path/edges`` by edge type.

    A filter on the type or the first label then reads only the matching folders, and a pattern with a label only those
    that hold it, which ``path/labels`` lists. Properties written with types (``with_typed_properties``) are columns of
    the files, so that conditions on them reach the scan.
    """
    nodes = graph.nodes.withColumn("primary_label", F.try_element_at("labels", F.lit(1)))
    (nodes.select("primary_label", F.explode("labels").alias("label")).distinct()
     .write.format(fmt).mode(mode).save(f"{path}/labels"))
    (nodes.write.format(fmt).mode(mode).partitionBy("primary_label").save(f"{path}/nodes"))
    graph.edges.write.format(fmt).mode(mode).partitionBy("edge_type").save(f"{path}/edges")


def _load(spark: SparkSession, path: str, fmt: str, folder_col: str) -> DataFrame:
    """Load a table, reading the folder column as text (Spark would guess a number for ``007``)."""
    found = spark.read.format(fmt).load(path).schema
    declared = T.StructType([T.StructField(f.name, T.StringType() if f.name == folder_col else f.dataType)
                             for f in found])
    return spark.read.format(fmt).schema(declared).load(path)


def read_graph(spark: SparkSession, path: str, fmt: str = "parquet", primary_label: str | None = None,
               edge_type: str | None = None) -> PropertyGraph:
    nodes = _load(spark, f"{path}/nodes", fmt, "primary_label")
    edges = _load(spark, f"{path}/edges", fmt, "edge_type")
    if primary_label is not None:
        nodes = nodes.where(F.col("primary_label") == primary_label)
    if edge_type is not None:
        edges = edges.where(F.col("edge_type") == edge_type)
    folders = None
    if exists(spark, f"{path}/labels"):
        pairs = spark.read.format(fmt).load(f"{path}/labels").limit(MOST_FOLDERS + 1).collect()
        if len(pairs) <= MOST_FOLDERS:
            listed: dict[str, tuple[str, ...]] = {}
            for pair in pairs:
                listed[pair.label] = (*listed.get(pair.label, ()), pair.primary_label)
            folders = LabelFolders(nodes, listed)
    return PropertyGraph(nodes.select(*NODE_COLUMNS), edges.select(*EDGE_COLUMNS), folders=folders)


def read_packets(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Decoded packets with the fixed packet columns."""
    return spark.read.format(fmt).schema(PACKET_SCHEMA).load(path)


def stream_packets(spark: SparkSession, path: str, fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """The same table as a stream of newly arriving files."""
    return (spark.readStream.format(fmt).schema(PACKET_SCHEMA)
            .option("maxFilesPerTrigger", files_per_batch).load(path))

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (SparkSession.builder.master("local[*]").appName("tests").config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def hot_keys(monkeypatch):
    """Treat keys with more than 5 rows as hot, so that small inputs take the path of large ones."""
    from meshlark.plans import skew

    monkeypatch.setattr(skew, "MIN_SLICE_ROWS", 5)


def ms(text: str) -> int:
    import datetime as dt

    return int(dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def graph_of(spark, edges, n=None, embeddings=None):
    """Graph of ``(src, dst, weight)`` tuples with nodes 0..n-1 or all ends."""
    from meshlark.graph import EDGE_SCHEMA, NODE_SCHEMA, PropertyGraph

    ids = set(range(n)) if n is not None else {x for e in edges for x in e[:2]}
    nodes = [(i, ["N"], {"name": f"n{i}"}, (embeddings or {}).get(i)) for i in sorted(ids)]
    rows = [(i, e[0], e[1], "E", {}, float(e[2]) if len(e) > 2 else 1.0, None, None) for i, e in enumerate(edges)]
    return PropertyGraph(spark.createDataFrame(nodes, NODE_SCHEMA), spark.createDataFrame(rows, EDGE_SCHEMA))


def ids_of(spark, *ids, name="node_id"):
    return spark.createDataFrame([(i,) for i in ids], f"{name} long")

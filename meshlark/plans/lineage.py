"""Cut the lineage of loop state by writing it to the shared folder.

A loop that only chains DataFrames gets a plan that grows with every round. Here the state of a round is
written as Parquet in the folder that ``spark.checkpoint.dir`` names, so a lost executor never loses it, and
Spark knows the exact size of the next join's input.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """Folder for loop state: the session's ``spark.checkpoint.dir``; a temporary one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None) or current
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="meshlark-")
    if current is None:
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


@dataclass
class Stored:
    """A written table, its row count and any further scalar measures taken while writing."""

    df: DataFrame
    rows: int
    path: str
    measures: dict = field(default_factory=dict)


def store(df: DataFrame, **measures: Column) -> Stored:
    """Write ``df`` to the shared folder, count rows in the same job, and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    seen = Observation()
    taken = [column.alias(name) for name, column in measures.items()]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *taken).write.parquet(path)
    found = seen.get
    stored = Stored(spark.read.schema(df.schema).parquet(path), found["rows"], path, found)
    for made in getattr(_scratches, "open", [])[-1:]:
        made.append(stored)
    return stored


_scratches = threading.local()


@contextmanager
def scratch() -> Iterator[list[Stored]]:
    """The tables stored in the block are deleted at its end, but for those that are taken from the list; so are the
    shuffle files, as soon as a table is written."""
    spark, name = SparkSession.active(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, made = spark.conf.get(name), []
    _scratches.open = [*getattr(_scratches, "open", []), made]
    spark.conf.set(name, "true")
    try:
        yield made
    finally:
        spark.conf.set(name, before)
        _scratches.open = _scratches.open[:-1]
        for stored in made:
            forget(stored)


def forget(stored: Stored) -> None:
    """Delete a superseded loop table of this session. Only for tables that no later plan reads."""
    spark = stored.df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(stored.path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def bucketed(df: DataFrame, *keys: str) -> DataFrame:
    """Write a static loop input once, bucketed by ``keys``; joins on ``keys`` in every round then move only the
    other side. Callers split hot keys first (see ``skew``).

    The files lie in the shared folder. The catalog entry only carries the bucket layout into the plan and is
    dropped at once, which leaves the files alone.
    """
    spark = df.sparkSession
    name = f"meshlark_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/tables/{spark.sparkContext.applicationId}/{name}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(parts, *keys).write.format("parquet").bucketBy(parts, *keys).option("path", path)
     .saveAsTable(name))
    table = spark.table(name)
    table.schema  # resolves the layout before the entry goes
    spark.sql(f"DROP TABLE {name}")
    return table


def forget_all(spark: SparkSession) -> None:
    """Delete all loop tables of this application. Results of loops can no longer be read afterwards."""
    target = spark._jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark)}/tables/{spark.sparkContext.applicationId}")
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

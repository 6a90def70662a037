"""Split hot join keys.

One node may own a third of all edges. ``Split`` cuts the rows of such a key into slices of about equal size
and repeats the other side of the join once per slice, only for hot keys. The list of hot keys is bounded by
construction: a key counts as hot only above ``total / MAX_HOT_KEYS`` rows, so at most ``MAX_HOT_KEYS`` exist
and the list can always be broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshlark.plans.lineage import bucketed, store

MAX_HOT_KEYS = 10_000
MIN_SLICE_ROWS = 1_000_000


@dataclass
class Split:
    """The big side (with a ``slice`` column if there are hot keys) and the hot keys with their slices."""

    df: DataFrame
    key: str
    hot: DataFrame | None

    def joined(self, other: DataFrame, key: str) -> DataFrame:
        """Inner join of ``other`` on its column ``key`` with the big side on its key.

        The rows of ``other`` are repeated once per slice of a hot key.
        """
        big = self.df.withColumnRenamed(self.key, key)
        if self.hot is None:
            return other.join(big, key)
        counts = self.hot.select(F.col("hot_key").alias(key), "slices")
        spread = (
            other.join(F.broadcast(counts), key, "left")
            .withColumn("slice", F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)))
            .drop("slices")
        )
        return spread.join(big, [key, "slice"]).drop("slice")


def split_hot(df: DataFrame, key: str, by: str, min_rows: int | None = None) -> Split:
    """Cut the rows of every key above the slice size by a hash of ``by``.

    Runs one aggregate over ``df`` (partial counts before the shuffle) and reads back two numbers.
    """
    degrees = df.groupBy(F.col(key).alias("hot_key")).count()
    total, largest = degrees.agg(F.sum("count"), F.max("count")).first()
    slice_rows = max(min_rows or MIN_SLICE_ROWS, -(-(total or 0) // MAX_HOT_KEYS))
    if not largest or largest <= slice_rows:
        return Split(df, key, None)
    hot = degrees.where(F.col("count") > slice_rows).select(
        "hot_key", F.ceil(F.col("count") / slice_rows).cast("int").alias("slices")
    )
    sliced = (
        df.join(F.broadcast(hot.withColumnRenamed("hot_key", key)), key, "left")
        .withColumn("slice", F.coalesce(F.pmod(F.xxhash64(by), F.col("slices")), F.lit(0)).cast("int"))
        .select(*df.columns, "slice")
    )
    return Split(sliced, key, hot)


def laid_out(df: DataFrame, rows: int, key: str, by: str) -> Split:
    """Prepare a written loop input for repeated joins on ``key``: hot keys cut, bucketed by key and slice.

    An input too small to hold a single hot key is used as it is.
    """
    if rows <= MIN_SLICE_ROWS:
        return Split(df, key, None)
    split = split_hot(df, key, by)
    if split.hot is None:
        return Split(bucketed(df, key), key, None)
    return Split(bucketed(split.df, key, "slice"), key, store(split.hot).df)

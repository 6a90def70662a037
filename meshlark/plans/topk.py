"""Per-request top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows per ``by`` and number them from 1.

    ``row_number() <= k`` lets Spark cut every input partition to k rows per group before the shuffle.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)

"""Similarity of dense vectors as column expressions, in double precision.

Vectors of different size, with a NULL element, or (for cosine) of zero length cannot be compared: NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def _total(items: Column) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda sum_, x: sum_ + x)


def _pairwise(a: Column, b: Column, combine) -> Column:
    return F.when(F.size(a) == F.size(b), _total(F.zip_with(doubles(a), doubles(b), combine)))


def dot(a: Column, b: Column) -> Column:
    return _pairwise(a, b, lambda x, y: x * y)


def norm(a: Column) -> Column:
    return F.sqrt(_total(F.transform(doubles(a), lambda x: x * x)))


def cosine(a: Column, b: Column) -> Column:
    length = norm(a) * norm(b)
    return F.when(length > 0, dot(a, b) / length)


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(_pairwise(a, b, lambda x, y: (x - y) * (x - y)))

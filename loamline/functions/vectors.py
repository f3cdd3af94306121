"""Vector expressions over array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-8


def dot(a: Column, b: Column) -> Column:
    """Null if either side is null or holds a null; shorter sides are not padded (null)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """a.b / ((|a|+eps)(|b|+eps)): defined, and 0, for zero vectors."""
    return dot(a, b) / ((norm(a) + EPS) * (norm(b) + EPS))

"""Vector columns as JVM expressions over arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))


def dot(a: Column, b: Column) -> Column:
    """Sum of products; elements beyond the shorter vector count as zero."""
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 if a vector is zero."""
    n = norm(a) * norm(b)
    return F.when(n == 0, F.lit(0.0)).otherwise(dot(a, b) / F.when(n == 0, F.lit(1.0)).otherwise(n))


def l2(a: Column, b: Column) -> Column:
    """Squared Euclidean distance, the order of nearest-neighbour results."""
    return _sum(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))))

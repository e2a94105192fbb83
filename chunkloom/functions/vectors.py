"""Vector and rectangle arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def l2_normalize(a: Column) -> Column:
    n = norm(a) + 1e-12
    return F.transform(a, lambda x: x.cast("double") / n)


def distance_score(distance: Column) -> Column:
    return F.greatest(F.lit(0.0), 1 - distance)


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Length that two intervals share."""
    return F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0))


def overlap_fraction(a: tuple, b: tuple) -> Column:
    """Shared area over the area of ``a``; boxes are (x0, y0, x1, y1)."""
    area = (a[2] - a[0]) * (a[3] - a[1])
    return F.when(area > 0, overlap(a[0], a[2], b[0], b[2]) * overlap(a[1], a[3], b[1], b[3]) / area).otherwise(0.0)

"""Distance expressions for clustering and for choosing the number of clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def nearest_center(value: Column, centers: Sequence[float]) -> Column:
    """Index of the centre with the least squared distance; the lowest index on ties."""
    candidates = [
        F.struct(F.pow(value - F.lit(float(c)), F.lit(2)).alias("distance"), F.lit(i).alias("index"))
        for i, c in enumerate(centers)
    ]
    return F.when(value.isNotNull(), F.array_min(F.array(*candidates))["index"])


def chord_distance(
    x: Column, y: Column, first: tuple[float, float], last: tuple[float, float]
) -> Column:
    """Distance of (x, y) from the line through two points; 0 if the points coincide."""
    (x1, y1), (xn, yn) = first, last
    length = ((yn - y1) ** 2 + (xn - x1) ** 2) ** 0.5
    if length == 0:
        return F.lit(0.0)
    return F.abs((yn - y1) * x - (xn - x1) * y + (xn * y1 - yn * x1)) / F.lit(length)

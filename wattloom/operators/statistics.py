"""Counts, means and squared deviations as a table that is added up instead of counted again.

A row (keys, n, mean, m2) stands for n values, their mean and the sum of their squared deviations
from it. Rows of equal keys merge into the row that all their values would have given, so parts that
were summarised apart are enough. Cost and silhouette of clusters follow from such rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.naming import named

def moments(rows: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Rows (by, n, mean, m2) of the values that are not NULL; groups without one are left out."""
    x = named(value)
    sums = rows.groupBy(*by).agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), (F.count(x) * F.var_pop(x)).alias("m2")
    )
    return sums.where(F.col("n") > 0)


def merged(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per key (one column or more) from any number of them.

    The parts of a key add their squared distances from a point near all means (the least mean), which
    keeps the digits that sums of squares around zero would lose.
    """
    keys = {c: f"_key{i}" for i, c in enumerate(by)}
    near = parts.groupBy(*[named(c).alias(key) for c, key in keys.items()]).agg(F.min("mean").alias("_near"))
    same = [named(c).eqNullSafe(F.col(key)) for c, key in keys.items()]
    offset = F.col("mean") - F.col("_near")
    rows = parts.join(near, same).select(
        *[named(c).alias(c) for c in by],
        "n",
        "_near",
        "m2",
        (F.col("n") * offset).alias("_first"),
        (F.col("n") * offset * offset).alias("_second"),
    )
    n, first = F.sum("n"), F.sum("_first")
    return rows.groupBy(*by).agg(
        n.alias("n"),
        (F.first("_near") + first / n).alias("mean"),
        F.greatest(F.lit(0.0), F.sum("m2") + F.sum("_second") - first * first / n).alias("m2"),
    )


def cluster_distances(x: Column, own: Column, clusters: Column) -> Column:
    """Mean squared distances of a value as an array of (mine, way), from one of (cluster, n, mean, m2).

    The mean squared distance to a cluster is that to its mean plus its mean squared deviation; to the
    own cluster it is taken over the others there, and NULL if there are none.
    """

    def way(c: Column) -> Column:
        offset = x - c["mean"]
        return offset * offset + c["m2"] / c["n"]

    return F.transform(
        clusters,
        lambda c: F.struct(
            (c["cluster"] == own).alias("mine"),
            F.when(c["cluster"] != own, way(c))
            .when(c["n"] > 1, way(c) * c["n"] / (c["n"] - 1))
            .alias("way"),
        ),
    )


def least_way(distances: Column, mine: bool) -> Column:
    return F.array_min(
        F.transform(F.filter(distances, lambda d: d["mine"] == F.lit(mine)), lambda d: d["way"])
    )


def silhouette(own: Column, other: Column) -> Column:
    """From the distances to the own and to the nearest other cluster; 0 where one is not there."""
    widest = F.greatest(own, other)
    absent = own.isNull() | other.isNull() | (widest == 0)
    return F.when(absent, 0.0).otherwise((other - own) / widest)

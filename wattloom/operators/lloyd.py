"""K-means of one value for many k and seeds at once.

Every fit is a short list of centres, so all fits advance together: a pass over the feature table
labels each row under every open fit and averages by (fit, cluster), and the averages are the next
centres. A fit closes when its centres rest, so there are as many passes as the slowest fit needs, and
what reaches the driver are the centres. One more pass gives the counts, means and squared deviations of
all clusters, from which all costs follow, and another one all silhouettes.

Starts are the values that come first by a hash of seed and value, so a fit depends neither on parts
nor on the order of rows, and SQL can say what it should be.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.naming import named
from wattloom.operators import statistics
from wattloom.operators.clustering import (
    CURVE,
    cluster_range,
    elbow_select,
    no_clusters,
    silhouette_select,
)

#: As in Spark's own fit: passes at most, and the way that a centre may move in a pass and still rest.
MAX_PASSES = 20
REST = 1e-4
SEEDS = (1, 2, 3)

Fit = tuple[int, int]  # (seed, k)


class Sweep(NamedTuple):
    """The ascending centres of the best fit of each k, one row (k, wcss, silhouette) per k, and the
    passes over the table that the fits took."""

    centers: dict[int, tuple[float, ...]]
    curve: DataFrame
    passes: int


def first_values(features: DataFrame, value: str, n: int, seeds: Sequence[int]) -> dict[int, list[float]]:
    """For each seed the n different values that come first by the MD5 of ``seed:value``, the value
    in thousandths."""
    seed = F.explode(F.array(*[F.lit(int(s)) for s in seeds])).alias("seed")
    thousandths = F.floor(F.col("x") * 1000).cast("string")
    order = F.md5(F.concat_ws(":", F.col("seed").cast("string"), thousandths))
    values = features.select(named(value).alias("x")).distinct().select("x", seed)
    first = Window.partitionBy("seed").orderBy(order, "x")
    drawn = values.withColumn("place", F.row_number().over(first)).where(F.col("place") <= n)
    found: dict[int, list[float]] = {int(s): [] for s in seeds}
    for row in sorted(drawn.collect(), key=lambda r: r.place):
        found[row.seed].append(row.x)
    return found


def numbers(values: Sequence[float]) -> str:
    return f"array({', '.join(f'{float(v)!r}D' for v in values)})"


def literal(
    fits: Mapping[Fit, Sequence[float]], clusters: Mapping[Fit, Sequence[Mapping]] | None = None
) -> Column:
    """The fits, and the statistics of their clusters if given, as one array literal. A pass's plan
    holds it as a value, so all passes share their code; SQL text names hundreds of numbers at once."""

    def of_clusters(rows: Sequence[Mapping]) -> str:
        return ", ".join(
            f"named_struct('cluster', {r['cluster']}, 'n', {float(r['n'])!r}D,"
            f" 'mean', {r['mean']!r}D, 'm2', {r['m2']!r}D)"
            for r in rows
        )

    structs = []
    for fit, centers in fits.items():
        more = f", 'clusters', array({of_clusters(clusters[fit])})" if clusters else ""
        structs.append(f"named_struct('seed', {fit[0]}, 'k', {fit[1]}, 'centers', {numbers(centers)}{more})")
    return F.expr(f"array({', '.join(structs)})")


def nearest(x: Column, centers: Column) -> Column:
    """The place of the nearest centre, the first on ties."""
    ways = F.transform(centers, lambda c, i: F.struct(F.abs(x - c).alias("way"), i.alias("i")))
    return F.array_min(ways)["i"]


def labelled(features: DataFrame, value: str, fits: Mapping[Fit, Sequence[float]]) -> DataFrame:
    """Rows (x, seed, k, cluster): every row under every fit."""
    x = named(value)
    every = F.transform(
        literal(fits),
        lambda f: F.struct(
            f["seed"].alias("seed"), f["k"].alias("k"), nearest(x, f["centers"]).alias("cluster")
        ),
    )
    return features.select(x.alias("x"), F.explode(every).alias("f")).select("x", "f.*")


def advance(features: DataFrame, value: str, fits: dict[Fit, tuple[float, ...]]) -> dict[Fit, tuple[float, ...]]:
    """The next centres; one without rows stays."""
    sums = labelled(features, value, fits).groupBy("seed", "k", "cluster").agg(F.avg("x").alias("mean"))
    moved = {fit: list(centers) for fit, centers in fits.items()}
    for row in sums.collect():
        moved[row.seed, row.k][row.cluster] = row.mean
    return {fit: tuple(centers) for fit, centers in moved.items()}


def rests(old: Sequence[float], new: Sequence[float]) -> bool:
    return all(abs(a - b) <= REST for a, b in zip(old, new, strict=True))


def all_fits(
    features: DataFrame, value: str, ks: Sequence[int], seeds: Sequence[int] = SEEDS
) -> tuple[dict[Fit, tuple[float, ...]], int]:
    """The centres of every (seed, k), and the number of passes. Fewer different values than k give as
    many centres as there are values."""
    starts = first_values(features, value, max(ks), seeds)
    fits = {(s, k): tuple(sorted(starts[s][:k])) for s in starts for k in ks}
    still, passes = dict(fits), 0
    while still and passes < MAX_PASSES:
        moved = advance(features, value, still)
        passes += 1
        fits |= moved
        still = {fit: new for fit, new in moved.items() if not rests(still[fit], new)}
    return {fit: tuple(sorted(centers)) for fit, centers in fits.items()}, passes


def cluster_statistics(features: DataFrame, value: str, fits: Mapping[Fit, Sequence[float]]) -> DataFrame:
    """Rows (seed, k, cluster, n, mean, m2) of all fits, from one pass."""
    return statistics.moments(labelled(features, value, fits), "x", ("seed", "k", "cluster"))


def silhouettes(
    features: DataFrame, value: str, fits: Mapping[Fit, Sequence[float]], clusters: Sequence[Mapping]
) -> dict[Fit, float]:
    """The mean silhouette of each fit with two clusters or more, from one pass; ``clusters`` holds the
    rows of ``cluster_statistics``."""
    own = {fit: [c for c in clusters if (c["seed"], c["k"]) == fit] for fit in fits}
    scored = {fit: rows for fit, rows in own.items() if len(rows) > 1}
    if not scored:
        return {}
    x = named(value)
    own_cluster = F.transform(
        literal({fit: fits[fit] for fit in scored}, scored),
        lambda f: F.struct(
            f["seed"].alias("seed"),
            f["k"].alias("k"),
            nearest(x, f["centers"]).alias("own"),
            f["clusters"].alias("clusters"),
        ),
    )
    # Step by step, so that no step is worked out again for each use in the next one.
    rows = features.select(x.alias("x"), F.explode(own_cluster).alias("f")).select("x", "f.*")
    ways = statistics.cluster_distances(F.col("x"), F.col("own"), F.col("clusters"))
    rows = rows.select("seed", "k", ways.alias("ways")).select(
        "seed",
        "k",
        statistics.least_way(F.col("ways"), True).alias("a"),
        statistics.least_way(F.col("ways"), False).alias("b"),
    )
    points = rows.select("seed", "k", statistics.silhouette(F.col("a"), F.col("b")).alias("score"))
    means = points.groupBy("seed", "k").agg(F.avg("score").alias("score")).collect()
    return {(r.seed, r.k): r.score for r in means}


def k_sweep(
    features: DataFrame,
    value: str,
    k_max: int = 15,
    seeds: Sequence[int] = SEEDS,
    with_silhouette: bool = True,
) -> Sweep:
    """Fit and score every k in ``cluster_range``, the cheapest fit of each over the seeds."""
    spark = features.sparkSession
    ks = list(cluster_range(features, k_max))
    if not ks:
        return Sweep({}, spark.createDataFrame([], CURVE), 0)
    fits, passes = all_fits(features, value, ks, seeds)
    clusters = cluster_statistics(features, value, fits).collect()
    costs = {fit: 0.0 for fit in fits}
    for row in clusters:
        costs[row.seed, row.k] += row.m2
    best = {k: min((costs[s, k], s) for s in seeds)[1] for k in ks}
    chosen = {(s, k): fits[s, k] for k, s in best.items()}
    scores = silhouettes(features, value, chosen, clusters) if with_silhouette else {}
    curve = [(k, costs[s, k], scores.get((s, k))) for k, s in best.items()]
    return Sweep({k: fits[s, k] for k, s in best.items()}, spark.createDataFrame(curve, CURVE), passes)


def rescored(
    features: DataFrame, value: str, centers: Mapping[int, Sequence[float]]
) -> DataFrame:
    """Rows (k, wcss, silhouette) of given centres for each k, in two passes for all."""
    fits = {(0, k): tuple(own) for k, own in centers.items()}
    if not fits:
        return features.sparkSession.createDataFrame([], CURVE)
    clusters = cluster_statistics(features, value, fits).collect()
    scores = silhouettes(features, value, fits, clusters)
    rows = [
        (k, sum(c.m2 for c in clusters if c.k == k), scores.get((seed, k))) for seed, k in fits
    ]
    return features.sparkSession.createDataFrame(rows, CURVE)


def cluster_by_choice(
    features: DataFrame, entity: str, value: str, method: str, seeds: Sequence[int] = SEEDS
) -> tuple[DataFrame, DataFrame]:
    """Clusters, numbered by rising centre, and curve, with k chosen by ``elbow`` or ``silhouette``."""
    with_silhouette = method == "silhouette"
    sweep = k_sweep(features, value, seeds=seeds, with_silhouette=with_silhouette)
    curve = sweep.curve.select("k", "silhouette" if with_silhouette else "wcss")
    if not sweep.centers:
        return no_clusters(features, entity, value), curve
    k = (silhouette_select if with_silhouette else elbow_select)(curve).first().k
    own = nearest(named(value), F.expr(numbers(sweep.centers[k]))).cast("int").alias("cluster")
    return features.select(entity, value, own).orderBy("cluster", value), curve

"""Exact quantiles of groups of any size.

A built-in exact percentile keeps all different values of a group in one buffer. Here each wanted rank
of each group has a bracket, at first the whole line. A round cuts the values inside a bracket into bins
at the edges that a sketch proposes, counts exactly what lies in the bins around the rank, and goes on
with the one bin that holds it: about a five-hundredth of the values. The edges themselves are counted
apart, so values that repeat do not go on, and every round has fewer rows. What is left of a group is
sorted once it is small. Sketches and counts are aggregated before the shuffle; no round holds a group
in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.naming import named
from wattloom.session import fresh_folder

#: Bins of a sketch, and its accuracy, by which an edge may miss its place.
BINS = 1_000
ACCURACY = 10_000
#: So many values of a bracket are sorted at most.
FEW = 10_000
#: So many groups are broadcast at most; more are joined by a shuffle.
MAX_BROADCAST = 200_000

TARGETS = "array<struct<rank:bigint,low:double,high:double,below:bigint,inside:bigint,value:double>>"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write and reread: the lineage ends here."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def joined(rows: DataFrame, state: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(state) if state.count() <= MAX_BROADCAST else state, "key")


def inside(x: Column, low: Column, high: Column) -> Column:
    return (low.isNull() | (x > low)) & (high.isNull() | (x < high))


def is_open(t: Column) -> Column:
    return t["value"].isNull() & (t["inside"] > FEW)


def initial(rows: DataFrame, quantiles: Sequence[float]) -> DataFrame:
    """Rows (key, n, min, max, targets): the ranks that each group's quantiles need, in an open bracket."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("x").alias("min"), F.max("x").alias("max"))
    places = [F.lit(float(q)) * (F.col("n") - 1) for q in quantiles]
    ranks = F.array_distinct(F.array(*[f(p).cast("long") for p in places for f in (F.floor, F.ceil)]))
    targets = F.transform(
        ranks,
        lambda r: F.struct(
            r.alias("rank"),
            F.lit(None).cast("double").alias("low"),
            F.lit(None).cast("double").alias("high"),
            F.lit(0).cast("long").alias("below"),
            F.col("n").alias("inside"),
            F.lit(None).cast("double").alias("value"),
        ),
    )
    return written(sizes.withColumn("targets", targets.cast(TARGETS)), "quantile-ranks")


def narrowed(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Rows (key, rank, low, high, below, inside, left, right): two edges around each open rank."""
    pairs = F.transform(F.filter("targets", is_open), lambda t: F.struct(t["low"], t["high"]))
    brackets = state.select("key", F.explode(F.array_distinct(pairs)).alias("b")).select("key", "b.*")
    hits = joined(rows, brackets).where(inside(F.col("x"), F.col("low"), F.col("high")))
    grid = F.array(*[F.lit(i / BINS) for i in range(BINS + 1)])
    edges = hits.groupBy("key", "low", "high").agg(
        F.percentile_approx("x", grid, F.lit(ACCURACY)).alias("edges")
    )
    edges = edges.select(*[F.col(c).alias(f"of_{c}") for c in ("key", "low", "high")], "edges")
    targets = state.select("key", F.explode(F.filter("targets", is_open)).alias("t")).select("key", "t.*")
    same = (
        (F.col("key") == F.col("of_key"))
        & F.col("low").eqNullSafe(F.col("of_low"))
        & F.col("high").eqNullSafe(F.col("of_high"))
    )
    at = F.floor((F.col("rank") - F.col("below") + 0.5) / F.col("inside") * BINS).cast("int")
    found = targets.join(edges, same).select(
        "key", "rank", "low", "high", "below", "inside",
        F.get("edges", F.greatest(at - 1, F.lit(0))).alias("left"),
        F.get("edges", F.least(at + 2, F.lit(BINS))).alias("right"),
    )
    return written(found, "quantile-edges")


def counted(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows (key, target): each rank with the bin that holds it, or with its value."""
    x, left, right = F.col("x"), F.col("left"), F.col("right")
    hits = joined(rows, edges).where(inside(x, F.col("low"), F.col("high")))

    def count(where: Column, name: str) -> Column:
        return F.count_if(where).alias(name)

    by = [c for c in edges.columns]
    bins = hits.groupBy(*by).agg(
        count(x < left, "before"),
        count(x == left, "on_left"),
        count((x > left) & (x < right), "between"),
        count((x == right) & (left != right), "on_right"),
    )
    rank = F.col("rank") - F.col("below")
    ends = [F.col("before")]
    for name in ("on_left", "between", "on_right"):
        ends.append(ends[-1] + F.col(name))

    def target(low: Column, high: Column, skipped: Column, n: Column, value: Column) -> Column:
        parts = [F.col("rank"), low, high, F.col("below") + skipped, n, value]
        return F.struct(*[p.alias(f"c{i}") for i, p in enumerate(parts)]).cast(
            TARGETS.removeprefix("array<").removesuffix(">")
        )

    none, nothing = F.lit(None).cast("double"), F.lit(0).cast("long")
    chosen = (
        F.when(rank < ends[0], target(F.col("low"), left, nothing, F.col("before"), none))
        .when(rank < ends[1], target(none, none, nothing, nothing, left))
        .when(rank < ends[2], target(left, right, ends[1], F.col("between"), none))
        .when(rank < ends[3], target(none, none, nothing, nothing, right))
        .otherwise(target(right, F.col("high"), ends[3], F.col("inside") - ends[3], none))
    )
    return bins.select("key", chosen.alias("target"))


def settled(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Rows (key, rank, value): the brackets that are left are sorted."""
    targets = state.select("key", F.explode("targets").alias("t")).select("key", "t.*")
    known = targets.where(F.col("value").isNotNull()).select("key", "rank", "value")
    left = joined(rows, targets.where(F.col("value").isNull()))
    left = left.where(inside(F.col("x"), F.col("low"), F.col("high")))
    order = Window.partitionBy("key", "rank").orderBy("x")
    numbered = left.withColumn("place", F.row_number().over(order) - 1)
    found = numbered.where(F.col("place") == F.col("rank") - F.col("below"))
    return known.unionByName(found.select("key", "rank", F.col("x").alias("value")))


def exact_quantiles(
    rows: DataFrame, by: Sequence[str], value: str, quantiles: Sequence[float]
) -> DataFrame:
    """Rows (by, n, min, max, quantiles): linear interpolation between the two ranks of each quantile.

    NULL and NaN are no values, and groups without a value have no row. NULL is a key like others.
    """
    x = named(value).cast("double")
    keys = F.struct(*[named(c).alias(f"k{i}") for i, c in enumerate(by)])
    rows = rows.where(x.isNotNull() & ~F.isnan(x)).select(keys.alias("key"), (x + F.lit(0.0)).alias("x"))
    state = initial(rows, quantiles)
    while not state.where(F.exists("targets", is_open)).isEmpty():
        moved = counted(rows, narrowed(rows, state))
        moved = moved.groupBy("key").agg(F.collect_list("target").alias("moved"))
        closed = F.filter("targets", lambda t: ~is_open(t))
        targets = F.concat(closed, F.coalesce("moved", F.array().cast(TARGETS))).alias("targets")
        state = written(
            state.join(moved, "key", "left").select("key", "n", "min", "max", targets), "quantile-ranks"
        )
        wanted = joined(rows, state.select("key", "targets"))
        wanted = wanted.where(
            F.exists(
                "targets",
                lambda t: t["value"].isNull() & inside(F.col("x"), t["low"], t["high"]),
            )
        )
        rows = written(wanted.select("key", "x"), "quantile-rows")
    values = settled(rows, state).groupBy("key").agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("values")
    )
    found = state.select("key", "n", "min", "max").join(values, "key")
    numbers = []
    for q in quantiles:
        place = F.lit(float(q)) * (F.col("n") - 1)
        low, high = (F.col("values")[f(place).cast("long")] for f in (F.floor, F.ceil))
        numbers.append(low + (high - low) * (place - F.floor(place)))
    return found.select(
        *[F.col(f"key.k{i}").alias(c) for i, c in enumerate(by)],
        "n", "min", "max", F.array(*numbers).alias("quantiles"),
    )


def reading_quartiles(
    readings: DataFrame, entity: str, metrics: Mapping[str, str]
) -> DataFrame:
    """``summary.five_numbers`` of the readings themselves, per (entity, metric), with their number."""
    values = F.array(
        *[F.struct(F.lit(tag).alias("data"), named(c).cast("double").alias("x")) for tag, c in metrics.items()]
    )
    rows = readings.select(named(entity).alias(entity), F.inline(values))
    found = exact_quantiles(rows, (entity, "data"), "x", (0.25, 0.5, 0.75))
    quartiles = [F.get("quantiles", F.lit(i)).alias(f"{p}-perc") for i, p in enumerate((25, 50, 75))]
    return found.select(named(entity), "data", "n", "min", *quartiles, "max")

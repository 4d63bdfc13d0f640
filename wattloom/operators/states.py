"""Readings as stored states that merge into every profile.

A state is one row per (entity, year, month, day, hour) with count, sum, least and greatest of each
metric. Annual, monthly and hourly results are sums over states, so they need no reading again. States
are stored in a folder per day; a corrected day replaces its own folder and leaves the others alone.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.calendar import month_label
from wattloom.functions.naming import named

CALENDAR = ("year", "month", "day", "hour")
DAY = "state_day"


def states(readings: DataFrame, entity: str, metrics: Mapping[str, str]) -> DataFrame:
    """Rows (entity, year, month, day, hour, <metric>_n, _sum, _min, _max)."""
    parts = [
        fn(named(column)).alias(f"{name}_{label}")
        for name, column in metrics.items()
        for label, fn in (("n", F.count), ("sum", F.sum), ("min", F.min), ("max", F.max))
    ]
    return readings.groupBy(named(entity).alias("entity"), *CALENDAR).agg(*parts)


def with_day(rows: DataFrame) -> DataFrame:
    """Add the day as a number; rows without a time have day 0."""
    day = F.col("year") * 10_000 + F.col("month") * 100 + F.col("day")
    return rows.withColumn(DAY, F.coalesce(day, F.lit(0)).cast("int"))


def write_states(rows: DataFrame, root: str) -> None:
    """Replace the folders of the days that ``rows`` have, and no other."""
    (
        with_day(rows)
        .hint("rebalance", F.col(DAY))
        .write.option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .mode("overwrite")
        .parquet(root)
    )


def on_days(readings: DataFrame, time: str, days: Iterable[datetime.date]) -> DataFrame:
    """The readings of some days, as ranges on time that reach the scan."""
    wanted = F.lit(False)
    for day in sorted(set(days)):
        start = datetime.datetime.combine(day, datetime.time())
        in_day = (F.col(time) >= F.lit(start)) & (F.col(time) < F.lit(start + datetime.timedelta(days=1)))
        wanted = wanted | in_day
    return readings.where(wanted)


def replace_days(
    readings: DataFrame,
    root: str,
    entity: str,
    metrics: Mapping[str, str],
    days: Iterable[datetime.date],
    time: str = "datetime",
) -> None:
    """Count some days anew. ``readings`` may hold all readings: only those of the days are read.

    A day that has no reading any more is left with an empty state, a row without entity and counts,
    since a folder is replaced only by rows.
    """
    days = sorted(set(days))
    found = states(on_days(readings, time, days), entity, metrics)
    blank = readings.sparkSession.createDataFrame(
        [(day.year, day.month, day.day) for day in days], "year int, month int, day int"
    ).withColumn("entity", F.lit(None).cast(found.schema["entity"].dataType))
    write_states(found.unionByName(blank, allowMissingColumns=True), root)


def read_states(spark: SparkSession, root: str, schema) -> DataFrame:
    """Stored states under the schema that ``states`` had; empty ones are left out."""
    rows = spark.read.schema(schema).parquet(root)
    counts = [F.col(f"`{c}`").isNotNull() for c in rows.columns if c.endswith("_n")]
    present = counts[0]
    for count in counts[1:]:
        present = present | count
    return rows.where(present).drop(DAY)


def _mean(name: str) -> Column:
    n = F.sum(f"{name}_n")
    return (F.when(n > 0, F.sum(f"{name}_sum") / n)).alias(f"{name}_mean")


def annual(stored: DataFrame, metrics: Iterable[str]) -> DataFrame:
    """``profiles.annual_stats`` from states."""
    stats = []
    for name in metrics:
        stats += [
            _mean(name),
            F.min(f"{name}_min").alias(f"{name}_min"),
            F.max(f"{name}_max").alias(f"{name}_max"),
        ]
    by_year = stored.groupBy(F.col("year").alias("date"), "entity").agg(*stats)
    return by_year.orderBy("entity", "date")


def monthly(stored: DataFrame, metrics: Iterable[str]) -> DataFrame:
    """``profiles.monthly_means`` from states."""
    means = stored.groupBy("year", "month").agg(*map(_mean, metrics))
    return means.select(
        month_label(F.col("year"), F.col("month")).alias("date"),
        *[f"{name}_mean" for name in metrics],
        "year",
        "month",
    )


def hourly(stored: DataFrame, metrics: Iterable[str]) -> DataFrame:
    """``profiles.hourly_profile`` from states."""
    return stored.groupBy("entity", "hour").agg(*map(_mean, metrics))

"""Grouped means. Each is one partial and one final hash aggregate, so a hot entity costs one
row per map task on the shuffle, however many readings it has."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.calendar import month_label, within_year
from wattloom.functions.naming import named


def _means(metrics: Mapping[str, str]) -> list[Column]:
    return [F.avg(named(column)).alias(f"{name}_mean") for name, column in metrics.items()]


def annual_stats(
    readings: DataFrame,
    entity: str,
    metrics: Mapping[str, str],
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Mean, minimum and maximum of each metric per (year, entity), by entity and year.

    ``metrics`` maps an output prefix to a column. ``years`` keeps an inclusive range.
    """
    if years is not None:
        readings = readings.where(F.col("year").between(*years))
    stats = [
        fn(named(column)).alias(f"{name}_{label}")
        for name, column in metrics.items()
        for label, fn in (("mean", F.avg), ("min", F.min), ("max", F.max))
    ]
    return (
        readings.groupBy("year", entity)
        .agg(*stats)
        .withColumnRenamed("year", "date")
        .orderBy(entity, "date")
    )


def monthly_means(readings: DataFrame, metrics: Mapping[str, str]) -> DataFrame:
    """Mean of each metric per (year, month), labelled ``YYYY_MM``."""
    return (
        readings.groupBy("year", "month")
        .agg(*_means(metrics))
        .select(
            month_label(F.col("year"), F.col("month")).alias("date"),
            *[f"{name}_mean" for name in metrics],
            "year",
            "month",
        )
    )


def hourly_profile(readings: DataFrame, entity: str, metrics: Mapping[str, str]) -> DataFrame:
    """Mean of each metric per (entity, hour of day)."""
    return readings.groupBy(entity, "hour").agg(*_means(metrics))


def entity_year_mean(
    readings: DataFrame, entity: str, metric: str, year: int, name: str, time: str | None = None
) -> DataFrame:
    """Mean of one metric per entity in one year; entities without a value are left out.

    With ``time`` the year is a range on that column, otherwise equality on ``year``.
    """
    in_year = within_year(readings, time, year) if time else F.col("year") == year
    return (
        readings.where(in_year)
        .groupBy(entity)
        .agg(F.avg(named(metric)).alias(name))
        .where(named(name).isNotNull())
    )


def rows_per_entity(readings: DataFrame, entity: str) -> DataFrame:
    return readings.groupBy(entity).agg(F.count(F.lit(1)).alias("count")).orderBy(entity)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("count"))

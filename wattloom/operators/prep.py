"""Cleaning of raw readings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.calendar import calendar_parts
from wattloom.functions.naming import named


def drop_if_exists(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``DataFrame.drop`` passes over names that are not there."""
    return df.drop(*columns)


def prep_readings(
    raw: DataFrame, time: str, keep: Mapping[str, str], metrics: Mapping[str, str]
) -> DataFrame:
    """``datetime``, the kept columns, the metrics as doubles, then year, month, day and hour.

    ``keep`` and ``metrics`` map new names to raw names. A malformed time or number gives NULL
    and keeps its row. Times are UTC: a raw time without a zone is the UTC clock already, so its
    calendar parts are taken directly, without a conversion per row.
    """
    instant = F.try_to_timestamp(named(time))
    without_zone = isinstance(raw.schema[time].dataType, T.TimestampNTZType)
    return raw.select(
        instant.alias("datetime"),
        *[named(source).alias(name) for name, source in keep.items()],
        *[named(source).try_cast("double").alias(name) for name, source in metrics.items()],
        *calendar_parts(named(time) if without_zone else instant),
    )

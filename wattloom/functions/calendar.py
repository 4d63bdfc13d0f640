"""Calendar expressions over a timestamp column or its integer parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def calendar_parts(time: Column) -> list[Column]:
    return [
        F.year(time).alias("year"),
        F.month(time).alias("month"),
        F.dayofmonth(time).alias("day"),
        F.hour(time).alias("hour"),
    ]


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def month_label(year: Column, month: Column) -> Column:
    """``YYYY_MM``."""
    return F.concat(year.cast("string"), F.lit("_"), two_digits(month))


def hour_stamp(hour: Column) -> Column:
    """The hour of day on a fixed date, as a time axis for charts."""
    return F.concat(F.lit("2021-01-01T"), two_digits(hour), F.lit(":00:00Z"))


def within_year(df: DataFrame, time: str, year: int) -> Column:
    """``year(time) == year`` as a range on the raw column, which reaches the parquet scan."""
    kind = df.schema[time].dataType
    start, end = (F.lit(f"{y:04d}-01-01 00:00:00").cast(kind) for y in (year, year + 1))
    return (F.col(time) >= start) & (F.col(time) < end)

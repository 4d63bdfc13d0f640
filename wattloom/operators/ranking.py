"""Top-n rankings. NULL and NaN never rank, and a tie goes to the smaller label."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.functions.naming import named


def ranks(df: DataFrame, by: str) -> Column:
    """Whether a value takes part in a ranking."""
    there = named(by).isNotNull()
    if isinstance(df.schema[by].dataType, (T.DoubleType, T.FloatType)):
        there = there & ~F.isnan(named(by))
    return there


def top_n(df: DataFrame, by: str, n: int, descending: bool, tie_break: str) -> DataFrame:
    """The first n rows by one column: each task keeps n rows, nothing is sorted globally."""
    order = named(by).desc() if descending else named(by).asc()
    return df.where(ranks(df, by)).orderBy(order, named(tie_break)).limit(n)


def two_way_ranking(df: DataFrame, metrics: Mapping[str, str], n: int, tie_break: str) -> DataFrame:
    """The n highest and the n lowest rows by each metric, with ``rank_type`` and ``rank_num``.

    ``metrics`` maps a tag to a column; the rank types are ``{tag}_desc`` and ``{tag}_asc``. The
    input is evaluated once. A rank limit runs before the shuffle, so a map task sends at most n
    rows per rank type.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(f"{tag}_{way}").alias("rank_type"),
                F.when(ranks(df, column), sign * named(column)).alias("score"),
            )
            for tag, column in metrics.items()
            for way, sign in (("desc", -1), ("asc", 1))
        ]
    )
    order = Window.partitionBy("rank_type").orderBy("score", named(tie_break))
    return (
        df.select("*", F.inline(entries))
        .where(F.col("score").isNotNull())
        .withColumn("rank_num", F.row_number().over(order))
        .where(F.col("rank_num") <= n)
        .select("rank_type", "rank_num", *[named(c) for c in df.columns])
    )

"""Summaries of an hour-of-day profile.

A profile has at most 24 hours (and one row for an unknown hour) per entity, so the exact
percentile holds a fixed number of values per group. Both metrics are summarised in one pass
and then turned into rows, rather than aggregated twice and united.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.naming import named

QUARTILES = (0.25, 0.5, 0.75)


def five_numbers(profile: DataFrame, entity: str, metrics: Mapping[str, str]) -> DataFrame:
    """min, 25-perc, 50-perc, 75-perc and max per (entity, metric), with linear interpolation.

    ``metrics`` maps the tag written to ``data`` to a column of the profile.
    """
    summaries = [
        F.struct(
            F.min(named(column)).alias("min"),
            F.percentile(named(column), F.array(*map(F.lit, QUARTILES))).alias("q"),
            F.max(named(column)).alias("max"),
        ).alias(tag)
        for tag, column in metrics.items()
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(tag).alias("data"),
                named(tag)["min"].alias("min"),
                named(tag)["q"][0].alias("25-perc"),
                named(tag)["q"][1].alias("50-perc"),
                named(tag)["q"][2].alias("75-perc"),
                named(tag)["max"].alias("max"),
            )
            for tag in metrics
        ]
    )
    return profile.groupBy(entity).agg(*summaries).select(entity, F.inline(rows))


def approx_quartiles(
    profile: DataFrame,
    entity: str,
    metrics: Mapping[str, str],
    quartiles: Sequence[float] = QUARTILES,
    accuracy: int = 10000,
) -> DataFrame:
    """p25, p50 and p75 per (entity, metric) as members of the data.

    The sketch per group is bounded by ``accuracy``, so raw readings will do as well as a profile.
    """
    sketches = [
        F.percentile_approx(named(column), list(quartiles), accuracy).alias(tag)
        for tag, column in metrics.items()
    ]
    labels = [f"p{round(100 * q)}" for q in quartiles]
    rows = F.array(
        *[
            F.struct(
                F.lit(tag).alias("data"),
                *[named(tag)[i].alias(label) for i, label in enumerate(labels)],
            )
            for tag in metrics
        ]
    )
    return profile.groupBy(entity).agg(*sketches).select(entity, F.inline(rows))

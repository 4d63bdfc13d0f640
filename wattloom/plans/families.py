"""The ten families of published keys, and one for the spread of run times.

Fixed values: key prefixes and patterns. ``scope`` names the single entity of the monthly results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.calendar import hour_stamp, two_digits
from wattloom.sinks.keyed_json import to_key_value


def kv_annual_stats(stats: DataFrame, entity: str) -> DataFrame:
    return to_key_value(stats, "q1", [F.col("date"), F.col(entity)])


def kv_monthly_ranks(ranks: DataFrame, scope: str) -> DataFrame:
    position = ("rank_type", "rank_num")
    return to_key_value(ranks, f"q2:{scope}:rank", [F.col(c) for c in position], drop=position)


def kv_monthly_means(means: DataFrame, scope: str) -> DataFrame:
    return to_key_value(means, f"q2:{scope}:monthly_avg", [F.col("date")])


def kv_hourly_stats(stats: DataFrame, entity: str) -> DataFrame:
    keys = (entity, "data")
    return to_key_value(stats, "q3:stats", [F.col(c) for c in keys], drop=keys)


def kv_hourly_profile(profile: DataFrame, entity: str) -> DataFrame:
    hour = F.col("hour")
    return to_key_value(
        profile,
        "q3:hourly_avg",
        [F.col(entity), two_digits(hour)],
        extra={"time": hour_stamp(hour)},
    )


def kv_clusters(clusters: DataFrame, entity: str, method: str) -> DataFrame:
    """``method`` is ``silhouette`` or ``elbow``."""
    return to_key_value(clusters, f"clustering:{method}", [F.col(entity)])


def kv_curve(curve: DataFrame, method: str) -> DataFrame:
    return to_key_value(curve, method, [F.col("k")])


def kv_run_times(runs: DataFrame) -> DataFrame:
    keys = ("query_name", "query_type", "num_executors")
    return to_key_value(runs, "performance", [F.col(c) for c in keys])


def kv_run_stats(stats: DataFrame) -> DataFrame:
    """Number, mean and deviation of the runs, to four places."""
    keys = ("query_name", "query_type", "num_executors")
    rows = stats.select(
        *keys,
        "runs",
        F.round("mean_seconds", 4).alias("mean_seconds"),
        F.round("stddev_seconds", 4).alias("stddev_seconds"),
    )
    return to_key_value(rows, "performance_stats", [F.col(c) for c in keys], drop=keys)

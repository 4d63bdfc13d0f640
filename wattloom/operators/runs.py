"""Statistics of run times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.operators import statistics

RUN_KEYS = ("query_name", "query_type", "num_executors")


def measured_runs(
    spark: SparkSession,
    query_name: str,
    query_type: str,
    num_executors: int,
    seconds: Sequence[float],
) -> DataFrame:
    """One row per timed run of one query."""
    rows = [(query_name, query_type, num_executors, float(s)) for s in seconds]
    schema = "query_name string, query_type string, num_executors int, seconds double"
    return spark.createDataFrame(rows, schema)


def run_time_stats(runs: DataFrame, seconds: str = "seconds") -> DataFrame:
    """Runs, mean and sample standard deviation per (query, variant, executors).

    The deviation of a single run is NULL.
    """
    return runs.groupBy(*RUN_KEYS).agg(
        F.count(seconds).alias("runs"),
        F.avg(seconds).alias("mean_seconds"),
        F.stddev_samp(seconds).alias("stddev_seconds"),
    )


def run_parts(runs: DataFrame, seconds: str = "seconds") -> DataFrame:
    """Runs as rows that later ones merge with: count, mean and squared deviations."""
    return statistics.moments(runs, seconds, RUN_KEYS)


def merged_run_stats(parts: DataFrame) -> DataFrame:
    """``run_time_stats`` of all runs of all parts."""
    n, m2 = F.col("n"), F.col("m2")
    return statistics.merged(parts, RUN_KEYS).select(
        *RUN_KEYS,
        n.alias("runs"),
        F.col("mean").alias("mean_seconds"),
        F.when(n > 1, F.sqrt(m2 / (n - 1))).alias("stddev_seconds"),
    )


def run_log_rows(stats: DataFrame) -> DataFrame:
    """The logged row per (query, variant, executors): the mean, to four places."""
    return stats.select(
        "query_name",
        "query_type",
        F.round("mean_seconds", 4).alias("avg_execution_time_seconds"),
        "num_executors",
    )

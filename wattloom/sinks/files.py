"""File sinks.

Rows are rebalanced before a write: Spark splits a partition that is too large, whatever its key,
and merges small ones. A hot entity becomes several files, a small result becomes one file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_readings(readings: DataFrame, path: str, entity: str, time: str = "datetime") -> None:
    """Parquet partitioned by entity, each file in time order so that row groups can be skipped."""
    (
        readings.hint("rebalance", F.col(entity))
        .sortWithinPartitions(entity, time)
        .write.partitionBy(entity)
        .mode("overwrite")
        .parquet(path)
    )


def write_result(result: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """CSV with header. A small result is one file in the given order."""
    rows = result.hint("rebalance")
    if order_by:
        rows = rows.sortWithinPartitions(*order_by)
    rows.write.csv(path, header=True, mode="overwrite")


def write_run_log(log: DataFrame, root: str) -> None:
    """One CSV per (query, executors, variant); logging a run again replaces only its own file."""
    (
        log.hint("rebalance")
        .write.option("partitionOverwriteMode", "dynamic")
        .partitionBy("query_name", "num_executors", "query_type")
        .csv(root, header=True, mode="overwrite")
    )


def append_run_part(parts: DataFrame, root: str) -> None:
    """Add rows (keys, n, mean, m2) to the runs that are there."""
    parts.hint("rebalance").write.mode("append").parquet(f"{root}/parts")


def evaluate(df: DataFrame) -> None:
    """Run a query in full and discard its rows."""
    df.write.format("noop").mode("overwrite").save()


def show(result: DataFrame, rows: int = 100) -> None:
    """Print schema and rows of a result on the console; only ``rows`` rows reach the driver."""
    result.printSchema()
    result.show(rows, truncate=False)

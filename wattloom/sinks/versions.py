"""Small tables kept in numbered versions. A version counts once its write has ended; what a writer
that was cut off left behind is written over by the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def file_status(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match, by the file system of the path; none if its root is not there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().toString() for status in files.globStatus(path) or []]


def exists(spark: SparkSession, pattern: str) -> bool:
    return bool(file_status(spark, pattern))


def latest(spark: SparkSession, root: str) -> int:
    """The number of the last whole version, 0 if there is none."""
    found = file_status(spark, f"{root}/v=*/_SUCCESS")
    return max((int(path.rsplit("/v=", 1)[1].split("/")[0]) for path in found), default=0)


def read_latest(spark: SparkSession, root: str, schema) -> DataFrame:
    """The last whole version; no rows if there is none."""
    number = latest(spark, root)
    if not number:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/v={number}")


def write_next(rows: DataFrame, root: str) -> int:
    """Write the next version; the ones before stay readable."""
    number = latest(rows.sparkSession, root) + 1
    rows.write.mode("overwrite").parquet(f"{root}/v={number}")
    return number

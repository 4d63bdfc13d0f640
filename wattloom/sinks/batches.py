"""Readings that grow by batches: a run reads the raw files that are new, and no other.

    <root>/batches/batch=<n>/<entity>=<value>/…   the readings of one run
    <root>/manifest/v=<n>                          which raw files are in which batch

A batch counts once a manifest names it. A run that was cut off left a batch that none names, and the
next run writes over it. A raw file that changed or went makes its batch void: the files of that batch
that are still there are read again, with the new ones, into a new batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.session import fresh_folder
from wattloom.sinks import versions
from wattloom.sinks.files import write_readings

FILE = ("path", "length", "modified")
MANIFEST = "batch int, path string, length long, modified timestamp"


def listing(spark: SparkSession, pattern: str) -> DataFrame:
    """Rows (path, length, modified) of the files that match; their content is not read."""
    if not versions.exists(spark, pattern):
        return spark.createDataFrame([], "path string, length long, modified timestamp")
    files = spark.read.format("binaryFile").load(pattern)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def manifest(spark: SparkSession, root: str) -> DataFrame:
    return versions.read_latest(spark, f"{root}/manifest", MANIFEST)


def add_new_files(
    spark: SparkSession,
    pattern: str,
    root: str,
    entity: str,
    read: Callable[[Sequence[str]], DataFrame],
) -> list[str]:
    """Bring the batches up to the raw files that match; the paths that were read. ``read`` gives the
    cleaned readings of some paths."""
    known = manifest(spark, root)
    path = fresh_folder(spark, "listing")
    listing(spark, pattern).write.parquet(path)
    found = spark.read.parquet(path)
    void = known.join(found, list(FILE), "left_anti").select("batch").distinct()
    live = known.join(void, "batch", "left_anti")
    open_files = found.join(live, list(FILE), "left_anti")
    # File names only, as the reader needs them.
    paths = sorted(row.path for row in open_files.select("path").collect())
    if not paths and void.isEmpty():
        return []
    number = versions.latest(spark, f"{root}/manifest") + 1
    if paths:
        write_readings(read(paths), f"{root}/batches/batch={number}", entity)
    added = open_files.select(F.lit(number).alias("batch"), *FILE)
    versions.write_next(live.select("batch", *FILE).unionByName(added), f"{root}/manifest")
    return paths


def read_batches(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The readings of all batches that count, under the given schema."""
    numbers = [row.batch for row in manifest(spark, root).select("batch").distinct().collect()]
    if not numbers:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/batches/batch={n}" for n in sorted(numbers)]
    readings = spark.read.schema(schema).option("basePath", f"{root}/batches").parquet(*paths)
    return readings.drop("batch")

"""Readers. Filters are plain predicates, so they prune partitions and reach the parquet scan."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.naming import named
from wattloom.sinks.batches import listing
from wattloom.sinks.versions import exists

log = logging.getLogger(__name__)


def read_raw(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """Raw parquet files two directory levels below the root. Without a schema, that of one
    footer holds for all."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root}/*/*/*.parquet")


def typed(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The given columns under the given types: NULL where a column is not there or a value does not
    fit."""
    return df.select(
        *[
            (named(c).try_cast(kind) if c in df.columns else F.lit(None).cast(kind)).alias(c)
            for c, kind in columns.items()
        ]
    )


def footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Rows (path, shape): the columns and types in the footer of each parquet file, read in tasks.

    Files in a store that pyarrow does not open are handed to the tasks by Spark.
    """
    known = all(p.split(":")[0] in ("file", "hdfs", "s3", "s3a", "gs", "abfs", "abfss") for p in paths)
    files = spark.read.format("binaryFile").load(list(paths))
    files = files.select("path", F.lit(None).cast("binary").alias("content") if known else "content")

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            shapes = []
            for path, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if content is None:
                    uri = path.replace("file:/", "file:///") if path.startswith("file:/") else path
                    store, place = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://"))
                    with store.open_input_file(place) as source:
                        shape = pq.read_schema(source)
                else:
                    shape = pq.read_schema(pa.BufferReader(content))
                shapes.append(", ".join(f"{f.name} {f.type}" for f in shape))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shapes, pa.string())], ["path", "shape"])

    return files.repartition(max(1, min(len(paths) // 16, 512))).mapInArrow(read, "path string, shape string")


def read_files(spark: SparkSession, paths: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Parquet files that need not have the same columns or types, as rows of the given ones.

    Files of one shape are read together, so there are as many scans as shapes, and a value is cast
    from the type that its file has.
    """
    if not paths:
        return spark.createDataFrame([], ", ".join(f"`{c}` {kind}" for c, kind in columns.items()))
    groups: dict[str, list[str]] = {}
    for row in footers(spark, paths).collect():  # names and shapes of files, no data
        groups.setdefault(row.shape, []).append(row.path)
    parts = [typed(spark.read.parquet(*sorted(group)), columns) for _, group in sorted(groups.items())]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def raw_pattern(root: str) -> str:
    return f"{root}/*/*/*.parquet"


def read_mixed(spark: SparkSession, root: str, columns: Mapping[str, str]) -> DataFrame:
    """The raw files under a root, whatever their shapes; no rows if there are none."""
    if not exists(spark, raw_pattern(root)):
        log.warning("no raw files under %s", root)
    paths = [row.path for row in listing(spark, raw_pattern(root)).select("path").collect()]
    return read_files(spark, paths, columns)


def read_readings(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Entity-partitioned readings. The root is read, not leaf folders, so the entity column is
    there; the schema is given, so nothing is inferred from folder names."""
    return spark.read.schema(schema).parquet(root)


def entity_subset(readings: DataFrame, entity: str, entities: Sequence[str]) -> DataFrame:
    return readings.where(F.col(entity).isin(list(entities)))


def single_entity(readings: DataFrame, entity: str, value: str) -> DataFrame:
    return readings.where(F.col(entity) == value)


# Columns are taken by position, so the header is compared with the schema.
CHECKED = {"header": True, "enforceSchema": False, "mode": "FAILFAST"}


def read_result(spark: SparkSession, path: str, schema) -> DataFrame:
    """A result CSV with header and known schema; another header or a malformed value is an error."""
    return spark.read.schema(schema).options(**CHECKED).csv(path)


PART_SCHEMA = (
    "query_name string, query_type string, num_executors int, n long, mean double, m2 double"
)
RUNS_SCHEMA = (
    "avg_execution_time_seconds double, query_name string, num_executors int, query_type string"
)


def read_run_log(spark: SparkSession, root: str) -> DataFrame:
    """All files of the run log, three partition levels below the root."""
    return (
        spark.read.schema(RUNS_SCHEMA)
        .option("basePath", root)
        .options(**CHECKED)
        .csv(f"{root}/*/*/*/*.csv")
        .select("query_name", "query_type", "avg_execution_time_seconds", "num_executors")
    )


def read_run_parts(spark: SparkSession, root: str) -> DataFrame:
    """The parts of all runs, none if none were logged."""
    if not exists(spark, f"{root}/parts"):
        return spark.createDataFrame([], PART_SCHEMA)
    return spark.read.schema(PART_SCHEMA).parquet(f"{root}/parts")

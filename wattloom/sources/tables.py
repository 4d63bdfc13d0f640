"""The given tables in the roles of the readings.

``lineitem`` plays the annual and monthly readings (entity: return flag), ``events`` the hourly
ones (entity: event type) and the ones to cluster (entity: user).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.operators.prep import prep_readings

METRICS = {"m1": "m1", "m2": "m2"}
MEANS = {"m1": "m1_mean", "m2": "m2_mean"}

# Schemas of the given tables.
SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
        " props string"
    ),
}

TYPES = {name: dict(c.split() for c in schema.split(", ")) for name, schema in SCHEMAS.items()}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table under its known schema, which spares a job that reads footers to infer it."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def shipment_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep_readings(
        table(spark, sf_dir, "lineitem"),
        time="l_shipdate",
        keep={"entity": "l_returnflag"},
        metrics={"m1": "l_extendedprice", "m2": "l_discount"},
    )


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_readings_of(table(spark, sf_dir, "events"))


def event_readings_of(events: DataFrame) -> DataFrame:
    return prep_readings(
        events.withColumn("k", F.get_json_object("props", "$.k")),
        time="ts",
        keep={"entity": "event_type"},
        metrics={"m1": "value", "m2": "k"},
    )


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time, user and value under raw types, so that a range on time reaches the scan."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("datetime"), F.col("user_id").alias("entity"), F.col("value").alias("m1")
    )


def shipment_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` in the role of a run log: flag, status, line number and quantity."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("query_name"),
        F.col("l_linestatus").alias("query_type"),
        F.col("l_linenumber").alias("num_executors"),
        F.col("l_quantity").alias("seconds"),
    )

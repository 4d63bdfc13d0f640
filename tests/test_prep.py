from __future__ import annotations

import datetime

from wattloom.operators.prep import drop_if_exists, prep_readings
from wattloom.plans import questions
from wattloom.sources.electricity import RAW_DROP

RAW = (
    "Datetime__UTC_ string, Country string, Zone_id string,"
    " Carbon_intensity_gCO_eq_kWh__direct_ string, Carbon_free_energy_percentage__CFE__ string"
)

PROCESSED = [
    "datetime", "country_code", "country", "carbon_intensity", "carbon_free_percentage",
    "year", "month", "day", "hour",
]


def test_tolerant_casts_keep_every_row(spark):
    raw = spark.createDataFrame(
        [
            ("2021-01-01T05:00:00Z", "Italy", "IT", "1.5", "20"),
            ("2021-01-01 06:00:00", "Italy", "IT", "N/A", None),
            ("yesterday", "Italy", "IT", "2", "30.25"),
        ],
        RAW,
    )
    rows = questions.clean(raw).collect()
    assert questions.clean(raw).columns == PROCESSED
    assert len(rows) == 3
    first, second, third = rows
    assert (first.year, first.month, first.day, first.hour) == (2021, 1, 1, 5)
    assert first.datetime == datetime.datetime(2021, 1, 1, 5)
    assert (first.carbon_intensity, first.carbon_free_percentage) == (1.5, 20.0)
    assert (second.hour, second.carbon_intensity, second.carbon_free_percentage) == (6, None, None)
    assert (third.datetime, third.year, third.hour) == (None, None, None)
    assert (third.carbon_intensity, third.carbon_free_percentage) == (2.0, 30.25)


def test_schema_is_the_processed_one(spark):
    kinds = dict(questions.clean(spark.createDataFrame([], RAW)).dtypes)
    assert kinds["datetime"] == "timestamp"
    assert kinds["carbon_intensity"] == kinds["carbon_free_percentage"] == "double"
    assert {kinds[c] for c in ("year", "month", "day", "hour")} == {"int"}


def test_numbers_and_timestamps_pass_through(spark):
    raw = spark.createDataFrame(
        [(datetime.datetime(2024, 2, 29, 23), "Italy", "IT", 7.25, 1.0)],
        RAW.replace("Datetime__UTC_ string", "Datetime__UTC_ timestamp")
        .replace("direct_ string", "direct_ double")
        .replace("CFE__ string", "CFE__ double"),
    )
    row = questions.clean(raw).first()
    assert (row.year, row.month, row.day, row.hour, row.carbon_intensity) == (2024, 2, 29, 23, 7.25)


def test_times_without_a_zone_are_the_utc_clock(spark):
    raw = spark.sql("SELECT timestamp_ntz'2024-12-31 23:30:00' AS t, 'x' AS e, 1 AS v")
    row = prep_readings(raw, "t", {"entity": "e"}, {"m1": "v"}).first()
    assert row.datetime == datetime.datetime(2024, 12, 31, 23, 30)
    assert (row.year, row.month, row.day, row.hour, row.m1) == (2024, 12, 31, 23, 1.0)


def test_drop_if_exists(spark):
    df = spark.createDataFrame([(1, "a", "b")], "id int, Zone_name string, Data_source string")
    assert drop_if_exists(df, RAW_DROP).columns == ["id"]
    assert drop_if_exists(df.select("id"), RAW_DROP).columns == ["id"]

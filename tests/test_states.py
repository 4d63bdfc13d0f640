from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from wattloom.operators import prep, profiles, states

METRICS = {"m1": "m1", "m2": "m2"}
DAY = datetime.date(2024, 2, 3)


def made(spark, rows):
    raw = spark.createDataFrame(rows, "t string, e string, a double, b double")
    return prep.prep_readings(raw, "t", {"entity": "e"}, {"m1": "a", "m2": "b"})


def drawn(seed, day_shift=0.0):
    rng = random.Random(seed)
    rows = [(None, "IT", 1.0, 2.0), ("bad", "SE", 3.0, None)]
    for month in (1, 2):
        for day in (1, 2, 3):
            for hour in (0, 5, 23):
                for e in ("IT", "SE", None):
                    for _ in range(rng.randrange(3)):
                        shift = day_shift if (month, day) == (2, 3) else 0.0
                        value = None if rng.random() < 0.2 else rng.gauss(50, 9) + shift
                        rows.append((f"2024-0{month}-0{day} {hour:02d}:{rng.randrange(60):02d}:00", e, value, rng.random()))
    return rows


def rows_of(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def check(readings, stored):
    pairs = [
        (states.annual(stored, METRICS), profiles.annual_stats(readings, "entity", METRICS)),
        (states.monthly(stored, METRICS), profiles.monthly_means(readings, METRICS)),
        (states.hourly(stored, METRICS), profiles.hourly_profile(readings, "entity", METRICS)),
    ]
    for found, expected in pairs:
        assert sorted(found.columns) == sorted(expected.columns)
        assert rows_of(found.select(*expected.columns)) == rows_of(expected)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "states")


def test_states_merge_into_the_profiles(spark, root):
    readings = made(spark, drawn(1))
    found = states.states(readings, "entity", METRICS)
    states.write_states(found, root)
    check(readings, states.read_states(spark, root, states.with_day(found).schema))


def test_a_corrected_day_replaces_its_own_state_only(spark, root, tmp_path):
    before, after = made(spark, drawn(2)), made(spark, drawn(2, day_shift=7.0))
    found = states.states(before, "entity", METRICS)
    schema = states.with_day(found).schema
    states.write_states(found, root)
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "states").rglob("*.parquet") if "20240203" not in str(p)}
    states.replace_days(after, root, "entity", METRICS, [DAY, DAY])
    check(after, states.read_states(spark, root, schema))
    assert untouched and all(p.stat().st_mtime_ns == t for p, t in untouched.items())


def test_a_day_without_readings(spark, root):
    readings = made(spark, drawn(3))
    found = states.states(readings, "entity", METRICS)
    states.write_states(found, root)
    left = readings.where(~F.coalesce(F.to_date("datetime") == F.lit(DAY), F.lit(False)))
    states.replace_days(left, root, "entity", METRICS, [DAY])
    check(left, states.read_states(spark, root, states.with_day(found).schema))


def test_only_the_days_are_read(spark, tmp_path):
    path = str(tmp_path / "readings")
    made(spark, drawn(4)).write.parquet(path)
    plan = states.on_days(spark.read.parquet(path), "datetime", [DAY])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(datetime,2024" in plan
    assert "datetime#" in plan and "< 2024-02-04 00:00:00" in plan

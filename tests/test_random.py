"""Operators against plain Python on random readings with gaps, ties and a hot entity."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from tests.brute import percentile
from wattloom.operators import profiles, ranking, summary

METRICS = {"m1": "m1", "m2": "m2"}
MEANS = {"m1": "m1_mean", "m2": "m2_mean"}
SCHEMA = "entity string, year int, month int, hour int, m1 double, m2 double"
SEEDS = (11, 12, 13)


def draw(seed):
    rng = random.Random(seed)

    def value():
        return None if rng.random() < 0.2 else float(rng.randint(-20, 20))

    rows = []
    for _ in range(1500):
        entity = "hot" if rng.random() < 0.4 else rng.choice("abcd")
        rows.append(
            (entity, rng.randint(2021, 2024), rng.randint(1, 12), rng.randint(0, 23), value(), value())
        )
    # One entity has no second metric at all.
    return [(*r[:5], None) if r[0] == "d" else r for r in rows]


def grouped(rows, key):
    groups = defaultdict(list)
    for row in rows:
        groups[key(row)].append(row)
    return groups


def mean(rows, i):
    values = [r[i] for r in rows if r[i] is not None]
    return sum(values) / len(values) if values else None


def near(value):
    return value if value is None else pytest.approx(value, abs=1e-9)


@pytest.fixture(params=SEEDS)
def rows(request):
    return draw(request.param)


@pytest.fixture
def readings(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


def test_annual_stats(readings, rows):
    expected = grouped(rows, lambda r: (r[1], r[0]))
    found = profiles.annual_stats(readings, "entity", METRICS).collect()
    assert [(r.entity, r.date) for r in found] == sorted((e, y) for y, e in expected)
    for r in found:
        group = expected[r.date, r.entity]
        for name, i in (("m1", 4), ("m2", 5)):
            values = [g[i] for g in group if g[i] is not None]
            assert r[f"{name}_mean"] == near(mean(group, i))
            assert r[f"{name}_min"] == min(values, default=None)
            assert r[f"{name}_max"] == max(values, default=None)


def test_rankings(readings, rows):
    months = {
        f"{y}_{m:02d}": (mean(g, 4), mean(g, 5))
        for (y, m), g in grouped(rows, lambda r: (r[1], r[2])).items()
    }
    means = profiles.monthly_means(readings, METRICS).select("date", "m1_mean", "m2_mean")
    assert {r.date: (near(r.m1_mean), near(r.m2_mean)) for r in means.collect()} == months
    found = defaultdict(list)
    for r in ranking.two_way_ranking(means, MEANS, 5, "date").orderBy("rank_num").collect():
        found[r.rank_type].append(r.date)
    for i, name in enumerate(METRICS):
        for way, sign in (("desc", -1), ("asc", 1)):
            ranked = sorted(
                (d for d in months if months[d][i] is not None),
                key=lambda d: (sign * months[d][i], d),
            )[:5]
            assert found[f"{name}_{way}"] == ranked
            top = ranking.top_n(means, f"{name}_mean", 5, way == "desc", "date")
            assert [r.date for r in top.collect()] == ranked


def test_five_numbers(readings, rows):
    cells = {k: (mean(g, 4), mean(g, 5)) for k, g in grouped(rows, lambda r: (r[0], r[3])).items()}
    profile = profiles.hourly_profile(readings, "entity", METRICS)
    assert {(r.entity, r.hour): (near(r.m1_mean), near(r.m2_mean)) for r in profile.collect()} == cells
    found = {(r.entity, r.data): r for r in summary.five_numbers(profile, "entity", MEANS).collect()}
    assert set(found) == {(e, d) for e, _ in cells for d in METRICS}
    for (entity, data), r in found.items():
        i = list(METRICS).index(data)
        values = [v[i] for (e, _), v in cells.items() if e == entity and v[i] is not None]
        numbers = [r[c] for c in ("min", "25-perc", "50-perc", "75-perc", "max")]
        if not values:
            assert numbers == [None] * 5
            continue
        expected = [min(values), *(percentile(values, p) for p in (0.25, 0.5, 0.75)), max(values)]
        assert numbers == pytest.approx(expected, abs=1e-9)


def test_year_means(readings, rows):
    group = grouped([r for r in rows if r[1] == 2023], lambda r: r[0])
    expected = {e: near(mean(g, 5)) for e, g in group.items() if mean(g, 5) is not None}
    found = profiles.entity_year_mean(readings, "entity", "m2", 2023, "mean").collect()
    assert {r.entity: r.mean for r in found} == expected
    assert "d" not in expected

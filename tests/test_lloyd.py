from __future__ import annotations

import hashlib
import math
import random

import pytest

from tests.brute import elbow, least_wcss, silhouette, wcss
from wattloom.operators import clustering, lloyd, statistics


def feature_rows(spark, values):
    rows = [(f"e{i:03d}", v) for i, v in enumerate(values)]
    return clustering.feature_table(spark.createDataFrame(rows, "entity string, value double"), "entity", "value")


def plain_fit(values, k, seed):
    """One fit alone, in plain loops: ascending centres and passes."""

    def order(x):
        return hashlib.md5(f"{seed}:{math.floor(x * 1000)}".encode()).hexdigest(), x

    centers = sorted(sorted(set(values), key=order)[:k])
    passes = 0
    while passes < 20:
        groups = {}
        for x in values:
            groups.setdefault(min(range(len(centers)), key=lambda i: (abs(x - centers[i]), i)), []).append(x)
        moved = [sum(groups[i]) / len(groups[i]) if i in groups else c for i, c in enumerate(centers)]
        passes += 1
        still = any(abs(a - b) > 1e-4 for a, b in zip(centers, moved))
        centers = moved
        if not still:
            break
    return sorted(centers), passes


def plain_labels(values, centers):
    return [min(range(len(centers)), key=lambda i: (abs(x - centers[i]), i)) for x in values]


@pytest.fixture(scope="module")
def values():
    rng = random.Random(7)
    return [round(rng.choice((5, 90, 300, 480, 640)) + rng.gauss(0, 15), 3) for _ in range(60)]


@pytest.fixture(scope="module")
def features(spark, values):
    return feature_rows(spark, values)


def test_the_sweep_equals_fits_one_by_one(features, values):
    sweep = lloyd.k_sweep(features, "value")
    slowest = 0
    for row in sweep.curve.collect():
        fits = [plain_fit(values, row.k, seed) for seed in lloyd.SEEDS]
        slowest = max(slowest, *(passes for _, passes in fits))
        costs = [wcss(values, plain_labels(values, centers)) for centers, _ in fits]
        assert row.wcss == pytest.approx(min(costs), rel=1e-9)
        assert sweep.centers[row.k] == pytest.approx(fits[costs.index(min(costs))][0], rel=1e-9)
        labels = plain_labels(values, sweep.centers[row.k])
        assert row.silhouette == pytest.approx(silhouette(values, labels), abs=1e-9)
    assert sorted(sweep.centers) == list(range(2, 16))
    assert sweep.passes == slowest  # not the sum over the fits


def test_jobs_do_not_grow_with_the_fits(spark, features, monkeypatch):
    passes = []
    real = lloyd.labelled

    def counted(*arguments):
        passes.append(arguments)
        return real(*arguments)

    monkeypatch.setattr(lloyd, "labelled", counted)
    sweep = lloyd.k_sweep(features, "value", seeds=(1, 2, 3, 4, 5))
    assert len(passes) == sweep.passes + 1 <= lloyd.MAX_PASSES + 1


@pytest.mark.parametrize("method", ["elbow", "silhouette"])
def test_choice(features, values, method):
    found, curve = lloyd.cluster_by_choice(features, "entity", "value", method)
    column = "wcss" if method == "elbow" else "silhouette"
    assert curve.columns == ["k", column]
    points = [(r.k, r[column]) for r in curve.collect()]
    k = elbow(points) if method == "elbow" else max(points, key=lambda p: (p[1], -p[0]))[0]
    rows = found.collect()
    assert [(r.cluster, r.value) for r in rows] == sorted((r.cluster, r.value) for r in rows)
    assert {r.cluster for r in rows} == set(range(k))
    assert sorted(r.value for r in rows) == sorted(values)


def test_starts_do_not_depend_on_parts(spark, values):
    once, again = (
        lloyd.k_sweep(clustering.feature_table(
            spark.createDataFrame([(f"e{i}", v) for i, v in enumerate(order)], "entity string, value double")
            .repartition(parts), "entity", "value", parts), "value").centers
        for order, parts in ((values, 2), (values[::-1], 7))
    )
    assert {k: pytest.approx(c, rel=1e-12) for k, c in once.items()} == again


def test_costs_come_near_the_least(features, values):
    costs = {r.k: r.wcss for r in lloyd.k_sweep(features, "value", with_silhouette=False).curve.collect()}
    for k, cost in costs.items():
        assert cost >= least_wcss(values, k) - 1e-6
    # Three random starts need not find it, but for as many clusters as there are groups they come near.
    assert costs[5] <= 10 * least_wcss(values, 5)


@pytest.mark.parametrize("values", [[], [1.0], [None], [None, 2.0, float("nan")]])
def test_fewer_than_two_points(spark, values):
    found, curve = lloyd.cluster_by_choice(feature_rows(spark, values), "entity", "value", "elbow")
    assert found.isEmpty() and curve.isEmpty()
    assert found.dtypes == [("entity", "string"), ("value", "double"), ("cluster", "int")]


def test_equal_points(spark):
    sweep = lloyd.k_sweep(feature_rows(spark, [4.0, 4.0, 4.0]), "value")
    assert [tuple(r) for r in sweep.curve.orderBy("k").collect()] == [(2, 0.0, None), (3, 0.0, None)]
    two = lloyd.k_sweep(feature_rows(spark, [4.0, 4.0, 9.0]), "value")
    assert [tuple(r) for r in two.curve.orderBy("k").collect()] == [(2, 0.0, pytest.approx(2 / 3)), (3, 0.0, pytest.approx(2 / 3))]


def test_given_centers_are_scored_in_two_passes(features, values):
    centers = {3: [0.0, 300.0, 600.0], 2: [600.0, 100.0]}
    for row in lloyd.rescored(features, "value", centers).collect():
        labels = plain_labels(values, centers[row.k])
        assert row.wcss == pytest.approx(wcss(values, labels), rel=1e-9)
        assert row.silhouette == pytest.approx(silhouette(values, labels), abs=1e-9)


def test_parts_merge_into_the_whole(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.randrange(4), 1e9 + rng.random()) for _ in range(500)] + [("c", 0, None)]
    rows += [(None, 1, 2.0), (None, 2, 4.0)]
    frame = spark.createDataFrame(rows, "g string, part int, x double")
    parts = statistics.moments(frame, "x", ("g", "part"))
    whole = {r.g: r for r in statistics.moments(frame, "x", ("g",)).collect()}
    merged = {r.g: r for r in statistics.merged(parts, ("g",)).collect()}
    assert set(merged) == set(whole) == {"a", "b", None}
    for g, row in whole.items():
        assert (merged[g].n, merged[g].mean) == (row.n, pytest.approx(row.mean, rel=1e-15))
        assert merged[g].m2 == pytest.approx(row.m2, rel=1e-6)

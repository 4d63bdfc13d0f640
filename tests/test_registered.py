"""Checks on registered queries that the SQL does not cover."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tests.brute import elbow, least_wcss, silhouette, wcss
from wattloom.operators import clustering
from wattloom.sources.tables import SCHEMAS, table

QUERIES = {n: entry_points.in_utc(q) for n, q in entry_points.REGISTERED.items()}
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def means(spark):
    rows = entry_points.year_means(spark, SMALL).orderBy("entity").collect()
    return {r.entity: r.m1_mean for r in rows}


@pytest.fixture(scope="module")
def features(spark):
    return entry_points.feature_rows(entry_points.year_means(spark, SMALL))


def scores_of(features, score):
    sweep = clustering.k_sweep(features, with_silhouette=score == "silhouette")
    return [(r.k, r[score]) for r in sweep.curve.collect()]


def labels_of(features, method, means):
    found, _ = clustering.cluster_by_choice(features, "entity", "m1_mean", method)
    rows = {r.entity: r for r in found.collect()}
    assert {e: pytest.approx(r.m1_mean) for e, r in rows.items()} == means
    return [rows[e].cluster for e in means]


def test_sweeps_score_every_k(features, means):
    values = list(means.values())
    costs, scores = (dict(scores_of(features, s)) for s in ("wcss", "silhouette"))
    assert sorted(costs) == sorted(scores) == list(range(2, min(15, len(values)) + 1))
    for k, cost in costs.items():
        assert cost >= least_wcss(values, k) - 1e-9
        assert -1 <= scores[k] <= 1


def test_elbow_clusters(features, means):
    costs = scores_of(features, "wcss")
    labels = labels_of(features, "elbow", means)
    k = len(set(labels))
    assert k == elbow(costs)
    assert wcss(list(means.values()), labels) == pytest.approx(dict(costs)[k])


def test_silhouette_clusters(features, means):
    scores = scores_of(features, "silhouette")
    labels = labels_of(features, "silhouette", means)
    k, best = max(scores, key=lambda p: (p[1], -p[0]))
    assert len(set(labels)) == k
    assert silhouette(list(means.values()), labels) == pytest.approx(best, abs=1e-6)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("kv_")))
def test_published_keys_are_unique(spark, name):
    keys = QUERIES[name](spark, SMALL).groupBy("key").count()
    assert keys.where(F.col("count") > 1).isEmpty()
    assert not keys.isEmpty()


@pytest.mark.parametrize(
    ("first", "second"),
    [
        ("annual_stats", "annual_stats_sql"),
        ("monthly_top5", "monthly_top5_sql"),
        ("hourly_five_number", "hourly_five_number_sql"),
    ],
)
def test_twins_agree(spark, first, second):
    def rows(name):
        df = QUERIES[name](spark, SMALL)
        return sorted(map(repr, df.collect())), df.schema.simpleString()

    assert rows(first) == rows(second)


def test_the_year_reaches_the_scan(spark):
    plan = QUERIES["entity_year_mean"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00), LessThan(ts,2025-01-01T00:00)" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_only_needed_columns_are_read(spark):
    plan = QUERIES["annual_stats"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" not in plan and "l_tax" not in plan


@pytest.mark.parametrize("name", sorted(SCHEMAS))
@pytest.mark.parametrize("scale", ["0.001", "0.01", "0.1"])
def test_known_schemas_are_those_of_the_files(spark, scale, name):
    found = spark.read.parquet(f"/root/testdata/sf{scale}/{name}.parquet").dtypes
    assert found == table(spark, f"/root/testdata/sf{scale}", name).dtypes


def plan_of(spark, name):
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


#: Joined by key with one row per group, checked in size before it is broadcast.
JOINING = {"reading_quartiles", "merged_run_stats"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - JOINING - {n for n in QUERIES if "sweep" in n}))
def test_no_plan_joins_broadcasts_or_calls_python(spark, name):
    plan = plan_of(spark, name)
    for operator in ("Join", "CartesianProduct", "BroadcastExchange", "Python", "InPandas"):
        assert operator not in plan


@pytest.mark.parametrize(
    "name",
    ["annual_stats", "monthly_means", "hourly_profile", "entity_year_mean", "rows_per_entity",
     "row_count", "run_time_stats", "wcss_given_labels"],
)
def test_groups_are_aggregated_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    scan, shuffle = plan.index("FileScan"), plan.rindex("Exchange")
    assert shuffle < plan.rindex("partial_") < scan


def test_one_scan_serves_all_rankings_and_both_metrics(spark):
    for name in ("monthly_top5", "monthly_top5_sql", "hourly_five_number", "hourly_five_number_sql"):
        assert plan_of(spark, name).count("FileScan") == 1

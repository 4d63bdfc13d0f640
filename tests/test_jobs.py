"""All jobs in turn, from raw files to published pairs."""

from __future__ import annotations

import csv
import glob
import json

import pytest
from pyspark.sql import functions as F

from wattloom import jobs
from wattloom.operators.profiles import entity_year_mean
from wattloom.operators.runs import measured_runs, run_log_rows, run_time_stats
from wattloom.plans import questions
from wattloom.sinks.files import write_readings, write_run_log
from wattloom.sources.scans import entity_subset, read_result
from wattloom.sources import electricity as names

CODES = {"Italy": "IT", "Sweden": "SE", "Great Britain": "GB", "South Korea": "KR"}


@pytest.fixture(scope="module")
def roots(tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    return {name: str(base / name) for name in ("raw", "readings", "results", "pairs")}


@pytest.fixture(scope="module")
def done(spark, roots):
    countries = spark.createDataFrame(
        [(c, CODES.get(c, c[:2].upper() + str(i)), i) for i, c in enumerate(names.THIRTY_COUNTRIES)]
        + [("Atlantis", "XX", 99)],
        "Country string, Zone_id string, level int",
    )
    hours = spark.sql(
        "SELECT explode(sequence(timestamp'2023-11-01', timestamp'2024-05-31 23:00:00',"
        " interval 7 hours)) AS t"
    )
    raw = countries.join(hours).select(
        F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("Datetime__UTC_"),
        "Country",
        "Zone_id",
        F.lit("x").alias("Zone_name"),
        F.format_string("%.2f", 20 * F.col("level") + F.hour("t") + F.month("t") * 0.5).alias(
            "Carbon_intensity_gCO_eq_kWh__direct_"
        ),
        (F.lit(100.0) - F.col("level") - F.hour("t") * 0.1).alias(
            "Carbon_free_energy_percentage__CFE__"
        ),
    )
    for year in (2023, 2024):
        raw.where(F.substring("Datetime__UTC_", 1, 4) == str(year)).write.parquet(
            f"{roots['raw']}/zone/{year}"
        )
    jobs.prep(spark, roots["raw"], roots["readings"])
    jobs.annual(spark, roots["readings"], roots["results"])
    jobs.monthly(spark, roots["readings"], roots["results"])
    jobs.hourly(spark, roots["readings"], roots["results"])
    for method in jobs.METHODS:
        jobs.clusters(spark, roots["readings"], roots["results"], method)
    assert jobs.publish(spark, roots["results"], jobs.write_pairs(roots["pairs"])) == []
    return raw.count()


def result(roots, name):
    (path,) = glob.glob(f"{roots['results']}/{name}/*.csv")
    with open(path) as lines:
        return list(csv.DictReader(lines))


def pairs(spark, roots, name):
    rows = spark.read.parquet(f"{roots['pairs']}/{name}").collect()
    assert len({r.key for r in rows}) == len(rows)
    return {r.key: json.loads(r.value) for r in rows}


def test_prep_keeps_every_row(spark, roots, done):
    readings = jobs.load(spark, roots["readings"])
    assert readings.count() == done
    assert readings.select("country").distinct().count() == 31


def test_countries_and_year_prune_the_scan(spark, roots, done):
    subset = entity_subset(jobs.load(spark, roots["readings"]), "country", names.THIRTY_COUNTRIES)
    means = entity_year_mean(subset, "country_code", "carbon_intensity", 2024, "mean")
    plan = means._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(year,2024)" in plan
    assert "PartitionFilters: [country" in plan
    assert "ReadSchema: struct<country_code:string,carbon_intensity:double,year:int>" in plan


def test_annual(roots, done):
    rows = result(roots, "annual")
    assert list(rows[0]) == [
        "date", "country_code", "carbon_mean", "carbon_min", "carbon_max",
        "cfe_mean", "cfe_min", "cfe_max",
    ]
    assert [(r["country_code"], r["date"]) for r in rows] == [
        ("IT", "2023"), ("IT", "2024"), ("SE", "2023"), ("SE", "2024"),
    ]
    for r in rows:
        for metric in ("carbon", "cfe"):
            low, mean, high = (float(r[f"{metric}_{s}"]) for s in ("min", "mean", "max"))
            assert low <= mean <= high


def test_annual_mean_is_the_clustered_value(roots, done):
    annual = {
        r["country_code"]: float(r["carbon_mean"])
        for r in result(roots, "annual")
        if r["date"] == "2024"
    }
    for method in jobs.METHODS:
        clusters = {
            r["country_code"]: float(r["avg_carbon_intensity"])
            for r in result(roots, f"clusters_{method}")
        }
        assert len(clusters) == 30
        for code, mean in annual.items():
            assert clusters[code] == pytest.approx(mean, rel=1e-12)


def test_monthly_ranks(roots, done):
    months = {r["date"]: r for r in result(roots, "monthly_means")}
    assert list(months) == [
        "2023_11", "2023_12", "2024_01", "2024_02", "2024_03", "2024_04", "2024_05",
    ]
    ranks = result(roots, "monthly_ranks")
    assert len(ranks) == 20
    for tag, column, source in (
        ("ci", "carbon_intensity", "avg_carbon_intensity"),
        ("cfe", "cfe", "avg_cfe"),
    ):
        for way, sign in (("desc", -1), ("asc", 1)):
            rows = [r for r in ranks if r["rank_type"] == f"{tag}_{way}"]
            assert [r["rank_num"] for r in rows] == list("12345")
            expected = sorted(months, key=lambda d: (sign * float(months[d][source]), d))[:5]
            assert [r["date"] for r in rows] == expected
            assert [r[column] for r in rows] == [months[d][source] for d in expected]


def test_hourly_stats(roots, done):
    assert len(result(roots, "hourly_profile")) == 48
    rows = result(roots, "hourly_stats")
    assert [(r["data"], r["country_code"]) for r in rows] == [
        ("carbon-intensity", "IT"), ("carbon-intensity", "SE"), ("cfe", "IT"), ("cfe", "SE"),
    ]
    for r in rows:
        numbers = [float(r[c]) for c in ("min", "25-perc", "50-perc", "75-perc", "max")]
        assert numbers == sorted(numbers)


@pytest.mark.parametrize("method", jobs.METHODS)
def test_clusters(roots, done, method):
    rows = [
        (int(r["cluster_prediction"]), float(r["avg_carbon_intensity"]))
        for r in result(roots, f"clusters_{method}")
    ]
    assert rows == sorted(rows)
    assert {c for c, _ in rows} == set(range(max(c for c, _ in rows) + 1))
    curve = result(roots, f"curve_{method}")
    assert [int(r["k"]) for r in curve] == list(range(2, 16))


def test_published_keys(spark, roots, done):
    annual = pairs(spark, roots, "annual")
    assert annual["q1:2024:IT"]["country_code"] == "IT"
    assert set(pairs(spark, roots, "hourly_profile")) == {
        f"q3:hourly_avg:{c}:{h:02d}" for c in ("IT", "SE") for h in range(24)
    }
    assert set(pairs(spark, roots, "monthly_ranks")) == {
        f"q2:italy:rank:{t}:{n}"
        for t in ("ci_desc", "ci_asc", "cfe_desc", "cfe_asc")
        for n in range(1, 6)
    }
    for method in jobs.METHODS:
        assert len(pairs(spark, roots, f"clusters_{method}")) == 30
        assert set(pairs(spark, roots, f"curve_{method}")) == {f"{method}:{k}" for k in range(2, 16)}


def test_sql_text_gives_the_written_results(spark, roots, done):
    readings = jobs.load(spark, roots["readings"])
    for df, name, schema in (
        (questions.annual_sql(readings), "annual", questions.ANNUAL_SCHEMA),
        (questions.monthly_ranks_sql(readings), "monthly_ranks", questions.RANKS_SCHEMA),
        (questions.hourly_stats_sql(readings), "hourly_stats", questions.STATS_SCHEMA),
    ):
        written = read_result(spark, f"{roots['results']}/{name}", schema)
        assert df.dtypes == written.dtypes
        expected = sorted(map(tuple, written.collect()))
        found = sorted(map(tuple, df.collect()))
        assert len(found) == len(expected)
        for ours, theirs in zip(found, expected):
            assert ours == tuple(
                pytest.approx(v, rel=1e-12) if isinstance(v, float) else v for v in theirs
            )


def test_empty_readings_give_empty_results(spark):
    readings = spark.createDataFrame([], names.READINGS_SCHEMA)
    means, profile = questions.monthly(readings), questions.hourly(readings)
    found = {
        questions.ANNUAL_SCHEMA: questions.annual(readings),
        questions.MONTHLY_SCHEMA: means,
        questions.RANKS_SCHEMA: questions.monthly_ranks(means),
        questions.HOURLY_SCHEMA: profile,
        questions.STATS_SCHEMA: questions.hourly_stats(profile),
    }
    clusters, curve = questions.clusters(questions.cluster_features(readings), "silhouette")
    found[questions.CLUSTERS_SCHEMA] = clusters
    found[questions.CURVE_SCHEMAS["silhouette"]] = curve
    for schema, df in found.items():
        assert df.isEmpty()
        assert df.dtypes == spark.createDataFrame([], schema).dtypes


def test_jobs_on_empty_readings_write_empty_results(spark, tmp_path):
    readings, results, out = (str(tmp_path / n) for n in ("readings", "results", "pairs"))
    write_readings(spark.createDataFrame([], names.READINGS_SCHEMA), readings, "country")
    jobs.annual(spark, readings, results)
    jobs.monthly(spark, readings, results)
    jobs.hourly(spark, readings, results)
    for method in jobs.METHODS:
        jobs.clusters(spark, readings, results, method)
    assert jobs.publish(spark, results, jobs.write_pairs(out)) == []
    for job in ("annual", "monthly", "hourly", "clusters"):
        for name, schema in jobs.written(job, "elbow").items():
            assert read_result(spark, f"{results}/{name}", schema).isEmpty()
            assert spark.read.schema("key string, value string").parquet(f"{out}/{name}").isEmpty()


def test_command_line_prints_and_publishes(spark, roots, done, tmp_path, capfd):
    where = ["--readings", roots["readings"], "--results", str(tmp_path / "results")]
    jobs.main(["annual", *where, "--show", "10"])
    assert "carbon_mean" in capfd.readouterr().out
    jobs.main(["clusters", *where, "--method", "elbow", "--seeds", "1", "2", "--show", "30"])
    assert "cluster_prediction" in capfd.readouterr().out
    jobs.main(["clusters", *where, "--method", "elbow", "--year", "1999"])
    empty = read_result(spark, str(tmp_path / "results/clusters_elbow"), questions.CLUSTERS_SCHEMA)
    assert empty.isEmpty()
    runs = run_time_stats(measured_runs(spark, "Q1", "sql", 2, [1, 2]))
    write_run_log(run_log_rows(runs), str(tmp_path / "runs"))
    publishing = ["publish", "--results", roots["results"], "--pairs", str(tmp_path / "pairs")]
    jobs.main([*publishing, "--runs", str(tmp_path / "runs")])
    found = pairs(spark, {"pairs": str(tmp_path / "pairs")}, "runs")
    assert list(found) == ["performance:Q1:sql:2"]
    assert found["performance:Q1:sql:2"]["avg_execution_time_seconds"] == 1.5
    with pytest.raises(SystemExit, match="runs"):
        jobs.main([*publishing, "--runs", str(tmp_path / "missing")])


def test_one_failure_does_not_stop_the_others(spark, roots, done, tmp_path):
    sent = []

    def send(name, df):
        if name == "annual":
            raise RuntimeError("store is away")
        sent.append(name)

    assert jobs.publish(spark, roots["results"], send) == ["annual"]
    assert len(sent) == 8

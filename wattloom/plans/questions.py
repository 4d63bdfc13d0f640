"""The cleaning job and the four questions over electricity readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators import clustering, lloyd, prep, profiles, ranking, summary
from wattloom.plans import sql_text
from wattloom.sources import electricity as names
from wattloom.sources.scans import entity_subset, single_entity

METRICS = {"carbon": "carbon_intensity", "cfe": "carbon_free_percentage"}
MEAN_NAMES = {"carbon_mean": "avg_carbon_intensity", "cfe_mean": "avg_cfe"}

GENERIC_NAMES = {"country_code": "entity", "carbon_intensity": "m1", "carbon_free_percentage": "m2"}
RANK_TAGS = {"ci": "carbon_intensity", "cfe": "cfe"}
STATS_TAGS = {"carbon-intensity": "avg_carbon_intensity", "cfe": "avg_cfe"}

# Schemas of the published results.
ANNUAL_SCHEMA = (
    "date int, country_code string, carbon_mean double, carbon_min double, carbon_max double,"
    " cfe_mean double, cfe_min double, cfe_max double"
)
MONTHLY_SCHEMA = "date string, avg_carbon_intensity double, avg_cfe double, year int, month int"
RANKS_SCHEMA = "rank_type string, rank_num int, date string, carbon_intensity double, cfe double"
HOURLY_SCHEMA = "country_code string, hour int, avg_carbon_intensity double, avg_cfe double"
STATS_SCHEMA = (
    "country_code string, data string, min double, `25-perc` double, `50-perc` double,"
    " `75-perc` double, max double"
)
CLUSTERS_SCHEMA = "country_code string, avg_carbon_intensity double, cluster_prediction int"
CURVE_SCHEMAS = {
    "elbow": "k int, wcss double",
    "silhouette": "k int, silhouette_score double",
}


def clean(raw: DataFrame) -> DataFrame:
    """Processed readings: time, country code, country, both metrics and the calendar parts."""
    kept = prep.drop_if_exists(raw, names.RAW_DROP)
    return prep.prep_readings(kept, names.RAW_TIME, names.RAW_KEEP, names.RAW_METRICS)


def annual(readings: DataFrame, years: tuple[int, int] | None = None) -> DataFrame:
    """Statistics per year of two countries."""
    subset = entity_subset(readings, "country", names.TWO_COUNTRIES)
    return profiles.annual_stats(subset, "country_code", METRICS, years)


def monthly(readings: DataFrame) -> DataFrame:
    """Means per month of one country."""
    one = single_entity(readings, "country", names.ONE_COUNTRY)
    return profiles.monthly_means(one, METRICS).withColumnsRenamed(MEAN_NAMES)


def monthly_ranks(means: DataFrame, n: int = 5) -> DataFrame:
    """The n months highest and lowest by either metric."""
    rows = means.select(
        "date",
        F.col("avg_carbon_intensity").alias("carbon_intensity"),
        F.col("avg_cfe").alias("cfe"),
    )
    return ranking.two_way_ranking(rows, RANK_TAGS, n, "date")


def hourly(readings: DataFrame) -> DataFrame:
    """Means per hour of day of two countries."""
    subset = entity_subset(readings, "country", names.TWO_COUNTRIES)
    profile = profiles.hourly_profile(subset, "country_code", METRICS)
    return profile.withColumnsRenamed(MEAN_NAMES)


def hourly_stats(profile: DataFrame) -> DataFrame:
    """Five numbers of each metric over the hours of the day."""
    return summary.five_numbers(profile, "country_code", STATS_TAGS)


def cluster_features(readings: DataFrame, year: int = names.CLUSTER_YEAR) -> DataFrame:
    """Mean carbon intensity of thirty countries in one year, as a feature table."""
    subset = entity_subset(readings, "country", names.THIRTY_COUNTRIES)
    means = profiles.entity_year_mean(
        subset, "country_code", "carbon_intensity", year, "avg_carbon_intensity"
    )
    return clustering.feature_table(means, "country_code", "avg_carbon_intensity")


def clusters(
    features: DataFrame, method: str, seeds: Sequence[int] = (1,), fit: str = "mllib"
) -> tuple[DataFrame, DataFrame]:
    """Clusters and tuning curve, with k chosen by ``elbow`` or ``silhouette``; ``fit`` is ``mllib``
    or ``lloyd``, the sweep that takes all k and seeds in the same passes."""
    choose = lloyd.cluster_by_choice if fit == "lloyd" else clustering.cluster_by_choice
    found, curve = choose(features, "country_code", "avg_carbon_intensity", method, seeds)
    return (
        found.withColumnRenamed("cluster", "cluster_prediction"),
        curve.withColumnRenamed("silhouette", "silhouette_score").orderBy("k"),
    )


def annual_sql(readings: DataFrame) -> DataFrame:
    """``annual`` as SQL text."""
    subset = entity_subset(readings, "country", names.TWO_COUNTRIES)
    stats = sql_text.annual_stats_sql(subset.withColumnsRenamed(GENERIC_NAMES))
    labels = [
        F.col(f"{generic}_{stat}").alias(f"{name}_{stat}")
        for generic, name in (("m1", "carbon"), ("m2", "cfe"))
        for stat in ("mean", "min", "max")
    ]
    return stats.select("date", F.col("entity").alias("country_code"), *labels)


def monthly_ranks_sql(readings: DataFrame, n: int = 5) -> DataFrame:
    """``monthly_ranks`` over ``monthly`` as SQL text."""
    one = single_entity(readings, "country", names.ONE_COUNTRY)
    ranks = sql_text.monthly_top_sql(one.withColumnsRenamed(GENERIC_NAMES), n, tuple(RANK_TAGS))
    return ranks.withColumnsRenamed({"m1_mean": "carbon_intensity", "m2_mean": "cfe"})


def hourly_stats_sql(readings: DataFrame) -> DataFrame:
    """``hourly_stats`` over ``hourly`` as SQL text."""
    subset = entity_subset(readings, "country", names.TWO_COUNTRIES)
    renamed = subset.withColumnsRenamed(GENERIC_NAMES)
    stats = sql_text.hourly_five_numbers_sql(renamed, tuple(STATS_TAGS))
    return stats.withColumnRenamed("entity", "country_code")

"""

Every query reads its whole table. Doubles are rounded to six places on both sides, because the
order of a floating-point sum differs between engines.
"""

from __future__ import annotations

import datetime
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from wattloom.functions.naming import named  # noqa: E402
from wattloom.operators import clustering, lloyd, prep, profiles, quantiles, ranking, runs  # noqa: E402
from wattloom.operators import states, summary  # noqa: E402
from wattloom.plans import families, sql_text  # noqa: E402
from wattloom.session import fresh_folder, shared_dir, ship_package, use_utc  # noqa: E402
from wattloom.sinks import batches, delta, files  # noqa: E402
from wattloom.sources import scans, tables  # noqa: E402
from wattloom.sources.tables import MEANS, METRICS  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"
CLUSTER_YEAR = 2024
CENTERS = (30.0, 40.0, 45.0, 50.0, 55.0, 60.0, 70.0)
CORRECTED_DAY = datetime.date(2024, 1, 15)
PLACES = 6


def rounded(df: DataFrame) -> DataFrame:
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.select(
        *[
            F.round(named(c), PLACES).alias(c) if c in doubles else named(c).alias(c)
            for c in df.columns
        ]
    )


# --- readings -------------------------------------------------------------------------------


def prep_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layout, two folder levels deep, and the cleaning of what is read from it."""
    root = fresh_folder(spark, "raw")
    tables.table(spark, sf_dir, "events").write.parquet(f"{root}/zone/events")
    readings = tables.event_readings_of(scans.read_raw(spark, root, tables.SCHEMAS["events"]))
    return readings.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


def raw_files(spark: SparkSession, sf_dir: str, root: str, name: str, part: int, parts: int) -> None:
    """One of several parts of the events as a raw file of its own."""
    events = tables.table(spark, sf_dir, "events").where(F.col("event_id") % parts == part)
    shapes = {
        "numbers": events,
        "texts": events.withColumn("value", F.col("value").cast("string")).withColumnRenamed("user_id", "_u"),
        "bare": events.drop("props"),
    }
    shapes[name].write.parquet(f"{root}/zone/{name}{part}")


def prep_mixed_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files with numbers, with the same numbers as texts, and without a column."""
    root = fresh_folder(spark, "raw")
    for part, name in enumerate(("numbers", "texts", "bare")):
        raw_files(spark, sf_dir, root, name, part, 3)
    readings = tables.event_readings_of(scans.read_mixed(spark, root, tables.TYPES["events"]))
    return readings.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


def incremental_prep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of prep: the second one reads only the raw files that came after the first."""
    raw, root = fresh_folder(spark, "raw"), fresh_folder(spark, "readings")

    def read(paths: list[str]) -> DataFrame:
        return tables.event_readings_of(scans.read_files(spark, paths, tables.TYPES["events"]))

    for part in range(2):
        raw_files(spark, sf_dir, raw, "numbers", part, 2)
        batches.add_new_files(spark, scans.raw_pattern(raw), root, "entity", read)
    schema = tables.event_readings(spark, sf_dir).schema
    readings = batches.read_batches(spark, root, schema).select(*schema.names)
    return readings.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


def drop_if_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.drop_if_exists(tables.table(spark, sf_dir, "events"), ("props", "Zone_name"))


def partitioned(spark: SparkSession, readings: DataFrame) -> DataFrame:
    """Readings written by entity and read back from the root, so that entities prune folders."""
    path = fresh_folder(spark, "readings")
    files.write_readings(readings, path, "entity")
    return scans.read_readings(spark, path, readings.schema).select(*readings.columns)


def scan_entity_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = partitioned(spark, tables.shipment_readings(spark, sf_dir))
    subset = scans.entity_subset(readings, "entity", ("A", "R"))
    return subset.select("entity", "year", "month", "m1", "m2")


def scan_single_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = partitioned(spark, tables.shipment_readings(spark, sf_dir))
    return scans.single_entity(readings, "entity", "R").select("entity", "year", "month", "m1", "m2")


def empty_input_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clustering of a year without readings."""
    means = year_means(spark, sf_dir, year=1900)
    return clustering.cluster_entities(feature_rows(means), "entity", "m1_mean", k=2)


def rows_per_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.rows_per_entity(tables.event_readings(spark, sf_dir), "entity")


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.row_count(tables.event_readings(spark, sf_dir))


def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = partitioned(spark, tables.event_readings(spark, sf_dir))
    return back.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


# --- annual and monthly statistics ----------------------------------------------------------


def annual_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = tables.shipment_readings(spark, sf_dir)
    return rounded(profiles.annual_stats(readings, "entity", METRICS))


def annual_stats_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sql_text.annual_stats_sql(tables.shipment_readings(spark, sf_dir)))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = annual_stats(spark, sf_dir)
    path = fresh_folder(spark, "annual")
    files.write_result(stats, path, order_by=("entity", "date"))
    return scans.read_result(spark, path, stats.schema)


def means_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.monthly_means(tables.shipment_readings(spark, sf_dir), METRICS)


def monthly_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(means_by_month(spark, sf_dir))


def top5(metric: str, descending: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        means = means_by_month(spark, sf_dir).select("date", *MEANS.values())
        return rounded(ranking.top_n(means, MEANS[metric], 5, descending, tie_break="date"))

    return query


def monthly_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = means_by_month(spark, sf_dir).select("date", *MEANS.values())
    return ranking.two_way_ranking(means, MEANS, 5, tie_break="date")


def monthly_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(monthly_ranks(spark, sf_dir))


def monthly_top5_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sql_text.monthly_top_sql(tables.shipment_readings(spark, sf_dir), n=5))


# --- hour of day ----------------------------------------------------------------------------


def means_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.hourly_profile(tables.event_readings(spark, sf_dir), "entity", METRICS)


def hourly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(means_by_hour(spark, sf_dir))


def hourly_five_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(summary.five_numbers(means_by_hour(spark, sf_dir), "entity", MEANS))


def hourly_five_number_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sql_text.hourly_five_numbers_sql(tables.event_readings(spark, sf_dir)))


def hourly_quartiles_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(summary.approx_quartiles(means_by_hour(spark, sf_dir), "entity", MEANS))


def event_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of all readings, stored with one day left out, which is then counted alone."""
    readings = tables.event_readings(spark, sf_dir)
    root, day = fresh_folder(spark, "states"), CORRECTED_DAY
    found = states.states(readings, "entity", METRICS)
    on_day = (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day)
    states.write_states(found.where(~on_day), root)
    states.replace_days(readings, root, "entity", METRICS, [day])
    return states.read_states(spark, root, states.with_day(found).schema)


def state_annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(states.annual(event_states(spark, sf_dir), METRICS))


def state_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(states.monthly(event_states(spark, sf_dir), METRICS))


def state_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(states.hourly(event_states(spark, sf_dir), METRICS))


def reading_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quartiles of the readings themselves, of which an entity may have any number."""
    readings = tables.event_readings(spark, sf_dir)
    return rounded(quantiles.reading_quartiles(readings, "entity", METRICS))


# --- clustering -----------------------------------------------------------------------------


def year_means(spark: SparkSession, sf_dir: str, year: int = CLUSTER_YEAR) -> DataFrame:
    events = tables.user_events(spark, sf_dir)
    return profiles.entity_year_mean(events, "entity", "m1", year, "m1_mean", time="datetime")


def feature_rows(means: DataFrame) -> DataFrame:
    return clustering.feature_table(means, "entity", "m1_mean")


def entity_year_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(year_means(spark, sf_dir))


def kmeans_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = clustering.feature_vectors(year_means(spark, sf_dir), "m1_mean")
    flat = clustering.flat_features(vectors)
    return rounded(flat.select("entity", F.col("features").alias("m1_mean")))


def given_clusters(means: DataFrame) -> DataFrame:
    return clustering.assign_to_centers(means, "m1_mean", CENTERS)


def nearest_center_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(given_clusters(year_means(spark, sf_dir)))


def wcss_given_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(clustering.wcss_of(given_clusters(year_means(spark, sf_dir)), "m1_mean"))


def silhouette_given_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = feature_rows(year_means(spark, sf_dir))
    return rounded(clustering.silhouette_of(given_clusters(features)))


def scored_sweep(score: str) -> Query:
    """Every k of the sweep, and whether its score is the one that its labels give, to 1e-6.

    The scores themselves depend on the seed; SQL can state this. The cost of a fit is that of its
    last labels and the centres before them, so it is compared with a tolerance.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        features = feature_rows(year_means(spark, sf_dir))
        sweep = clustering.k_sweep(features, with_silhouette=score == "silhouette")
        centers = {k: [c[0] for c in m.clusterCenters()] for k, m in sweep.models.items()}
        again = lloyd.rescored(features, "m1_mean", centers)
        fitted = sweep.curve.select("k", F.col(score).alias("score"), F.lit(True).alias("fitted"))
        anew = again.select("k", F.col(score).alias("score"), F.lit(False).alias("fitted"))
        both = fitted.union(anew).groupBy("k").agg(
            (F.max("score") - F.min("score")).alias("gap"), F.max(F.abs("score")).alias("size")
        )
        return both.select("k", (F.col("gap") <= 1e-6 * (1 + F.col("size"))).alias("agrees"))

    return query


def cluster_assignments(method: str) -> Query:
    """Sweep, choice of k, final clustering: every entity, its value, and whether its cluster is the
    one of the nearest mean. The labels depend on the seed; SQL can state this."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        features = feature_rows(year_means(spark, sf_dir))
        clusters, _ = clustering.cluster_by_choice(features, "entity", "m1_mean", method)
        nearest = clustering.is_nearest(clusters, "m1_mean")
        return rounded(nearest.select("entity", "m1_mean", "nearest"))

    return query


def lloyd_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost and silhouette of every k, from starts that a hash names."""
    return rounded(lloyd.k_sweep(feature_rows(year_means(spark, sf_dir)), "m1_mean").curve)


def lloyd_choice(spark: SparkSession, sf_dir: str, method: str) -> tuple[DataFrame, DataFrame]:
    features = feature_rows(year_means(spark, sf_dir))
    clusters, curve = lloyd.cluster_by_choice(features, "entity", "m1_mean", method)
    return rounded(clusters), rounded(curve)


def lloyd_clusters(method: str) -> Query:
    """Sweep, choice of k, and every entity's cluster."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return lloyd_choice(spark, sf_dir, method)[0]

    return query


def monthly_curve(spark: SparkSession, sf_dir: str, metric: str = "m1_mean") -> DataFrame:
    """A curve that does not depend on a seed: month number and monthly mean."""
    k = (F.col("year") * 12 + F.col("month")).alias("k")
    return means_by_month(spark, sf_dir).select(k, F.col(metric).alias("score"))


def elbow_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_dir(spark)
    return clustering.elbow_select(monthly_curve(spark, sf_dir).checkpoint(), score="score")


def silhouette_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.silhouette_select(monthly_curve(spark, sf_dir, "m2_mean"), score="score")


# --- publishing -----------------------------------------------------------------------------


def kv_annual_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return families.kv_annual_stats(annual_stats(spark, sf_dir), "entity")


def kv_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second publish of the annual statistics sends, after one of an earlier state: the
    shipments before July 1996, when those before 1993 were still kept."""
    readings = tables.shipment_readings(spark, sf_dir)
    pairs = [
        families.kv_annual_stats(rounded(profiles.annual_stats(some, "entity", METRICS)), "entity")
        for some in (
            readings.where(F.col("datetime") < F.lit(datetime.datetime(1996, 7, 1))),
            readings.where(F.col("datetime") >= F.lit(datetime.datetime(1993, 1, 1))),
        )
    ]
    root, sent = fresh_folder(spark, "published"), fresh_folder(spark, "sent")
    for number, new in enumerate(pairs):
        delta.publish_changes(new, root, lambda rows: rows.write.parquet(f"{sent}/{number}"))
    return spark.read.schema("key string, value string, change string").parquet(f"{sent}/1")


def kv_monthly_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return families.kv_monthly_ranks(monthly_top5(spark, sf_dir), scope="all")


def kv_monthly_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return families.kv_monthly_means(monthly_means(spark, sf_dir), scope="all")


def kv_hourly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return families.kv_hourly_stats(hourly_five_number(spark, sf_dir), "entity")


def kv_hourly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return families.kv_hourly_profile(hourly_profile(spark, sf_dir), "entity")


def kv_clusters(method: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return families.kv_clusters(nearest_center_assign(spark, sf_dir), "entity", method)

    return query


def kv_curve(method: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return families.kv_curve(rounded(monthly_curve(spark, sf_dir)), method)

    return query


def kv_swept_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clusters of the sweep as they are published."""
    clusters, _ = lloyd_choice(spark, sf_dir, "silhouette")
    return families.kv_clusters(clusters, "entity", "silhouette")


def kv_swept_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, curve = lloyd_choice(spark, sf_dir, "elbow")
    return families.kv_curve(curve, "elbow")


def run_time_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(runs.run_time_stats(tables.shipment_runs(spark, sf_dir)))


def merged_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run times logged in four goes, each as moments, and merged."""
    measured = tables.shipment_runs(spark, sf_dir)
    root = fresh_folder(spark, "run-parts")
    for part in range(4):
        some = measured.where(F.floor("seconds").cast("int") % 4 == part)
        files.append_run_part(runs.run_parts(some), root)
    return rounded(runs.merged_run_stats(scans.read_run_parts(spark, root)))


def run_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean per (query, variant, executors), logged as nested CSV files and read back."""
    stats = runs.run_time_stats(tables.shipment_runs(spark, sf_dir))
    root = fresh_folder(spark, "runs")
    files.write_run_log(runs.run_log_rows(stats), root)
    return scans.read_run_log(spark, root)


def kv_run_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = runs.run_time_stats(tables.shipment_runs(spark, sf_dir))
    return families.kv_run_times(runs.run_log_rows(stats))


REGISTERED: dict[str, Query] = {
    "prep_readings": prep_readings,
    "prep_mixed_shapes": prep_mixed_shapes,
    "incremental_prep": incremental_prep,
    "drop_if_exists": drop_if_exists,
    "scan_entity_subset": scan_entity_subset,
    "scan_single_entity": scan_single_entity,
    "empty_input_guard": empty_input_guard,
    "rows_per_entity": rows_per_entity,
    "row_count": row_count,
    "partitioned_roundtrip": partitioned_roundtrip,
    "annual_stats": annual_stats,
    "annual_stats_sql": annual_stats_sql,
    "csv_roundtrip": csv_roundtrip,
    "monthly_means": monthly_means,
    "top5_m1_desc": top5("m1", descending=True),
    "top5_m1_asc": top5("m1", descending=False),
    "top5_m2_desc": top5("m2", descending=True),
    "top5_m2_asc": top5("m2", descending=False),
    "monthly_top5": monthly_top5,
    "monthly_top5_sql": monthly_top5_sql,
    "hourly_profile": hourly_profile,
    "hourly_five_number": hourly_five_number,
    "hourly_five_number_sql": hourly_five_number_sql,
    "hourly_quartiles_approx": hourly_quartiles_approx,
    "state_annual": state_annual,
    "state_monthly": state_monthly,
    "state_hourly": state_hourly,
    "reading_quartiles": reading_quartiles,
    "entity_year_mean": entity_year_mean,
    "kmeans_features": kmeans_features,
    "nearest_center_assign": nearest_center_assign,
    "wcss_given_labels": wcss_given_labels,
    "silhouette_given_labels": silhouette_given_labels,
    "wcss_sweep": scored_sweep("wcss"),
    "silhouette_sweep": scored_sweep("silhouette"),
    "elbow_select": elbow_select,
    "silhouette_select": silhouette_select,
    "cluster_assignments": cluster_assignments("elbow"),
    "cluster_assignments_silhouette": cluster_assignments("silhouette"),
    "lloyd_sweep": lloyd_sweep,
    "lloyd_clusters_elbow": lloyd_clusters("elbow"),
    "lloyd_clusters_silhouette": lloyd_clusters("silhouette"),
    "kv_annual_stats": kv_annual_stats,
    "kv_delta": kv_delta,
    "kv_monthly_ranks": kv_monthly_ranks,
    "kv_monthly_means": kv_monthly_means,
    "kv_hourly_stats": kv_hourly_stats,
    "kv_hourly_profile": kv_hourly_profile,
    "kv_clusters": kv_clusters("silhouette"),
    "kv_clusters_elbow": kv_clusters("elbow"),
    "kv_curve": kv_curve("silhouette"),
    "kv_curve_elbow": kv_curve("elbow"),
    "kv_swept_clusters": kv_swept_clusters,
    "kv_swept_curve": kv_swept_curve,
    "run_time_stats": run_time_stats,
    "merged_run_stats": merged_run_stats,
    "run_log_roundtrip": run_log_roundtrip,
    "kv_run_times": kv_run_times,
}


def in_utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(ship_package(use_utc(spark)), sf_dir)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Annual statistics, the flagship query, on the smallest tables."""
    return annual_stats(use_utc(spark), SMOKE_DIR)


def corpus() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the corpus operators; none where that part is not installed."""
    try:
        import corpus_pipeline
        from wattloom.llm import expected
        from wattloom.llm import queries as operators
    except ImportError as error:
        if error.name not in ("wattloom.llm", "corpus_pipeline"):
            raise
        return {}, {}
    found = dict(operators.QUERIES, pipeline=corpus_pipeline.run)
    sql = dict(expected.EXPECTED)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Query]:
    return {name: in_utc(query) for name, query in {**REGISTERED, **corpus()[0]}.items()}


def oracle_sql() -> dict[str, str]:
    from wattloom.plans.expected import expected_sql

    return {**expected_sql(CENTERS, CLUSTER_YEAR), **corpus()[1]}

"""The jobs: clean the raw readings, answer the questions, publish the results.

Run with ``spark-submit`` or ``python -m wattloom.jobs``:

    prep     --raw ROOT --readings ROOT
    annual   --readings ROOT --results ROOT        (likewise monthly, hourly)
    clusters --readings ROOT --results ROOT --method elbow|silhouette [--year 2024] [--seeds 1 2]
    publish  --results ROOT --pairs ROOT [--runs ROOT] [--state ROOT]

A job prints what it wrote with ``--show ROWS``. A question job runs ``--repeat`` times and logs its run
times under ``--runs ROOT``, which ``publish --runs ROOT`` reads, and takes ``--form sql`` for its SQL
text. ``prep --incremental`` reads only raw files that are new; ``clusters --fit lloyd`` fits all k in the
same passes; ``publish --state ROOT`` writes only what has changed since the last time.

Readings, results and pairs have a root each, so none is overwritten with another. A result that
feeds a second one is read back from where it was written, so the readings are scanned once.
"""

from __future__ import annotations

import argparse
import logging
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from wattloom.operators import profiles, runs
from wattloom.plans import families, questions
from wattloom.session import build_session
from wattloom.sinks import batches, versions
from wattloom.sinks.delta import publish_changes
from wattloom.sinks.files import append_run_part, show, write_readings, write_result, write_run_log
from wattloom.sources import electricity as names
from wattloom.sources.scans import (
    raw_pattern,
    read_files,
    read_mixed,
    read_readings,
    read_result,
    read_run_log,
    read_run_parts,
)

log = logging.getLogger(__name__)

SCOPE = "italy"
METHODS = ("elbow", "silhouette")


def prep(spark: SparkSession, raw: str, readings: str) -> None:
    """All raw files, whatever their columns and types; none leave empty readings."""
    write_readings(questions.clean(read_mixed(spark, raw, names.RAW_TYPES)), readings, "country")


def prep_new(spark: SparkSession, raw: str, readings: str) -> list[str]:
    """The raw files that no batch of the readings has yet; their paths."""

    def read(paths: Sequence[str]) -> DataFrame:
        return questions.clean(read_files(spark, paths, names.RAW_TYPES))

    paths = batches.add_new_files(spark, raw_pattern(raw), readings, "country", read)
    log.info("%d raw files read", len(paths))
    return paths


def load(spark: SparkSession, readings: str) -> DataFrame:
    """The readings that either prep wrote."""
    if versions.latest(spark, f"{readings}/manifest"):
        return batches.read_batches(spark, readings, names.READINGS_SCHEMA)
    return read_readings(spark, readings, names.READINGS_SCHEMA)


def prep_report(spark: SparkSession, readings: str, rows: int) -> None:
    """Schema, first rows, number of rows and rows per country, of the written readings."""
    written = load(spark, readings)
    show(written, rows)
    show(profiles.row_count(written), 1)
    show(profiles.rows_per_entity(written, "country").orderBy("country"), rows)


def annual(spark: SparkSession, readings: str, results: str, form: str = "df") -> None:
    question = questions.annual_sql if form == "sql" else questions.annual
    stats = question(load(spark, readings))
    write_result(stats, f"{results}/annual", order_by=("country_code", "date"))


def monthly(spark: SparkSession, readings: str, results: str, form: str = "df") -> None:
    means = questions.monthly(load(spark, readings))
    write_result(means, f"{results}/monthly_means", order_by=("date",))
    written = read_result(spark, f"{results}/monthly_means", questions.MONTHLY_SCHEMA)
    ranks = questions.monthly_ranks(written)
    if form == "sql":
        ranks = questions.monthly_ranks_sql(load(spark, readings))
    write_result(ranks, f"{results}/monthly_ranks", order_by=("rank_type", "rank_num"))


def hourly(spark: SparkSession, readings: str, results: str, form: str = "df") -> None:
    profile = questions.hourly(load(spark, readings))
    write_result(profile, f"{results}/hourly_profile", order_by=("country_code", "hour"))
    written = read_result(spark, f"{results}/hourly_profile", questions.HOURLY_SCHEMA)
    stats = questions.hourly_stats(written)
    if form == "sql":
        stats = questions.hourly_stats_sql(load(spark, readings))
    write_result(stats, f"{results}/hourly_stats", order_by=("data", "country_code"))


def clusters(
    spark: SparkSession,
    readings: str,
    results: str,
    method: str,
    year: int = names.CLUSTER_YEAR,
    seeds: Sequence[int] = (1,),
    fit: str = "mllib",
) -> None:
    features = questions.cluster_features(load(spark, readings), year)
    found, curve = questions.clusters(features, method, seeds, fit)
    order = ("cluster_prediction", "avg_carbon_intensity")
    write_result(found, f"{results}/clusters_{method}", order_by=order)
    write_result(curve, f"{results}/curve_{method}", order_by=("k",))


def executor_count(spark: SparkSession) -> int:
    """Executors alive, the driver not counted; 1 where the driver runs the tasks."""
    return max(1, spark.sparkContext._jsc.sc().getExecutorMemoryStatus().size() - 1)


def log_runs(spark: SparkSession, root: str, job: str, form: str, seconds: Sequence[float]) -> None:
    """Add runs to those of the same job, form and number of executors, and log the mean of all."""
    measured = runs.measured_runs(spark, job, form, executor_count(spark), seconds)
    append_run_part(runs.run_parts(measured), root)
    stats = runs.merged_run_stats(read_run_parts(spark, root))
    same = stats.join(measured.select(*runs.RUN_KEYS).distinct(), list(runs.RUN_KEYS), "left_semi")
    write_run_log(runs.run_log_rows(same), root)


def result_pairs(
    spark: SparkSession, results: str, run_log: str | None = None
) -> dict[str, Callable[[], DataFrame]]:
    """The published pairs of each result folder, and of the run log if its root is given."""

    def read(name: str, schema: str) -> DataFrame:
        return read_result(spark, f"{results}/{name}", schema)

    entity = "country_code"
    pairs: dict[str, Callable[[], DataFrame]] = {
        "annual": lambda: families.kv_annual_stats(
            read("annual", questions.ANNUAL_SCHEMA), entity
        ),
        "monthly_ranks": lambda: families.kv_monthly_ranks(
            read("monthly_ranks", questions.RANKS_SCHEMA), SCOPE
        ),
        "monthly_means": lambda: families.kv_monthly_means(
            read("monthly_means", questions.MONTHLY_SCHEMA), SCOPE
        ),
        "hourly_stats": lambda: families.kv_hourly_stats(
            read("hourly_stats", questions.STATS_SCHEMA), entity
        ),
        "hourly_profile": lambda: families.kv_hourly_profile(
            read("hourly_profile", questions.HOURLY_SCHEMA), entity
        ),
    }
    for method in METHODS:
        pairs[f"clusters_{method}"] = lambda method=method: families.kv_clusters(
            read(f"clusters_{method}", questions.CLUSTERS_SCHEMA), entity, method
        )
        pairs[f"curve_{method}"] = lambda method=method: families.kv_curve(
            read(f"curve_{method}", questions.CURVE_SCHEMAS[method]), method
        )
    if run_log:
        pairs["runs"] = lambda: families.kv_run_times(read_run_log(spark, run_log))
        pairs["run_stats"] = lambda: families.kv_run_stats(
            runs.merged_run_stats(read_run_parts(spark, run_log))
        )
    return pairs


def publish(
    spark: SparkSession,
    results: str,
    send: Callable[[str, DataFrame], None],
    run_log: str | None = None,
) -> list[str]:
    """Send the pairs of every result; one that fails is logged and does not stop the others.

    Returns the names of those that failed.
    """
    failed = []
    for name, pairs in result_pairs(spark, results, run_log).items():
        try:
            send(name, pairs())
        except Exception:
            log.exception("%s was not published", name)
            failed.append(name)
    return failed


def write_pairs(root: str) -> Callable[[str, DataFrame], None]:
    """Send by writing one parquet folder per result."""

    def send(name: str, pairs: DataFrame) -> None:
        pairs.write.mode("overwrite").parquet(f"{root}/{name}")

    return send


def only_changes(send: Callable[[str, DataFrame], None], state: str) -> Callable[[str, DataFrame], None]:
    """Send rows (key, value, change) against what was sent before, kept under ``state``."""

    def send_changes(name: str, pairs: DataFrame) -> None:
        publish_changes(pairs, f"{state}/{name}", lambda delta: send(name, delta))

    return send_changes


def written(job: str, method: str) -> dict[str, str]:
    """Folder and schema of each result of a question job."""
    return {
        "annual": {"annual": questions.ANNUAL_SCHEMA},
        "monthly": {
            "monthly_means": questions.MONTHLY_SCHEMA,
            "monthly_ranks": questions.RANKS_SCHEMA,
        },
        "hourly": {
            "hourly_profile": questions.HOURLY_SCHEMA,
            "hourly_stats": questions.STATS_SCHEMA,
        },
        "clusters": {
            f"clusters_{method}": questions.CLUSTERS_SCHEMA,
            f"curve_{method}": questions.CURVE_SCHEMAS[method],
        },
    }[job]


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="wattloom.jobs")
    parser.add_argument(
        "job", choices=("prep", "annual", "monthly", "hourly", "clusters", "publish")
    )
    parser.add_argument("--raw")
    parser.add_argument("--readings")
    parser.add_argument("--results")
    parser.add_argument("--pairs")
    parser.add_argument("--runs")
    parser.add_argument("--state")
    parser.add_argument("--incremental", action="store_true")
    parser.add_argument("--repeat", type=int, default=1, metavar="N")
    parser.add_argument("--fit", choices=("mllib", "lloyd"), default="mllib")
    parser.add_argument("--method", choices=METHODS, default="elbow")
    parser.add_argument("--year", type=int, default=names.CLUSTER_YEAR)
    parser.add_argument("--seeds", type=int, nargs="+", default=[1])
    parser.add_argument("--form", choices=("df", "sql"), default="df")
    parser.add_argument("--show", type=int, default=0, metavar="ROWS")
    options = parser.parse_args(arguments)
    spark = build_session(f"wattloom-{options.job}")
    if options.job == "prep":
        (prep_new if options.incremental else prep)(spark, options.raw, options.readings)
        if options.show:
            prep_report(spark, options.readings, options.show)
    elif options.job == "publish":
        send = write_pairs(options.pairs)
        if options.state:
            send = only_changes(send, options.state)
        failed = publish(spark, options.results, send, options.runs)
        if failed:
            raise SystemExit(f"not published: {', '.join(failed)}")
    else:
        form = options.method if options.job == "clusters" else options.form
        seconds = []
        for _ in range(options.repeat):
            began = time.perf_counter()
            where = (options.readings, options.results)
            if options.job == "clusters":
                clusters(spark, *where, options.method, options.year, options.seeds, options.fit)
            else:
                job = {"annual": annual, "monthly": monthly, "hourly": hourly}[options.job]
                job(spark, *where, options.form)
            seconds.append(time.perf_counter() - began)
        if options.runs:
            log_runs(spark, options.runs, options.job, form, seconds)
        if options.show:
            for name, schema in written(options.job, options.method).items():
                show(read_result(spark, f"{options.results}/{name}", schema), options.show)


if __name__ == "__main__":
    main()

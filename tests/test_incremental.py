"""Raw files of any shape, batches of new files, publishing of changes, merged run times."""

from __future__ import annotations

import os
import shutil
import statistics

import pytest
from pyspark.sql import functions as F

from wattloom import jobs
from wattloom.operators import runs
from wattloom.sinks import batches, delta, files, versions
from wattloom.sources import electricity as names
from wattloom.sources import scans

NUMBERS = "Datetime__UTC_ timestamp, Country string, Zone_id string, Carbon_intensity_gCO_eq_kWh__direct_ double, Carbon_free_energy_percentage__CFE__ double"
TEXTS = NUMBERS.replace("timestamp", "string").replace("double", "string")


def raw_file(spark, root, name, rows, schema=NUMBERS, drop=()):
    frame = spark.createDataFrame([], schema) if not rows else spark.createDataFrame(
        rows, TEXTS).select(*[F.col(f.name).cast(f.dataType) for f in spark.createDataFrame([], schema).schema])
    frame.drop(*drop).coalesce(1).write.mode("overwrite").parquet(f"{root}/zone/{name}")


def row(day, country="Italy", value="1.5", free="7"):
    return (f"2024-01-{day:02d} 05:00:00", country, country[:2].upper(), value, free)


def stored(spark, root):
    found = jobs.load(spark, root).select("day", "country", "carbon_intensity", "carbon_free_percentage").collect()
    return sorted(map(tuple, found), key=repr)


def test_raw_files_of_different_shapes(spark, tmp_path):
    raw, readings = str(tmp_path / "raw"), str(tmp_path / "readings")
    raw_file(spark, raw, "numbers", [row(1)])
    raw_file(spark, raw, "texts", [row(2), row(3, value="n/a")], TEXTS)
    raw_file(spark, raw, "bare", [row(4)], drop=["Carbon_free_energy_percentage__CFE__"])
    raw_file(spark, raw, "empty", [], TEXTS)
    jobs.prep(spark, raw, readings)
    assert stored(spark, readings) == [
        (1, "Italy", 1.5, 7.0), (2, "Italy", 1.5, 7.0), (3, "Italy", None, 7.0), (4, "Italy", 1.5, None),
    ]


def test_files_are_read_through_spark_where_pyarrow_cannot(spark, tmp_path, monkeypatch):
    raw = str(tmp_path / "raw")
    raw_file(spark, raw, "numbers", [row(1)])
    paths = [r.path for r in batches.listing(spark, scans.raw_pattern(raw)).collect()]
    by_pyarrow = scans.footers(spark, paths).collect()
    plain = [p.removeprefix("file:") for p in paths]  # a path without a known scheme
    assert [r.shape for r in scans.footers(spark, plain).collect()] == [r.shape for r in by_pyarrow]


def test_a_root_that_is_not_there(spark, tmp_path, caplog):
    jobs.prep(spark, str(tmp_path / "nowhere"), str(tmp_path / "readings"))
    assert "no raw files" in caplog.text
    assert stored(spark, str(tmp_path / "readings")) == []
    assert jobs.prep_new(spark, str(tmp_path / "nowhere"), str(tmp_path / "batches")) == []


def test_only_new_files_are_read(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "readings")
    raw_file(spark, raw, "a", [row(1), row(2, "Sweden")])
    assert len(jobs.prep_new(spark, raw, root)) == 1
    raw_file(spark, raw, "b", [row(3)], TEXTS)
    read = jobs.prep_new(spark, raw, root)
    assert len(read) == 1 and "/b/" in read[0]
    assert jobs.prep_new(spark, raw, root) == []
    assert [r[0] for r in stored(spark, root)] == [1, 2, 3]
    folders = sorted(os.listdir(f"{root}/batches/batch=2"))
    assert [f for f in folders if f.startswith("country=")] == ["country=Italy"]


def test_a_run_that_was_cut_off_is_done_again(spark, tmp_path, monkeypatch):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "readings")
    raw_file(spark, raw, "a", [row(1)])
    jobs.prep_new(spark, raw, root)
    raw_file(spark, raw, "b", [row(2)])
    real = versions.write_next
    monkeypatch.setattr(versions, "write_next", lambda *_: (_ for _ in ()).throw(OSError("cut off")))
    with pytest.raises(OSError, match="cut off"):
        jobs.prep_new(spark, raw, root)
    assert [r[0] for r in stored(spark, root)] == [1]
    monkeypatch.setattr(versions, "write_next", real)
    assert len(jobs.prep_new(spark, raw, root)) == 1
    assert [r[0] for r in stored(spark, root)] == [1, 2]


def test_changed_and_vanished_files(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "readings")
    raw_file(spark, raw, "a", [row(1)])
    raw_file(spark, raw, "b", [row(2)])
    jobs.prep_new(spark, raw, root)
    raw_file(spark, raw, "c", [row(3)])
    jobs.prep_new(spark, raw, root)
    raw_file(spark, raw, "b", [row(4), row(5)])  # other content, of the first batch
    assert len(jobs.prep_new(spark, raw, root)) == 2
    assert [r[0] for r in stored(spark, root)] == [1, 3, 4, 5]
    shutil.rmtree(f"{raw}/zone/c")
    assert jobs.prep_new(spark, raw, root) == []
    assert [r[0] for r in stored(spark, root)] == [1, 4, 5]


PAIRS = "key string, value string"


def sent(spark, rows, root):
    found = []
    pairs = spark.createDataFrame(rows, PAIRS)
    delta.publish_changes(pairs, root, lambda d: found.extend(sorted(map(tuple, d.collect()))))
    return found


def test_only_changes_are_sent(spark, tmp_path):
    root = str(tmp_path / "state")
    rows = [("a", "1"), ("b", "2"), ("c", None)]
    assert sent(spark, rows, root) == [("a", "1", "set"), ("b", "2", "set"), ("c", None, "set")]
    assert sent(spark, rows, root) == []
    assert sent(spark, [("b", "3"), ("c", None), ("d", "4")], root) == [
        ("a", None, "delete"), ("b", "3", "set"), ("d", "4", "set"),
    ]
    assert sent(spark, [], root) == [("b", None, "delete"), ("c", None, "delete"), ("d", None, "delete")]


@pytest.mark.parametrize("rows", [[("a", "1"), ("a", "2")], [("a", "1"), ("a", "1")], [(None, "1")]])
def test_keys_that_are_not_unique_are_refused(spark, tmp_path, rows):
    with pytest.raises(Exception, match="a key must be there once"):
        sent(spark, rows, str(tmp_path / "state"))
    assert versions.latest(spark, str(tmp_path / "state")) == 0


def test_a_publish_that_was_cut_off_sends_again(spark, tmp_path):
    root = str(tmp_path / "state")
    pairs = spark.createDataFrame([("a", "1")], PAIRS)

    def fail(_):
        raise OSError("gone")

    with pytest.raises(OSError):
        delta.publish_changes(pairs, root, fail)
    assert sent(spark, [("a", "1")], root) == [("a", "1", "set")]


class FolderStore:
    """Writes what it is told as files, so that tasks can share it."""

    def __init__(self, path):
        self.path = path

    def set_many(self, pairs):
        for key, value in pairs:
            with open(f"{self.path}/{key}", "w") as out:
                out.write(value)

    def delete_many(self, keys):
        for key in keys:
            os.remove(f"{self.path}/{key}")

    def close(self):
        pass


def test_changes_reach_a_store(spark, tmp_path):
    store, root = str(tmp_path / "store"), str(tmp_path / "state")
    os.mkdir(store)
    for rows in ([("a", "1"), ("b", "2")], [("b", "3"), ("c", "4")]):
        pairs = spark.createDataFrame(rows, PAIRS)
        delta.publish_changes(pairs, root, lambda d: delta.send(d, lambda: FolderStore(store), 1))
    assert {n: open(f"{store}/{n}").read() for n in os.listdir(store)} == {"b": "3", "c": "4"}


def test_runs_merge(spark, tmp_path):
    root = str(tmp_path / "runs")
    assert scans.read_run_parts(spark, root).isEmpty()
    seconds = [3.0, 5.0, 4.5, 4.0, 9.0]
    for some in (seconds[:1], seconds[1:3], seconds[3:]):
        files.append_run_part(runs.run_parts(runs.measured_runs(spark, "annual", "df", 2, some)), root)
    files.append_run_part(runs.run_parts(runs.measured_runs(spark, "hourly", "df", 2, [1.0])), root)
    found = {r.query_name: r for r in runs.merged_run_stats(scans.read_run_parts(spark, root)).collect()}
    assert found["annual"].runs == 5
    assert found["annual"].mean_seconds == pytest.approx(statistics.mean(seconds))
    assert found["annual"].stddev_seconds == pytest.approx(statistics.stdev(seconds))
    assert found["hourly"].stddev_seconds is None


def test_repeated_jobs_publish_their_spread_and_only_changes(spark, tmp_path):
    raw, readings, results, logged, pairs, state = (str(tmp_path / n) for n in ("raw", "readings", "results", "runs", "pairs", "state"))
    raw_file(spark, raw, "a", [row(d, c, str(d * n)) for d in (1, 2) for n, c in enumerate(names.THIRTY_COUNTRIES)])
    jobs.main(["prep", "--raw", raw, "--readings", readings, "--incremental"])
    where = ["--readings", readings, "--results", results, "--runs", logged]
    jobs.main(["annual", *where, "--repeat", "2"])
    jobs.main(["annual", *where])
    for job in ("monthly", "hourly"):
        jobs.main([job, *where])
    for method in jobs.METHODS:
        jobs.main(["clusters", *where, "--method", method, "--fit", "lloyd"])
    publish = ["publish", "--results", results, "--pairs", pairs, "--runs", logged, "--state", state]
    jobs.main(publish)
    stats = {r.key: r.value for r in spark.read.parquet(f"{pairs}/run_stats").collect()}
    assert '"runs":3' in stats["performance_stats:annual:df:1"]
    assert '"stddev_seconds":null' in stats["performance_stats:monthly:df:1"]
    codes = {c[:2].upper() for c in names.THIRTY_COUNTRIES}
    assert spark.read.parquet(f"{pairs}/clusters_elbow").count() == len(codes)
    jobs.main(publish)
    assert all(spark.read.parquet(f"{pairs}/{n}").isEmpty() for n in os.listdir(pairs))

from __future__ import annotations

import gzip
import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattloom.llm import warc

SCHEMA = "page_id long, url string, html string, key string, digest string, id long, timestamp string"


def pages():
    long = "x" * 1500
    rows = [
        (1, "http://www.b.org/x y", long), (2, "https://a.org/q?A=1#f", long), (3, "http://b.org/x%20y", "short"),
        (4, "http://c.org", "short"), (5, None, None), (6, "", ""), (7, "http://b.org/z", "é" * 700),
        (7, "http://b.org/z", "é" * 700), (None, "http://d.org/\tq", long), (8, "http://b.org/x y", "y" * 1000),
        (9, "http://b.org/x y", "y" * 1000), (10, "http://e.org/", "z" * 999), (11, "http://e.org/", "z" * 999),
        (-3, "http://f.org/", "long\r\n\r\n" * 50_000), (None, None, None),
    ]
    return [(*row, "k", "d", 1, "t") for row in rows]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def when():
    return F.timestamp_seconds(F.lit(10_000) + F.col("page_id"))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30)), max_size=9))
def test_loser_tree(runs):
    merged = list(warc.LoserTree([sorted(run) for run in runs]))
    assert merged == sorted(x for run in runs for x in run)


def test_round_trip(spark):
    rows = pages()
    found = warc.read_records(warc.write_archive(table(spark, rows), when())).collect()
    expected = []
    for page_id, _, html, *_ in rows:
        payload = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == payload and r[0] is not None]
        stored = max(same) if len(payload) >= 1000 and len(same) > 0 else None
        refers = stored if stored is not None and stored != page_id else None
        kind = "response" if refers is None else "revisit"
        expected.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), kind, refers))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


@pytest.mark.parametrize("fan_in", [2, 64])
def test_the_index_is_in_global_order(spark, monkeypatch, fan_in):
    monkeypatch.setattr(warc, "RUN_CAPTURES", 20)
    monkeypatch.setattr(warc, "RANGE_CAPTURES", 100)
    random.seed(1)
    rows = [(i, f"http://h{random.randrange(9)}.org/{random.randrange(30)}", "p") for i in range(500)]
    rows = [(*r, "k", "d", 1, "t") for r in rows]
    archive = warc.write_archive(table(spark, rows), when(), fan_in=fan_in)
    assert archive.index.count() > 1
    index = warc.read_index(archive).orderBy("part", "place").collect()
    keys = [(r.key, r.timestamp) for r in index]
    assert keys == sorted(keys) and len(keys) == 500


def test_any_id_and_time(spark):
    long = "x" * 1500
    ids = [2**63 - 1, -(2**63), 10**18, 337_090_610_141_320, -1, 0, None]
    rows = [(i, "http://a.org/", long, "k", "d", 1, "t") for i in ids]
    times = [
        F.timestamp_seconds(F.lit(1_600_000_000) + F.pmod("page_id", F.lit(10**9))),
        F.when(F.col("page_id") > 0, F.timestamp_seconds(F.lit(10**12))).otherwise(F.timestamp_seconds(F.lit(-(10**12)))),
    ]
    for captured in times:
        archive = warc.write_archive(table(spark, rows), captured)
        assert all(len(r.timestamp) == 14 and r.timestamp.isdigit() for r in warc.read_index(archive).collect())
        found = {r.page_id: r.refers_to for r in warc.read_records(archive).collect()}
        assert found == {i: None if i == 2**63 - 1 else 2**63 - 1 for i in ids}


def test_a_null_id_refers_to_page_minus_one(spark):
    rows = [(i, "http://a.org/", "x" * 1500, "k", "d", 1, "t") for i in (None, -1, -2)]
    found = warc.read_records(warc.write_archive(table(spark, rows), when())).collect()
    assert {r.page_id: r.refers_to for r in found} == {None: -1, -1: None, -2: -1}


def test_records_of_one_archive_are_read_in_several_tasks(spark):
    rows = [(i, f"http://a.org/{i}", "p" * 50, "k", "d", 1, "t") for i in range(400)]
    records = warc.read_records(warc.write_archive(spark.createDataFrame(rows, SCHEMA).coalesce(1), when()))
    tasks = records.select("page_id", F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert sum(r["count"] for r in tasks) == 400
    assert len(tasks) > 1


def test_other_readers_can_read_the_archive(spark, tmp_path):
    folder = str(tmp_path / "warc")
    warc.write_archive(table(spark, pages()), when(), folder=folder)
    records = 0
    for path in (tmp_path / "warc").glob("*.warc.gz"):
        raw = gzip.decompress(path.read_bytes())
        records += raw.count(b"WARC/1.1\r\nWARC-Type: ")
    assert records == len(pages())


def test_url_keys(spark):
    urls = ["http://WWW.Example.com/A?b#c", "https://example.com", None, "ftp://x.y:80/p q"]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(warc.url_key(F.col("u")).alias("k"))
    assert [r.k for r in rows.collect()] == ["com,example)/a?b", "com,example)/", ")/", "y:80,x)/p%20q"]


def test_empty_table(spark):
    archive = warc.write_archive(spark.createDataFrame([], SCHEMA), when())
    assert warc.read_records(archive).collect() == []

"""Operators that return documents return their columns as they came, whatever they are called."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import odd_rows
from wattloom.llm import decontamination, line_crf, line_join, mixing, shingle_join
from wattloom.llm.common import table

NAMES = (
    "_id", "_hash", "_key_a", "_key_b", "_row", "_kept", "_kept_id", "_text_hash", "row", "kept", "id", "key",
    "hash", "lines", "left", "size", "copies", "n", "n_words", "start", "item_id", "a.b",
)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(r[0], r[1], r[3], *[f"{name}{i}" for name in NAMES]) for i, r in enumerate(odd_rows())]
    columns = ["doc_id long", "text string", "source string", *[f"`{name}` string" for name in NAMES]]
    return spark.createDataFrame(rows, ", ".join(columns)).repartition(3)


def check(found, docs, same_text=True):
    assert found.columns == docs.columns
    assert found.dtypes == docs.dtypes
    known = {(r[3:], r[1] if same_text else None) for r in map(tuple, docs.collect())}
    rows = [tuple(r) for r in found.collect()]
    assert rows
    assert {(r[3:], r[1] if same_text else None) for r in rows} <= known


def test_near_copies(docs):
    check(shingle_join.one_of_each(docs), docs)


def test_contaminated(spark, docs):
    check(decontamination.without_contaminated(docs, table(spark, SMALL, "benchmark")), docs)


def test_quality(spark):
    real = table(spark, SMALL, "documents")
    model = line_crf.train(real, table(spark, SMALL, "labels"))
    named = [F.concat(F.lit(name), F.col("doc_id")).alias(name) for name in NAMES]
    docs = real.select("doc_id", "text", "source", *named)
    check(line_crf.kept_documents(docs, model), docs)


def test_repeated_lines(docs):
    found = line_join.without_repeats(docs)
    check(found, docs, same_text=False)
    assert found.count() == docs.count()


def test_mix(docs):
    check(mixing.mixed_documents(docs), docs)

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import no_documents, odd_documents, odd_rows
from wattloom.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(rows):
    """Excess over three times a source's words reshared by weight, round by round."""
    sizes = defaultdict(int)
    for row in rows:
        sizes[row[3]] += words(row[1])
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    stopped, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        share = left / max(1, sum(weight[s] for s in order if s not in stopped))
        above = {s for s in order if s not in stopped and share * weight[s] > 3 * sizes[s]}
        if not above:
            return sizes, {s: 3 * sizes[s] if s in stopped else share * weight[s] for s in order}
        stopped |= above


def test_targets_and_sums(spark):
    rows = odd_rows()
    sizes, expected = targets(rows)
    found = mixing.mix_sizes(odd_documents(spark)).collect()
    assert len(found) == len(rows)
    assert Counter((r.doc_id, r["size"]) for r in found) == Counter((r[0], words(r[1])) for r in rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in found:
        assert r.target == pytest.approx(expected[r.source])
        assert r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for source, sum_taken in taken.items():
        assert abs(sum_taken - expected[source]) <= max(1, largest[source])


def test_reruns_agree_and_layout_does_not_matter(spark):
    once = sorted(mixing.mix_sizes(odd_documents(spark)).collect(), key=repr)
    again = sorted(mixing.mix_sizes(odd_documents(spark).repartition(7)).collect(), key=repr)
    assert once == again


def test_documents_come_as_often_as_taken(spark):
    docs = odd_documents(spark)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    copies = Counter()
    for r in mixing.mix_sizes(docs).collect():
        copies[r.doc_id, r["size"]] += r.copies
    found = Counter((r.doc_id, words(r.text)) for r in mixed.collect())
    assert found == Counter({k: v for k, v in copies.items() if v})


def test_empty_table(spark):
    assert mixing.mix_sizes(no_documents(spark)).collect() == []
    assert mixing.mixed_documents(no_documents(spark)).collect() == []


def test_inclusion_follows_the_preference(spark):
    """Ranked by odds, documents of weight 4 are taken about four times as often as of weight 1."""
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("source"),
        F.when(F.col("id") % 4 == 0, "x").otherwise("x y z").alias("text"),
    )
    prefer = lambda size: F.when(size == 3, 4).otherwise(1).cast("long")
    rows = mixing.mix_sizes(docs, preference=prefer).where("source = 'a'").collect()
    target, source_size = rows[0].target, rows[0].source_size
    extra = defaultdict(list)
    for r in rows:
        extra[r["size"]].append(r.copies - int(target // source_size))
    shares = {size: sum(v) / len(v) for size, v in extra.items()}
    assert shares[3] == pytest.approx(4 * shares[1], rel=0.1)


@pytest.mark.parametrize("sizes", [[5], [0, 0], [1, 10_000], [3, 3, 3, 3]])
def test_few_rows(spark, sizes):
    rows = [(i, "w " * n, f"s{i % 2}") for i, n in enumerate(sizes)]
    found = mixing.mix_sizes(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert len(found.collect()) == len(sizes)


def test_a_large_plan_is_salted_instead_of_broadcast(spark, monkeypatch):
    docs = odd_documents(spark)
    expected = sorted(mixing.mix_sizes(docs).collect(), key=repr)
    monkeypatch.setattr(mixing, "MAX_BROADCAST_ROWS", 0)
    assert sorted(mixing.mix_sizes(docs).collect(), key=repr) == expected

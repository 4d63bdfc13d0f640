from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.brute import percentile
from wattloom.operators import quantiles

QS = (0.0, 0.25, 0.5, 0.9, 1.0)


def drawn(seed):
    rng = random.Random(seed)
    rows = [("wide", rng.gauss(0, 1) * 10 ** rng.randrange(-8, 9)) for _ in range(3_000)]
    rows += [("ties", float(rng.choice((1, 1, 1, 2, 3)))) for _ in range(2_000)]
    rows += [("one", 7.0)] * 1_500 + [(None, float(i)) for i in range(999)]
    rows += [("few", v) for v in (3.0, 1.0, 2.0)] + [("none", None), ("nan", float("nan")), ("few", None)]
    rows += [("skewed", 0.0)] * 1_000 + [("skewed", 10.0**i) for i in range(300)]
    rng.shuffle(rows)
    return rows


def expected(rows):
    groups = {}
    for key, x in rows:
        if x is not None and x == x:
            groups.setdefault(key, []).append(x)
    return {
        key: (len(v), min(v), max(v), [percentile(v, q) for q in QS]) for key, v in groups.items()
    }


@pytest.mark.parametrize(("few", "bins", "broadcast"), [(10_000, 1_000, 200_000), (20, 8, 200_000), (50, 100, 0)])
def test_against_sorted_groups(spark, monkeypatch, few, bins, broadcast):
    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "BINS", bins)
    monkeypatch.setattr(quantiles, "MAX_BROADCAST", broadcast)
    rows = drawn(few)
    frame = spark.createDataFrame(rows, "key string, x double").repartition(4)
    found = {r.key: r for r in quantiles.exact_quantiles(frame, ("key",), "x", QS).collect()}
    known = expected(rows)
    assert set(found) == set(known)
    for key, (n, least, most, values) in known.items():
        row = found[key]
        assert (row.n, row.min, row.max) == (n, least, most)
        assert row.quantiles == pytest.approx(values, rel=1e-12, abs=1e-12)


def test_sorting_is_left_few_rows(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW", 100)
    sizes = []
    real = quantiles.settled
    monkeypatch.setattr(quantiles, "settled", lambda rows, state: sizes.append(rows.count()) or real(rows, state))
    x = ((17 * F.col("id")) % 200_003).cast("double").alias("x")
    frame = spark.range(200_000).select(F.lit("k").alias("key"), x)
    found = quantiles.exact_quantiles(frame, ("key",), "x", (0.5,)).first()
    ordered = sorted((17 * i) % 200_003 for i in range(200_000))
    assert found.quantiles == [(ordered[99_999] + ordered[100_000]) / 2]
    assert sizes[0] <= 2_000


def test_empty_table(spark):
    empty = spark.createDataFrame([], "key string, x double")
    assert quantiles.exact_quantiles(empty, ("key",), "x", QS).collect() == []

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tests.oracle import connect, differences
from wattloom.llm import expected, hard_negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int, anchor_block string, rank string"


def plain(rows) -> list[tuple]:
    """All scores by Python's integers."""
    usable = {}
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = int(math.fmod(label + 1, 10)) if vec_id % 7 == 0 else label
        value = (label, [float(np.float32(x)) for x in vector])
        usable[vec_id] = min(usable.get(vec_id, value), value)
    whole = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in usable.items()}
    limit = 1 << 63
    found = []
    for anchor in sorted(i for i in whole if i % 100 == 0):
        label, vector = whole[anchor]
        scores = [
            (max(-limit, min(limit - 1, sum(a * b for a, b in zip(vector, v)))), i, other)
            for i, (other, v) in whole.items()
            if i != anchor
        ]
        scores.sort(key=lambda s: (-s[0], s[1]))
        for positive, positive_id, _ in [s for s in scores if s[2] == label][:5]:
            window = [s for s in scores if s[2] != label and 30 * positive <= 100 * s[0] <= 90 * positive]
            for rank, (score, i, _) in enumerate(window[:10], 1):
                found.append((anchor, positive_id, rank, i, positive, score))
    return sorted(found)


def mined(spark, rows) -> list[tuple]:
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hard_negatives.mine(frame).collect())


def drawn_rows(seed: int, n: int, size: float = 0.3, dimensions: int = 8) -> list[tuple]:
    drawn = random.Random(seed)
    middle = [[drawn.gauss(0, size) for _ in range(dimensions)] for _ in range(3)]
    return [
        (10 * i, [x + drawn.gauss(0, size / 2) for x in middle[i % 3]], drawn.randrange(3), "b", "r")
        for i in range(n)
    ]


@pytest.mark.parametrize("size", [0.001, 0.3, 40.0, 1e7, 1e17])
def test_against_all_scores(spark, size):
    rows = drawn_rows(1, 300, size)
    found = mined(spark, rows)
    assert found == plain(rows)
    assert found or size not in (0.3, 40.0, 1e7)


def test_odd_rows(spark):
    rows = drawn_rows(2, 120)
    rows += [
        (None, rows[0][1], 1, "b", "r"),
        (5, None, 1, "b", "r"),
        (6, rows[0][1], None, "b", "r"),
        (8, [float("nan")] * 8, 1, "b", "r"),
        (9, [0.1, None], 1, "b", "r"),
        (11, [float("inf")] + [0.0] * 7, 1, "b", "r"),
        (12, [], 1, "b", "r"),
        (13, [0.5, 0.5], 2, "b", "r"),
        (-100, rows[3][1], 0, None, None),
        (-7, rows[3][1], -3, "b", "r"),
        rows[10],  # a repeated row
        (100, rows[5][1], 1, "b", "r"),  # another row of an anchor's id
        (300, rows[5][1], 2, "b", "r"),
    ]
    rows += [(1000 + i, rows[0][1], 2, "b", "r") for i in range(1, 30)]  # ties
    assert mined(spark, rows) == plain(rows)


def test_blocks_do_not_matter(spark, monkeypatch):
    rows = drawn_rows(4, 200)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 7)
    assert mined(spark, rows) == plain(rows)


def test_nothing_to_mine(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [0.1], 1, "b", "r"), (1, [0.1], 2, "b", "r")]) == []
    assert mined(spark, [(100, [], 1, "b", "r"), (1, [], 1, "b", "r"), (2, [], 2, "b", "r")]) == [
        (100, 1, 1, 2, 0, 0)
    ]


@pytest.mark.parametrize("size", [1, 100, 2**20, 2**40])
def test_fields_hold_exact_products(size):
    drawn = random.Random(size)
    kind = np.int64 if size < 2**30 else object
    rows, anchors = (
        np.array([[drawn.randrange(-size, size + 1) for _ in range(16)] for _ in range(n)], dtype=kind)
        for n in (37, 5)
    )
    packed = hard_negatives.Packed(rows, anchors)
    assert packed.fields == {1: 9, 100: 3, 2**20: 1, 2**40: 1}[size]
    for anchor in anchors:
        exact = [sum(int(a) * int(b) for a, b in zip(anchor, row)) for row in rows]
        limit = 1 << 63
        assert packed.scores(anchor).tolist() == [max(-limit, min(limit - 1, e)) for e in exact]


def test_query_agrees_with_sql(spark, sf_dir):
    name = "op12_hard_negatives"
    found = queries.QUERIES[name](spark, sf_dir)
    assert found.count() > 100
    assert differences(found, connect(sf_dir), expected.EXPECTED[name]) == []

from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm.fixtures import SCHEMA, changed, no_documents, odd_documents, odd_rows, prose
from wattloom.llm import shingle_join


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def components(rows):
    """By comparing all pairs."""
    sets = [(r[0], shingle_set(r[1])) for r in rows]
    label = list(range(len(sets)))
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            both = len(a & b)
            if a and b and 100 * both >= 85 * (len(a) + len(b) - both) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    found = []
    for (doc_id, s), own in zip(sets, label, strict=True):
        ids = [d for (d, _), x in zip(sets, label, strict=True) if x == own and d is not None]
        found.append((doc_id, len(s), min(ids, default=None) if s else doc_id))
    return sorted(found, key=repr)


def near_rows():
    """Chains and stars of near copies, over long shared passages and odd rows."""
    random.seed(5)
    rows = [(r[0], r[1]) for r in odd_rows() if r[0] != 18]
    passage = prose(77, 60)
    base = prose(78, 150)
    for i in range(60):
        words = base.split()
        for _ in range(random.randrange(8)):
            words[random.randrange(len(words))] = f"edit{random.randrange(10**6)}"
        rows.append((1000 + i, " ".join(words)))
    for i in range(40):
        rows.append((2000 + i, f"{passage} {prose(200 + i, random.randrange(1, 120))}"))
    chain = prose(79, 200).split()
    for i in range(10):
        chain[i * 18] = f"link{i}"
        rows.append((3000 + i, " ".join(chain)))
    rows += [(4000 + i, " ".join(f"v{j}" for j in range(n))) for i, n in enumerate([1, 2, 3, 4, 5, 9, 10, 11, 12])]
    return rows


@pytest.mark.parametrize("frequent", [64, 2, 0, -1000])
def test_against_all_pairs(spark, monkeypatch, frequent):
    """Wherever the line between rare and frequent tokens is drawn."""
    monkeypatch.setattr(shingle_join, "FREQUENT", frequent)
    rows = near_rows()
    docs = spark.createDataFrame([(*r, "en", "s", 1, 1, "k", True, "r", 2, "h") for r in rows], SCHEMA)
    found = shingle_join.linked_documents(docs.repartition(3)).collect()
    assert sorted(map(tuple, found), key=repr) == components(rows)


def test_entries_meet_for_every_similar_pair():
    """Two sets at the threshold or above share an entry, for any mix of rare and frequent tokens."""
    random.seed(8)
    draw = np.random.default_rng(8)
    for _ in range(400):
        n = random.randrange(6, 400)
        counts = np.where(draw.random(1 << shingle_join.SKETCH_BITS) < random.random(), 500, 1).astype(np.uint32)
        pool = np.unique(draw.integers(0, 2**63, 3 * n).astype(np.uint64) * np.uint64(2))
        draw.shuffle(pool)
        a = set(pool[:n].tolist())
        gone = random.randrange(0, max(1, n * 15 // 100) + 1)
        added = random.randrange(0, max(1, n * 15 // 100) + 1)
        b = set(list(a)[gone:]) | set(pool[n : n + added].tolist())
        if a == b or 100 * len(a & b) < 85 * len(a | b):
            continue
        entries = [
            set(shingle_join.entries(np.array(sorted(s), dtype=np.uint64), counts, 100, 85)[0].tolist())
            for s in (a, b)
        ]
        assert entries[0] & entries[1]


def test_one_of_each(spark):
    docs = odd_documents(spark)
    left = shingle_join.one_of_each(docs)
    assert left.columns == docs.columns
    rows = left.collect()
    found = {(r.doc_id, r.component_id) for r in shingle_join.linked_documents(docs).collect()}
    expected = sorted(str(i) for i, c in found if i == c or i is None and c is None)
    nulls = sum(r.doc_id is None for r in rows)
    assert nulls == 2
    assert sorted(str(r.doc_id) for r in rows if r.doc_id is not None) == [e for e in expected if e != "None"]


def test_empty_table(spark):
    assert shingle_join.linked_documents(no_documents(spark)).collect() == []
    assert shingle_join.one_of_each(no_documents(spark)).collect() == []


def test_long_text_and_changes(spark):
    rows = [(1, prose(1, 30_000, 5000)), (2, changed(prose(1, 30_000, 5000), 200)), (3, changed(prose(1, 30_000, 5000), 20))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = shingle_join.linked_documents(docs).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 1), (3, 3)}

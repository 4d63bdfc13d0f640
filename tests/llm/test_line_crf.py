from __future__ import annotations

import itertools
import re

import numpy as np
import pytest

from tests.llm.fixtures import no_documents, odd_documents, odd_rows, prose
from wattloom.llm import line_crf


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def test_counts(spark):
    rows = [r for r in odd_rows() if r[0] != 18]
    found = line_crf.assess(odd_documents(spark).where("doc_id is null or doc_id <> 18"), line_crf.prior_model()).collect()
    counts = sorted((str(r.doc_id), *tuple(r)[1:7]) for r in found)
    assert counts == sorted((str(r[0]), *brute_counts(r[1])) for r in rows)
    assert all(not r.kept for r in found if r.base_failed)


@pytest.mark.parametrize("seed", range(30))
def test_viterbi_finds_the_best_labels(seed):
    draw = np.random.default_rng(seed)
    gains, moves = draw.normal(size=draw.integers(1, 9)), draw.normal(size=(2, 2))

    def value(labels):
        own = sum(g for g, y in zip(gains, labels, strict=True) if y)
        return own + sum(moves[a, b] for a, b in itertools.pairwise(labels))

    best = max(itertools.product((0, 1), repeat=len(gains)), key=value)
    assert value([int(y) for y in line_crf.viterbi(gains, moves)]) == pytest.approx(value(best))


def test_gradient_is_that_of_the_likelihood():
    draw = np.random.default_rng(2)
    features = draw.normal(size=(3, 5, len(line_crf.PRIOR)))
    labels, lengths = draw.integers(0, 2, (3, 5)).astype(float), np.array([5, 1, 3])
    for i, n in enumerate(lengths):
        features[i, n:], labels[i, n:] = 0, 0
    model = line_crf.Model(draw.normal(size=len(line_crf.PRIOR)), draw.normal(size=(2, 2)))
    value, by_feature, by_move = line_crf.likelihood_gradient(model, features, labels, lengths)
    step = 1e-6
    for k in range(len(model.weights)):
        moved = model.weights.copy()
        moved[k] += step
        other = line_crf.likelihood_gradient(line_crf.Model(moved, model.moves), features, labels, lengths)[0]
        assert (other - value) / step == pytest.approx(by_feature[k], abs=1e-4)
    for at in itertools.product((0, 1), repeat=2):
        moved = model.moves.copy()
        moved[at] += step
        other = line_crf.likelihood_gradient(line_crf.Model(model.weights, moved), features, labels, lengths)[0]
        assert (other - value) / step == pytest.approx(by_move[at], abs=1e-4)


def test_labels_of_documents_teach_lines(spark):
    rows = [(i, prose(i, 80, 5000), 1) for i in range(60)]
    rows += [(100 + i, prose(i, 80, 5000).replace(" ", " | "), 0) for i in range(20)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    model = line_crf.train(docs, labels)
    kept = {r.doc_id: r.kept for r in line_crf.assess(docs, model).collect()}
    assert kept == {r[0]: bool(r[2]) for r in rows}
    mixed = rows[0][1] + "\n" + "\n".join(f"*** | {i} | $$$" for i in range(5))
    found = line_crf.assess(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).first()
    assert found.kept and found.content_share < 1


def test_odd_rows_and_empty_tables(spark):
    docs = odd_documents(spark)
    no_labels = spark.createDataFrame([], "doc_id long, quality int")
    model = line_crf.train(docs, no_labels)
    assert np.array_equal(model.weights, line_crf.prior_model().weights)
    kept = line_crf.kept_documents(docs, model)
    assert kept.schema == docs.schema
    judged = line_crf.assess(docs, model)
    assert judged.count() == docs.count()
    assert kept.count() == judged.where("kept").count()
    assert line_crf.assess(no_documents(spark), model).collect() == []
    assert line_crf.kept_documents(no_documents(spark), model).collect() == []
    odd_labels = spark.createDataFrame([(None, 1), (10, None), (10, 1), (11, 0), (11, 1)], "doc_id long, quality int")
    assert line_crf.assess(docs, line_crf.train(docs, odd_labels)).count() == docs.count()

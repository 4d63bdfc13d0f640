from __future__ import annotations

import math
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import no_documents, odd_documents, odd_rows
from wattloom.llm import gru_lm


def tokens_of(text):
    return [*(text or "").encode().lower().split(), b""]


def small_model(words=10, seed=0):
    shape = gru_lm.Shape([f"w{i}".encode() for i in range(words - 1)] + [b""], 7)
    p = gru_lm.initial(shape, [words - i for i in range(words)], seed)
    draw = np.random.default_rng(seed)
    return shape, gru_lm.Parameters(*[part + draw.normal(0, 0.3, part.shape).astype(np.float32) * (part > -50) for part in p])


def reference_score(p, per_class, tokens):
    """One step after the other, with the formulas of a gated recurrent unit."""
    h, total = np.zeros(gru_lm.HIDDEN), 0.0
    size = gru_lm.HIDDEN
    for token in tokens:
        group, place = divmod(int(token), per_class)
        for z, at in ((h @ p.class_out + p.class_bias, group), (h @ p.word_out[group] + p.word_bias[group], place)):
            total += z[at] - np.log(np.exp(z - z.max()).sum()) - z.max()
        x, u = p.inputs[token], h @ p.recurrent
        update = 1 / (1 + np.exp(-(x[:size] + u[:size])))
        reset = 1 / (1 + np.exp(-(x[size : 2 * size] + u[size : 2 * size])))
        h = (1 - update) * h + update * np.tanh(x[2 * size :] + reset * u[2 * size :])
    return total / math.log(10)


def test_scores_carry_the_state_over_windows():
    shape, p = small_model()
    draw = np.random.default_rng(1)
    texts = [draw.integers(0, 11, n).astype(np.int32) for n in (1, 3, 75, 20, 21, 200)]
    found = gru_lm.score_texts(texts, p, shape.per_class)
    assert found == pytest.approx([reference_score(p, shape.per_class, t) for t in texts], rel=1e-4)


def test_probabilities_sum_to_one():
    shape, p = small_model()
    h = np.random.default_rng(3).normal(size=(1, gru_lm.HIDDEN)).astype(np.float32)
    every = np.arange(gru_lm.CLASSES * shape.per_class)
    total = np.exp(gru_lm.log_probabilities(p, np.repeat(h, len(every), 0), every, shape.per_class).astype(float)).sum()
    assert total == pytest.approx(1, abs=1e-4)


def test_backpropagation_follows_the_loss():
    """The slope that a window gives the recurrent weights is the numeric one."""
    shape, p = small_model()
    draw = np.random.default_rng(4)
    tokens = draw.integers(1, 11, (3, 8)).astype(np.int32)
    before = np.concatenate([np.full((3, 1), -1), tokens[:, :-1]], axis=1)
    before[1, 4] = -1
    wide = gru_lm.Parameters(*[part.astype(np.float64) for part in p])

    def loss(recurrent):
        q, total = wide._replace(recurrent=recurrent), 0.0
        h, n = np.zeros((3, gru_lm.HIDDEN)), 0
        for t in range(8):
            new, _ = gru_lm.step(q, h, np.maximum(before[:, t], 0))
            h = np.where((before[:, t] < 0)[:, None], 0, new)
            if t % gru_lm.LOSS_EVERY == 0:
                total -= gru_lm.log_probabilities(q, h, tokens[:, t], shape.per_class).sum()
                n += 3
        return total * 32.0 / n

    slopes = {}

    class Noted(gru_lm.Trainer):
        def change(self, name, slope, at=slice(None)):
            slopes.setdefault(name, slope)

    Noted(wide, shape.per_class).window(tokens, before, np.zeros((3, gru_lm.HIDDEN)), 0)
    for at in [(0, 0), (3, 20), (7, 40), (15, 47), (2, 33)]:
        moved = [wide.recurrent.copy() for _ in range(2)]
        moved[0][at] += 1e-5
        moved[1][at] -= 1e-5
        numeric = (loss(moved[0]) - loss(moved[1])) / 2e-5
        assert slopes["recurrent"][at] == pytest.approx(np.clip(numeric, -5, 5), rel=1e-3, abs=1e-5)


def test_every_step_adds_to_the_loss():
    shape, p = small_model()
    tokens = np.random.default_rng(6).integers(1, 11, (3, 20)).astype(np.int32)
    targets = []

    class Noted(gru_lm.Trainer):
        def output_slopes(self, h, token, scale):
            targets.append(token)
            return super().output_slopes(h, token, scale)

    Noted(p, shape.per_class).window(tokens, tokens, np.zeros((3, gru_lm.HIDDEN), np.float32), 0)
    assert np.array_equal(np.sort(np.concatenate(targets)), np.sort(tokens.ravel()))


@pytest.mark.parametrize("size", [1, 3, 79, 81, 170, 1003, 20_007])
def test_every_token_is_a_target_once(size):
    """Also those of short last windows and those left over by equal streams."""
    shape, p = small_model()
    tokens = np.random.default_rng(5).integers(1, 11, size).astype(np.int32)
    before = np.concatenate([[-1], tokens[:-1]]).astype(np.int32)
    targets = []

    class Noted(gru_lm.Trainer):
        def output_slopes(self, h, token, scale):
            targets.append(token)
            return super().output_slopes(h, token, scale)

    Noted(p, shape.per_class).train(tokens, before)
    found = np.concatenate(targets)
    assert len(found) == size and np.array_equal(np.bincount(found, minlength=11), np.bincount(tokens, minlength=11))


def test_vocabulary_follows_the_corpus(spark, monkeypatch):
    """Frequent words beyond the least number are words of the model, with more classes."""
    monkeypatch.setattr(gru_lm, "VOCABULARY", 20)
    monkeypatch.setattr(gru_lm, "CLASSES", 4)
    often, seldom = [f"w{i}" for i in range(150)], [f"r{i}" for i in range(60)]
    rows = [(i, " ".join([*often, *(seldom if i < 3 else [])])) for i in range(gru_lm.MIN_COUNT)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = gru_lm.train(docs, F.lit(True))
    assert {*model.shape.words} == {b"", *(w.encode() for w in often)}
    assert model.shape.classes == 13 and model.parameters.class_out.shape[1] == 13
    h = np.random.default_rng(3).normal(size=(1, gru_lm.HIDDEN)).astype(np.float32)
    every = np.arange(13 * model.shape.per_class)
    found = gru_lm.log_probabilities(model.parameters, np.repeat(h, len(every), 0), every, model.shape.per_class)
    assert np.exp(found.astype(float)).sum() == pytest.approx(1, abs=1e-4)
    check_base(rows, gru_lm.score(docs, model).collect(), rows)


def check_base(rows, found, training):
    counts = Counter()
    for doc_id, text in training:
        counts.update(tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for doc_id, text in rows:
        own = tokens_of(text)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        expected[doc_id, len(own), sum(counts[w] > 0 for w in own), n, round(base, 6)] += 1
    assert Counter((r[0], r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == expected


def test_base_scores(spark, monkeypatch):
    rows = [r[:2] for r in odd_rows()]
    docs = odd_documents(spark)
    usable = F.coalesce(F.col("doc_id") % 3 != 0, F.lit(False))
    training = [r for r in rows if r[0] is not None and r[0] % 3 != 0]
    found = gru_lm.score(docs, gru_lm.train(docs, usable)).collect()
    check_base(rows, found, [r for r in training])
    # Few words held, the others joined: the same numbers.
    monkeypatch.setattr(gru_lm, "HELD_COUNTS", 50)
    monkeypatch.setattr(gru_lm, "VOCABULARY", 20)
    check_base(rows, gru_lm.score(docs, gru_lm.train(docs, usable)).collect(), training)


def test_context_helps_on_held_out_texts(spark):
    draw = random.Random(1)
    languages = [[f"{x}{i}" for i in range(150)] for x in "abc"]
    rows = [(i, " ".join(draw.choice(languages[i % 3]) for _ in range(draw.randrange(5, 150)))) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    found = gru_lm.score(docs, gru_lm.train(docs, F.col("doc_id") % 5 != 0)).collect()
    held = [r for r in found if r.doc_id % 5 == 0]
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain > 0.1  # of log10(3) at most


def test_empty_tables(spark):
    docs, none = odd_documents(spark), no_documents(spark)
    assert gru_lm.score(none, gru_lm.train(none, F.lit(True))).collect() == []
    untrained = gru_lm.score(docs, gru_lm.train(docs, F.lit(False))).collect()
    assert len(untrained) == docs.count()
    assert all(r.n_known == 0 and math.isfinite(r.score) for r in untrained)


def test_tasks_follow_tokens_not_splits(spark):
    """All parameters are a task's result, so 32 splits of a small share are one task."""
    rows = [(i, " ".join(f"w{(i * 7 + j) % 9}" for j in range(30))) for i in range(200)]
    shape, p = small_model()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(32)
    tokens = 31 * len(rows)
    size = sum(part.size for part in p)
    assert gru_lm.learners(tokens, p) == -(-gru_lm.SENT * tokens // size)
    for tasks in (1, gru_lm.learners(tokens, p)):
        start = spark.sparkContext.broadcast(gru_lm.started(shape, p))
        found = gru_lm.learned(docs, "text", start, tasks).where("block = 0").collect()
        assert 1 <= len(found) <= tasks and sum(r.weight for r in found) == tokens


def test_rounds_ask_for_those_tasks(spark, monkeypatch):
    asked, starts = [], []
    learned = gru_lm.learned

    def noted(docs, text, start, tasks):
        made = learned(docs, text, start, tasks)
        asked.append((tasks, made.rdd.getNumPartitions()))
        starts.append(start)
        return made

    monkeypatch.setattr(gru_lm, "learned", noted)
    rows = [(i, "a b c d e") for i in range(300)]
    gru_lm.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(16), F.lit(True))
    assert asked == [(1, 1)] * gru_lm.ROUNDS
    # No round leaves its copy of the parameters.
    assert not any(os.path.exists(start._path) for start in starts)


def test_long_texts_take_the_output_layers_together(monkeypatch):
    """One call for many steps of a few long texts, not one for every window."""
    shape, p = small_model()
    texts = [np.random.default_rng(2).integers(0, 11, n).astype(np.int32) for n in (5000, 3, 4000)]
    calls, plain = [], gru_lm.log_probabilities

    def noted(p, h, token, per_class):
        calls.append(len(token))
        return plain(p, h, token, per_class)

    monkeypatch.setattr(gru_lm, "log_probabilities", noted)
    found = gru_lm.score_texts(texts, p, shape.per_class)
    assert calls == [9003]
    assert found == pytest.approx([reference_score(p, shape.per_class, t) for t in texts], rel=1e-4)


def test_output_slopes_follow_the_loss():
    """Of states, weights and biases, with words that come twice, and with logits that overflow."""
    for stretch in (1.0, 60.0):
        shape = gru_lm.Shape([f"w{i}".encode() for i in range(9)] + [b""], 7, classes=4)
        draw = np.random.default_rng(8)
        p = gru_lm.Parameters(*[
            part.astype(np.float64) + stretch * draw.normal(0, 0.3, part.shape) * (part > -50)
            for part in gru_lm.initial(shape, list(range(10, 0, -1)))
        ])
        h, token = draw.uniform(-1, 1, (12, gru_lm.HIDDEN)), draw.integers(0, 11, 12).astype(np.int32)

        def loss(p, h):
            total = 0.0
            for row, (group, place) in zip(h, (divmod(int(t), shape.per_class) for t in token), strict=True):
                for z, at in ((row @ p.class_out + p.class_bias, group), (row @ p.word_out[group] + p.word_bias[group], place)):
                    total += z.max() + np.log(np.exp(z - z.max()).sum()) - z[at]
            return total * 0.5

        slopes = {}

        class Noted(gru_lm.Trainer):
            def change(self, name, slope, at=None):
                slopes[name, at] = slope

        slopes["h"] = Noted(p, shape.per_class).output_slopes(h, token, 0.5)

        def numeric(array, at):
            found = []
            for d in (1e-6, -1e-6):
                kept = array[at]
                array[at] += d
                found.append(loss(p, h))
                array[at] = kept
            return (found[0] - found[1]) / 2e-6

        for i in (0, 5, 11):
            assert slopes["h"][i, 3] == pytest.approx(numeric(h, (i, 3)), rel=1e-3, abs=1e-5)
            c = int(token[i]) // shape.per_class
            assert slopes["class_out", None][2, c] == pytest.approx(numeric(p.class_out, (2, c)), rel=1e-3, abs=1e-5)
            assert slopes["class_bias", None][c] == pytest.approx(numeric(p.class_bias, c), rel=1e-3, abs=1e-5)
            at = int(token[i]) % shape.per_class
            assert slopes["word_out", c][4, at] == pytest.approx(numeric(p.word_out, (c, 4, at)), rel=1e-3, abs=1e-5)
            assert slopes["word_bias", c][at] == pytest.approx(numeric(p.word_bias, (c, at)), rel=1e-3, abs=1e-5)


def grouped_model(monkeypatch, words=90, stretch=0.3):
    """Classes in groups, as for many words."""
    monkeypatch.setattr(gru_lm, "GROUPED", 20)
    shape = gru_lm.shaped([f"w{i}".encode() for i in range(words - 1)] + [b""], 7)
    assert shape.groups > 1 and shape.groups < shape.classes < words
    p, draw = gru_lm.initial(shape, [words - i for i in range(words)]), np.random.default_rng(9)
    return shape, gru_lm.Parameters(*[q.astype(np.float64) + draw.normal(0, stretch, q.shape) * (q > -50) for q in p])


def grouped_log_probability(p, per_class, h, token):
    """Group, class within the group, word within the class, one after the other."""
    own, place = divmod(int(token), per_class)
    wide = -(-len(p.class_bias) // len(p.group_bias))
    group, at = divmod(own, wide)
    some, total = slice(group * wide, (group + 1) * wide), 0.0
    for out, bias, i in (
        (p.group_out, p.group_bias, group),
        (p.class_out[:, some], p.class_bias[some], at),
        (p.word_out[own], p.word_bias[own], place),
    ):
        z = h @ out + bias
        total += z[i] - z.max() - np.log(np.exp(z - z.max()).sum())
    return total


@pytest.mark.parametrize("few", [1, 1000])
def test_grouped_classes_one_by_one_and_side_by_side(monkeypatch, few):
    """Probabilities and all slopes, for classes taken together and for each alone."""
    monkeypatch.setattr(gru_lm, "FEW", few)
    monkeypatch.setattr(gru_lm, "ROWS", 16)
    shape, p = grouped_model(monkeypatch)
    draw = np.random.default_rng(8)
    h, token = draw.uniform(-1, 1, (200, gru_lm.HIDDEN)), draw.integers(0, 91, 200).astype(np.int32)
    token[:60] = 3
    plain = [grouped_log_probability(p, shape.per_class, row, t) for row, t in zip(h, token, strict=True)]
    assert gru_lm.log_probabilities(p, h, token, shape.per_class) == pytest.approx(plain, rel=1e-6)
    slopes = {n: np.zeros(q.shape) for n, q in p._asdict().items()}

    class Noted(gru_lm.Trainer):
        def change(self, name, slope, at=slice(None)):
            slopes[name][at] += slope

    back = Noted(p, shape.per_class).output_slopes(h, token, 0.5)
    loss = lambda: -0.5 * gru_lm.log_probabilities(p, h, token, shape.per_class).sum()

    def numeric(array, at):
        found, kept = [], array[at]
        for d in (1e-6, -1e-6):
            array[at] = kept + d
            found.append(loss())
        array[at] = kept
        return (found[0] - found[1]) / 2e-6

    for name in ("group_out", "group_bias", "class_out", "class_bias", "word_out", "word_bias"):
        array = getattr(p, name)
        for flat in draw.integers(0, array.size, 12):
            at = np.unravel_index(flat, array.shape)
            if array[at] > -50:
                assert slopes[name][at] == pytest.approx(numeric(array, at), rel=1e-3, abs=1e-5)
    for at in [(0, 3), (70, 5), (199, 15)]:
        assert back[at] == pytest.approx(numeric(h, at), rel=1e-3, abs=1e-5)


def test_grouped_probabilities_start_at_the_counts(monkeypatch):
    shape, _ = grouped_model(monkeypatch)
    counts = list(range(190, 100, -1))
    p = gru_lm.initial(shape, counts)
    every = np.arange(91)
    found = gru_lm.log_probabilities(p, np.zeros((91, gru_lm.HIDDEN), np.float32), every, shape.per_class)
    mass = np.array([7, *(c + 1 for c in counts)])
    assert np.exp(found.astype(float)) == pytest.approx(mass / mass.sum(), rel=1e-3)


def test_a_round_holds_its_parameters_once(spark):
    """The driver takes the new parameters in parts, as single numbers: not all rows at a time."""
    import tracemalloc

    shape = gru_lm.Shape([b"a", b"b", b"", *[f"w{i}".encode() for i in range(30_000)]], 7)
    p = gru_lm.initial(shape, [1] * len(shape.words))
    docs = spark.createDataFrame([(i, "a b") for i in range(50)], "doc_id long, text string")
    tracemalloc.start()
    try:
        found = gru_lm.train_round(docs, "text", shape, p, 1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [q.shape for q in found] == [q.shape for q in p]
    assert not np.array_equal(found.inputs, p.inputs) and np.array_equal(found.inputs[9:], p.inputs[9:])
    assert peak < 3 * sum(q.nbytes for q in p)


def test_words_are_cut_as_bytes_are():
    import pyarrow as pa

    texts = ["", " ", "a", "\t\n\x0b\x0c\r", None, "x\x00y  Z", "  a \r\n b  ", "Ä B c \x1cd\x1f e\x85", "a"]
    vocabulary = gru_lm.Vocabulary([b"a", b"", b"b"])
    # Also as a part of a longer column.
    own, rare = vocabulary.ids(pa.array(["q q", *texts]).slice(1))
    at = {b"a": 1, b"": 2, b"b": 3}
    assert [x.tolist() for x in own] == [[at.get(w, 0) for w in tokens_of(text)] for text in texts]
    assert rare == [[w for w in tokens_of(text) if w not in at] for text in texts]

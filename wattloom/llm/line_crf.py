"""Quality rules with a linear-chain conditional random field over the lines of a document.

Each line gets a handful of shape features. A chain of two labels, content and boilerplate, with a
weight per (feature, label) and per (label, next label) is decoded by Viterbi; a document is kept if
enough of its words lie in content lines. Counts that reject a document by themselves (too few
words, too many repeated five-word windows) come first.

The weights are fitted by maximum likelihood on a bounded sample of labelled documents: the lines
of good documents count as content unless they repeat, the lines of bad ones as boilerplate. The
fit is drawn towards fixed prior weights, which are what is left without labels.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.llm.common import whole_row

SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\v\f\r"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = b"abcdefghijklmnopqrstuvwxyz"
DIGITS = b"0123456789"
PUNCTUATION = b".,;:?'\"()-"
WINDOW = 5

#: Labelled documents to fit on, and how long they may be.
SAMPLE_DOCUMENTS = 1500
SAMPLE_LINES = 60
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_CONTENT = 0.3

# Prior weights of "content" over "boilerplate" by feature, in the order of
# line_features, and of staying on a label over changing it.
PRIOR = (0.5, 0.3, -12.0, -3.0, -3.0, -10.0, 0.5, -2.0, 1.0, 0.0, 0.0)
PRIOR_STAY = 1.0


class Model(NamedTuple):
    """Weights of content over boilerplate per feature, and label-to-label weights (2 x 2)."""

    weights: np.ndarray
    moves: np.ndarray


def line_features(line: bytes, words: Sequence[bytes], repeated: bool) -> tuple[float, ...]:
    """Bias, length, shares of symbols, capitals, digits, exclamation marks, a full stop at the
    end, repetition in the document, share of different words, punctuation, word length."""
    size = len(line) or 1
    n = len(words)
    upper = len(line) - len(line.translate(None, UPPER))
    lower = len(line) - len(line.translate(None, LOWER))
    return (
        1.0,
        min(n, 60) / 20,
        (len(line) - len(line.translate(None, SYMBOLS))) / size,
        upper / (upper + lower + 1),
        (len(line) - len(line.translate(None, DIGITS))) / size,
        line.count(b"!") / size,
        float(line.rstrip()[-1:] in (b".", b"?", b":")),
        float(repeated),
        len(set(words)) / n if n else 0.0,
        (len(line) - len(line.translate(None, PUNCTUATION))) / size,
        min((len(line) - n + 1) / n, 20.0) / 10 if n else 0.0,
    )


class Lines(NamedTuple):
    """The lines with a word: their features, their words; and the counts of the document."""

    features: list[tuple[float, ...]]
    n_words: list[int]
    n_dup_lines: int
    words: list[bytes]


def read_lines(text: str) -> Lines:
    seen: set[bytes] = set()
    features, counts, all_words, repeats = [], [], [], 0
    for line in text.encode().split(b"\n"):
        words = line.split()
        if not words:
            continue
        repeated = line in seen
        repeats += repeated
        seen.add(line)
        features.append(line_features(line, words, repeated))
        counts.append(len(words))
        all_words += words
    return Lines(features, counts, repeats, all_words)


def repeat_words(words: Sequence[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more in the text, the first one included."""
    windows = list(zip(*(words[i:] for i in range(window)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    covered = upto = 0
    for i, w in enumerate(windows):
        if found[w] > 1:
            covered += i + window - max(i, upto)
            upto = i + window
    return covered


def viterbi(scores: np.ndarray, moves: np.ndarray) -> list[bool]:
    """The best labels of one document, True for content; ties go to content."""
    (stay_b, b_to_c), (c_to_b, stay_c) = moves.tolist()
    boiler, content = 0.0, 0.0
    back: list[tuple[bool, bool]] = []
    for i, gain in enumerate(scores.tolist()):
        if i == 0:
            boiler, content = 0.0, gain
            continue
        from_c_to_b, from_b_to_b = content + c_to_b, boiler + stay_b
        from_c_to_c, from_b_to_c = content + stay_c, boiler + b_to_c
        back.append((from_c_to_b >= from_b_to_b, from_c_to_c >= from_b_to_c))
        boiler = max(from_c_to_b, from_b_to_b)
        content = gain + max(from_c_to_c, from_b_to_c)
    labels = [content >= boiler]
    for to_boiler, to_content in reversed(back):
        labels.append(to_content if labels[-1] else to_boiler)
    return labels[::-1]


def likelihood_gradient(
    model: Model, features: np.ndarray, labels: np.ndarray, lengths: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean log-likelihood per line of padded chains (docs x lines x features) and its gradients,
    by the forward-backward recursions in log space."""
    docs, steps, _ = features.shape
    gain = features @ model.weights
    scores = np.stack([np.zeros_like(gain), gain], axis=2)
    inside = np.arange(steps)[None, :] < lengths[:, None]
    forward = np.zeros((docs, steps, 2))
    forward[:, 0] = scores[:, 0]
    for t in range(1, steps):
        reach = np.logaddexp.reduce(forward[:, t - 1, :, None] + model.moves, axis=1)
        forward[:, t] = np.where(inside[:, t, None], reach + scores[:, t], forward[:, t - 1])
    total = np.logaddexp.reduce(forward[:, -1], axis=1)
    backward = np.zeros((docs, steps, 2))
    for t in range(steps - 2, -1, -1):
        ahead = model.moves + (scores[:, t + 1] + backward[:, t + 1])[:, None, :]
        backward[:, t] = np.where(inside[:, t + 1, None], np.logaddexp.reduce(ahead, axis=2), 0.0)
    share = np.exp(forward + backward - total[:, None, None])[:, :, 1]
    lines = max(1, inside.sum())
    wrong = np.where(inside, labels - share, 0.0)
    by_feature = np.einsum("dt,dtf->f", wrong, features) / lines
    by_move = np.zeros((2, 2))
    score = np.where(inside, labels * gain, 0.0).sum() - total.sum()
    for t in range(1, steps):
        on = inside[:, t]
        pair = (
            forward[:, t - 1, :, None]
            + model.moves
            + (scores[:, t] + backward[:, t])[:, None, :]
            - total[:, None, None]
        )
        expected = np.exp(pair[on]).sum(axis=0)
        before, now = labels[on, t - 1].astype(int), labels[on, t].astype(int)
        actual = np.zeros((2, 2))
        np.add.at(actual, (before, now), 1.0)
        score += (actual * model.moves).sum()
        by_move += actual - expected
    return score / lines, by_feature, by_move / lines


def prior_model() -> Model:
    return Model(np.array(PRIOR), np.array([[PRIOR_STAY, 0.0], [0.0, PRIOR_STAY]]))


def fit(chains: Sequence[tuple[np.ndarray, np.ndarray]], rounds: int = 500, pull: float = 1e-3) -> Model:
    """Fit to (features, labels) of documents by gradient ascent with adapted steps (Adam)."""
    start = prior_model()
    if not chains:
        return start
    steps = max(len(labels) for _, labels in chains)
    features = np.zeros((len(chains), steps, len(PRIOR)))
    labels = np.zeros((len(chains), steps))
    lengths = np.array([len(y) for _, y in chains])
    for i, (x, y) in enumerate(chains):
        features[i, : len(y)], labels[i, : len(y)] = x, y
    flat = np.concatenate([start.weights, start.moves.ravel()])
    prior, first, second = flat.copy(), np.zeros_like(flat), np.zeros_like(flat)
    for step in range(1, rounds + 1):
        model = Model(flat[: len(PRIOR)], flat[len(PRIOR) :].reshape(2, 2))
        _, by_feature, by_move = likelihood_gradient(model, features, labels, lengths)
        slope = np.concatenate([by_feature, by_move.ravel()]) - pull * (flat - prior)
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        flat = flat + 0.1 * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.99**step)) + 1e-8
        )
    return Model(flat[: len(PRIOR)], flat[len(PRIOR) :].reshape(2, 2))


def train(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
    quality: str = "quality", sample: int = SAMPLE_DOCUMENTS,
) -> Model:
    """Fit on the ``sample`` labelled documents of the smallest hash, up to SAMPLE_LINES lines.

    Rows without an id, a text or a label are left out; a repeated label row counts again. Without
    labelled rows of both kinds the prior weights are returned.
    """
    marked = labels.select(F.col(id).alias("id"), F.col(quality).cast("int").alias("good"))
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    short = rows.where(F.regexp_count("text", F.lit("\n")) < SAMPLE_LINES)
    # Features are made where the texts are; only numbers of the sample reach the driver.
    picked = marked.where(F.col("good").isNotNull() & F.col("id").isNotNull())
    picked = picked.orderBy(F.xxhash64("id"), "id").limit(2 * sample)
    joined = short.join(F.broadcast(picked), "id").select("id", "good", "text")

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chains = [read_lines(t).features for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([[list(map(float, x)) for x in c] for c in chains], pa.list_(pa.list_(pa.float64()))),
                ],
                ["id", "good", "features"],
            )

    made = joined.mapInArrow(featurize, "id string, good int, features array<array<double>>"
                             .replace("string", dict(joined.dtypes)["id"]))
    found = made.where(F.size("features") > 0).orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    if len({row.good > 0 for row in found}) < 2:
        return prior_model()
    repeated = 7
    chains = []
    for row in found:
        x = np.array(row.features)
        y = (x[:, repeated] == 0).astype(float) if row.good > 0 else np.zeros(len(x))
        chains.append((x, y))
    return fit(chains)


VERDICT = T.StructType(
    [
        *[
            T.StructField(name, T.LongType())
            for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        ],
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("n_lines", T.LongType()),
        T.StructField("content_share", T.DoubleType()),
    ]
)


def judge(text: str, model: Model, min_content: float) -> tuple:
    """The counts of one document and the verdict, in the order of VERDICT."""
    lines = read_lines(text)
    n = len(lines.words)
    raw = text.encode()
    word_chars = len(text) - sum(map(text.count, SPACES))
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    repeats = repeat_words(lines.words)
    failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
    share = 0.0
    if n:
        content = viterbi(np.array(lines.features) @ model.weights, model.moves)
        share = sum(k for k, on in zip(lines.n_words, content, strict=True) if on) / n
    kept = not failed and share >= min_content
    return n, word_chars, n_symbols, lines.n_dup_lines, repeats, failed, kept, len(lines.n_words), share


def assess(
    docs: DataFrame, model: Model, passed: Sequence[str] = ("doc_id",), text: str = "text",
    min_content: float = MIN_CONTENT,
) -> DataFrame:
    """The columns ``passed`` of each row, then VERDICT. A NULL text counts as empty: no words, so
    ``base_failed``. Lines are cut at line feeds and a line without a word is none; whole texts are
    read however long. An empty table gives an empty result."""
    names = [f"_passed{i}" for i in range(len(passed))]
    rows = docs.select(
        F.col(text).alias("text"), *[F.col(f"`{c}`").alias(n) for c, n in zip(passed, names, strict=True)]
    )
    counts = VERDICT.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judge(value.as_py() or "", model, min_content) for value in batch.column(0)]
            columns = list(zip(*found, strict=True)) or [[] for _ in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:],
                    *[pa.array(c, pa.int64()) for c in columns[:5]],
                    *[pa.array(c, pa.bool_()) for c in columns[5:7]],
                    pa.array(columns[7], pa.int64()),
                    pa.array(columns[8], pa.float64()),
                ],
                [*names, *counts],
            )

    schema = T.StructType([*rows.schema.fields[1:], *VERDICT.fields])
    made = rows.mapInArrow(run, schema)
    return made.select(*[F.col(n).alias(c) for c, n in zip(passed, names, strict=True)], *counts)


def kept_documents(docs: DataFrame, model: Model, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns."""
    whole = docs.select(whole_row(docs), F.col(text).alias("text"))
    judged = assess(whole, model, ("row",), "text", **options)
    return judged.where("kept").select("row.*")

"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(bias + sum of weights of the terms + sum over pairs of terms of the inner product of
their factors). Terms are the different words of a text and the beginnings of words (stems that
take many endings), hashed into a fixed number of buckets. An additive model weighs each term alone;
the factors let two terms together, such as an insult and the mention of a group, weigh more than
both apart. The pairs cost no more than the terms: (sum of factors)^2 - sum of squared factors.

The machine is fitted on a bounded sample of labelled documents, in one task; texts are hashed where
they are read, and only bucket numbers of the sample travel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 18
FACTORS = 4
PREFIXES = (4, 5, 6)
#: Labelled documents to fit on, per label: those of the smallest hash.
SAMPLE_TOXIC = 3000
SAMPLE_CLEAN = 6000
#: A weight shrinks by what chance alone makes of its slope, times this.
NOISE = 1.0
#: The part of the factors' squares in the loss: less, and the pairs learn single long texts by heart.
FACTOR_SQUARES = 0.12
#: Where the sums of squared slopes start.
START = 1e-4
#: Rounds over the sample, more of them if they make fewer than STEPS steps.
EPOCHS = 30
STEPS = 600
BATCH = 256
KNOWN_WORDS = 400_000
THRESHOLD = 0.3
EDGES = ".,;:!?\"'()[]{}|*#$%&<>-_/\\"


class Machine(NamedTuple):
    bias: float
    weights: np.ndarray
    factors: np.ndarray


class Hasher:
    """Buckets of the terms of a text; the terms of a word are kept (a bounded number)."""

    def __init__(self) -> None:
        self.known: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        core = word.strip(EDGES)
        terms = {f"{core[:n]}~" for n in PREFIXES if len(core) > n} | {core} if core else set()
        buckets = [zlib.crc32(term.encode()) % BUCKETS for term in sorted(terms)]
        return np.array(buckets, dtype="<u4").tobytes()

    def buckets(self, text: str) -> np.ndarray:
        """Different buckets of a text, ascending."""
        words = set(text.lower().split())
        known = self.known
        new = [word for word in words if word not in known]
        if len(known) + len(new) > KNOWN_WORDS:
            known.clear()
            new = list(words)
        for word in new:
            known[word] = self.word(word)
        return np.unique(np.frombuffer(b"".join(map(known.__getitem__, words)), dtype="<u4"))


HASHER = Hasher()


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of rows, 0 for empty runs."""
    out = np.zeros((len(lengths), *values.shape[1:]), dtype=np.float64)
    filled = np.flatnonzero(lengths)
    if len(filled):
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])[filled]
        out[filled] = np.add.reduceat(values, starts, axis=0)
    return out


def raw_scores(machine: Machine, buckets: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores before the sigmoid, and the sums of factors, of documents laid end to end."""
    factors = machine.factors[buckets]
    total = sums(factors, lengths)
    squares = sums((factors * factors).sum(axis=1), lengths)
    pairs = 0.5 * ((total * total).sum(axis=1) - squares)
    return machine.bias + sums(machine.weights[buckets], lengths) + pairs, total


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(documents: list[np.ndarray], labels: np.ndarray, seed: int = 1) -> Machine:
    """Logistic loss, Adagrad on shuffled batches, over all buckets of the sample.

    No bucket is left out: a term may tell only together with another, and a rare one may be an
    insult. Weights shrink by the slope that chance gives a bucket of as many documents, factors in
    proportion to themselves, so that rare words of a few documents are not learned by heart.
    """
    random = np.random.default_rng(seed)
    lengths = np.array([len(d) for d in documents])
    held, places = np.unique(np.concatenate(documents), return_inverse=True)
    size, starts = len(held), np.concatenate([[0], np.cumsum(lengths)])
    places = places.astype(np.int64)
    # What chance alone makes of a bucket's slope grows with the root of its number of documents.
    share = labels.mean()
    noise = NOISE * np.sqrt(np.bincount(places, minlength=size) * share * (1 - share)) / len(documents)
    bias, bias_sum = float(np.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5))), 1e-8
    weights, factors = np.zeros(size), random.normal(0, 0.01, (size, FACTORS))
    weight_sum, factor_sum = np.full(size, START), np.full((size, FACTORS), START)
    for _ in range(max(EPOCHS, -(-STEPS // -(-len(documents) // BATCH)))):
        order = random.permutation(len(documents))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            buckets = np.concatenate([places[starts[i] : starts[i + 1]] for i in rows])
            raw, total = raw_scores(Machine(bias, weights, factors), buckets, lengths[rows])
            wrong = (sigmoid(raw) - labels[rows]) / len(rows)
            slope = np.bincount(buckets, np.repeat(wrong, lengths[rows]), size)
            pulls = wrong[:, None] * total
            pull = [np.bincount(buckets, np.repeat(pulls[:, f], lengths[rows]), size) for f in range(FACTORS)]
            slopes = np.stack(pull, axis=1) - factors * slope[:, None] + FACTOR_SQUARES * factors
            weight_sum += slope**2
            factor_sum += slopes**2
            rate = 0.1 / np.sqrt(weight_sum)
            moved = weights - rate * slope
            weights = np.sign(moved) * np.maximum(np.abs(moved) - rate * noise, 0)
            factors -= 0.02 * slopes / np.sqrt(factor_sum)
            bias_sum += wrong.sum() ** 2
            bias -= 0.05 * wrong.sum() / np.sqrt(bias_sum)
    machine = Machine(bias, np.zeros(BUCKETS), np.zeros((BUCKETS, FACTORS)))
    machine.weights[held], machine.factors[held] = weights, factors
    return machine


def pack(machine: Machine) -> bytes:
    parts = [np.array([machine.bias]), machine.weights, machine.factors.ravel()]
    return np.concatenate(parts).astype("<f4").tobytes()


def unpack(packed: bytes) -> Machine:
    flat = np.frombuffer(packed, dtype="<f4")
    return Machine(float(flat[0]), flat[1 : 1 + BUCKETS], flat[1 + BUCKETS :].reshape(BUCKETS, FACTORS))


def untrained() -> Machine:
    """Where there is nothing to learn from, every text gets the same low score."""
    return Machine(-3.0, np.zeros(BUCKETS), np.zeros((BUCKETS, FACTORS)))


def train(
    docs: DataFrame, labels: DataFrame, usable: Column, id: str = "doc_id", text: str = "text",
    toxic: str = "toxic",
) -> Machine:
    """Fit on labelled rows for which ``usable`` (over the columns of ``labels``) holds.

    At most SAMPLE_TOXIC toxic and SAMPLE_CLEAN clean rows, of the smallest hash of the id; the bias
    is then set for their shares among all usable rows. Labels without a document are left out, and
    so are rows with a NULL id or label. With one label only, nothing is learned.
    """
    marked = labels.where(usable).select(F.col(id).alias("id"), F.col(toxic).cast("int").alias("toxic"))
    marked = marked.where(F.col("id").isNotNull() & F.col("toxic").isNotNull())
    parts = [
        marked.where(condition).orderBy(F.xxhash64("id"), "id").limit(size)
        for condition, size in ((F.col("toxic") > 0, SAMPLE_TOXIC), (F.col("toxic") <= 0, SAMPLE_CLEAN))
    ]
    # At most SAMPLE_TOXIC + SAMPLE_CLEAN rows of two numbers.
    picked = F.broadcast(parts[0].unionByName(parts[1]))
    texts = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sample = texts.join(picked, "id").select("toxic", F.xxhash64("id").alias("order"), "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [HASHER.buckets(t.as_py()).tobytes() for t in batch.column(2)]
            arrays = [batch.column(0), batch.column(1), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["toxic", "order", "buckets"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        labels = np.array([float(row["toxic"] > 0) for row in rows])
        if 0 < labels.sum() < len(labels):
            # In the order of the hash, so that a rerun fits the same machine.
            place = sorted(range(len(rows)), key=lambda i: (rows[i]["order"], rows[i]["buckets"]))
            documents = [np.frombuffer(rows[i]["buckets"], dtype="<u4") for i in place]
            packed = pack(fit(documents, labels[place]))
            yield pa.RecordBatch.from_pydict({"machine": [packed]}, schema=pa.schema([("machine", pa.binary())]))

    features = sample.mapInArrow(hashed, "toxic int, order long, buckets binary")
    found = features.repartition(1).mapInArrow(learn, "machine binary").first()
    if found is None:
        return untrained()
    machine = unpack(bytes(found.machine))
    sizes = marked.agg(
        F.sum((F.col("toxic") > 0).cast("long")).alias("toxic"), F.count("*").alias("rows")
    ).first()
    clean = sizes.rows - sizes.toxic
    shift = np.log(sizes.toxic / clean) - np.log(min(sizes.toxic, SAMPLE_TOXIC) / min(clean, SAMPLE_CLEAN))
    return machine._replace(bias=machine.bias + float(shift))


def scored(
    docs: DataFrame, machine: Machine, id: str = "doc_id", text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Rows (id, score, predicted). A NULL text counts as empty and gets the score of no terms.
    Whole texts are read; repeated rows get equal scores; an empty table gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast(pack(machine))
    kept: dict[int, Machine] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = kept.setdefault(0, unpack(shared.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [HASHER.buckets(t.as_py() or "") for t in part.column(1)]
                lengths = np.array([len(b) for b in found])
                raw, _ = raw_scores(own, np.concatenate(found), lengths)
                score = sigmoid(raw)
                arrays = [part.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "score", "predicted"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    made = rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, score double, predicted int")
    return made.withColumnRenamed("id", id)

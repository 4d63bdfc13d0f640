"""Log-likelihoods of whole documents under a gated recurrent language model.

Counts first: every task counts the words of its training documents, the counts are summed by word,
and the words from some count on become the model's vocabulary, which grows with them; all others are one event, "rare", whose
probability the model gives and which is split by the counts. Words are cut into classes of about
equal size by falling frequency, and a word's probability is that of its class times that of the
word within the class, two short softmaxes instead of one long one; with many words, classes are in
groups, and there are three. All start at the counts, so the untrained model is a unigram model, and
training adds what the context tells. Small classes are taken many at a time.

Training runs in rounds over all training documents, one share of them per round. Every task takes
the current parameters through its documents, laid out as parallel streams, by truncated
backpropagation through time, and the tasks' results are averaged, block of parameters by block, in
proportion to the tokens that each has seen. A result is all parameters, so the number of tasks
follows from the tokens of a round and the size of the model, not from the splits of the input, and
what is sent is in proportion to the tokens. The driver takes the averages part by part and holds the
parameters once. The streams grow with the root of the number of words. Scoring carries the state of
a document from step to step, so its whole text is one sequence.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import saved

#: The vocabulary: all words of MIN_COUNT and more, and so many of the most frequent at least;
#: further words are "rare". Counts are sent along up to a bound, the only one on the vocabulary;
#: the others are joined.
VOCABULARY = 4095
MIN_COUNT = 20
HELD_COUNTS = 250_000
#: At least; the root of the number of words, if that is more.
CLASSES = 64
#: Beyond so many words there are classes to the power 0.7 of their number, in groups.
GROUPED = 4096
HIDDEN = 16
ROUNDS = 3
#: At least; two for each root of the number of words, if that is more.
STREAMS = 128
WINDOW = 20
#: Every LOSS_EVERYth step adds to the loss: all of them, every token is a target once.
LOSS_EVERY = 1
RATE = 0.05
BLOCK = 4096
#: Parts in which the driver takes the parameters of a round, one after the other.
PARTS_SENT = 8
#: Numbers that the tasks of a round send, for each of its tokens.
SENT = 1
#: Tokens whose states are kept while texts are scored, until the output layers take them all.
SCORED = 65_536
#: Texts that are scored side by side: the arrays of a step stay in a CPU's cache.
SIDE = 1024
HELD_WORDS = 1_000_000
#: Texts that are cut into words at a time.
CUT = 4096

#: Rows of the upper softmaxes at a time, which stay in a CPU's cache.
ROWS = 1024
#: Rows of the word softmaxes at a time; fewer classes than FEW are taken one by one.
LOT = 2048
FEW = 5

F32 = np.float32


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of all texts, A-Z in lower case, cut at ASCII white space; where those of each text
    begin, and the end; which texts have none. These count as one empty word, as they are cut."""
    spaced = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    cut = pc.ascii_split_whitespace(spaced)
    none = pc.equal(pc.binary_length(spaced), 0).to_numpy(zero_copy_only=False)
    return cut.flatten().cast(pa.binary()), cut.offsets.to_numpy(), none


def some_texts(batch: pa.RecordBatch, column: int) -> Iterator[pa.Array]:
    for at in range(0, batch.num_rows, CUT):
        yield batch.column(column).slice(at, CUT)


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """Rows (word, count) over all words and the ends of texts (the empty word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush():
            words, held = list(counts), list(counts.values())
            counts.clear()
            for at in range(0, len(words), 50_000):
                arrays = [pa.array(words[at : at + 50_000], pa.binary()), pa.array(held[at : at + 50_000], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["word", "count"])

        for batch in batches:
            for texts in some_texts(batch, 0):
                words, starts, none = words_of(texts)
                found = words.value_counts()
                counts.update(dict(zip(found.field(0).to_pylist(), found.field(1).to_pylist(), strict=True)))
                counts[b""] += int((~none).sum())
                if len(counts) > HELD_WORDS:
                    yield from flush()
        yield from flush()

    made = docs.select(text).mapInArrow(run, "word binary, count long")
    return made.groupBy("word").agg(F.sum("count").alias("count"))


class Shape(NamedTuple):
    """What all tasks share besides the parameters: ids of words, and the tokens of rare ones."""

    words: list[bytes]
    rare_mass: int
    classes: int = CLASSES
    groups: int = 1

    @property
    def per_class(self) -> int:
        return -(-(len(self.words) + 1) // self.classes)


def shaped(words: list[bytes], rare_mass: int) -> Shape:
    """Classes of the words by falling frequency: two short softmaxes, or three for many words."""
    if len(words) <= GROUPED:
        return Shape(words, rare_mass, max(CLASSES, math.isqrt(len(words)) + 1))
    classes = math.ceil(len(words) ** 0.7)
    return Shape(words, rare_mass, classes, math.isqrt(classes) + 1)


def per_group(classes: int, groups: int) -> int:
    return -(-classes // groups)


class Parameters(NamedTuple):
    """Input rows per word (update, reset, candidate), recurrent weights, the output layers."""

    inputs: np.ndarray  # words x 3H
    recurrent: np.ndarray  # H x 3H
    group_out: np.ndarray  # H x groups
    group_bias: np.ndarray
    class_out: np.ndarray  # H x classes, those of a group side by side
    class_bias: np.ndarray
    word_out: np.ndarray  # classes x H x words per class
    word_bias: np.ndarray  # classes x words per class; -inf where there is no word

    def copied(self) -> Parameters:
        return Parameters(*[part.copy() for part in self])

    def of(self, flat: np.ndarray) -> Parameters:
        """Parameters of the same shapes, as parts of one array."""
        parts = np.split(flat, np.cumsum([part.size for part in self])[:-1])
        return Parameters(*[new.reshape(part.shape) for new, part in zip(parts, self, strict=True)])


def initial(shape: Shape, counts: list[int], seed: int = 1) -> Parameters:
    """Small random weights; output biases that give the counts' own probabilities.

    Id 0 is the rare event, the words follow by falling frequency.
    """
    random = np.random.default_rng(seed)
    mass = np.zeros(shape.classes * shape.per_class)
    mass[0] = shape.rare_mass
    mass[1 : 1 + len(counts)] = np.array(counts) + 1.0
    by_class = mass.reshape(shape.classes, shape.per_class)
    of_class, wide = by_class.sum(axis=1), per_group(shape.classes, shape.groups)
    of_group = np.add.reduceat(np.append(of_class, 0), np.minimum(np.arange(shape.groups) * wide, shape.classes))
    # A group may have no class, and reduceat gives such a one the class after it.
    of_group[np.arange(shape.groups) * wide >= shape.classes] = 0

    def bias(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.maximum(np.log(part) - np.log(np.maximum(whole, 1)), -60.0).astype(F32)

    def draw(scale: float, *size: int) -> np.ndarray:
        drawn = random.standard_normal(size, dtype=F32)
        drawn *= F32(scale)
        return drawn

    return Parameters(
        draw(0.1, len(mass), 3 * HIDDEN),
        draw(0.5 / math.sqrt(HIDDEN), HIDDEN, 3 * HIDDEN),
        np.zeros((HIDDEN, shape.groups), F32),
        bias(of_group, of_group.sum()),
        np.zeros((HIDDEN, shape.classes), F32),
        bias(of_class, of_group.repeat(wide)[: shape.classes]),
        np.zeros((shape.classes, HIDDEN, shape.per_class), F32),
        bias(by_class, of_class[:, None]),
    )


def sigmoid(x: np.ndarray) -> np.ndarray:
    x = 0.5 * x
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def step(p: Parameters, h: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, tuple]:
    """The next states of a batch of streams, and what the backward pass needs."""
    x, u = p.inputs[token], h @ p.recurrent
    x[:, : 2 * HIDDEN] += u[:, : 2 * HIDDEN]
    gates = sigmoid(x[:, : 2 * HIDDEN])
    update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
    candidate = np.tanh(x[:, 2 * HIDDEN :] + reset * u[:, 2 * HIDDEN :])
    return h + update * (candidate - h), (h, update, reset, candidate, u[:, 2 * HIDDEN :])


def logits(h: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Without the biases, and less by a row's largest where their exponents could overflow: states
    lie within -1 and 1, so the sum of a word's weights is its bound."""
    z = h @ out
    if np.abs(out).sum(axis=-2).max() > 30:
        z -= z.max(axis=-1, keepdims=True)
    return z


def own_places(z: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """The index of one place in each row."""
    if z.ndim == 2:
        return np.arange(len(z)), at
    return np.arange(len(z))[:, None], np.arange(z.shape[1]), at


def biases(bias: np.ndarray, at: np.ndarray) -> np.ndarray:
    return bias[at] if bias.ndim == 1 else bias[np.arange(len(bias))[:, None], at]


def chosen(h: np.ndarray, out: np.ndarray, bias: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The log softmax of h @ out + bias at one place of each row, of one class or of many."""
    z = logits(h, out)
    picked = z[own_places(z, at)] + biases(bias, at)
    return picked - np.log(np.exp(z, out=z) @ np.exp(bias)[..., None])[..., 0]


def softmax_slopes(
    h: np.ndarray, out: np.ndarray, bias: np.ndarray, at: np.ndarray, scale: float, real: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the loss at one place of each row, of one class or of many: by the states, and by
    the weights with the bias as last row. Biases and denominators are factors of rows and columns,
    so that few steps touch all logits. Rows that are not ``real`` add nothing to the weights."""
    z = logits(h, out)
    e, mass = np.exp(z, out=z), np.exp(bias)[..., None, :]
    total = e @ mass.swapaxes(-1, -2)
    e[own_places(e, at)] -= total[..., 0] / biases(mass[..., 0, :], at)
    share = scale / total
    if real is not None:
        share *= real[..., None]
    ahead = np.concatenate([h * share, share], axis=-1)
    return (e @ (out * mass).swapaxes(-1, -2)) * share, (ahead.swapaxes(-1, -2) @ e) * mass


def lots(counts: np.ndarray) -> Iterator[np.ndarray]:
    """The classes with rows, in lots of about equally many rows each."""
    seen = np.flatnonzero(counts)
    seen = seen[np.argsort(counts[seen], kind="stable")]
    rows, at = counts[seen], 0
    while at < len(seen):
        most = rows[at] + rows[at] // 4
        end = min(int(np.searchsorted(rows, most, "right")), at + max(1, LOT // int(most)))
        yield seen[at:end]
        at = end


def side_by_side(first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of each class of a lot, and which of them are real: short ones repeat their first."""
    at = np.arange(counts.max())
    real = at < counts[:, None]
    return first[:, None] + at * real, real


def slices(bounds: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each part that has rows, ROWS at a time."""
    for part in np.flatnonzero(np.diff(bounds)):
        for at in range(bounds[part], bounds[part + 1], ROWS):
            yield part, slice(at, min(at + ROWS, bounds[part + 1]))


class Places(NamedTuple):
    """Where sorted tokens lie in the output layers."""

    group: np.ndarray  # of each token; its class and its place there likewise
    own: np.ndarray
    place: np.ndarray
    by_group: np.ndarray  # the first row of each group, and the end
    by_class: np.ndarray
    wide: int  # classes of a group


def places(p: Parameters, token: np.ndarray, per_class: int) -> Places:
    classes, groups = len(p.class_bias), len(p.group_bias)
    wide = per_group(classes, groups)
    own = token // per_class
    group = own // wide
    by_group, by_class = (np.searchsorted(x, np.arange(n + 1)) for x, n in ((group, groups), (own, classes)))
    return Places(group, own, token - own * per_class, by_group, by_class, wide)


def log_probabilities(p: Parameters, h: np.ndarray, token: np.ndarray, per_class: int) -> np.ndarray:
    """Natural log of the probability of each token after its state."""
    order = np.argsort(token)
    h = h[order]
    at = places(p, token[order], per_class)
    found = np.zeros(len(token), h.dtype)
    if len(p.group_bias) > 1:
        for _, rows in slices(np.array([0, len(token)])):
            found[rows] = chosen(h[rows], p.group_out, p.group_bias, at.group[rows])
    for g, rows in slices(at.by_group):
        some = slice(g * at.wide, (g + 1) * at.wide)
        found[rows] += chosen(h[rows], p.class_out[:, some], p.class_bias[some], at.own[rows] - some.start)
    counts = np.diff(at.by_class)
    for lot in lots(counts):
        if len(lot) < FEW:
            for c in lot:
                rows = slice(at.by_class[c], at.by_class[c + 1])
                found[rows] += chosen(h[rows], p.word_out[c], p.word_bias[c], at.place[rows])
            continue
        rows, real = side_by_side(at.by_class[lot], counts[lot])
        more = chosen(h[rows], p.word_out[lot], p.word_bias[lot], at.place[rows])
        found[rows[real]] += more[real]
    out = np.empty_like(found)
    out[order] = found
    return out


class Trainer:
    """Truncated backpropagation with Adagrad over parallel streams of tokens."""

    def __init__(self, p: Parameters, per_class: int):
        self.p, self.per_class = p, per_class
        # The biases start where the counts want them, so they move slowly.
        self.sums = Parameters(
            *[np.full(q.shape, 1.0 if n.endswith("bias") else 1e-3, F32) for n, q in p._asdict().items()]
        )

    def change(self, name: str, slope: np.ndarray, at=slice(None)) -> None:
        held, part = getattr(self.sums, name), getattr(self.p, name)
        sums = held[at] + slope * slope
        held[at] = sums
        np.sqrt(sums, out=sums)
        np.divide(slope, sums, out=sums)
        sums *= F32(RATE)
        part[at] -= sums

    def output_slopes(self, h: np.ndarray, token: np.ndarray, scale: float) -> np.ndarray:
        """Update the output layers and return the slope of the loss by the states."""
        p, scale = self.p, h.dtype.type(scale)
        order = np.argsort(token)
        h = h[order]
        at = places(p, token[order], self.per_class)
        back = np.zeros_like(h)
        if len(p.group_bias) > 1:
            slope = np.zeros((HIDDEN + 1, len(p.group_bias)), h.dtype)
            for _, rows in slices(np.array([0, len(token)])):
                back[rows], by_weight = softmax_slopes(h[rows], p.group_out, p.group_bias, at.group[rows], scale)
                slope += by_weight
            self.change("group_out", slope[:-1])
            self.change("group_bias", slope[-1])
        slope = np.zeros((HIDDEN + 1, len(p.class_bias)), h.dtype)
        for g, rows in slices(at.by_group):
            some = slice(g * at.wide, (g + 1) * at.wide)
            by_state, by_weight = softmax_slopes(
                h[rows], p.class_out[:, some], p.class_bias[some], at.own[rows] - some.start, scale
            )
            back[rows] += by_state
            slope[:, some] += by_weight
        self.change("class_out", slope[:-1])
        self.change("class_bias", slope[-1])
        counts = np.diff(at.by_class)
        for lot in lots(counts):
            if len(lot) < FEW:
                for c in lot:
                    rows = slice(at.by_class[c], at.by_class[c + 1])
                    by_state, slope = softmax_slopes(h[rows], p.word_out[c], p.word_bias[c], at.place[rows], scale)
                    back[rows] += by_state
                    self.change("word_out", slope[:-1], c)
                    self.change("word_bias", slope[-1], c)
                continue
            rows, real = side_by_side(at.by_class[lot], counts[lot])
            by_state, slope = softmax_slopes(h[rows], p.word_out[lot], p.word_bias[lot], at.place[rows], scale, real)
            back[rows[real]] += by_state[real]
            self.change("word_out", slope[:, :-1], lot)
            self.change("word_bias", slope[:, -1], lot)
        slopes = np.empty_like(back)
        slopes[order] = back
        return slopes

    def window(
        self, tokens: np.ndarray, before: np.ndarray, h: np.ndarray, turn: int, weight: float = 1.0
    ) -> np.ndarray:
        """One window (streams x steps): ``before`` is the token read ahead of each predicted one,
        -1 at the start of a text, where the state is cleared. Returns the last states."""
        p, (streams, steps) = self.p, tokens.shape
        tokens, before = np.ascontiguousarray(tokens.T), np.ascontiguousarray(before.T)
        starts, read = before < 0, np.maximum(before, 0)
        states, kept = [], []
        for t in range(steps):
            h, memory = step(p, h, read[t])
            h[starts[t]] = 0
            states.append(h)
            kept.append(memory)
        scored = range(turn % LOSS_EVERY, steps, LOSS_EVERY)
        picked = np.concatenate([states[t] for t in scored])
        # The mean loss per scored token, times a constant, so that steps do not depend on sizes.
        slopes = self.output_slopes(picked, np.concatenate([tokens[t] for t in scored]), weight * 32.0 / len(picked))
        by_step = dict(zip(scored, np.split(slopes, len(scored)), strict=True))
        dh = np.zeros_like(h)
        d_recurrent = np.zeros_like(p.recurrent)
        d_inputs = np.empty((steps, streams, 3 * HIDDEN), h.dtype)
        d_u, back = np.empty_like(d_inputs[0]), np.ascontiguousarray(p.recurrent.T)
        of_update, of_reset, of_candidate = (slice(i * HIDDEN, (i + 1) * HIDDEN) for i in range(3))
        for t in range(steps - 1, -1, -1):
            if t in by_step:
                dh += by_step[t]
            dh[starts[t]] = 0
            old, update, reset, candidate, u = kept[t]
            d_x, stay = d_inputs[t], 1 - update
            d_candidate = dh * update
            d_update = d_candidate * (candidate - old)
            np.multiply(d_update, stay, out=d_x[:, of_update])
            d_candidate *= 1 - candidate * candidate
            d_x[:, of_candidate] = d_candidate
            np.multiply(d_candidate, reset, out=d_u[:, of_candidate])
            np.multiply(d_u[:, of_candidate] * u, 1 - reset, out=d_x[:, of_reset])
            d_u[:, : 2 * HIDDEN] = d_x[:, : 2 * HIDDEN]
            d_recurrent += old.T @ d_u
            dh *= stay
            dh += d_u @ back
        self.change("recurrent", np.clip(d_recurrent, -5, 5))
        read = read.ravel()
        order = np.argsort(read)
        first = np.flatnonzero(np.diff(read[order], prepend=-1))
        slope = np.add.reduceat(d_inputs.reshape(-1, 3 * HIDDEN)[order], first)
        self.change("inputs", slope, read[order[first]])
        return h

    def train(self, tokens: np.ndarray, before: np.ndarray) -> None:
        """All tokens of a batch, cut into streams of equal length; a rest shorter than the number
        of streams goes on from the last stream, with the weight that its tokens have in a window."""
        most = max(STREAMS, 2 * math.isqrt(len(self.p.inputs)))
        streams = max(1, min(most, len(tokens) // (4 * WINDOW)))
        length = len(tokens) // streams
        h = np.zeros((streams, HIDDEN), F32)
        grid = tokens[: streams * length].reshape(streams, length)
        ahead = before[: streams * length].reshape(streams, length)
        for turn, at in enumerate(range(0, length, WINDOW)):
            cut = slice(at, at + WINDOW)
            h = self.window(grid[:, cut], ahead[:, cut], h, turn)
        h = h[-1:]
        for turn, at in enumerate(range(streams * length, len(tokens), WINDOW)):
            cut = slice(at, at + WINDOW)
            part = tokens[None, cut]
            h = self.window(part, before[None, cut], h, turn, part.size / (streams * WINDOW))


class Vocabulary:
    """Ids of words: their places from 1 on, 0 for all others."""

    def __init__(self, words: list[bytes]):
        self.words, self.end = pa.array(words, pa.binary()), words.index(b"") + 1

    def ids(self, texts: pa.Array) -> tuple[list[np.ndarray], list[list[bytes]]]:
        """Of the words of each text and of its end; and the words without an id."""
        words, starts, none = words_of(texts)
        found = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy() + 1
        rare = words.filter(pa.array(found == 0)).to_pylist()
        before = np.concatenate([[0], np.cumsum(found == 0)])[starts]
        # A text without words has its end already.
        ends = np.insert(found, starts[1:][~none], self.end)
        at = starts + np.concatenate([[0], np.cumsum(~none)])
        return np.split(ends, at[1:-1]), [rare[a:b] for a, b in zip(before, before[1:], strict=False)]


def learners(tokens: int, p: Parameters) -> int:
    """The tasks of a round over so many tokens, whose results are SENT numbers a token."""
    return max(1, -(-SENT * tokens // sum(part.size for part in p)))


def started(shape: Shape, p: Parameters) -> tuple[Shape, Parameters]:
    """What the tasks of a round start with."""
    return shape, p


def learned(docs: DataFrame, text: str, start: Broadcast, tasks: int) -> DataFrame:
    """Rows (block, weight, part): the parameters of each task after its documents. ``start`` holds
    the shape and the parameters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape, p = start.value
        vocabulary = Vocabulary(shape.words)
        trainer = Trainer(p.copied(), shape.per_class)
        seen = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [own for some in some_texts(batch, 0) for own in vocabulary.ids(some)[0]]
            tokens = np.concatenate(texts)
            before = np.concatenate([[-1], tokens[:-1]]).astype(np.int32)
            before[np.cumsum([0, *map(len, texts[:-1])])] = -1
            trainer.train(tokens, before)
            seen += len(tokens)
        if seen:
            flat = np.concatenate([part.ravel() for part in trainer.p], dtype="<f4")
            for block, at in enumerate(range(0, len(flat), BLOCK)):
                arrays = [pa.array([block]), pa.array([float(seen)]), pa.array([flat[at : at + BLOCK].tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["block", "weight", "part"])

    return docs.select(text).coalesce(tasks).mapInArrow(run, "block long, weight double, part binary")


def averaged(made: DataFrame) -> DataFrame:
    """Rows (block, part): the mean of each block by the tokens seen, in single precision."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of blocks: a fixed number of numbers, however many tasks there are."""
        sums: dict[int, np.ndarray] = {}
        weights: Counter = Counter()
        for batch in batches:
            for row in batch.to_pylist():
                part = np.frombuffer(row["part"], "<f4") * np.float64(row["weight"])
                sums[row["block"]] = sums[row["block"]] + part if row["block"] in sums else part
                weights[row["block"]] += row["weight"]
        for block, total in sums.items():
            part = (total / weights[block]).astype("<f4").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([part], pa.binary())], ["block", "part"])

    return made.repartition(PARTS_SENT, "block").mapInArrow(add, "block long, part binary")


def train_round(docs: DataFrame, text: str, shape: Shape, p: Parameters, tasks: int) -> Parameters:
    """One share of the documents through the tasks, averaged by tokens. The driver holds the new
    parameters once, and a part of them as rows."""
    start = docs.sparkSession.sparkContext.broadcast(started(shape, p))
    flat, found = np.empty(sum(part.size for part in p), F32), 0
    for row in averaged(learned(docs, text, start, tasks)).toLocalIterator():
        part = np.frombuffer(row.part, "<f4")
        flat[row.block * BLOCK : row.block * BLOCK + len(part)] = part
        found += len(part)
    start.destroy()  # else each round leaves a copy of the parameters with every executor
    return p.of(flat) if found else p


class Model(NamedTuple):
    shape: Shape
    parameters: Parameters
    train_tokens: int
    distinct: int
    counts: DataFrame
    held: dict[bytes, int]


def frequent_words(counts: DataFrame, most: int) -> dict[bytes, int]:
    """The words from some count on, the least one that at most ``most`` words reach."""
    tally = counts.groupBy("count").agg(F.count("*").alias("words")).collect()
    least, reached = None, 0
    for row in sorted(tally, key=lambda row: -row["count"]):
        reached += row.words
        if reached > most:
            break
        least = row["count"]
    if least is None:
        return {}
    found = counts.where(F.col("count") >= least).select("word", "count").toArrow()
    return dict(zip(found["word"].to_pylist(), found["count"].to_pylist(), strict=True))


def train(docs: DataFrame, usable: Column, id: str = "doc_id", text: str = "text") -> Model:
    """Learn from the rows for which ``usable`` holds: counts of all their words, then ROUNDS rounds
    that together take every row once."""
    rows = docs.where(usable).select(F.col(id).alias("id"), F.col(text).alias("text"))
    counts = saved(count_words(rows, "text"), "word-counts")
    total = counts.agg(F.sum("count").alias("tokens"), F.count("*").alias("distinct")).first()
    held = frequent_words(counts, HELD_COUNTS)
    ends = counts.where(F.length("word") == 0).select("count").first()
    held[b""] = ends[0] if ends else 0
    # The end of a text is always a word of the model.
    size = max(VOCABULARY, sum(c >= MIN_COUNT for c in held.values()))
    words = sorted(held.items(), key=lambda item: (item[0] != b"", -item[1], item[0]))[:size]
    words.sort(key=lambda item: (-item[1], item[0]))
    tokens, distinct = total.tokens or 0, total.distinct
    # What is left for rare words and for unknown ones, all counted once more.
    rare = tokens + distinct + 1 - sum(c + 1 for _, c in words)
    shape = shaped([w for w, _ in words], max(1, rare))
    p = initial(shape, [c for _, c in words])
    share = F.pmod(F.xxhash64("id", F.lit("round")), F.lit(ROUNDS))
    for i in range(ROUNDS):
        p = train_round(rows.where(share == i), "text", shape, p, learners(tokens // ROUNDS, p))
    return Model(shape, p, tokens, distinct, counts, held)


def score_texts(texts: list[np.ndarray], p: Parameters, per_class: int) -> np.ndarray:
    """Log10 probabilities of whole token sequences, SIDE of about equal lengths at a time. Their
    states wait until there are SCORED of them, which the output layers take together."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    totals = np.zeros(len(texts))
    states, tokens, rows, held = [], [], [], 0

    def taken() -> np.ndarray:
        found = log_probabilities(p, np.concatenate(states), np.concatenate(tokens), per_class)
        return np.bincount(np.concatenate(rows), found.astype(np.float64), len(texts))

    for at in range(0, len(order), SIDE):
        for state, token in running(p, [texts[i] for i in order[at : at + SIDE]]):
            states.append(state)
            tokens.append(token)
            rows.append(np.arange(at, at + len(token)))
            held += len(token)
            if held >= SCORED:
                totals += taken()
                states, tokens, rows, held = [], [], [], 0
    if held:
        totals += taken()
    scores = np.zeros(len(texts))
    scores[order] = totals / math.log(10)
    return scores


def running(p: Parameters, texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """States and tokens of texts, the longest ahead, so that those still running at a step are the
    first rows; each keeps its state from step to step."""
    lengths = np.array([len(text) for text in texts])
    flat = np.concatenate(texts)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    h = np.zeros((len(texts), HIDDEN), F32)
    for t in range(int(lengths[0])):
        still = int(np.searchsorted(-lengths, -t))
        h = h[:still]
        if t:
            h, _ = step(p, h, flat[starts[:still] + t - 1])
        yield h, flat[starts[:still] + t]


PARTS = (
    "row_id long, text_hash long, n_tokens long, known long, base double, score double, n_rest long,"
    " rest array<struct<word:binary,n:long>>"
)


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, n_tokens, n_known, train_tokens, base_score, score), all texts whole.

    base_score is that of add-one counts; score is the model's. Both are sums over the words and
    the end of log10 probabilities. Words that the model does not hold are looked up by a join of
    the different ones of each text with the counts. A NULL text is an empty one: its end only.
    Rows equal in id and text get equal scores. An empty table gives an empty result; without
    training rows every word is unknown.
    """
    context = docs.sparkSession.sparkContext
    tokens = model.train_tokens
    space = math.log10(tokens + model.distinct + 1)
    rare_mass = math.log10(model.shape.rare_mass)
    shared = context.broadcast((model.shape, model.parameters, model.held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape, p, counts = shared.value
        vocabulary = Vocabulary(shape.words)
        gains = np.array([0.0, *[math.log10(counts[w] + 1) for w in shape.words]])
        known_id = np.array([False, *[counts[w] > 0 for w in shape.words]])
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, rows = [], []
            rest_words, rest_counts, rest_ends = [], [], [0]
            for own, rare in chain.from_iterable(zip(*vocabulary.ids(some), strict=True) for some in some_texts(batch, 2)):
                looked_up = list(map(counts.get, rare))
                held = [n for n in looked_up if n is not None]
                rest = Counter(w for w, n in zip(rare, looked_up, strict=True) if n is None)
                rest_words += rest
                rest_counts += rest.values()
                rest_ends.append(len(rest_words))
                gain = float(np.log10(np.array(held, dtype=np.float64) + 1).sum())
                base = float(gains[own].sum()) + gain - space * len(own)
                texts.append(own)
                rows.append((
                    len(own), int(known_id[own].sum()) + len(held), base, gain - rare_mass * len(rare),
                    len(rare) - len(held),
                ))
            n_tokens, known, base, rare_gain, n_rest = zip(*rows, strict=True)
            rest = pa.StructArray.from_arrays(
                [pa.array(rest_words, pa.binary()), pa.array(rest_counts, pa.int64())], ["word", "n"]
            )
            columns = [
                pa.array(n_tokens, pa.int64()),
                pa.array(known, pa.int64()),
                pa.array(base),
                pa.array(score_texts(texts, p, shape.per_class) + np.array(rare_gain)),
                pa.array(n_rest, pa.int64()),
                pa.ListArray.from_arrays(pa.array(rest_ends, pa.int32()), rest),
            ]
            names = [part.split()[0] for part in PARTS.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names)

    rows = docs.select(F.col(id).cast("long"), F.xxhash64(F.col(text)), F.col(text))
    made = saved(rows.mapInArrow(run, PARTS), "text-scores")
    # Words that are not held are rare, so none of them has many texts.
    found = made.select("row_id", "text_hash", F.inline("rest")).join(model.counts, "word", "left")
    per_text = found.groupBy("row_id", "text_hash").agg(
        F.sum(F.when(F.col("count") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * F.log10(F.coalesce("count", F.lit(0)) + 1)).alias("gain"),
        F.sum("n").alias("words"),
    )
    per_text = per_text.withColumnsRenamed({"row_id": "_id", "text_hash": "_hash"})
    same = made["row_id"].eqNullSafe(F.col("_id")) & (made["text_hash"] == F.col("_hash"))
    # Rows equal in id and text share one sum, so each takes its part of it.
    part = F.col("n_rest") / F.col("words")
    gain = F.coalesce(F.col("gain") * part, F.lit(0.0))
    more = F.coalesce(F.round(F.col("more_known") * part), F.lit(0.0)).cast("long")
    return made.drop("rest").join(per_text, same, "left").select(
        F.col("row_id").alias(id),
        "n_tokens",
        (F.col("known") + more).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + gain).alias("base_score"),
        (F.col("score") + gain).alias("score"),
    )

"""Hard negatives by exact integer scores from Kronecker-packed products.

Components become integers, floor(256 x). A bias makes them non-negative, and the components of
several candidates are put side by side into one wide integer, a field each, wide enough for the
largest sum of products. One multiplication of that integer by a biased component of the anchor then
multiplies all its fields, the products are summed over the components, and each field of the sum is,
less what the biases add, the exact inner product of one candidate:

    sum (a + A)(b + B)  =  a.b + B sum a + A sum b + d A B

64-bit words hold as many fields as the data allow; where not even one fits, Python's integers of any
width take their place.

The anchors are a stated query set, held against all rows in blocks: each task has one block of
anchors and one of rows, and gives at most a fixed number of rows for an anchor. A first round finds
the positives of each anchor, a second one the negatives within the window of each positive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import saved

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these percentages of the positive's.
LEAST_PERCENT, MOST_PERCENT = 30, 90
#: Rows of a block at most.
BLOCK_ROWS = 32_768
#: Up to this magnitude components are 64-bit integers.
NARROW = 1 << 30
#: Fields and scores of so many bits at most are computed in 64-bit words.
WORD_BITS = 62


def scaled(vectors: pa.ListArray, dimensions: int) -> np.ndarray:
    """floor(256 x) as a matrix, missing components zero: 64-bit integers, or Python's if too large."""
    counts = vectors.value_lengths().to_numpy(zero_copy_only=False)
    floored = np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False))
    if np.abs(floored).max(initial=0) < NARROW:
        values = floored.astype(np.int64)
    else:
        values = np.array([int(v) for v in floored.tolist()], dtype=object)
    matrix = np.zeros((len(vectors), dimensions), dtype=values.dtype)
    matrix[np.arange(dimensions) < counts[:, None]] = values
    return matrix


class Packed:
    """The rows of a block in fields of wide integers, to be multiplied by some anchors."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray):
        n, dimensions = rows.shape
        self.bias, self.anchor_bias = (max(0, -int(m.min(initial=0))) for m in (rows, anchors))
        most = (int(rows.max(initial=0)) + self.bias) * (int(anchors.max(initial=0)) + self.anchor_bias)
        bits = max(1, (dimensions * most).bit_length())
        narrow = bits <= WORD_BITS and rows.dtype != object and anchors.dtype != object
        self.number = np.uint64 if narrow else int
        self.n, self.bits = n, bits
        self.fields = 64 // bits if narrow else 1
        words = -(-n // self.fields)
        # Field f holds the rows from f * words on.
        biased = np.zeros((self.fields * words, dimensions), dtype=np.uint64 if narrow else object)
        biased[:n] = rows + self.bias
        self.words = np.zeros((dimensions, words), dtype=biased.dtype)
        for field in range(self.fields):
            part = biased[field * words : (field + 1) * words].T
            self.words += part << self.number(field * bits)
        constant = dimensions * self.bias * self.anchor_bias
        self.row_part = self.anchor_bias * rows.sum(axis=1) + constant if dimensions else 0

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """The inner products of one anchor with all rows, as the nearest 64-bit numbers."""
        total = np.zeros(self.words.shape[1], dtype=self.words.dtype)
        for word, component in zip(self.words, anchor.tolist(), strict=True):
            total += word * self.number(component + self.anchor_bias)
        anchor_part = self.bias * sum(anchor.tolist())
        if self.number is int:
            exact = total[: self.n] - self.row_part - anchor_part
            return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)
        mask = np.uint64((1 << self.bits) - 1)
        fields = [total >> np.uint64(field * self.bits) & mask for field in range(self.fields)]
        return np.concatenate(fields)[: self.n].astype(np.int64) - self.row_part - anchor_part


def matrices(tables: list[pa.Table]) -> list[np.ndarray]:
    vectors = [pa.concat_arrays(t.column("vector").chunks) for t in tables]
    sizes = [v.value_lengths().to_numpy(zero_copy_only=False).max(initial=0) for v in vectors]
    return [scaled(v, int(max(sizes))) for v in vectors]


def scored(anchors: pa.Table, rows: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """The place of each anchor, and its scores with all rows."""
    if not anchors.num_rows or not rows.num_rows:
        return
    ours, theirs = matrices([anchors, rows])
    packed = Packed(theirs, ours)
    for i, anchor in enumerate(ours):
        yield i, packed.scores(anchor)


def falling(places: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Places by falling score (~ turns the order of all 64-bit numbers); ties keep the rising ids."""
    return places[np.argsort(~scores[places], kind="stable")]


def numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def as_table(found: list[np.ndarray], names: list[str]) -> pa.Table:
    rows = np.concatenate(found) if found else np.zeros((0, len(names)), dtype=np.int64)
    return pa.Table.from_arrays([pa.array(rows[:, i]) for i in range(len(names))], names=names)


def best_positives(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """For each anchor the POSITIVES best other rows of its label in this block."""
    ids, labels = numbers(rows, "id"), numbers(rows, "label")
    anchor_ids, anchor_labels = numbers(anchors, "id"), numbers(anchors, "label")
    found = []
    for i, scores in scored(anchors, rows):
        same = np.flatnonzero((labels == anchor_labels[i]) & (ids != anchor_ids[i]))
        best = falling(same, scores)[:POSITIVES]
        found.append(np.stack([np.full(len(best), anchor_ids[i]), ids[best], scores[best]], axis=1))
    return as_table(found, ["anchor_id", "positive_id", "positive_score"])


def best_negatives(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """For each anchor and positive the NEGATIVES best rows of other labels in this block and within
    the window of the positive's score."""
    ids, labels = numbers(rows, "id"), numbers(rows, "label")
    anchor_ids, anchor_labels = numbers(anchors, "id"), numbers(anchors, "label")
    positives = anchors.column("positives").to_pylist()
    found = []
    for i, scores in scored(anchors, rows):
        other = falling(np.flatnonzero(labels != anchor_labels[i]), scores)
        ordered = scores[other]
        for positive in positives[i]:
            score = positive["positive_score"]
            least, most = -(-LEAST_PERCENT * score // 100), MOST_PERCENT * score // 100
            best = np.flatnonzero((ordered >= least) & (ordered <= most))[:NEGATIVES]
            same = [np.full(len(best), v) for v in (anchor_ids[i], positive["positive_id"], score)]
            found.append(np.stack([*same, ids[other[best]], ordered[best]], axis=1))
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    return as_table(found, names)


def usable_rows(embeddings: DataFrame, id: str, vector: str, label: str) -> DataFrame:
    """Rows (id, label, vector) that take part; the label is changed where 7 divides the id."""
    components = F.col(vector).cast("array<double>")
    whole = F.forall(components, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    changed = F.when(F.col(id) % 7 == 0, (F.col(label) + 1) % 10).otherwise(F.col(label))
    return embeddings.where(F.col(id).isNotNull() & F.col(label).isNotNull() & whole).select(
        F.col(id).cast("long").alias("id"),
        changed.cast("long").alias("label"),
        components.alias("vector"),
    )


def in_blocks(rows: DataFrame, own: str, blocks: int, other: str, copies: int) -> DataFrame:
    """Each row in a block of its own side, once for each block of the other side."""
    block = F.pmod(F.xxhash64(F.lit(own), "id"), F.lit(blocks)).cast("int").alias(own)
    every = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other)
    return rows.select(block, every, *rows.columns)


def one_per_id(rows: pa.Table) -> pa.Table:
    """By rising id; of rows of one id the first by label, then by vector."""
    ids = numbers(rows, "id")
    order = np.argsort(ids, kind="stable").tolist()
    if len(np.unique(ids)) < len(ids):
        labels, vectors = (rows.column(c).to_pylist() for c in ("label", "vector"))
        order.sort(key=lambda i: (ids[i], labels[i], vectors[i]))
        order = [i for n, i in enumerate(order) if n == 0 or ids[i] != ids[order[n - 1]]]
    return rows.take(pa.array(order, pa.int64()))


def on_blocks(
    anchors: DataFrame, rows: DataFrame, best: Callable[[pa.Table, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """``best`` of every block of anchors and every block of rows, each pair in a task of its own."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    n_rows, n_anchors = rows.count(), anchors.count()
    # Blocks are bounded; those of a small table are still spread over the cores.
    row_blocks = max(1, -(-n_rows // BLOCK_ROWS), min(2 * cores, -(-n_rows // 2048)))
    anchor_blocks = max(1, -(-n_anchors // BLOCK_ROWS))
    left = in_blocks(anchors, "anchor_block", anchor_blocks, "row_block", row_blocks)
    right = in_blocks(rows, "row_block", row_blocks, "anchor_block", anchor_blocks)
    pair = ("anchor_block", "row_block")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return best(left, one_per_id(right))

    return left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInArrow(run, schema)


def first_rows(found: DataFrame, per: tuple[str, ...], score: str, id: str, n: int) -> DataFrame:
    """The n best of each group, ranked; what the blocks gave is bounded per group and block."""
    window = Window.partitionBy(*per).orderBy(F.col(score).desc(), id)
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)


def mine(
    embeddings: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    anchor_every: int = 100,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id ``anchor_every`` divides. Their positives are the POSITIVES rows of
    best score of the same label, and the negatives of each the NEGATIVES best rows of another label
    whose score lies within its window. Rows without id, label or vector, or with a component that
    is NULL, NaN or infinite, take no part; of rows of one id one does, the first by label and then
    by vector. Ties go to the smaller id. A shorter vector ends in zeros, an empty one scores 0. A
    score beyond 64 bits is the nearest 64-bit number. Anchors without a positive or a negative have
    no row, and an empty table none at all. Other columns are not read.
    """
    rows = saved(usable_rows(embeddings, id, vector, label), "vectors")
    unique = rows.where(F.col("id") % anchor_every == 0).groupBy("id")
    anchors = unique.agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.*")
    anchors = saved(anchors, "anchors")
    positives = on_blocks(
        anchors, rows, best_positives, "anchor_id long, positive_id long, positive_score long"
    )
    positives = first_rows(positives, ("anchor_id",), "positive_score", "positive_id", POSITIVES)
    listed = positives.groupBy(F.col("anchor_id").alias("id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")
    )
    negatives = on_blocks(
        saved(anchors.join(listed, "id"), "anchors-with-positives"),
        rows,
        best_negatives,
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    pair = ("anchor_id", "positive_id")
    return first_rows(negatives, pair, "negative_score", "negative_id", NEGATIVES).select(
        *pair, "rank", "negative_id", "positive_score", "negative_score"
    )

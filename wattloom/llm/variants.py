"""Spelling variants: words one edit apart, found by dense prefix-suffix tiles.

Two different words, the longer of n code points and the other of n or n - 1, are one inserted,
deleted or replaced code point apart if and only if their common prefix and their common suffix
together have n - 1 code points or more. The common prefix then has 0 to n - 1; this range is cut into
PARTS intervals, and in the interval from a to b - 1 both words share their first a and their last
n - b code points. So each word is listed under PARTS such keys for its own length and for that of
words longer by one, and near words meet under exactly one key: that of the interval their common
prefix is in.

Words sorted by key are cut into blocks. A pair of blocks with a key in common is a tile: two padded
matrices of code points are compared row by row, all with all, for common prefixes and, reversed,
suffixes. Nothing but the near pairs leaves the tile. A key with more words than a tile task should
hold is dealt out as pairs of its parts, each to a task of its own.

Counting the words is DataFrame functions; the tiles run in ``mapInArrow``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import saved, small

RUN = r"[A-Za-zÀ-ÿ]{%d,}"
MIN_LENGTH, MIN_COUNT = 7, 2
#: A word's form occurs so many times as often.
MORE_FREQUENT = 10
DELETE_EVERY = 31
PARTS = 3
#: Words of a block, bytes of one of its matrices, and words of a key in one task.
BLOCK, BLOCK_BYTES, KEY_WORDS = 128, 4_000_000, 4_096
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, nothing else; ``lower`` does just that where no other letter has a case."""
    plain = ~text.rlike("[^\\x00-\\x7Fß-öø-þ]")
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def word_counts(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Rows (word, n): the words of at least MIN_LENGTH code points and MIN_COUNT occurrences.

    A word is a maximal run of letters; in those whose checksum DELETE_EVERY divides, one code point
    is left out. A NULL id is written as the empty text.
    """
    name = F.coalesce(F.col(id).cast("string"), F.lit(""))
    whole = F.regexp_extract_all(F.col(text), F.lit(RUN % MIN_LENGTH), F.lit(0))
    # The outer form, which adds no filter that would cut every text a second time.
    runs = docs.select(name.alias("id"), F.explode_outer(whole).alias("run"))
    runs = runs.select("id", lower_ascii(F.col("run")).alias("run"))
    checksum = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8"))
    marked = runs.select("run", checksum.alias("h"))
    at = F.col("h") % F.length("run")
    shorter = F.concat(
        F.substring("run", F.lit(1), at.cast("int")), F.expr("substring(run, cast(h % length(run) + 2 as int))")
    )
    words = marked.select(F.when(F.col("h") % DELETE_EVERY == 0, shorter).otherwise(F.col("run")).alias("word"))
    words = words.where(F.length("word") >= MIN_LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


def keyed(words: DataFrame) -> DataFrame:
    """Rows (word, n, longer, part, key): each word under its keys."""
    longer = F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("longer")
    parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part")
    cut = words.select("word", "n", longer).select("*", parts)
    first = F.expr(f"left(word, cast(longer * part div {PARTS} as int))")
    last = F.expr(f"right(word, cast(longer - longer * (part + 1) div {PARTS} as int))")
    return cut.select("*", F.xxhash64("longer", "part", first, last).alias("key"))


def dealt(keys: DataFrame, key_words: int) -> DataFrame:
    """Add ``tile`` and ``side``: words of a key meet if they are in one tile and not both on side 1 or
    both on side 2. A key of many words is cut by a hash into parts, and has a tile per pair of them."""
    large = keys.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > key_words)
    large = saved(large.select("key", F.ceil(F.col("size") / key_words).cast("int").alias("chunks")), "large-keys")
    marked = keys.join(small(large), "key", "left")
    one = F.array(F.struct(F.lit(0).alias("low"), F.lit(0).alias("high"), F.lit(0).alias("side")))
    own = F.pmod(F.xxhash64(F.lit(7), "word"), F.col("chunks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.struct(
            F.least(own, other).alias("low"),
            F.greatest(own, other).alias("high"),
            F.when(own == other, 0).when(own < other, 1).otherwise(2).alias("side"),
        ),
    )
    tiles = F.explode(F.when(F.col("chunks").isNull(), one).otherwise(pairs)).alias("tile")
    return marked.select("word", "n", "longer", "part", "key", tiles).select(
        "word", "n", "longer", "part", F.xxhash64("key", "tile.low", "tile.high").alias("tile"), "tile.side"
    )


class Block:
    """Words of consecutive rows as padded matrices of code points, forwards and backwards."""

    def __init__(self, rows: pa.RecordBatch):
        self.words = rows.column("word").to_pylist()
        width = max(map(len, self.words))
        self.forwards = self.matrix(self.words, width)
        self.backwards = self.matrix([w[::-1] for w in self.words], width)
        self.n, self.longer, self.part, self.tile, self.side = (
            rows.column(c).to_numpy() for c in ("n", "longer", "part", "tile", "side")
        )
        self.length = np.fromiter(map(len, self.words), np.int64, len(self.words))

    @staticmethod
    def matrix(words: list[str], width: int) -> np.ndarray:
        points = np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)
        return np.ascontiguousarray(points.T.astype(np.uint8))  # letters are below U+0100


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common beginnings of all rows of one matrix and all of another."""
    run = np.ones((a.shape[1], b.shape[1]), dtype=bool)
    total = np.zeros(run.shape, dtype=np.int32)
    for left, right in zip(a, b, strict=False):
        run &= left[:, None] == right
        if not run.any():
            break
        total += run
    return total


def near_pairs(a: Block, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Places in the two blocks of words that are one edit apart and belong to this tile's key."""
    meet = (a.tile[:, None] == b.tile) & (a.longer[:, None] == b.longer) & (a.part[:, None] == b.part)
    meet &= (a.side[:, None] == 0) | (a.side[:, None] != b.side)
    if a is b:
        meet &= np.triu(np.ones(meet.shape, dtype=bool), 1)
    longest = np.maximum(a.length[:, None], b.length)
    meet &= longest == a.longer[:, None]
    if not meet.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    prefix = common(a.forwards, b.forwards)
    suffix = common(a.backwards, b.backwards)
    low, high = (a.longer * (a.part + i) // PARTS for i in (0, 1))
    meet &= (prefix >= low[:, None]) & (prefix < high[:, None]) & (prefix + suffix >= longest - 1)
    return np.nonzero(meet)


def blocks_of(rows: pa.Table) -> list[Block]:
    """Consecutive rows, few enough for their matrices to stay small."""
    lengths = rows.column("longer").to_numpy()
    found, at = [], 0
    while at < rows.num_rows:
        size = min(BLOCK, max(1, BLOCK_BYTES // int(lengths[at : at + BLOCK].max())))
        found.append(Block(rows.slice(at, size).combine_chunks().to_batches()[0]))
        at += size
    return found


NEAR = "word string, near string, near_n long"


def near_of(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Near pairs, both ways, of rows sorted by tile."""
    blocks = blocks_of(rows)
    for i, a in enumerate(blocks):
        for b in blocks[i:]:
            if b is not a and b.tile[0] != a.tile[-1]:
                break
            left, right = near_pairs(a, b)
            if not len(left):
                continue
            ours, theirs = [a.words[j] for j in left], [b.words[j] for j in right]
            counts = np.concatenate([b.n[right], a.n[left]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ours + theirs), pa.array(theirs + ours), pa.array(counts)],
                ["word", "near", "near_n"],
            )


def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by tile; those of the last tile of a batch wait for the next one."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        tile = batch.column("tile").to_numpy()
        if tile[0] == tile[-1]:
            continue
        rows = pa.Table.from_batches(waiting)
        ready = rows.num_rows - int((tile == tile[-1]).sum())
        yield from near_of(rows.slice(0, ready))
        waiting = rows.slice(ready).to_batches()
    if waiting:
        yield from near_of(pa.Table.from_batches(waiting))


def near_words(words: DataFrame, key_words: int = KEY_WORDS) -> DataFrame:
    """Rows (word, near, near_n) of every two of the words (word, n) that are one edit apart."""
    rows = dealt(keyed(words), key_words)
    sorted_rows = rows.repartition("tile").sortWithinPartitions("tile", "longer")
    return sorted_rows.mapInArrow(tiles, NEAR)


def roots_of(forms: DataFrame) -> DataFrame:
    """Rows (word, root): from each word of (word, form) along the forms to the last.

    A form occurs MORE_FREQUENT times as often as its word, so paths have few steps and no circle.
    Each round doubles the steps taken; it ends when no root has a form.
    """
    roots = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("at"), F.col("root").alias("further"))
        step = roots.join(further, F.col("root") == F.col("at"), "left")
        if step.where(F.col("further").isNotNull()).isEmpty():
            return roots
        roots = saved(step.select("word", F.coalesce("further", "root").alias("root")), "roots")


def variant_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n), one per word of ``word_counts``.

    ``form`` is the near word of largest n (the first in code-point order on ties), if that is at
    least MORE_FREQUENT times the word's own. NULL and empty texts have no words. Repeated rows count
    each. An empty table gives an empty result. Other columns are not read.
    """
    words = saved(word_counts(docs, id, text), "words")
    near = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    best_n = -F.col("best.less")
    frequent = best_n >= MORE_FREQUENT * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"),
        F.when(frequent, best_n).alias("form_n"),
    )
    variants = saved(joined, "variants")
    roots = roots_of(variants.where(F.col("form").isNotNull()))
    return variants.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

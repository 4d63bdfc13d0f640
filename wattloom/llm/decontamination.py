"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive words: some positions count, the others may hold anything.
Equal hashes of the counted words of a document and of a benchmark item are a hit; it fixes how the
two would lie side by side. Around a hit the item is compared word by word, so replaced words cost
as much as they are worth and need not be equal. The three masks below, over at most 9 words, hit
every overlap of 13 words that has two words replaced wherever these lie. Shorter items have masks
of their own, searched for each length so that they hit every overlap that counts.

Texts of both sides are cut into pieces of bounded size, which hold the words within reach of their
positions too, so that no row of a step has a whole text. A hit is compared within its reach.

The benchmark is cut into blocks of bounded size, which are broadcast one after another: hashes with
places, and apart from them the pieces. A document's words are hashed next to its text: no text,
word or position is shuffled, only verified overlaps are.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import saved, text_key, whole_row, word_array

# The counted positions of each mask, for a window of words or more.
MASKS = ((0, 1, 2, 3, 4, 6), (0, 1, 2, 4, 7, 8), (0, 1, 3, 5, 6, 7))
MAX_WEIGHT = 6
MAX_MASKS = 3
BLOCK_SEEDS = 1_000_000
WINDOW = 13
MIN_SHARE = 0.8
# Positions of a piece, and of a run of hits that one of them stands for.
PIECE = 512
RUN = 32


def hits(mask: tuple[int, ...], length: int, replaced: tuple[int, ...]) -> bool:
    """Whether the mask fits somewhere into so many words without counting a replaced one."""
    return any(
        all(start + offset not in replaced for offset in mask) for start in range(length - mask[-1])
    )


def masks_for(length: int, min_share: float) -> tuple[tuple[int, ...], ...]:
    """Masks that hit all of ``length`` words wherever as many are replaced as ``min_share`` allows.

    Of the heaviest masks of which MAX_MASKS do, the ones that each hit the most of what is left.
    """
    least_equal = max(1, math.ceil(length * min_share - 1e-9))
    placements = set(combinations(range(length), length - least_equal))
    for weight in range(min(MAX_WEIGHT, least_equal), 0, -1):
        reach = {
            mask: {p for p in placements if hits(mask, length, p)}
            for rest in combinations(range(1, length), weight - 1)
            for mask in [(0, *rest)]
        }
        chosen, left = [], placements
        while left and len(chosen) < MAX_MASKS:
            chosen.append(max(sorted(reach), key=lambda mask: len(reach[mask] & left)))  # noqa: B023
            left = left - reach[chosen[-1]]
        if not left:
            return tuple(chosen)
    return ((0,),)


def masks_in_use(lengths: list[int], min_share: float) -> dict[tuple[int, ...], list[int]]:
    """The masks for items of the given lengths, each with the lengths it is for."""
    uses: dict[tuple[int, ...], list[int]] = {}
    for length in sorted(lengths):
        for mask in MASKS if length >= WINDOW else masks_for(length, min_share):
            uses.setdefault(mask, []).append(length)
    return uses


def seed_hash(mask: tuple[int, ...], words: Column, at: Column) -> Column:
    """The hash of the counted words from a position on. Beyond the end of the text there are
    fewer words, which at worst gives a hit that is then found wanting."""
    counted = [F.get(words, at + offset) for offset in mask]
    return F.xxhash64(F.lit(sum(1 << offset for offset in mask)), *counted)


def reach_of(window: int, min_share: float, longest: int) -> tuple[int, int]:
    """Words before a hit, and from its first word on, that are compared around it.

    If a hit lies in each window that counts, it is enough to see the windows of RUN hits in a row.
    Otherwise a hit anywhere stands for the whole item.
    """
    least_equal = math.ceil(window * min_share - 1e-9)
    if window < WINDOW or (window == WINDOW and least_equal >= WINDOW - 2):
        return window, window + RUN - 1
    return max(window, longest), max(window, longest)


def pieces_of(texts: DataFrame, reach: tuple[int, int]) -> DataFrame:
    """Rows of PIECE positions in place of each text's ``words``: ``first`` is the first position,
    ``near`` their words and those in reach, NULL outside of the text, ``n_words`` the text's size."""
    left, right = reach

    def nothing(n: int) -> Column:
        return F.array_repeat(F.lit(None).cast("string"), n)

    kept = [c for c in texts.columns if c != "words"]
    # The words are used once here, so that they are not written twice.
    padded = texts.select(*kept, F.concat(nothing(left), F.col("words"), nothing(right)).alias("padded"))
    n_words = F.size("padded") - (left + right)
    firsts = F.when(n_words > 0, F.sequence(F.lit(0), n_words - 1, F.lit(PIECE)))
    cut = padded.select(*kept, "padded", n_words.alias("n_words"), F.explode(firsts).alias("first"))
    near = F.slice("padded", F.col("first") + 1, PIECE + left + right)
    return cut.select(*kept, "n_words", "first", near.alias("near"))


def placed_in(pieces: DataFrame, reach: tuple[int, int]) -> DataFrame:
    """A row for each position of each piece, counted from the piece's ``first``.

    Generated code holds all that comes of a row it reads. The lambda ends it here, so that this is
    what comes of a piece and not of a text; it looks at the piece, so that it stays behind the cut."""
    last = F.array(F.size("near") - (sum(reach) + 1))
    ended = pieces.select("*", F.get(F.transform(last, lambda n: n), F.lit(0)).alias("last"))
    return ended.select(*pieces.columns, F.explode(F.sequence(F.lit(0), F.col("last"))).alias("place"))


def seeds_of(
    pieces: DataFrame, uses: dict[tuple[int, ...], list[int]], window: int, reach: tuple[int, int]
) -> DataFrame:
    """Rows (number, mask, item_at, hash, before) of all positions of the masks of each item's
    length; ``mask`` is a mask's place in ``uses``, ``before`` the hash one word earlier, by which a
    run of hits can be told from its first."""
    at, here = F.col("first") + F.col("place"), F.col("place") + reach[0]
    masks = F.array(
        *[
            F.struct(
                F.lit(place).alias("mask"),
                seed_hash(mask, F.col("near"), here).alias("hash"),
                F.when(at > 0, seed_hash(mask, F.col("near"), here - 1)).alias("before"),
                (
                    (at + mask[-1] < F.col("n_words"))
                    & F.least(F.lit(window), F.col("n_words")).isin(lengths)
                ).alias("fits"),
            )
            for place, (mask, lengths) in enumerate(uses.items())
        ]
    )
    seeds = placed_in(pieces, reach).select("number", at.alias("item_at"), F.inline(masks))
    return seeds.where("fits").drop("fits")


def best_window(document: Column, item: Column, window: int, size: int) -> Column:
    """The most equal words in any ``window`` consecutive ones of ``size`` words side by side."""
    equal = F.zip_with(document, item, lambda a, b: F.coalesce(a == b, F.lit(False)).cast("int"))

    def most(equal: Column) -> Column:
        def moved(state: Column, at: Column) -> Column:
            left_behind = F.coalesce(F.get(equal, at - window), F.lit(0))
            now = state["now"] + F.get(equal, at) - left_behind
            return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

        start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
        places = F.sequence(F.lit(0), F.lit(size - 1))
        return F.aggregate(places, start, moved, lambda state: state["most"])

    # A lambda of one element, so that the words are compared once.
    return F.get(F.transform(F.array(equal), most), F.lit(0))


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[Column],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    min_share: float = MIN_SHARE,
    min_words: int = 1,
    block_seeds: int = BLOCK_SEEDS,
) -> DataFrame:
    """Verified overlaps: the columns ``keep`` of the document, item_id, start, n_equal, n_window.

    An overlap counts if, lying side by side as a hit says, at least ``min_share`` of some
    ``window`` consecutive words of the item are equal (of the whole item if it is shorter).
    Words are compared in lower case. With a window of up to 13 words and the default share every
    overlap is found; in a longer window those with a hit of the fixed masks. Items shorter than
    ``min_words`` are left out (none by default). A NULL or empty text overlaps with nothing;
    repeated items are separate items.
    """
    items = benchmark.select(
        F.monotonically_increasing_id().alias("number"),
        F.col(item_id).alias("item_id"),
        word_array(F.lower(F.col(item_text))).alias("words"),
    )
    # Written once: the numbers must stay, and the sum of sizes gives the number of blocks.
    items = saved(items.where(F.size("words") >= max(1, min_words)), "benchmark-items")
    total, longest, lengths = items.agg(
        F.sum(F.size("words").cast("long")),
        F.max(F.size("words")),
        F.collect_set(F.least(F.lit(window), F.size("words"))),
    ).first()
    uses = masks_in_use(lengths or [window], min_share)
    masks = list(uses)
    blocks = max(1, -(-(total or 0) * len(masks) // block_seeds))
    left, right = reach = reach_of(window, min_share, longest or 1)
    names = [f"_keep{i}" for i in range(len(keep))]
    rows = docs.select(
        *[c.alias(n) for c, n in zip(keep, names, strict=True)],
        word_array(F.lower(F.col(text))).alias("words"),
    )
    hashes = F.array(*[seed_hash(mask, F.col("near"), F.col("place") + left) for mask in masks])
    hashed = placed_in(pieces_of(rows, reach), reach).select("*", F.explode(hashes).alias("key"))

    def found_in(block: int) -> DataFrame:
        pieces = pieces_of(items, reach)
        pieces = pieces.where(F.pmod(F.xxhash64("number", "first"), F.lit(blocks)) == block)
        seeds = seeds_of(pieces, uses, window, reach)
        # First the hits alone, with the words in reach of them, and only then their places in items.
        hashes_of_block = seeds.select(F.col("hash").alias("key")).distinct()
        at, beside = F.col("first") + F.col("place"), F.slice("near", F.col("place") + 1, left + right)
        hits = hashed.join(F.broadcast(hashes_of_block), "key", "left_semi")
        hits = hits.select(*names, "key", at.alias("at"), beside.alias("beside"))
        previous = [seed_hash(mask, F.col("beside"), F.lit(left - 1)) for mask in masks]
        hits = hits.select("*", F.when(F.col("at") > 0, F.array(*previous)).alias("previous"))
        # The first hit of a run stands for RUN of it, and so does each in its turn. The lambda keeps
        # the join out of generated code, which would hold all places of a hit at once.
        of_mask = F.array(F.get("previous", F.col("mask")))
        repeated = F.coalesce(F.exists(of_mask, lambda hash: hash == F.col("before")), F.lit(False))
        stands = ~repeated | (F.col("item_at") % RUN == 0)
        found = hits.join(F.broadcast(seeds), (F.col("key") == F.col("hash")) & stands)
        found = found.select(
            *names,
            "beside",
            (F.col("at") - F.col("item_at")).alias("start"),
            "number",
            (F.col("item_at") - F.col("item_at") % PIECE).alias("first"),
            (F.col("item_at") % PIECE).alias("place"),
        )
        found = found.join(F.broadcast(pieces), ["number", "first"])
        item = F.slice("near", F.col("place") + 1, left + right)
        found = found.select(
            *names,
            "item_id",
            "start",
            best_window(F.col("beside"), item, window, left + right).alias("n_equal"),
            F.least(F.lit(window), F.col("n_words")).alias("n_window"),
        )
        return found.where(F.col("n_equal") >= F.col("n_window") * min_share)

    found = [found_in(b) for b in range(int(blocks))]
    # One block at a time: in one plan the broadcasts of all would be held together.
    best = reduce(DataFrame.unionByName, [saved(f, "overlaps") for f in found] if blocks > 1 else found)
    best = best.groupBy(*names, "item_id").agg(
        F.max(F.struct("n_equal", (-F.col("start")).alias("start"), "n_window")).alias("best")
    )
    return best.select(
        *names,
        "item_id",
        (-F.col("best.start")).alias("start"),
        F.col("best.n_equal").alias("n_equal"),
        F.col("best.n_window").alias("n_window"),
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", **options) -> DataFrame:
    """Rows (id, item_id, start, n_equal, n_window): the best overlap of each document and item.

    Rows of equal id are one document; ``start`` is the first word, negative if the item begins
    before the document does. An empty table on either side gives an empty result.
    """
    found = overlaps(docs, benchmark, [F.col(id)], **options)
    return found.withColumnRenamed("_keep0", id)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text overlaps with no item. The text decides, so a NULL id does
    not matter, and equal rows share their lot."""
    found = overlaps(docs, benchmark, text_key(F.col(text)), text=text, **options)
    bad = found.select(F.col("_keep0").alias("_key_a"), F.col("_keep1").alias("_key_b")).distinct()
    keyed = docs.select(whole_row(docs), *text_key(F.col(text)))
    return keyed.join(bad, ["_key_a", "_key_b"], "left_anti").select("row.*")

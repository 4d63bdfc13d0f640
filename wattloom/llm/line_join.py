"""Removal of repeated lines by an exact set-similarity join.

A line is the set of its different words. Two lines match if their Jaccard similarity reaches a
threshold; of matching lines the later ones go. Equal sets are one set from the start. The words of
a set are ordered by rarity, and sets that match share a word among the first few of that order
(prefix filter). Joined on such words, pairs must pass three tests that need no other word: sizes
not too different (length filter), enough words left after the shared one (positional filter), and
few enough words that maps of bits of hashed words show to be in one set only. What passes is compared
as whole sets.

A line goes as soon as one earlier line matches, so not all matches of a group are needed. The first
round pairs each set with the earliest holder of each word of its prefix only, one pair per set and
word, however large a group is: the rarest words of a near copy are often its own changes, so they
alone would not find it. Words in few texts are left out, as no large group shares them. The second pairs the sets that are left with all earlier ones, and
compares a set with the one most like it by the bits before it turns to the others.

Rarity comes from counts of all words of all texts in a fixed number of hash buckets, as a step of its
logarithm. Any order gives the same result. A word is a 64-bit number: the step in the upper 8 bits,
its hash in the others, so sorting the numbers sorts by rarity, and equal numbers are taken for equal
words.

Everything is DataFrame and SQL functions; what is shuffled is numbers, except the texts that
``without_repeats`` joins with the lines they keep.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from wattloom.llm.common import saved, small, whole_row

#: Two lines match at NUMERATOR / DENOMINATOR or more.
NUMERATOR, DENOMINATOR = 4, 5
BUCKET_BITS = 20
#: Words that occur so often at most are left to the second round, which then meets so many sets at
#: most for each of them.
SPARED = 128
#: Maps of 64 bits each that the index holds.
MAPS = 2
#: Maps of 64 bits each, by which candidates are compared once more before their whole sets are.
WIDE = 4


def one_gap(text: Column, gaps: str) -> Column:
    """Spaces for the gaps: splitting at a single character needs no pattern. Plain searches of bytes,
    as most gaps are in few texts; ``translate`` looks up every character."""
    return reduce(lambda found, gap: F.replace(found, F.lit(gap), F.lit(" ")), gaps, text)


def raw_lines(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Rows (id, text_hash, line_no, line) of lines with a word, in lower case, gaps as spaces."""
    spaced = one_gap(F.lower(F.coalesce(F.col(text), F.lit(""))), "\t\x0b\x0c\r")
    rows = docs.select(
        F.col(id).alias("id"),
        F.xxhash64(F.col(text)).alias("text_hash"),
        F.split(spaced, "\n").alias("lines"),
    )
    # The outer form, which adds no filter that would cut every text a second time.
    lines = rows.select("id", "text_hash", F.posexplode_outer("lines").alias("line_no", "line"))
    # Gaps are spaces by now, and the filter does not cut the words a second time.
    return lines.where(F.ltrim("line") != "")


def word_hashes(line: Column) -> Column:
    words = F.array_remove(F.split(line, " "), "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def bucket(hash: Column) -> Column:
    return F.shiftrightunsigned(hash, 64 - BUCKET_BITS).cast("int")


def rarity_step(count: Column) -> Column:
    return F.least(F.lit(255), F.floor(8 * F.log2(count + 1))) - 128


def rarity_steps(docs: DataFrame, text: str) -> Column:
    """An array with the rarity step (-128 .. 127) of each bucket, in the upper 8 bits, as a scalar
    subquery."""
    # The outer form, so that they are cut once; rows of words, as lambdas are not compiled.
    spaced = one_gap(F.lower(F.col(text)), "\t\n\x0b\x0c\r")
    words = docs.select(F.explode_outer(F.split(spaced, " ")).alias("word")).where(F.col("word") != "")
    counted = words.select(bucket(F.xxhash64("word")).alias("bucket"))
    counts = saved(counted.groupBy("bucket").agg(F.count("*").alias("words")), "word-buckets")
    step = rarity_step(F.coalesce("words", F.lit(0)))
    every = docs.sparkSession.range(1 << BUCKET_BITS).select(F.col("id").cast("int").alias("bucket"))
    steps = every.join(counts, "bucket", "left").select(
        "bucket", F.shiftleft(step.cast("long"), 56).alias("step")
    )
    ordered = steps.agg(F.sort_array(F.collect_list(F.struct("bucket", "step"))).alias("steps"))
    return saved(ordered.select(F.col("steps.step").alias("steps")), "rarity-steps").scalar()


def sets_of(lines: DataFrame, steps: Column) -> DataFrame:
    """Add the set of each line: ``tokens`` in order of rarity, ``n``, and ``set``, its name."""
    hashes = word_hashes(F.col("line"))
    # The subquery cannot stand in the lambda; as a column of the row below it is put there by the
    # optimizer and never becomes part of a row.
    numbered = lines.select("id", "text_hash", "line_no", hashes.alias("hashes"), steps.alias("steps"))

    def token(hash: Column) -> Column:
        # Never NULL, so that the sort below is one of plain numbers.
        step = F.coalesce(F.get("steps", bucket(hash)), F.lit(0).cast("long"))
        return step.bitwiseOR(hash.bitwiseAND(F.lit((1 << 56) - 1)))

    tokens = F.sort_array(F.transform("hashes", token))
    return (
        numbered.select("id", "text_hash", "line_no", tokens.alias("tokens"))
        .select("*", F.size("tokens").alias("n"), F.xxhash64("tokens").alias("set"))
    )


def least_overlap(n: Column, m: Column) -> Column:
    """The smallest overlap of matching sets, times (NUMERATOR + DENOMINATOR)."""
    return (n + m) * NUMERATOR


def bit_maps(words: str, name: str, maps: int) -> list[Column]:
    """Maps ``name_0`` .. of 64 bits, of which each hash in the array ``words`` sets one."""
    return [
        F.expr(
            f"aggregate({words}, 0L, (bits, h) -> if("
            f"(shiftright(h, 6) & {maps - 1}) = {k}, bits | shiftleft(1L, cast(h & 63 AS INT)), bits))"
        ).alias(f"{name}_{k}")
        for k in range(maps)
    ]


BITS = [f"bits_{k}" for k in range(MAPS)]


def missing(x: Sequence[Column], y: Sequence[Column]) -> Column:
    """At least so many words of the set with the maps x are not in the one with the maps y."""
    return reduce(add, [F.bit_count(a.bitwiseAND(F.bitwise_not(b))) for a, b in zip(x, y, strict=True)])


def bits_of(side: str) -> list[Column]:
    return [F.col(f"{side}.{c}") for c in BITS]


def alike(n: Column, m: Column) -> Column:
    """What the sizes n and m and the bits of two sets, x and y, allow if these match."""
    x, y = bits_of("x"), bits_of("y")
    shared = F.least(n - missing(x, y), m - missing(y, x))
    return (
        (n * DENOMINATOR >= m * NUMERATOR)
        & (m * DENOMINATOR >= n * NUMERATOR)
        & (shared * (NUMERATOR + DENOMINATOR) >= least_overlap(n, m))
    )


def line_sets(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Rows (set, n, bits_0 .., prefix, first, rank): each set of words and its first place, which is
    (id, hash of the text, line number), NULL ids first. ``rank`` never falls from one place to a
    later one; ids that are no numbers all have rank 0."""
    made = sets_of(raw_lines(docs, id, text), rarity_steps(docs, text))
    prefix = F.col("n") - F.ceil(F.col("n") * NUMERATOR / DENOMINATOR) + 1
    sets = saved(
        made.select(
            "set", "n", *bit_maps("tokens", "bits", MAPS), F.slice("tokens", F.lit(1), prefix.cast("int")).alias("prefix"),
            F.struct("id", "text_hash", "line_no").alias("place"),
        )
        .groupBy("set", "n")
        .agg(F.min("place").alias("first"), *[F.min(c).alias(c) for c in (*BITS, "prefix")]),
        "line-sets",
    )
    rank = F.lit(0).cast("long")
    if isinstance(docs.schema[id].dataType, NumericType):
        at = F.col("first.id").cast("double")
        low, high = sets.agg(F.min(at), F.max(at)).first()
        if low is not None and low < high < float("inf"):
            part = (at - low) / (high - low)
            rank = F.coalesce(F.floor(part * ((1 << 31) - 1)).cast("long"), rank)
    return sets.withColumn("rank", rank)


def pairs_with_earliest(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets with the earliest set that holds one of the same words in its prefix, of
    words that more than SPARED sets may hold."""
    line_no = F.least(F.col("first.line_no"), F.lit(65535)).cast("long")
    # Earlier places have lesser numbers, but for texts of one id. A wrong guess costs a pair.
    order = F.shiftleft("rank", 32).bitwiseOR(F.shiftleft(line_no, 16)).bitwiseOR(F.col("set").bitwiseAND(65535))
    keys = sets.select("set", "n", *BITS, order.alias("order"), F.explode("prefix").alias("token"))
    # No set holds a word that its texts do not, so rarity bounds the holders.
    step = rarity_step(F.lit(SPARED + 1)).cast("long")
    keys = keys.where(F.col("token") >= F.shiftleft(step, 56))
    # One shuffle by word, and one pair per set and word at most. Column by column: a struct of them
    # would be shuffled beside them.
    own = ("set", "n", *BITS)
    holders = Window.partitionBy("token").orderBy("order", "set")
    both = keys.select(
        *[F.first(c).over(holders).alias(f"first_{c}") for c in own], *own,
    ).select(F.struct(*[F.col(f"first_{c}").alias(c) for c in own]).alias("x"), F.struct(*own).alias("y"))
    fits = (F.col("x.set") != F.col("y.set")) & alike(F.col("x.n"), F.col("y.n"))
    return both.where(fits).select(F.col("x.set").alias("a"), F.col("y.set").alias("b")).distinct()


def pairs_with_open(sets: DataFrame, gone: DataFrame) -> DataFrame:
    """Pairs (a, b, unlike) of all sets a and those sets b that are not gone and not earlier; the
    latter is the number of bits that differ."""
    marked = sets.join(small(gone.withColumn("gone", F.lit(True))), "set", "left")
    index = marked.select(
        "set", "n", *BITS, "rank", F.when(F.col("gone"), 0).otherwise(1).alias("open"),
        F.posexplode("prefix").alias("at", "token"),
    ).select(
        "set", *BITS, "rank", "token",
        (F.col("n") * 2 + F.col("open")).alias("n_open"), (F.col("n") - F.col("at")).alias("left"),
    )
    x, y = index.alias("x"), index.alias("y")
    n, m = (F.shiftright(f"{s}.n_open", 1) for s in "xy")
    left = F.least(F.col("x.left"), F.col("y.left"))
    # A test of both sides stays in the join, so that one shuffle of the index serves as both.
    is_open = F.col("y.n_open").bitwiseAND(1) * F.col("x.n_open") > 0
    fits = (
        (F.col("x.token") == F.col("y.token"))
        & is_open
        & (F.col("x.rank") <= F.col("y.rank"))
        & (F.col("x.set") != F.col("y.set"))
        & (left * (NUMERATOR + DENOMINATOR) >= least_overlap(n, m))
        & alike(n, m)
    )
    unlike = missing(bits_of("x"), bits_of("y")) + missing(bits_of("y"), bits_of("x"))
    return x.join(y, fits).select(
        F.col("x.set").alias("a"), F.col("y.set").alias("b"), unlike.alias("unlike")
    ).distinct()


def whole_sets(docs: DataFrame, id: str, text: str, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows (set, first, hashes, n, wide_0 ..) of all sets in the pairs, cut again from the first
    place of each."""
    wanted = pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct()
    places = saved(sets.join(small(saved(wanted, "wanted-sets")), "set").select("set", "first.*"), "candidate-lines")
    ids = saved(places.select("id", "text_hash").distinct(), "candidate-texts")
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("hash"))
    same = (texts["hash"] == F.col("p.text_hash")) & texts["id"].eqNullSafe(F.col("p.id"))
    some = texts.join(small(ids).alias("p"), same, "left_semi").select("id", "text")
    lines = raw_lines(some, "id", "text")
    here = (
        (lines["text_hash"] == F.col("p.text_hash"))
        & (lines["line_no"] == F.col("p.line_no"))
        & lines["id"].eqNullSafe(F.col("p.id"))
    )
    cut = lines.join(small(places).alias("p"), here).select(
        "p.set", F.struct("p.id", "p.text_hash", "p.line_no").alias("first"),
        word_hashes(lines["line"]).alias("hashes"),
    )
    # Rows equal in id and text give a line more than once.
    whole = cut.groupBy("set").agg(F.min(F.struct("first", "hashes")).alias("whole"))
    whole = whole.select("set", "whole.*").select("*", F.size("hashes").alias("n"), *bit_maps("hashes", "wide", WIDE))
    return saved(whole, "candidate-sets")


def likely(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """Those pairs (a, b) that the wide maps of bits allow."""
    wide = [f"wide_{k}" for k in range(WIDE)]
    of_a, of_b = (
        whole.select(F.col("set").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("n", *wide)]) for s in "ab"
    )
    maps_a, maps_b = ([F.col(f"{c}_{s}") for c in wide] for s in "ab")
    only_a, only_b = missing(maps_a, maps_b), missing(maps_b, maps_a)
    n, m = F.col("n_a"), F.col("n_b")
    shared = F.least(n - only_a, m - only_b)
    both = pairs.join(of_a, "a").join(of_b, "b")
    return both.where(shared * (NUMERATOR + DENOMINATOR) >= least_overlap(n, m)).select("a", "b")


def later_of_matches(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """Rows (set) of the later one of each pair whose whole sets match."""
    of_a, of_b = (
        whole.select(F.col("set").alias(s), F.col("first").alias(f"first_{s}"), F.col("hashes").alias(f"t_{s}"))
        for s in "ab"
    )
    overlap = F.size(F.array_intersect("t_a", "t_b"))
    matches = likely(pairs, whole).join(of_a, "a").join(of_b, "b").where(
        overlap * (NUMERATOR + DENOMINATOR) >= least_overlap(F.size("t_a"), F.size("t_b"))
    )
    later = F.when(F.col("first_a") < F.col("first_b"), F.col("b")).otherwise(F.col("a"))
    return saved(matches.select(later.alias("set")).distinct(), "repeated-lines")


def kept_sets(docs: DataFrame, id: str, text: str) -> DataFrame:
    """The rows of ``line_sets`` that no earlier set matches."""
    sets = line_sets(docs, id, text)
    pairs = saved(pairs_with_earliest(sets), "line-pairs")
    gone = later_of_matches(pairs, whole_sets(docs, id, text, sets, pairs))
    pairs = saved(pairs_with_open(sets, gone), "line-pairs")
    whole = whole_sets(docs, id, text, sets, pairs)
    nearest = saved(pairs.groupBy("b").agg(F.min_by("a", "unlike").alias("a")), "nearest-pairs")
    found = later_of_matches(nearest, whole)
    # Without those found, and without the pairs compared above.
    left = pairs.join(small(found.withColumnRenamed("set", "b")), "b", "left_anti").join(
        small(nearest), ["a", "b"], "left_anti"
    )
    gone = saved(gone.union(found).union(later_of_matches(left, whole)).distinct(), "gone-lines")
    return sets.join(small(gone), "set", "left_anti")


def kept_lines(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, text_hash, lines): the numbers, ascending, of the lines that each text keeps.

    A line stays if no earlier line, by (id, line number), matches it. Texts that keep none have no
    row. Lines without a word are not lines.
    """
    kept = kept_sets(docs, id, text).select("first.*")
    return kept.groupBy("id", "text_hash").agg(F.sort_array(F.collect_list("line_no")).alias("lines"))


def line_counts(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, n_lines, n_kept, kept_md5): the latter is the MD5 of the kept numbers, by commas.

    NULL and empty texts have no line. Rows equal in id and text are one text and are not removed
    against each other. An empty table gives an empty result.
    """
    kept = kept_lines(docs, id, text).withColumnRenamed("id", "kept_id")
    rows = docs.select(
        F.col(id).alias("id"),
        F.xxhash64(F.col(text)).alias("text_hash"),
        F.coalesce(
            F.regexp_count(F.col(text), F.lit(r"(?m)[^\x20\x09-\x0D][^\n]*")), F.lit(0)
        ).cast("long").alias("n_lines"),
    )
    same = (rows["text_hash"] == kept["text_hash"]) & rows["id"].eqNullSafe(kept["kept_id"])
    numbers = F.concat_ws(",", F.col("lines").cast("array<string>"))
    return rows.join(kept, same, "left").select(
        F.col("id").alias(id),
        "n_lines",
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_kept"),
        F.md5(F.coalesce(numbers, F.lit(""))).alias("kept_md5"),
    )


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with texts of their kept lines only; lines without a word go as well."""
    kept = kept_lines(docs, id, text).select(
        F.col("id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash"), F.col("lines").alias("_kept")
    )
    marked = docs.select(
        whole_row(docs), F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("hash")
    )
    same = (F.col("hash") == F.col("_kept_hash")) & F.col("id").eqNullSafe(F.col("_kept_id"))
    lines = F.split(F.col("text"), "\n")
    left = F.array_join(F.transform("_kept", lambda i: F.get(lines, i)), "\n")
    joined = marked.join(kept, same, "left").select("row", F.coalesce(left, F.lit("")).alias("left"))
    return joined.select(
        *[F.col("left" if c == text else f"row.`{c}`").alias(c) for c in docs.columns]
    )

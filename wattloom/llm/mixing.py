"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target of words. A document is first taken in as many whole copies as the
source's rate (target / words of the source) holds for certain; one more copy goes to a sample of
the source's documents. Their inclusion probabilities are unequal: in proportion to a preference,
up to 1, so that the expected words of the sample make up what the whole copies leave open. The
documents are ranked by (u / (1 - u)) / (p / (1 - p)), the random odds over the inclusion odds, and
taken in that order until the words are nearest to the target: the size of the sample is fixed.

Nothing is ranked over a whole source. The rank variable is cut into about sqrt(n) bins for n
documents of a source; sums per bin tell the bin in which the order ends, and only that bin is
sorted. So the result is, per source, a cut in the rank variable, and every document decides on
its own whether it is in, next to its text, without a shuffle of texts.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import null_safe_key, saved, word_count

MAX_BROADCAST_ROWS = 100_000
SALTS = 64


class Mix(NamedTuple):
    """How to mix: one row per (source, preference); see ``mix_plan``."""

    table: DataFrame
    rows: int


def bit_length_of(size: Column) -> Column:
    """1 for sizes 0 and 1, 2 for 2 and 3, 3 for 4 to 7 and so on: a mild preference for length."""
    return F.length(F.bin(size)).cast("long")


def uniform(id: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the id and the seed only."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") + 0.5) / F.lit(2.0**48)


def source_targets(totals: DataFrame, cycle: int, max_repeats: int) -> DataFrame:
    """Add ``target`` to one row per source (source, key, source_size).

    Sources by code point, NULL last, weigh 1 .. cycle, repeating, and share all words. A target
    above max_repeats times its source's words stops there, and the excess goes to the others by
    weight. In the order of (limit / weight) the stopped ones come first, so running sums give the
    share per weight at which the next source is not above its limit.
    """
    weighted = totals.withColumn(
        "weight",
        ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % cycle + 1),
    ).withColumn("limit", F.col("source_size") * max_repeats)
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("key"))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    share = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    stopped = weighted.withColumn("share", share).withColumn(
        "above", F.col("share") * F.col("weight") > F.col("limit")
    )
    # Of the sources that are not above, the first has the final share per weight.
    in_order = F.struct(F.col("limit") / F.col("weight"), F.col("key"))
    final = F.min_by(
        F.when(~F.col("above"), F.col("share")), F.when(~F.col("above"), in_order)
    ).over(everything)
    target = F.least(final * F.col("weight"), F.col("limit").cast("double"))
    return stopped.select("key", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def inclusion(classes: DataFrame) -> DataFrame:
    """Add ``copies`` and ``p`` to rows (key, preference, class_size, source_size, target).

    p = min(1, a * preference) with a such that the expected words are those that whole copies
    leave open. Classes in falling preference: the first ones are certain, the rest get a.
    """
    rate = F.col("target") / F.nullif(F.col("source_size"), F.lit(0))
    open_words = F.col("target") - F.col("copies") * F.col("source_size")
    source = Window.partitionBy("key")
    order = source.orderBy(F.col("preference").desc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    mass = F.col("preference") * F.col("class_size")
    factor = (F.col("open") - F.coalesce(F.sum("class_size").over(before), F.lit(0))) / F.nullif(
        F.sum(mass).over(source) - F.coalesce(F.sum(mass).over(before), F.lit(0)), F.lit(0)
    )
    certain = (F.col("factor") * F.col("preference") > 1).cast("int")
    final = F.max_by("factor", F.struct((1 - F.col("certain")), "preference")).over(source)
    p = F.when(F.col("certain") == 1, 1.0).otherwise(F.col("final") * F.col("preference"))
    return (
        classes.withColumn("copies", F.coalesce(F.floor(rate), F.lit(0)).cast("long"))
        .withColumn("open", open_words)
        .withColumn("factor", F.coalesce(factor, F.lit(0.0)))
        .withColumn("certain", certain)
        .withColumn("final", final)
        .withColumn("p", F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))
        .drop("factor", "certain", "final")
    )


def ranked(rows: DataFrame, id: str, seed: int) -> DataFrame:
    """Add the rank variable ``q`` and its bin to rows that know their p and bins.

    p = 1 ranks first with 0; p = 0 never ranks and has none.
    """
    u = uniform(F.col(id), seed)
    q = (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))
    q = F.when(F.col("p") <= 0, F.lit(None)).when(F.col("p") >= 1, 0.0).otherwise(q)
    return rows.withColumn("q", q).withColumn(
        "bin", F.floor(F.col("q") / (1 + F.col("q")) * F.col("bins")).cast("long")
    )


def join_plan(rows: DataFrame, mix: Mix, id: str) -> DataFrame:
    """Rows (key, preference, ...) with their plan. A plan of few rows is broadcast; a larger one is
    repeated over salts, so that a source with most of the rows is dealt to many tasks."""
    on = ["key", "preference"]
    if mix.rows <= MAX_BROADCAST_ROWS:
        return rows.join(F.broadcast(mix.table), on)
    salts = mix.table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(F.col(id)), F.lit(SALTS)).cast("int"))
    return salted.join(salts, [*on, "salt"]).drop("salt")


def mix_plan(
    sized: DataFrame, id: str, seed: int, cycle: int = 3, max_repeats: int = 3
) -> Mix:
    """The plan for rows (id, key, source, size, preference).

    One row per (key, preference): source_size, target, copies, p, bins, and the cut: rows in a
    bin below ``cut_bin`` get one more copy, rows in it if (q, id) is at most (cut_q, cut_id).
    """
    classes = saved(
        sized.groupBy("key", "source", "preference").agg(
            F.sum("size").alias("class_size"), F.count("*").alias("rows")
        ),
        "mix-classes",
    )
    totals = classes.groupBy("key", "source").agg(
        F.sum("class_size").alias("source_size"),
        F.ceil(F.sqrt(F.sum("rows"))).cast("long").alias("bins"),
    )
    targets = source_targets(totals, cycle, max_repeats).join(totals.select("key", "bins"), "key")
    table = saved(inclusion(classes.drop("source", "rows").join(targets, "key")), "mix-rates")
    draft = Mix(table, table.count())

    candidates = ranked(join_plan(sized, draft, id), id, seed).where(F.col("q").isNotNull())
    bins = candidates.groupBy("key", "bin").agg(
        F.sum("size").alias("words"), F.max("open").alias("open")
    )
    order = Window.partitionBy("key").orderBy("bin")
    reached = bins.withColumn("upto", F.sum("words").over(order))
    last = (
        reached.where(F.col("upto") > F.col("open"))
        .groupBy("key")
        .agg(F.min("bin").alias("cut_bin"), F.min_by(F.col("upto") - F.col("words"), "bin").alias("base"))
    )
    last = saved(last, "mix-bins")
    # Only the rows of the last bin of each source, about sqrt(n), are sorted.
    plan_rows = Mix(table.join(last, "key"), draft.rows)
    in_last = ranked(join_plan(sized, plan_rows, id), id, seed).where(
        F.col("bin") == F.col("cut_bin")
    )
    id_text = F.coalesce(F.col(id).cast("long"), F.lit(-1)).alias("cut_id")
    upto = F.sum("size").over(
        Window.partitionBy("key").orderBy("q", F.coalesce(F.col(id).cast("long"), F.lit(-1)))
    )
    cut = (
        in_last.select("key", "q", id_text, "size", "open", (F.col("base") + upto).alias("upto"))
        .where(F.col("upto") - F.col("size") / 2 <= F.col("open"))
        .groupBy("key")
        .agg(F.max(F.struct("q", "cut_id")).alias("cut"))
        .select("key", F.col("cut.q").alias("cut_q"), F.col("cut.cut_id").alias("cut_id"))
    )
    plan = saved(
        table.join(last.drop("base"), "key", "left").join(cut, "key", "left").drop("open", "class_size"),
        "mix-plan",
    )
    return Mix(plan, draft.rows)


def with_copies(rows: DataFrame, mix: Mix, id: str, seed: int) -> DataFrame:
    """Add ``copies``, the number of times that the mix takes a row."""
    planned = ranked(join_plan(rows, mix, id), id, seed)
    row_id = F.coalesce(F.col(id).cast("long"), F.lit(-1))
    before_cut = F.struct(F.col("q"), row_id.alias("cut_id")) <= F.struct(
        F.col("cut_q").alias("q"), F.col("cut_id")
    )
    extra = (
        F.when(F.col("q").isNull(), False)
        .when(F.col("cut_bin").isNull(), True)
        .when(F.col("bin") != F.col("cut_bin"), F.col("bin") < F.col("cut_bin"))
        .otherwise(F.col("cut_q").isNotNull() & before_cut)
    )
    return planned.withColumn("copies", F.col("copies") + extra.cast("long"))


def sized_rows(docs: DataFrame, id: str, source: str, size: Column, preference) -> DataFrame:
    return (
        docs.select(F.col(id), F.col(source).alias("source"), size.alias("size"))
        .withColumn("key", null_safe_key(F.col("source")))
        .withColumn("preference", preference(F.col("size")))
    )


def mix_sizes(
    docs: DataFrame,
    id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: int = 1,
    cycle: int = 3,
    max_repeats: int = 3,
    preference=bit_length_of,
) -> DataFrame:
    """Per row: id, source, size, source_size, target, copies and taken (copies * size).

    ``size`` is the number of words, 0 for a NULL or empty text. ``preference`` makes a positive
    whole number from the size; keep its values few, as there is a plan row for each. NULL sources
    are one source, the last. Rows of equal id draw the same number, so equal rows are taken alike.
    A source without words has target 0 and no copies. An empty table gives an empty result. Only
    the three named columns are read, so others may have any name.
    """
    sized = saved(sized_rows(docs, id, source, word_count(F.col(text)), preference), "mix-sizes")
    mix = mix_plan(sized, id, seed, cycle, max_repeats)
    return with_copies(sized, mix, id, seed).select(
        id,
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "source",
        "copies",
    )


def mixed_documents(
    docs: DataFrame,
    id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: int = 1,
    cycle: int = 3,
    max_repeats: int = 3,
    preference=bit_length_of,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; other columns pass through."""
    sized = saved(sized_rows(docs, id, source, word_count(F.col(text)), preference), "mix-sizes")
    mix = mix_plan(sized, id, seed, cycle, max_repeats)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = (
        docs.select(F.col(id), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), row)
        .withColumn("key", null_safe_key(F.col("source")))
        .withColumn("preference", preference(F.col("size")))
    )
    taken = with_copies(rows, mix, id, seed).where(F.col("copies") > 0)
    repeated = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return taken.select("row", repeated.alias("copy")).select("row.*")

"""N-gram Jaccard join with token-combination prefixes.

The tokens of a document are its different shingles. They are ordered by rarity, and two documents
as similar as asked for share a token in a prefix of that order. For a frequent token that says
little: everything that quotes one passage shares it. So the tokens are cut into classes: a rare
token is indexed by itself, frequent tokens are dealt to subclasses and indexed by pairs within
one. n rare tokens of a prefix can lose all their entries only if n of them are missing from the
other document, n frequent ones of a subclass if n - 1 are; a prefix is extended until this sum
exceeds the number of tokens that may be missing. Then any two linked documents meet in an entry:
take the prefix that ends first, at most the allowed number of its tokens is missing from the
other document, and what is left of its entries lies in the other prefix as well.

Documents with equal shingle sets are one class from the start. Candidates are checked by sizes and
positions, then by counts of tokens per hash bucket, then on the whole sets. They come in two
rounds, since only components are asked for: first each entry's documents against the one that has
the fewest rarer tokens; then, in entries that still hold several components, the pairs between
different ones. So a large group of near copies costs a star and not all its pairs, and no link
between components is left out.

Rarity comes from counts of all shingles in a fixed number of hash buckets. Any order and any cut
into classes gives the same links, so a shared bucket costs time and not correctness.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import saved, small, whole_row
from wattloom.llm.graph import components

WORDS = 4
PERCENT = 85
SKETCH_BITS = 20
#: A token is frequent if its bucket holds so many more than the mean bucket.
FREQUENT = 64
#: Subclasses of frequent tokens: one per so many tokens of the document's size class.
SUBCLASS_TOKENS = 32
HISTOGRAM = 256
KNOWN_WORDS = 400_000
#: Entries of 8 bytes that may be broadcast.
MAX_BROADCAST_ENTRIES = 2_000_000

#: One factor per place in a shingle, so a shingle has at most so many words.
ODD = [
    np.uint64(k)
    for k in (
        0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
    )
]
KNOWN: dict[bytes, bytes] = {}


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash per word; those of a bounded number of words are kept."""
    import xxhash

    new = [w for w in set(words) if w not in KNOWN]
    if len(KNOWN) + len(new) > KNOWN_WORDS:
        KNOWN.clear()
        new = list(set(words))
    for word in new:
        KNOWN[word] = xxhash.xxh3_64_digest(word)
    return np.frombuffer(b"".join(map(KNOWN.__getitem__, words)), dtype=np.uint64)


def shingles(text: str | None, n: int = WORDS) -> np.ndarray:
    """The different shingles of a text as ascending 64-bit hashes.

    A-Z are lower-cased and words cut at ASCII white space. A text of fewer words is one shingle.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = word_hashes(words)
    width = min(n, len(words))
    mixed = np.zeros(len(words) - width + 1, dtype=np.uint64)
    for i in range(width):
        mixed += hashes[i : i + len(mixed)] * ODD[i]
    mixed += np.uint64(width)
    mixed ^= mixed >> np.uint64(29)
    mixed *= ODD[1]
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def size_classes(n: int, percent: int) -> list[int]:
    """Exponents of the sizes that a set linked with one of n tokens can have."""
    low, high = -(-percent * n // 100), 100 * n // percent
    return list(range(low.bit_length(), high.bit_length() + 1))


def entries(
    tokens: np.ndarray, counts: np.ndarray, frequent_from: int, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Index entries of one set and, per entry, how many rare tokens come before it."""
    n = len(tokens)
    allowed = n - -(-percent * n // 100)
    if allowed == 0 and (100 * n) // percent == n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)  # linked with equal sets only
    load = counts[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    # The class comes first in the order, then the count, then the hash.
    frequent = load >= frequent_from
    order = np.lexsort((tokens, load))
    ordered, rare = tokens[order], int((~frequent).sum())
    needed = allowed + 1
    if rare >= needed:
        return ordered[:needed], np.arange(needed, dtype=np.int32)
    found, before = [ordered[:rare]], [np.arange(rare, dtype=np.int32)]
    common = ordered[rare:]
    for size_class in size_classes(n, percent):
        subclasses = max(1, (1 << size_class) // (2 * SUBCLASS_TOKENS))
        part = ((common >> np.uint64(8)) % np.uint64(subclasses)).astype(np.int64)
        # Each token but the first of its subclass adds one to what must be missing.
        gains = np.ones(len(common), dtype=np.int64)
        gains[np.unique(part, return_index=True)[1]] = 0
        reached = np.searchsorted(rare + np.cumsum(gains), needed)
        taken, own = common[: reached + 1], part[: reached + 1]
        by_part = np.argsort(own, kind="stable")
        taken, own = taken[by_part], own[by_part]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        ends = np.r_[starts[1:], len(own)]
        for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
            if end - start < 2:
                continue
            i, j = np.triu_indices(end - start, 1)
            run = taken[start:end]
            low, high = np.minimum(run[i], run[j]), np.maximum(run[i], run[j])
            pair = (low * ODD[0]) ^ (high * ODD[2] + np.uint64(size_class))
            found.append(pair ^ (pair >> np.uint64(31)))
            before.append(np.full(len(i), rare, dtype=np.int32))
    return np.concatenate(found), np.concatenate(before)


def histogram(tokens: np.ndarray) -> bytes:
    counts = np.bincount((tokens & np.uint64(HISTOGRAM - 1)).astype(np.int64), minlength=HISTOGRAM)
    return np.minimum(counts, 65535).astype("<u2").tobytes()


FACTS = "id long, text_hash long, n int, key long, histogram binary, sketch binary"


def read_facts(docs: DataFrame, id: str, text: str, n: int) -> DataFrame:
    """Per row: id, hash of the text, size and key of its set; and one row of counts per task."""
    rows = docs.select(F.col(id).cast("long"), F.xxhash64(F.col(text)), F.col(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard

        names = [f.split()[0] for f in FACTS.split(", ")]
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in batches:
            sizes, keys, histograms = [], [], []
            for value in batch.column(2):
                tokens = shingles(value.as_py(), n)
                np.add.at(counts, (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
                sizes.append(len(tokens))
                keys.append(xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63))
                histograms.append(histogram(tokens))
            arrays = [
                batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(keys, pa.int64()),
                pa.array(histograms, pa.binary()), pa.nulls(len(sizes), pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names)
        packed = zstandard.ZstdCompressor(level=1).compress(counts.tobytes())
        last = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())]
        yield pa.RecordBatch.from_arrays([*last, pa.array([packed], pa.binary())], names)

    return rows.mapInArrow(run, FACTS)


def total_counts(facts: DataFrame) -> np.ndarray:
    """The sum of the tasks' counts, added up in two levels; a fixed 2 ** SKETCH_BITS numbers."""
    parts = facts.where(F.col("sketch").isNotNull()).select("sketch")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        total = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in batches:
            for value in batch.column(0):
                packed = zstandard.ZstdDecompressor().decompress(value.as_py())
                total += np.minimum(np.frombuffer(packed, dtype=np.uint32), ~total)
        packed = zstandard.ZstdCompressor(level=1).compress(total.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["sketch"])

    import zstandard

    some = max(1, int(parts.count() ** 0.5))
    level = parts.repartition(some).mapInArrow(add, "sketch binary")
    found = level.repartition(1).mapInArrow(add, "sketch binary").first()
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(found.sketch)), dtype=np.uint32)


def index_rows(docs: DataFrame, text: str, n: int, percent: int, counts: np.ndarray) -> DataFrame:
    """Rows (entry, key, n, before) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    frequent_from = int(counts.mean()) + FREQUENT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                parts: list[tuple] = []
                for value in batch.column(0).slice(at, 500):
                    tokens = shingles(value.as_py(), n)
                    found, before = entries(tokens, shared.value, frequent_from, percent)
                    if len(found):
                        key = xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)
                        parts.append((found, key, len(tokens), before))
                if parts:
                    sizes = [len(p[0]) for p in parts]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate([p[0] for p in parts]).view(np.int64)),
                            pa.array(np.repeat(np.array([p[1] for p in parts], np.int64), sizes)),
                            pa.array(np.repeat(np.array([p[2] for p in parts], np.int32), sizes)),
                            pa.array(np.concatenate([p[3] for p in parts])),
                        ],
                        ["entry", "key", "n", "before"],
                    )

    return docs.select(F.col(text)).mapInArrow(run, "entry long, key long, n int, before int")


def may_link(percent: int, n: Column, before: Column, m: Column, before_m: Column) -> Column:
    """Whether sizes and positions allow a link: in the first entry that two sets share, no rarer
    token is common, so the overlap is at most what comes after it."""
    most = F.least(n - before, m - before_m)
    return most.cast("long") * (100 + percent) >= (n + m).cast("long") * percent


def verified(
    pairs: DataFrame, classes: DataFrame, docs: DataFrame, text: str, id: str, n: int, percent: int
) -> DataFrame:
    """The pairs (a, b) that are linked, by their whole sets.

    The counts per hash bucket bound the overlap from above and settle most pairs that are not.
    """
    sides = [
        classes.select(F.col("key").alias(s), F.col("n").alias(f"n_{s}"), F.col("histogram").alias(f"h_{s}"))
        for s in "ab"
    ]
    bounded = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "n_a", "n_b", "h_a", "h_b")

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            h = [
                np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, HISTOGRAM)
                for i in (4, 5)
            ]
            most = np.where((h[0] == 65535) | (h[1] == 65535), 1 << 40, np.minimum(*h).astype(np.int64))
            sizes = sum(batch.column(i).to_numpy().astype(np.int64) for i in (2, 3))
            keep = most.sum(axis=1) * (100 + percent) >= sizes * percent
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    left = saved(bounded.mapInArrow(possible, "a long, b long"), "possible-pairs")
    keys = left.select(F.col("a").alias("key")).union(left.select("b")).distinct()
    wanted = saved(classes.join(keys, "key").select("key", "rep.text_hash", "rep.id"), "wanted-sets")
    rows = docs.select(
        F.xxhash64(F.col(text)).alias("text_hash"), F.col(id).cast("long").alias("id"), F.col(text).alias("text")
    )
    same = (rows["text_hash"] == F.col("w.text_hash")) & rows["id"].eqNullSafe(F.col("w.id"))
    texts = rows.join(small(wanted).alias("w"), same).select("key", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [shingles(t.as_py(), n).view(np.int64) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.list_(pa.int64()))], ["key", "tokens"]
                )

    made = saved(texts.mapInArrow(sets, "key long, tokens array<long>").dropDuplicates(["key"]), "sets")
    of_a, of_b = (made.select(F.col("key").alias(s), F.col("tokens").alias(f"t_{s}")) for s in "ab")
    overlap = F.size(F.array_intersect("t_a", "t_b"))
    union = F.size("t_a") + F.size("t_b") - overlap
    linked = left.join(of_a, "a").join(of_b, "b").where(100 * overlap >= percent * union)
    return saved(linked.select("a", "b"), "links")


def joined(
    docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame]:
    """Facts per row, and (key, n, component, component_id, keep) per class of equal sets."""
    facts = saved(read_facts(docs, id, text, n), "shingle-facts")
    counts = total_counts(facts)
    facts = facts.where(F.col("sketch").isNull() & (F.col("n") > 0))
    classes = saved(
        facts.groupBy("key", "n").agg(
            F.min("id").alias("first_id"),
            F.min(F.struct("id", "text_hash")).alias("rep"),
            F.max("histogram").alias("histogram"),
        ),
        "shingle-classes",
    )
    index = saved(index_rows(docs, text, n, percent, counts), "shingle-index")
    # Numbers only, so this is a hash aggregate; the centers are looked for in what is left.
    shared = index.groupBy("entry").agg(F.min("key").alias("least"), F.max("key").alias("most"))
    shared = saved(shared.where("least < most").select("entry"), "shared-entries")
    lists = index.join(small(shared, MAX_BROADCAST_ENTRIES), "entry").distinct()
    lists = saved(lists, "entry-lists")
    centers = lists.groupBy("entry").agg(F.min(F.struct("before", "n", "key")).alias("center"))

    center = [F.col(f"center.{c}") for c in ("key", "n", "before")]
    star = lists.join(centers, "entry").where(F.col("key") != center[0]).where(
        may_link(percent, F.col("n"), F.col("before"), center[1], center[2])
    )
    star = star.select(F.least("key", center[0]).alias("a"), F.greatest("key", center[0]).alias("b"))
    links = verified(star.distinct(), classes, docs, text, id, n, percent)

    found = components(links).withColumnRenamed("node", "key")
    labelled = lists.join(found, "key", "left")
    labelled = saved(
        labelled.withColumn("component", F.coalesce("component", "key")), "labelled-lists"
    )
    open_entries = labelled.groupBy("entry").agg(
        F.min("component").alias("least"), F.max("component").alias("most")
    )
    open_entries = saved(open_entries.where("least < most").select("entry"), "open-entries")
    rest = saved(labelled.join(small(open_entries), "entry"), "open-lists")
    x, y = rest.alias("x"), rest.alias("y")
    across = x.join(
        y,
        (F.col("x.entry") == F.col("y.entry"))
        & (F.col("x.component") < F.col("y.component"))
        & may_link(percent, F.col("x.n"), F.col("x.before"), F.col("y.n"), F.col("y.before")),
    ).select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b"))
    more = verified(across.distinct(), classes, docs, text, id, n, percent)

    found = components(links.union(more)).withColumnRenamed("node", "key")
    whole = classes.drop("histogram").join(found, "key", "left")
    whole = whole.withColumn("component", F.coalesce("component", "key"))
    named = whole.groupBy("component").agg(
        F.min("first_id").alias("component_id"), F.min("rep").alias("keep"), F.count("*").alias("sets")
    )
    return facts, saved(whole.join(named, "component"), "shingle-components")


def linked_documents(
    docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """Rows (id, n_shingles, component_id).

    Two documents are linked if 100 * shared shingles >= percent * all shingles of both. The
    component_id is the least id reachable by links. A text that is NULL or has no word has no
    shingle and is linked with nothing: its component is its own. Repeated rows are linked; rows
    with a NULL id take part, and a component of such rows only has a NULL component_id. An empty
    table gives an empty result. Shingles and sets are told apart by 64-bit hashes.
    """
    facts, classes = joined(docs, id, text, n, percent)
    of_key = classes.select("key", F.col("n"), "component_id")
    found = facts.select("id", "n", "key").join(of_key, ["key", "n"])
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]")), F.lit(0))
    empty = docs.where(words == 0).select(F.col(id).cast("long").alias("id"), F.lit(0).alias("n"))
    return (
        found.select("id", "n", "component_id")
        .unionByName(empty.withColumn("component_id", F.col("id")))
        .select(F.col("id").alias(id), F.col("n").cast("long").alias("n_shingles"), "component_id")
    )


def one_of_each(
    docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` without those that are linked to a document with a smaller id; of rows
    equal in id and text one stays. Texts without words stay."""
    facts, classes = joined(docs, id, text, n, percent)
    rows = facts.groupBy("key", "n", "id", "text_hash").agg(F.count("*").alias("rows"))
    keep = classes.select("key", F.col("n"), F.col("keep.id").alias("keep_id"), F.col("keep.text_hash").alias("keep_hash"))
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("text_hash") == F.col("keep_hash"))
    judged = saved(rows.join(keep, ["key", "n"]).withColumn("kept", kept), "shingle-verdicts")
    gone = saved(judged.where(~F.col("kept")).select("id", "text_hash"), "shingle-gone")
    own_id = F.col(id).cast("long").alias("_id")
    marked = docs.select(whole_row(docs), F.xxhash64(F.col(text)).alias("_hash"), own_id)
    same = (marked["_hash"] == F.col("g.text_hash")) & marked["_id"].eqNullSafe(F.col("g.id"))
    left = marked.join(small(gone).alias("g"), same, "left_anti")
    if not judged.where(F.col("kept") & (F.col("rows") > 1)).isEmpty():
        left = left.dropDuplicates(["_hash", "_id"])
    return left.select("row.*")

from __future__ import annotations

import random
import re
from itertools import combinations

import duckdb

from tests.llm.fixtures import no_documents, odd_documents, prose
from wattloom.llm import decontamination
from wattloom.llm import expected as expected_sql


def test_masks_hit_every_window_with_two_words_replaced():
    for bad in combinations(range(decontamination.WINDOW), 2):
        assert any(
            all(start + offset not in bad for offset in mask)
            for mask in decontamination.MASKS
            for start in range(decontamination.WINDOW - max(mask))
        )


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())


def best_overlap(document, item, window=13):
    """Every way in which the two lie side by side, without masks."""
    best = None
    length = min(window, len(item))
    for start in range(1 - len(item), len(document)):
        same = [0 <= start + k < len(document) and document[start + k] == w for k, w in enumerate(item)]
        equal = max(sum(same[k : k + length]) for k in range(len(item) - length + 1))
        if equal * 5 >= length * 4 and (best is None or equal > best[1]):
            best = (start, equal, length)
    return best


def every_replacement(spark, lengths):
    """Items of each length; documents that hold one with each allowed choice of words replaced,
    and with one word more replaced, bare and among other words."""
    items, docs = [], []
    for length in lengths:
        item = [f"n{length}w{k}" for k in range(length)]
        items.append((length, " ".join(item)))
        allowed = length * 1 // 5 if length < 13 else 2
        for count in (allowed, min(length, allowed + 1)):
            for bad in combinations(range(min(length, 13)), count):
                text = " ".join("other" if k in bad else w for k, w in enumerate(item))
                docs += [(len(docs), text), (len(docs) + 1, f"before it {text.upper()} after")]
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string"),
        docs, items,
    )


def test_short_items_lose_nothing(spark):
    docs, items, texts, item_texts = every_replacement(spark, range(1, 15))
    expected = set()
    for doc_id, text in texts:
        for item_id, item_text in item_texts:
            # Items have no word in common, so only the item planted can overlap.
            if f"n{item_id}w" in text.lower():
                best = best_overlap(words_of(text), words_of(item_text))
                if best:
                    expected.add((doc_id, item_id, *best))
    found = decontamination.contaminated(docs, items).select("doc_id", "item_id", "start", "n_equal", "n_window")
    assert {tuple(r) for r in found.collect()} == expected and expected
    left_out = decontamination.contaminated(docs, items, min_words=13).select("item_id").distinct()
    assert {r.item_id for r in left_out.collect()} == {13, 14}


def test_frequent_words_and_short_items(spark):
    draw = random.Random(5)
    rows = [(i, " ".join(draw.choice("abcd") for _ in range(draw.randrange(0, 30)))) for i in range(60)]
    wanted = [(i, " ".join(draw.choice("abcd") for _ in range(1 + i))) for i in range(18)]
    expected = {
        (i, item, *best)
        for i, text in rows
        for item, item_text in wanted
        for best in [best_overlap(words_of(text), words_of(item_text))]
        if best
    }
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(wanted, "item_id long, text string")
    found = decontamination.contaminated(docs, items).select("doc_id", "item_id", "start", "n_equal", "n_window")
    assert {tuple(r) for r in found.collect()} == expected


def test_sql_finds_the_same(spark, tmp_path):
    docs, items, _, _ = every_replacement(spark, [1, 4, 5, 7, 8, 10, 13, 15])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    with duckdb.connect() as db:
        for name in ("documents", "benchmark"):
            db.sql(f"CREATE VIEW {name} AS FROM '{tmp_path}/{name}.parquet/*.parquet'")
        expected = db.sql(f"SELECT doc_id, item_id, start, n_equal, n_window FROM ({expected_sql.OP6})").fetchall()
    found = decontamination.contaminated(docs, items).select("doc_id", "item_id", "start", "n_equal", "n_window")
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_long_texts_with_many_hits(spark):
    """Rows that hold a text for each hit, or an item for each of its places, take many GB here."""
    words = ["common" if i % 15 == 7 else f"w{i}" for i in range(100_000)]
    part = [w if i % 7 else "other" for i, w in enumerate(words[20_000:26_000])]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "few words")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "common"), (2, " ".join(part))], "item_id long, text string")
    found = decontamination.contaminated(docs, items).select("doc_id", "item_id", "start", "n_equal", "n_window")
    assert {tuple(r) for r in found.collect()} == {(1, 1, 7, 1, 1), (1, 2, 20_000, 12, 13)}


def test_pieces_and_runs_lose_nothing(spark):
    """Texts and items of several pieces, passages across their borders, runs of one word."""
    draw = random.Random(9)
    long = [f"n{draw.randrange(10**6)}" for _ in range(700)]
    broken = [w if i % 13 not in (3, 9) else "other" for i, w in enumerate(long)]
    wanted = [long, long[40:70], ["same"] * 45, ["one", *["same"] * 9, "two", *["same"] * 9], long[250:262]]
    fill = [f"f{i}" for i in range(1000)]
    rows = [
        fill[:240] + long[30:75] + fill[300:480] + long[236:290] + fill[:30],
        fill[:251] + broken[:530],
        broken[200:],
        ["same"] * 300,
        fill[:250] + ["one", *["same"] * 40, "two", "same", "other", *["same"] * 30],
        long[690:] + fill[:300] + long[:11],
        ["any", *long[:12]],
    ]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(wanted)], "item_id long, text string")
    for options in ({}, {"window": 9}, {"block_seeds": 1000}):
        expected = {
            (i, item, *best)
            for i, row in enumerate(rows)
            for item, item_words in enumerate(wanted)
            for best in [best_overlap(row, item_words, options.get("window", 13))]
            if best
        }
        found = decontamination.contaminated(docs, items, **options)
        found = found.select("doc_id", "item_id", "start", "n_equal", "n_window")
        assert {tuple(r) for r in found.collect()} == expected and len(expected) > 10


def test_long_windows_see_the_whole_item(spark):
    """The hit lies in the first words; the window that counts, in the last ones."""
    item = [f"w{i}" for i in range(120)]
    text = [*item[:10], *["other"] * 60, *(w if i % 5 else "other" for i, w in enumerate(item[70:]))]
    docs = spark.createDataFrame([(1, " ".join(text))], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = decontamination.contaminated(docs, items, window=20)
    assert [(r.start, r.n_equal, r.n_window) for r in found.collect()] == [(0, 16, 20)]


def tables(spark):
    passage = " ".join(f"item{i}" for i in range(20))
    replaced = " ".join(f"item{i}" if i not in (6, 13) else "else" for i in range(20))
    few = " ".join(f"item{i}" if i % 3 else "else" for i in range(20))
    rows = [
        (1, f"{prose(1, 40)} {passage} {prose(2, 40)}"),
        (2, f"{prose(3, 40)}\n{replaced.upper()}\t{prose(4, 40)}"),
        (3, f"{prose(5, 40)} {few} {prose(6, 40)}"),
        (4, passage.split(" ", 5)[5]),  # begins within the passage
        (5, prose(7, 90)),
        (6, None),
        (7, ""),
        (None, passage),
        (8, passage),
        (8, passage),
        (9, f"{prose(8, 20_000)} {passage}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(100, passage), (101, None), (102, "too short"), (103, prose(90, 30, 10_000)), (104, passage)]
    return docs, spark.createDataFrame(items, "item_id long, text string")


def test_planted_passages(spark):
    docs, items = tables(spark)
    rows = decontamination.contaminated(docs, items).collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    assert found == {(i, item) for i in (1, 2, 4, None, 8, 9) for item in (100, 104)}
    by_doc = {r.doc_id: r for r in rows if r.item_id == 100}
    assert by_doc[1].start == 40 and by_doc[1].n_equal == 13
    assert by_doc[4].start == -5
    assert by_doc[2].n_equal == 12


def test_blocks_of_the_benchmark_give_the_same(spark):
    docs, items = tables(spark)
    whole = decontamination.contaminated(docs, items).collect()
    parts = decontamination.contaminated(docs, items, block_seeds=40).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, parts))


def test_clean_rows_stay(spark):
    docs, items = tables(spark)
    left = decontamination.without_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [3, 5, 6, 7]


def test_odd_rows_and_empty_tables(spark):
    docs = odd_documents(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated(docs, none).collect() == []
    left = decontamination.without_contaminated(docs, none)
    assert left.columns == docs.columns and left.count() == docs.count()
    _, items = tables(spark)
    assert decontamination.contaminated(no_documents(spark), items).collect() == []
    assert decontamination.without_contaminated(no_documents(spark), items).collect() == []

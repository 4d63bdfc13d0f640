"""Documents with nulls, empty and long texts, ties, repeated rows and odd extra columns."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " size int, key string, kept boolean, row string, n int, text_hash string"
)


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    """Lines of invented words, eight to a line."""
    random_words = random.Random(seed)
    made = [f"w{random_words.randrange(vocabulary)}" for _ in range(words)]
    return "\n".join(" ".join(made[i : i + 8]) + "." for i in range(0, words, 8))


def changed(text: str, every: int) -> str:
    """Another text with each so manyth word replaced."""
    lines = [line.split(" ") for line in text.split("\n")]
    at = 0
    for line in lines:
        for i in range(len(line)):
            at += 1
            if at % every == 0:
                line[i] = f"other{at}"
    return "\n".join(" ".join(line) for line in lines)


def odd_rows() -> list[tuple]:
    base = prose(1, 120)
    texts: list[tuple[int | None, str | None, str | None]] = [
        (10, base, "a"),
        (11, base, "a"),
        (11, base, "a"),  # a repeated row
        (12, changed(base, 60), "b"),
        (13, None, "b"),
        (14, "", None),
        (15, " \t\n\r\x0b\x0c ", "b"),
        (16, "One two", "a"),
        (17, "one TWO", "a"),
        (None, prose(3, 40), "c"),
        (None, prose(4, 40), None),
        (18, prose(5, 30_000, 5000), "c"),
        (19, "a\x1cb c ́x ß İ 中文 — <|endoftext|> don't 123 $$$ ###", "é"),
        (20, "same " * 60, "a"),
        (-5, prose(6, 64), "z"),
        (2**40, prose(7, 64), "z"),
    ]
    texts += [(100 + i, prose(100 + i, 50 + 7 * i), "ab"[i % 2]) for i in range(20)]
    return [
        (i, t, None if i == 12 else "en", s, None if t is None else len(t), 1, "k", True, "r", 2, "h")
        for i, t, s in texts
    ]


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)

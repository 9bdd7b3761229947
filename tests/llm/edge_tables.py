"""Small documents with every edge: nulls, empty, long, ties, repeats, clashing extra columns."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "text_key string, row int, score string, sequence_id string, lines_before string")


def words(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(1, 8)))
                    for _ in range(n))


def rows() -> list[tuple]:
    long = words(1, 20_000)
    texts = [
        (1, words(2, 120)), (2, words(2, 120)), (3, words(2, 120) + " "), (4, None), (5, ""),
        (6, " \t\n\x0b\x0c\r "), (7, words(3, 60)), (7, words(3, 60)), (None, words(4, 70)),
        (None, None), (8, long), (9, "x" * 30_000), (10, "a b c"), (11, "!!! ??? ..."),
        (12, "line one\n\nline one\nline two\n"), (13, "é" * 5 + " 世界 👍 \x00 <|endoftext|> b"),
        (14, " ".join(["same"] * 200)), (15, long.replace("a", "a", 1) + " end"),
    ]
    return [(i, t, None if k % 3 else "en", None if k % 4 == 0 else f"src{k % 2}",
             None if t is None else len(t), "clash", k, None, "x", "y")
            for k, (i, t) in enumerate(texts)]


def table(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)

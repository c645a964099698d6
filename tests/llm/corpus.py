"""A small corpus with nulls, empty, repeated, equal, near and long texts, and columns with clashing names."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

COLUMNS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, row string, "
    "node int, hits int, n int, class int, host string, bad_rate double, next_group int"
)


def words(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(n)]


def rows() -> list[tuple[int | None, str | None]]:
    base = words(1, 200)
    near = [*base[:50], "changed", *base[51:]]
    passage = " ".join(words(2, 60))
    out: list[tuple[int | None, str | None]] = [
        (1, " ".join(base)),
        (2, " ".join(near) + "."),
        (3, " ".join(base).upper()),
        (4, None),
        (5, ""),
        (6, " \n\t"),
        (7, "two words"),
        (8, "Two Words"),
        (9, passage + " tail one"),
        (10, "head two\n" + passage),
        (11, passage + " x " + passage),
        (None, "a row without id"),
        (None, None),
        (12, " ".join(words(3, 20_000))),
        (13, "x" * 70_000),
        (14, "<|endoftext|> odd   blanks \x00 日本 😀. it's"),
        (7, "two words"),
        (7, "two words"),
    ]
    out += [(100 + i, " ".join(words(50 + i, 30 + i))) for i in range(20)]
    return out


def corpus(spark: SparkSession, chosen: list[tuple[int | None, str | None]] | None = None) -> DataFrame:
    filled = [
        (i, t, "en", None, None if t is None else len(t), "k", None, 1, 2, 3, 4, "h", 0.5, 6)
        for i, t in (rows() if chosen is None else chosen)
    ]
    return spark.createDataFrame(filled, COLUMNS)

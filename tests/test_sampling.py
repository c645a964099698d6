from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from starmill.operators.sampling import exact_sample


def brute_force(rows: list[tuple], n: int, keys: int) -> Counter:
    def ticket(row: tuple) -> str:
        return hashlib.md5("|".join(["42", *map(str, row[:keys])]).encode()).hexdigest()

    return Counter(sorted(rows, key=lambda r: (ticket(r), r))[:n])


def sampled(spark, rows: list[tuple], n: int, keys: list[str], **options: float) -> Counter:
    df = spark.createDataFrame(rows, "a bigint, b string").repartition(5)
    return Counter(tuple(r) for r in exact_sample(df, n, keys, **options).collect())


@pytest.mark.parametrize("n", [1, 100, 2999, 3000, 5000])
def test_sample_is_exact(spark, n: int) -> None:
    rows = [(i, f"v{i % 7}") for i in range(3000)]
    assert sampled(spark, rows, n, ["a"]) == brute_force(rows, n, 1)


def test_copies_of_one_row_may_fill_a_third(spark) -> None:
    rows = [(i, "x") for i in range(2000)] + [(5, "x")] * 1000
    for n in (50, 1500):
        assert sampled(spark, rows, n, ["a", "b"]) == brute_force(rows, n, 2)


def test_a_cut_that_is_too_low_is_raised(spark) -> None:
    """Few distinct keys, each with many rows: the first cut can miss them all."""
    rows = [(i % 3, f"v{i:05d}") for i in range(6000)]
    assert sampled(spark, rows, 500, ["a"], oversample=0.01) == brute_force(rows, 500, 1)


def test_empty_table(spark) -> None:
    assert sampled(spark, [(1, "x")][:0] or [], 10, ["a"]) == Counter()

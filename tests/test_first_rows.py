"""The first rows of a table against a sort in memory."""

from __future__ import annotations

import math
import random
from datetime import date, datetime
from decimal import Decimal

import pytest

from starmill.operators import first_rows as module
from starmill.operators.first_rows import bounded, first_rows

SHAPE = "t string, d date, x double, n int, m decimal(12,2), w decimal(30,2), at timestamp_ntz, b binary, i int"


def table(spark, size: int, seed: int = 1):
    rng = random.Random(seed)

    def some(value):
        return None if rng.random() < 0.02 else value

    return spark.createDataFrame(
        [
            (
                some(rng.choice(["", "a", "abcdefg", "abcdefgh", "abcdefgi", "é", "z" * 20])),
                some(date(2024, 1, rng.randint(1, 9))),
                some(rng.choice([math.nan, -0.5, 1.0, 1e300, -math.inf])),
                some(rng.randint(0, 40)),
                some(Decimal(rng.randint(-500, 500)) / 100),
                some(Decimal(rng.randint(-5, 5))),
                some(datetime(2024, 1, rng.randint(1, 28), 3, 4, 5, rng.randint(0, 999_999))),
                some(bytes([rng.randint(0, 3)])),
                i,
            )
            for i in range(size)
        ],
        SHAPE,
    )


def key(value):
    """Nulls first, not-a-number last, as Spark sorts."""
    if value is None:
        return (0,)
    if isinstance(value, float) and math.isnan(value):
        return (2,)
    return (1, value.encode() if isinstance(value, str) else bytes(value) if isinstance(value, bytearray) else value)


@pytest.mark.parametrize("ordered", [1, 100_000])
@pytest.mark.parametrize(
    "order", [["d", "t", "i"], ["x", "m", "i"], ["at", "i"], ["w", "b", "i"], ["N", "d", "x", "i"]]
)
def test_first_rows(spark, monkeypatch, order, ordered) -> None:
    """With bounds of single columns, and of as many columns as ties need."""
    monkeypatch.setattr(module, "ORDERED_ROWS", ordered)
    df = table(spark, 3000).repartition(7)
    names = {c.lower(): c for c in df.columns}
    rows = sorted(df.collect(), key=lambda r: [key(r[names[c.lower()]]) for c in order])
    for k in (1, 200):
        found = first_rows(df, order, k).collect()
        assert [r.i for r in found] == [r.i for r in rows[:k]]


def test_bounds_leave_little(spark) -> None:
    df = spark.range(0, 200_000, 1, 16).selectExpr("id * 7919 % 200000 AS k", "id")
    assert 100 <= bounded(df, ["k"], 100).count() < 400
    same = spark.range(0, 200_000, 1, 16).selectExpr("1 AS k", "id * 7919 % 200000 AS j")
    assert 100 <= bounded(same, ["k", "j"], 100).count() < 400


@pytest.mark.parametrize("size", [0, 1, 20])
def test_fewer_rows_than_wanted(spark, size) -> None:
    df = table(spark, size)
    assert [r.i for r in first_rows(df, ["n", "i"], 50).collect()] == [
        r.i for r in sorted(df.collect(), key=lambda r: [key(r.n), key(r.i)])
    ]


def test_nulls_only(spark) -> None:
    df = spark.range(5000).selectExpr("CAST(NULL AS int) AS k", "id")
    assert [r.id for r in first_rows(df, ["k", "id"], 3).collect()] == [0, 1, 2]

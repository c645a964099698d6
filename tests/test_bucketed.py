"""Stored key profiles against joins in memory, and their plans."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import types as T

from starmill.sources.bucketed import KeyProfile, orphans
from tests.plans import plan_text
from tests.star_fixture import fact_rows, small_star

BUCKETS = 4


@pytest.fixture
def profiles(spark, tmp_path):
    star = small_star(spark)
    fact, stores = KeyProfile(spark, f"{tmp_path}/fact/store_sk"), KeyProfile(spark, f"{tmp_path}/dim/store_sk")
    fact.add(star["fct_sales"], "store_sk", buckets=BUCKETS)
    stores.add(star["dim_stores"], "store_sk", buckets=BUCKETS)
    return fact, stores


def expected(rows) -> tuple[int, int, int]:
    keys = Counter(row[4] for row in rows if row[4] is not None)
    missing = [k for k in keys if k not in range(5)]
    return len(keys), len(missing), sum(keys[k] for k in missing)


def test_orphans(spark, profiles) -> None:
    fact, stores = profiles
    assert tuple(orphans(fact, stores).first()) == expected(fact_rows())
    # Rows that come later are added to the buckets.
    more = [(*row[:4], 99 if i % 2 else 3, *row[5:]) for i, row in enumerate(fact_rows(40))]
    fact.add(small_star(spark, more)["fct_sales"], "store_sk", buckets=BUCKETS)
    assert tuple(orphans(fact, stores).first()) == expected([*fact_rows(), *more])


def test_neither_side_is_shuffled(spark, profiles) -> None:
    text = plan_text(orphans(*profiles))
    assert "SortMergeJoin" in text and "hashpartitioning" not in text and "BroadcastExchange" not in text
    assert text.count("Exchange SinglePartition") == 1
    assert "Bucketed: true" in text or f"SelectedBucketsCount: {BUCKETS} out of {BUCKETS}" in text


def test_hot_key_is_one_row(spark, profiles) -> None:
    rows = profiles[0].read().collect()
    assert len(rows) == len({r.key for r in rows}) and max(r.n for r in rows) >= 200


def test_profile_is_opened_by_its_path_alone(spark, profiles) -> None:
    """As another session would, whose catalog does not know it."""
    fact, stores = profiles
    counts = tuple(orphans(fact, stores).first())
    for profile in profiles:
        spark.sql(f"DROP TABLE {profile.name}")
    assert tuple(orphans(KeyProfile(spark, fact.path), KeyProfile(spark, stores.path)).first()) == counts


def test_texts_and_other_buckets(spark, tmp_path) -> None:
    names = KeyProfile(spark, f"{tmp_path}/names")
    rows = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "`odd name` string")
    names.add(rows, "odd name", T.StringType(), 2)
    assert {(r.key, r.n) for r in names.read().collect()} == {("a", 2), ("b", 1)}
    with pytest.raises(ValueError, match="string keys in 2 buckets"):
        names.add(rows, "odd name", T.StringType(), 3)
    none = KeyProfile(spark, f"{tmp_path}/none")
    none.add(rows.limit(0), "odd name", T.StringType(), 2)
    assert tuple(orphans(names, none).first()) == (2, 2, 3) and tuple(orphans(none, names).first()) == (0, 0, 0)

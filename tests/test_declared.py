from __future__ import annotations

from collections import Counter
from datetime import date, datetime

import pytest

from starmill.operators import references
from starmill.operators.lookups import ENTRY_BYTES, key_set_bytes, within_budget
from starmill.operators.references import Reference, orphan_counts
from starmill.plans import declared, results
from tests.star_fixture import FACT_SCHEMA, fact_rows, small_star

# The published check names, in order.
PUBLISHED = """
mart.dim_customers__rowcount_floor
mart.fct_sales__rowcount_floor
mart.fct_sales__sales_id__not_null
mart.fct_sales__sales_date__not_null
mart.fct_sales__customer_sk__not_null
mart.fct_sales__product_sk__not_null
mart.fct_sales__store_sk__not_null
mart.fct_sales__salesperson_sk__not_null
mart.fct_sales__total_amount__not_null
mart.fct_sales__sales_id__unique
mart.fct_sales__customer_sk_fk__references_dim_customers.customer_sk
mart.fct_sales__product_sk_fk__references_dim_products.product_sk
mart.fct_sales__store_sk_fk__references_dim_stores.store_sk
mart.fct_sales__salesperson_sk_fk__references_dim_salespersons.salesperson_sk
mart.fct_sales__campaign_sk_fk__references_dim_campaigns.campaign_sk
mart.fct_sales__total_amount__non_negative
mart.fct_sales__sales_date__not_future
mart.fct_sales__total_amount__not_absurd
analytics.mart_store_daily__rowcount_floor
analytics.mart_store_daily__revenue__non_negative
analytics.mart_campaign_perf__campaign_name__not_null
""".split()

AS_OF = datetime(2024, 1, 30)


def failed_by_rule(checks) -> dict[str, int]:
    return {r.check_name: r.failed_rows for r in checks.collect()}


def brute_force(rows: list[tuple]) -> dict[str, int]:
    """The fact checks of the small star, row by row."""
    columns = [c.split()[0] for c in FACT_SCHEMA.split(", ")]
    table = [dict(zip(columns, row)) for row in rows]
    parents = {
        "customer_sk": ("dim_customers", range(11)),
        "product_sk": ("dim_products", range(12)),
        "store_sk": ("dim_stores", range(5)),
        "salesperson_sk": ("dim_salespersons", range(5)),
        "campaign_sk": ("dim_campaigns", range(6)),
    }
    out = {
        f"mart.fct_sales__{c}__not_null": sum(r[c] is None for r in table)
        for c in columns if c != "campaign_sk"
    }
    out["mart.fct_sales__rowcount_floor"] = 0 if table else 1
    out["mart.dim_customers__rowcount_floor"] = 0
    out["mart.fct_sales__sales_id__unique"] = sum(
        n > 1 for n in Counter(r["sales_id"] for r in table).values()
    )
    for column, (dim, keys) in parents.items():
        out[f"mart.fct_sales__{column}_fk__references_{dim}.{column}"] = sum(
            r[column] is not None and r[column] not in keys for r in table
        )
    out["mart.fct_sales__total_amount__non_negative"] = sum(r["total_amount"] < 0 for r in table)
    out["mart.fct_sales__total_amount__not_absurd"] = sum(
        r["total_amount"] > 1_000_000 for r in table
    )
    limit = datetime(2024, 1, 31)
    out["mart.fct_sales__sales_date__not_future"] = sum(r["sales_date"] > limit for r in table)
    return out


def test_names_are_the_published_ones_in_order() -> None:
    assert [r.check_name for r in declared.RETAIL_RULES] == PUBLISHED


@pytest.mark.parametrize("derived", [False, True])
def test_suite_equals_brute_force(spark, derived: bool) -> None:
    tables = declared.qualified(mart=small_star(spark))
    checks = declared.evaluate(
        declared.RETAIL_RULES, tables, AS_OF, derived=tables if derived else ()
    )
    assert failed_by_rule(checks) == brute_force(fact_rows())


def test_empty_fact_fails_only_its_floor(spark) -> None:
    tables = declared.qualified(mart=small_star(spark, rows=[]))
    checks = declared.evaluate(declared.RETAIL_RULES, tables, AS_OF).collect()
    assert [r.check_name for r in checks if r.status == "FAIL"] == ["mart.fct_sales__rowcount_floor"]
    assert len(checks) == 18


def test_missing_analytics_tables_are_skipped_and_reported(spark, caplog) -> None:
    tables = declared.qualified(mart=small_star(spark))
    with caplog.at_level("WARNING"):
        present = declared.present_rules(declared.RETAIL_RULES, tables)
    assert len(present) == 18
    assert "analytics.mart_store_daily__revenue__non_negative" in caplog.text


def test_missing_required_table_raises(spark) -> None:
    tables = declared.qualified(mart=small_star(spark))
    del tables["mart.fct_sales"]
    with pytest.raises(KeyError, match="fct_sales"):
        declared.present_rules(declared.RETAIL_RULES, tables)


def test_repeated_null_is_one_repeated_key(spark) -> None:
    df = spark.createDataFrame([(None,), (None,), (1,), (2,), (2,)], "k bigint")
    checks = declared.evaluate([declared.unique("mart.t", "k")], {"mart.t": df})
    assert failed_by_rule(checks) == {"mart.t__k__unique": 2}


@pytest.mark.parametrize("budget", [0, references.BROADCAST_BYTES])
def test_repeated_parent_does_not_multiply_orphans(spark, budget: int) -> None:
    fact = spark.createDataFrame([(1,), (1,), (9,), (None,)], "k bigint")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    [counts] = orphan_counts(fact, {4: Reference("k", parent, "k")}, broadcast_bytes=budget)
    assert [(r.rule, r.failed_rows) for r in counts.collect()] == [(4, 1)]


def test_large_and_small_dimensions_in_one_suite(spark) -> None:
    star = small_star(spark)
    pointers = {
        0: Reference("customer_sk", star["dim_customers"], "customer_sk"),
        1: Reference("store_sk", star["dim_stores"], "store_sk"),
        2: Reference("campaign_sk", star["dim_campaigns"], "campaign_sk"),
    }
    found = {}
    for budget in (0, 8 * ENTRY_BYTES, 1000 * ENTRY_BYTES):
        parts = orphan_counts(star["fct_sales"], pointers, broadcast_bytes=budget)
        assert len(parts) == (2 if budget == 8 * ENTRY_BYTES else 1)
        found[budget] = {r.rule: r.failed_rows for part in parts for r in part.collect()}
    assert found[0] == found[8 * ENTRY_BYTES] == found[1000 * ENTRY_BYTES]


def test_orphans_by_slice(spark) -> None:
    fact = spark.createDataFrame([(1, 1), (1, 9), (2, 1), (3, None)], "y int, k bigint")
    parent = spark.createDataFrame([(1,)], "k bigint")
    for budget in (0, 10 * ENTRY_BYTES):
        [counts] = orphan_counts(fact, {0: Reference("k", parent, "k")}, ["y"], budget)
        assert {r.y: r.failed_rows for r in counts.collect()} == {1: 1, 2: 0, 3: 0}


def test_text_keys_compare_with_whole_numbers(spark) -> None:
    fact = spark.createDataFrame([("7",), ("08",), (None,)], "k string")
    parent = spark.createDataFrame([(7,), (8,)], "k int")
    for budget in (0, 10 * ENTRY_BYTES):
        [counts] = orphan_counts(fact, {0: Reference("k", parent, "k")}, broadcast_bytes=budget)
        assert counts.collect()[0].failed_rows == 0


@pytest.mark.parametrize("kind", ["double", "decimal(10,1)", "smallint"])
def test_numbers_of_any_kind_compare(spark, kind: str) -> None:
    """A key with gaps comes from CSV as 1.0 where the dimension holds 1."""
    fact = spark.sql(f"SELECT CAST(k AS {kind}) AS k FROM VALUES (1), (2), (9), (NULL) AS t(k)")
    parent = spark.createDataFrame([(1,), (2,)], "k bigint")
    for budget in (0, 10 * ENTRY_BYTES):
        [counts] = orphan_counts(fact, {0: Reference("k", parent, "k")}, broadcast_bytes=budget)
        assert counts.collect()[0].failed_rows == 1


def test_keys_that_do_not_compare_raise(spark) -> None:
    fact = spark.sql("SELECT DATE'2024-01-01' AS k")
    parent = spark.createDataFrame([(1,)], "k bigint")
    with pytest.raises(TypeError, match="do not compare"):
        orphan_counts(fact, {0: Reference("k", parent, "k")})


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("date", [date(2024, 1, 31), date(2024, 2, 1)]),
        ("timestamp_ntz", [datetime(2024, 1, 31), datetime(2024, 1, 31, 0, 0, 1)]),
        ("timestamp", [datetime(2024, 1, 31), datetime(2024, 1, 31, 0, 0, 1)]),
    ],
)
def test_not_future_for_every_kind_of_date(spark, kind: str, values: list) -> None:
    text = spark.createDataFrame([(str(v),) for v in values], "d string")
    df = text.selectExpr(f"CAST(d AS {kind}) AS d")
    checks = declared.evaluate([declared.not_future("mart.t", "d")], {"mart.t": df}, AS_OF)
    assert failed_by_rule(checks) == {"mart.t__d__not_future": 1}


def test_not_future_defaults_to_the_present(spark) -> None:
    df = spark.sql("SELECT current_date() + x AS d FROM VALUES (-9), (0), (9) AS t(x)")
    checks = declared.evaluate([declared.not_future("mart.t", "d")], {"mart.t": df})
    assert failed_by_rule(checks) == {"mart.t__d__not_future": 1}


def test_threshold_allows_failures(spark) -> None:
    df = spark.createDataFrame([(None,), (1,)], "k int")
    rule = declared.Rule("not_null", "mart.t", "k", "k_mostly", "", threshold=1)
    assert declared.evaluate([rule], {"mart.t": df}).collect()[0].status == "PASS"


def test_document_keeps_the_order_of_the_suite(spark, tmp_path) -> None:
    tables = declared.qualified(mart=small_star(spark))
    checks = declared.evaluate(declared.RETAIL_RULES, tables, AS_OF)
    path = str(tmp_path / "dq")
    results.write_document(checks, path, datetime(2024, 5, 6, 7, 8, 9), "db")
    stored = results.read_document(spark, path).collect()
    assert len(stored) == 1
    assert [r.check_name for r in stored[0].results] == PUBLISHED[:18]
    assert stored[0].run_utc == "2024-05-06T07:08:09+00:00"
    assert stored[0].summary.total == 18
    assert stored[0].summary.passed + stored[0].summary.failed == 18


def test_repeated_rules_have_equal_rows(spark) -> None:
    df = spark.createDataFrame([(None,), (1,), (1,)], "k bigint")
    rules = [make("mart.t", "k") for make in (declared.not_null, declared.unique) for _ in range(2)]
    rows = declared.evaluate(rules, {"mart.t": df}).orderBy("position").collect()
    assert [(r.status, r.failed_rows) for r in rows] == [("FAIL", 1)] * 4


@pytest.mark.parametrize("budget", [0, references.BROADCAST_BYTES])
def test_empty_tables_have_real_counts(spark, monkeypatch, budget: int) -> None:
    monkeypatch.setattr(references.orphan_counts, "__defaults__", ((), budget))
    empty = spark.createDataFrame([], "k bigint")
    tables = {"mart.t": empty, "mart.p": empty}
    rules = [
        declared.rowcount_floor("mart.t"),
        declared.not_null("mart.t", "k"),
        declared.unique("mart.t", "k"),
        declared.references("mart.t", "k", "mart.p", "k"),
    ]
    rows = declared.evaluate(rules, tables).orderBy("position").collect()
    assert [r.failed_rows for r in rows] == [1, 0, 0, 0]


def test_lost_count_raises(spark) -> None:
    rules = [declared.not_null("mart.t", "k"), declared.not_null("mart.t", "j")]
    counts = spark.createDataFrame([(0, 0)], "rule int, failed_rows bigint")
    with pytest.raises(Exception, match="no count for the check mart.t__j__not_null"):
        declared.with_status(rules, counts).collect()


def test_names_in_any_case(spark) -> None:
    df = spark.createDataFrame([(1, 5.0), (None, -1.0)], "Sales_ID bigint, Total_Amount double")
    parent = spark.createDataFrame([(7,)], "SALES_id int")
    rules = [
        declared.not_null("mart.t", "sales_id"),
        declared.non_negative("mart.t", "TOTAL_AMOUNT"),
        declared.unique("mart.t", "SALES_ID"),
        declared.references("mart.t", "sales_id", "mart.p", "sales_id"),
    ]
    found = declared.evaluate(rules, {"mart.t": df, "mart.p": parent}).orderBy("position").collect()
    assert [r.failed_rows for r in found] == [1, 1, 0, 1]
    with pytest.raises(KeyError, match="0 columns are named absent"):
        declared.evaluate([declared.not_null("mart.t", "absent")], {"mart.t": df})


def test_long_text_keys_count_by_their_bytes(spark) -> None:
    parents = spark.createDataFrame([("x" * 1000,), ("y",)], "k string")
    sizes = key_set_bytes({"long": (parents, "k"), "short": (parents.where("k = 'y'"), "K")})
    assert sizes == {"long": 1001 + 2 * ENTRY_BYTES, "short": 1 + ENTRY_BYTES}
    assert within_budget(sizes, 500) == ["short"]
    assert within_budget({"a": 300, "b": 300, "c": 100}, 450) == ["c", "a"]

"""SQL counterparts of the registered queries, over the whole given tables.

Sums of money are taken over decimals on both sides, so that they do not depend on row order.
"""

from __future__ import annotations

STAR = {
    "fct_sales": """
SELECT l.l_orderkey*10 + l.l_linenumber AS sales_id, l.l_shipdate AS sales_date,
  CAST(YEAR(l.l_shipdate)*10000 + MONTH(l.l_shipdate)*100 + DAY(l.l_shipdate) AS INT) AS date_sk,
  o.o_custkey AS customer_sk, l.l_partkey AS product_sk, l.l_suppkey AS store_sk,
  CAST(l.l_orderkey % 25 AS INT) AS salesperson_sk,
  CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN NULL
       ELSE CAST(substr(o.o_orderpriority,1,1) AS INT) END AS campaign_sk,
  l.l_extendedprice AS total_amount
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "dim_customers": """
SELECT c_custkey AS customer_sk, c_name AS customer_name, c_mktsegment AS segment,
  c_acctbal AS balance FROM customer""",
    "dim_products": """
SELECT p_partkey AS product_sk, p_name AS product_name, p_type AS category, p_brand AS brand
FROM part""",
    "dim_stores": """
SELECT s.s_suppkey AS store_sk, s.s_name AS store_id, n.n_name AS store_name,
  s.s_acctbal AS balance
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "dim_salespersons": """
SELECT n_nationkey AS salesperson_sk, n_name AS salesperson_name
FROM nation WHERE n_nationkey < 20""",
    "dim_campaigns": """
SELECT DISTINCT CAST(substr(o_orderpriority,1,1) AS INT) AS campaign_sk,
  substr(o_orderpriority,3) AS campaign_name
FROM orders WHERE o_orderpriority NOT IN ('4-NOT SPECIFIED','5-LOW')""",
    "dim_dates": """
SELECT DISTINCT
  CAST(YEAR(l_shipdate)*10000 + MONTH(l_shipdate)*100 + DAY(l_shipdate) AS INT) AS date_sk,
  CAST(l_shipdate AS DATE) AS full_date
FROM lineitem""",
}

TOTAL = "SUM(CAST(f.total_amount AS DECIMAL(18,2)))"
REVENUE = f"CAST({TOTAL} AS DOUBLE)"
AVERAGE = f"{REVENUE} / COUNT(f.total_amount)"

STAR["mart_store_daily"] = f"""
SELECT CAST(f.sales_date AS DATE) AS sales_day, f.store_sk, s.store_name,
  COUNT(*) AS transactions, {REVENUE} AS revenue, {AVERAGE} AS avg_order_value
FROM fct_sales f LEFT JOIN dim_stores s ON f.store_sk = s.store_sk
GROUP BY 1, 2, 3"""
STAR["mart_campaign_perf"] = f"""
SELECT f.campaign_sk, c.campaign_name, COUNT(*) AS transactions, {REVENUE} AS revenue,
  {AVERAGE} AS avg_order_value, MIN(CAST(f.sales_date AS DATE)) AS first_sale_day,
  MAX(CAST(f.sales_date AS DATE)) AS last_sale_day
FROM fct_sales f LEFT JOIN dim_campaigns c ON f.campaign_sk = c.campaign_sk
GROUP BY 1, 2"""

DIMENSIONS = [
    "dim_campaigns", "dim_customers", "dim_dates", "dim_products", "dim_salespersons", "dim_stores",
]


def with_star(select: str, **more: str) -> str:
    """A statement over the star: its views, further named queries, then the select."""
    views = {**STAR, **more}
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in views.items())
    return f"WITH {ctes}\n{select}"


# --- declared suite ---------------------------------------------------------------------------


def check(name: str, failed: str, details: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, CASE WHEN n <= 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
        f"n AS failed_rows, CAST(0 AS BIGINT) AS threshold_failed_rows, '{details}' AS details "
        f"FROM (SELECT CAST(({failed}) AS BIGINT) AS n) t"
    )


def count_where(table: str, condition: str) -> str:
    return f"SELECT COUNT(*) FROM {table} WHERE {condition}"


def floor(layer: str, table: str, rows: int = 1) -> str:
    return check(
        f"{layer}.{table}__rowcount_floor",
        f"SELECT CASE WHEN COUNT(*) >= {rows} THEN 0 ELSE 1 END FROM {table}",
        f"{table} should have at least {rows} row{'s' if rows > 1 else ''}",
    )


def required(column: str) -> str:
    return check(f"mart.fct_sales__{column}__not_null",
                 count_where("fct_sales", f"{column} IS NULL"), f"{column} should never be NULL")


def second_copies(column: str) -> str:
    """A key that repeats has exactly one row that is its second."""
    copies = f"SELECT ROW_NUMBER() OVER (PARTITION BY {column} ORDER BY {column}) AS copy FROM fct_sales"
    return f"SELECT COUNT(*) FROM ({copies}) k WHERE copy = 2"


def unique(column: str) -> str:
    return check(
        f"mart.fct_sales__{column}__unique",
        second_copies(column),
        f"{column} should be unique in fct_sales",
    )


def orphans(column: str, dim: str) -> str:
    known = f"SELECT COUNT(*) FROM fct_sales WHERE {column} IN (SELECT {column} FROM {dim})"
    return f"(SELECT COUNT({column}) FROM fct_sales) - ({known})"


def reference(column: str, dim: str) -> str:
    return check(
        f"mart.fct_sales__{column}_fk__references_{dim}.{column}",
        orphans(column, dim),
        f"All {column} values in fct_sales should exist in {dim}.{column}",
    )


def non_negative(layer: str, table: str, column: str) -> str:
    return check(f"{layer}.{table}__{column}__non_negative",
                 count_where(table, f"{column} < 0"), f"{column} should be >= 0")


def not_absurd(bound: int, suffix: str = "") -> str:
    return check(
        f"mart.fct_sales__total_amount__not_absurd{suffix}",
        count_where("fct_sales", f"total_amount > {bound}"),
        f"total_amount should not exceed {bound:,} (sanity check)",
    )


def union(*selects: str) -> str:
    return "\nUNION ALL\n".join(selects)


# Columns, references and calendar names of the retail star, here and below.
REQUIRED = [
    "sales_id", "sales_date", "customer_sk", "product_sk", "store_sk", "salesperson_sk",
    "total_amount",
]
REFERENCES = {
    "customer_sk": "dim_customers",
    "product_sk": "dim_products",
    "store_sk": "dim_stores",
    "salesperson_sk": "dim_salespersons",
    "campaign_sk": "dim_campaigns",
}
NOT_FUTURE = check(
    "mart.fct_sales__sales_date__not_future",
    count_where("fct_sales", "sales_date > TIMESTAMP '2001-06-01 00:00:00' + INTERVAL 1 DAY"),
    "sales_date should not be in the future (beyond 1 day)",
)
CAMPAIGN_NAME = check(
    "analytics.mart_campaign_perf__campaign_name__not_null",
    count_where("mart_campaign_perf", "campaign_name IS NULL"),
    "campaign_name should not be NULL (dim join should resolve)",
)
DECLARED = union(
    floor("mart", "dim_customers"),
    floor("mart", "fct_sales"),
    *[required(c) for c in REQUIRED],
    unique("sales_id"),
    *[reference(c, d) for c, d in REFERENCES.items()],
    non_negative("mart", "fct_sales", "total_amount"),
    NOT_FUTURE,
    not_absurd(1_000_000),
    floor("analytics", "mart_store_daily"),
    non_negative("analytics", "mart_store_daily", "revenue"),
    CAMPAIGN_NAME,
)
SUITE_TOTALS = (
    "SELECT COUNT(*) AS total, CAST(SUM(CASE WHEN status = 'PASS' THEN 1 ELSE 0 END) AS BIGINT) "
    "AS passed, CAST(SUM(CASE WHEN status = 'FAIL' THEN 1 ELSE 0 END) AS BIGINT) AS failed "
    "FROM declared"
)

# --- discovered suite -------------------------------------------------------------------------

KEYS = {
    "dim_campaigns": ["campaign_sk"],
    "dim_customers": ["customer_sk"],
    "dim_dates": ["date_sk"],
    "dim_products": ["product_sk"],
    "dim_salespersons": ["salesperson_sk"],
    "dim_stores": ["store_sk", "store_id"],
    "fct_sales": [
        "sales_id", "date_sk", "customer_sk", "product_sk", "store_sk", "salesperson_sk",
        "campaign_sk",
    ],
}
FIRST_KEYS = {
    table: next(c for c in columns if c.endswith("_sk")) for table, columns in KEYS.items()
}
TEXTS = {
    "dim_campaigns": ["campaign_name"],
    "dim_customers": ["customer_name", "segment"],
    "dim_dates": [],
    "dim_products": ["product_name", "category", "brand"],
    "dim_salespersons": ["salesperson_name"],
    "dim_stores": ["store_id", "store_name"],
}
AUTO_REFERENCES = {"date_sk": "dim_dates", **REFERENCES}


def found(kind: str, table: str, column: str, suffix: str, severity: int, failed: str) -> str:
    return (
        f"SELECT TIMESTAMP '2026-01-01 00:00:00' AS run_ts, '{kind}' AS check_type, "
        f"'mart.{table}' AS \"table\", '{column}' AS \"column\", "
        f"'mart.{table}__{column}__{suffix}' AS dq_check_name, "
        "CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, n AS failed_rows, "
        f"CASE WHEN n = 0 THEN 0 ELSE {severity} END AS severity "
        f"FROM (SELECT CAST(({failed}) AS BIGINT) AS n) t"
    )


AUTO_NULLS = union(*[
    found("nulls", t, c, "nulls", 3, count_where(t, f"{c} IS NULL"))
    for t, columns in KEYS.items() for c in columns
])
AUTO_DUPLICATES = union(*[
    found("duplicates", t, c, "duplicates", 4,
          f"SELECT COUNT({c}) - COUNT(DISTINCT {c}) FROM {t}")
    for t, c in FIRST_KEYS.items()
])
AUTO_FK = union(*[
    found("fk_missing", "fct_sales", c, f"missing_in_mart.{d}", 5, orphans(c, d))
    for c, d in AUTO_REFERENCES.items()
])
AUTO = union(AUTO_NULLS, AUTO_DUPLICATES, AUTO_FK)


def over_auto(select: str) -> str:
    return with_star(select, auto=AUTO)


FAILED = "CASE WHEN status = 'FAIL' THEN 1 ELSE 0 END"
FAILED_ROWS = "CAST(COALESCE(SUM(CASE WHEN status = 'FAIL' THEN failed_rows END), 0) AS BIGINT)"
PASS_RATE = f"CAST(COUNT(*) - SUM({FAILED}) AS DOUBLE) / COUNT(*)"

YEARLY = """
SELECT YEAR(f.sales_date) + 1 AS y,
  SUM(CASE WHEN f.campaign_sk IS NULL THEN 1 ELSE 0 END) AS nulls,
  SUM(CASE WHEN f.campaign_sk IS NOT NULL AND d.campaign_sk IS NULL THEN 1 ELSE 0 END) AS orphans,
  SUM(CASE WHEN f.total_amount > 100000 THEN 1 ELSE 0 END) AS huge
FROM fct_sales f LEFT JOIN dim_campaigns d ON f.campaign_sk = d.campaign_sk
GROUP BY 1"""

RUNS = """
SELECT make_timestamp(y, 1, 1, 0, 0, 0.0) AS run_ts,
  CAST((CASE WHEN nulls > 0 THEN 1 ELSE 0 END) + (CASE WHEN orphans > 0 THEN 1 ELSE 0 END)
    + (CASE WHEN huge > 0 THEN 1 ELSE 0 END) AS INTEGER) AS failed_checks,
  CAST(nulls + orphans + huge AS BIGINT) AS total_failed_rows,
  CAST(3 AS INTEGER) AS total_checks FROM yearly"""

# --- business panels --------------------------------------------------------------------------

DATED = "fct_sales f JOIN dim_dates d ON f.date_sk = d.date_sk"
HEATMAP = f"""
SELECT strftime(d.full_date, '%b') AS month, strftime(d.full_date, '%a') AS dow,
  {REVENUE} AS metric FROM {DATED} GROUP BY 1, 2"""
SYNTHETIC = """
SELECT CAST(DATE '2024-01-01' + CAST(rn - 1 AS INTEGER) AS DATE) AS date, total_amount AS metric
FROM (SELECT total_amount, ROW_NUMBER() OVER (
        ORDER BY sales_date, sales_id, product_sk, store_sk, total_amount) AS rn FROM fct_sales) n
WHERE rn <= 365"""
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
MONTH_ROWS = ", ".join(f"('{m}')" for m in MONTHS)
DAY_COLUMNS = ", ".join(
    f"COALESCE(SUM(CASE WHEN h.dow = '{d}' THEN h.metric END), 0.0) AS \"{d}\"" for d in WEEKDAYS
)
MIX = f"""
SELECT p.category, {REVENUE} AS metric
FROM fct_sales f JOIN dim_products p ON f.product_sk = p.product_sk GROUP BY 1"""

ORACLE: dict[str, str] = {
    "fct_sales": with_star("SELECT * FROM fct_sales"),
    "curate_dims": with_star(
        union(*[
            f"SELECT '{d}' AS dim, COUNT(*) AS n, CAST(SUM({FIRST_KEYS[d]}) AS BIGINT) AS keys, "
            f"CAST({' + '.join(f'SUM(LENGTH({c}))' for c in TEXTS[d]) or '0'} AS BIGINT) AS letters "
            f"FROM {d}"
            for d in DIMENSIONS
        ])
    ),
    "ingest_csv_roundtrip": (
        "SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, "
        "o.o_orderpriority, c.c_custkey, c.c_name, CAST(c.c_nationkey AS BIGINT) AS c_nationkey, "
        "c.c_acctbal, c.c_mktsegment, CAST(n.n_nationkey AS BIGINT) AS n_nationkey, n.n_name, "
        "CAST(n.n_regionkey AS BIGINT) AS n_regionkey FROM orders o "
        "JOIN customer c ON o.o_custkey = c.c_custkey "
        "JOIN nation n ON c.c_nationkey = n.n_nationkey"
    ),
    "ingest_summary": with_star(union(*[
        f"SELECT '{raw}.csv' AS file, 'raw.{raw}' AS \"table\", COUNT(*) AS rows, "
        f"CAST({width} AS BIGINT) AS columns FROM {view}"
        for raw, view, width in [
            ("dim_campaigns", "dim_campaigns", 2),
            ("dim_customers", "dim_customers", 4),
            ("dim_dates", "dim_dates", 2),
            ("dim_products", "dim_products", 4),
            ("dim_salespersons", "dim_salespersons", 2),
            ("dim_stores", "dim_stores", 4),
            ("fact_sales_denormalized",
             "(SELECT f.* FROM fct_sales f LEFT JOIN dim_stores s ON f.store_sk = s.store_sk) w", 10),
            ("fact_sales_normalized", "fct_sales", 9),
        ]
    ])),
    "export_parquet_roundtrip": with_star("SELECT * FROM mart_store_daily"),
    "export_csv_roundtrip": with_star("SELECT * FROM mart_campaign_perf"),
    "pipeline_runs": with_star(
        "SELECT '2026-01-01T00:00:00+00:00' AS run_utc, 'build_marts' AS note, "
        "(SELECT COUNT(*) FROM fct_sales) AS n_sales, (SELECT COUNT(*) FROM customer) AS n_customers"
    ),
    "sample_fact_exact": (
        "SELECT * FROM lineitem ORDER BY md5(concat_ws('|', '42', CAST(l_orderkey AS VARCHAR), "
        "CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), "
        "CAST(l_shipdate AS VARCHAR))), l_orderkey, l_partkey, l_suppkey, l_linenumber, "
        "l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate "
        "LIMIT 2000"
    ),
    "mart_store_daily": with_star("SELECT * FROM mart_store_daily"),
    "mart_campaign_perf": with_star("SELECT * FROM mart_campaign_perf"),
    "mart_store_daily_discount": with_star(
        "SELECT CAST(l.l_shipdate AS DATE) AS sales_day, l.l_suppkey AS store_sk, s.store_name, "
        "COUNT(*) AS transactions, ROUND(SUM(l.l_extendedprice * l.l_discount), 4) AS revenue, "
        "ROUND(SUM(l.l_extendedprice * l.l_discount), 4) / COUNT(*) AS avg_order_value "
        "FROM lineitem l LEFT JOIN dim_stores s ON l.l_suppkey = s.store_sk GROUP BY 1, 2, 3"
    ),
    "dq_any_case": with_star(union(
        check("mart.fct_sales__Campaign_SK__not_null",
              count_where("fct_sales", "campaign_sk IS NULL"), "Campaign_SK should never be NULL"),
        check("mart.fct_sales__Sales_ID__unique",
              second_copies("sales_id"), "Sales_ID should be unique in fct_sales"),
        check("mart.fct_sales__CAMPAIGN_SK_fk__references_dim_campaigns.Campaign_sk",
              orphans("campaign_sk", "dim_campaigns"),
              "All CAMPAIGN_SK values in fct_sales should exist in dim_campaigns.Campaign_sk"),
        check("mart.fct_sales__Campaign_SK__not_null",
              count_where("fct_sales", "campaign_sk IS NULL"), "Campaign_SK should never be NULL"),
    )),
    "dq_rowcount_floor": with_star(union(
        floor("mart", "dim_customers"), floor("mart", "fct_sales"),
        floor("analytics", "mart_store_daily"), floor("mart", "dim_campaigns", 4),
    )),
    "dq_not_null": with_star(union(*[required(c) for c in [*REQUIRED, "campaign_sk"]])),
    "dq_unique": with_star(union(unique("sales_id"), unique("campaign_sk"))),
    "dq_fk": with_star(union(*[reference(c, d) for c, d in REFERENCES.items()])),
    "dq_non_negative": with_star(union(
        non_negative("mart", "fct_sales", "total_amount"),
        non_negative("mart", "dim_customers", "balance"),
        non_negative("analytics", "mart_store_daily", "revenue"),
    )),
    "dq_not_future": with_star(NOT_FUTURE),
    "dq_not_absurd": with_star(union(not_absurd(1_000_000), not_absurd(100_000, "_100000"))),
    "dq_campaign_name_not_null": with_star(CAMPAIGN_NAME),
    "dq_suite_declared": with_star("SELECT * FROM declared", declared=DECLARED),
    "dq_suite_summary": with_star(SUITE_TOTALS, declared=DECLARED),
    "dq_results_json": with_star("SELECT * FROM declared", declared=DECLARED),
    "dq_report_rows": with_star(
        "SELECT '2026-01-01T00:00:00+00:00' AS run_utc, 'warehouse' AS db_path, "
        "s.total, s.passed, s.failed, d.* FROM declared d, totals s",
        declared=DECLARED, totals=SUITE_TOTALS,
    ),
    "dq_auto_nulls": with_star(AUTO_NULLS),
    "dq_auto_duplicates": with_star(AUTO_DUPLICATES),
    "dq_auto_fk": with_star(AUTO_FK),
    "dq_suite_auto": with_star(AUTO),
    "dq_run_rollup": over_auto(
        "SELECT '20260101000000000000' AS run_id, run_ts, 'warehouse' AS db_name, "
        f"CAST(COUNT(*) AS INTEGER) AS total_checks, CAST(SUM({FAILED}) AS INTEGER) AS failed_checks, "
        f"{FAILED_ROWS} AS total_failed_rows, {PASS_RATE} AS pass_rate FROM auto GROUP BY run_ts"
    ),
    "dq_history_last_k": with_star(f"{RUNS} ORDER BY y DESC LIMIT 5", yearly=YEARLY),
    "panel_failures_over_time": with_star(
        f"SELECT * FROM ({RUNS} ORDER BY y DESC LIMIT 30) r QUALIFY COUNT(*) OVER () >= 2",
        yearly=YEARLY,
    ),
    "panel_coverage_yearly": with_star(
        "SELECT 'mart.fct_sales' AS \"table\", COUNT(*) AS nulls, CAST(0 AS BIGINT) AS duplicates, "
        "COUNT(*) AS fk_missing, COUNT(*) AS bound FROM yearly HAVING COUNT(*) > 0",
        yearly=YEARLY,
    ),
    "panel_trend_by_day_number": with_star(
        "SELECT CAST(strptime(CAST(d.date_sk AS VARCHAR), '%Y%m%d') AS DATE) AS date, "
        f"{REVENUE} AS metric FROM {DATED} GROUP BY 1"
    ),
    "panel_kpis": over_auto(
        f"SELECT COUNT(*) AS total_checks, CAST(SUM({FAILED}) AS BIGINT) AS failed_checks, "
        f"{FAILED_ROWS} AS total_failed_rows, {PASS_RATE} AS pass_rate, "
        f"printf('%.1f', 100 * {PASS_RATE}) || '%' AS pass_rate_text FROM auto"
    ),
    "panel_status": over_auto('SELECT status, COUNT(*) AS "size" FROM auto GROUP BY 1'),
    "panel_by_type": over_auto(
        'SELECT check_type, status, COUNT(*) AS "size" FROM auto GROUP BY 1, 2'
    ),
    "panel_coverage": over_auto(
        'SELECT "table", '
        + ", ".join(
            f"CAST(SUM(CASE WHEN check_type = '{k}' THEN 1 ELSE 0 END) AS BIGINT) AS {k}"
            for k in ["nulls", "duplicates", "fk_missing"]
        )
        + ' FROM auto GROUP BY 1 ORDER BY COUNT(*) DESC, "table" LIMIT 12'
    ),
    "panel_top_failures": over_auto(
        'SELECT dq_check_name, check_type, "table", "column", failed_rows FROM auto '
        "WHERE status = 'FAIL' ORDER BY failed_rows DESC, dq_check_name LIMIT 25"
    ),
    "panel_detail": over_auto(
        'SELECT status, check_type, "table", "column", failed_rows, dq_check_name FROM auto '
        "ORDER BY status, failed_rows DESC, dq_check_name LIMIT 60"
    ),
    "panel_trend": with_star(
        f"SELECT d.full_date AS date, {REVENUE} AS metric FROM {DATED} GROUP BY 1 ORDER BY 1"
    ),
    "panel_heatmap": with_star(HEATMAP),
    "panel_heatmap_pivot": with_star(
        f"SELECT m.month, {DAY_COLUMNS} FROM (VALUES {MONTH_ROWS}) m(month) "
        "LEFT JOIN heatmap h ON m.month = h.month GROUP BY 1",
        heatmap=HEATMAP,
    ),
    "panel_trend_synth": with_star(SYNTHETIC),
    "panel_heatmap_synth": with_star(
        "SELECT strftime(date, '%b') AS month, strftime(date, '%a') AS dow, "
        "CAST(SUM(CAST(metric AS DECIMAL(18,2))) AS DOUBLE) AS metric FROM synth GROUP BY 1, 2",
        synth=SYNTHETIC,
    ),
    "panel_top_stores": with_star(
        f"SELECT s.store_name AS store, {REVENUE} AS metric FROM fct_sales f "
        "JOIN dim_stores s ON f.store_sk = s.store_sk GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"
    ),
    "panel_rev_mix": with_star(f"SELECT * FROM ({MIX}) m ORDER BY metric DESC, category"),
    "panel_rev_mix_top": with_star(
        f"SELECT * FROM ({MIX}) m WHERE metric > 0 ORDER BY metric DESC, category LIMIT 12"
    ),
    "panel_campaign_perf": with_star(
        f"SELECT c.campaign_name AS campaign, CAST(COUNT(*) AS DOUBLE) AS transactions, "
        f"{AVERAGE} AS avg_order_value, {REVENUE} AS revenue FROM fct_sales f "
        "JOIN dim_campaigns c ON f.campaign_sk = c.campaign_sk GROUP BY 1 "
        "ORDER BY 4 DESC, 1 LIMIT 40"
    ),
}

ORACLE["dq_fk_stored_keys"] = with_star(" UNION ALL ".join(
    f"SELECT '{column}' AS column_name, COUNT(DISTINCT f.{column}) AS keys, "
    f"COUNT(DISTINCT CASE WHEN d.{column} IS NULL THEN f.{column} END) AS orphan_keys, "
    f"COUNT(CASE WHEN d.{column} IS NULL THEN f.{column} END) AS failed_rows "
    f"FROM fct_sales f LEFT JOIN (SELECT DISTINCT {column} FROM {dim}) d ON f.{column} = d.{column}"
    for column, dim in REFERENCES.items()
))

# Stored monthly totals give what the whole fact gives.
ORACLE |= {
    "mart_store_daily_monthly": ORACLE["mart_store_daily"],
    "mart_campaign_perf_monthly": ORACLE["mart_campaign_perf"],
    "panel_trend_monthly": ORACLE["panel_trend"],
}

"""The whole pipeline over CSV files, twice."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starmill.__main__ import arguments, fit_to_input, main, schemas
from starmill.plans import history
from starmill.plans.pipeline import Warehouse, make_sample, run_all, run_declared_checks
from starmill.sources.csv_ingest import MANIFEST, read_csv
from starmill.sources.exports import export_all_csv, export_csv
from starmill.sources.files import size
from tests.star_fixture import small_star

FIRST, SECOND = datetime(2024, 6, 1, 1, 2, 3), datetime(2024, 6, 2, 1, 2, 3)


@pytest.fixture(scope="module")
def csv_folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("csv"))
    star = small_star(spark)
    fact = star.pop("fct_sales")
    dates = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-12-31')) AS full_date")
    star["dim_dates"] = dates.select("full_date", F.dayofyear("full_date").alias("date_sk"))
    star["fact_sales_normalized"] = fact
    star["fact_sales_denormalized"] = fact.join(star["dim_stores"], "store_sk", "left")
    export_all_csv(star, folder)
    return folder


def test_two_runs(spark, csv_folder, tmp_path) -> None:
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    exports = str(tmp_path / "artifacts")
    sources = [str(tmp_path / "full-data-is-absent"), csv_folder]
    run_all(warehouse, sources, FIRST, export_to=exports)
    panels = run_all(warehouse, sources, SECOND)

    assert set(warehouse.raw.names()) >= {"fact_sales_normalized", "fact_sales_denormalized"}
    assert warehouse.mart.read("fct_sales").count() == 600
    assert warehouse.mart.read("pipeline_runs").count() == 2
    assert warehouse.analytics.names() == ["mart_campaign_perf", "mart_store_daily"]
    assert spark.read.option("header", True).csv(f"{exports}/fct_sales.csv").count() == 600
    assert spark.read.parquet(f"{exports}/mart_store_daily.parquet").count() > 0

    runs = history.read_runs(warehouse.history).orderBy("run_ts").collect()
    assert [r.run_ts for r in runs] == [FIRST, SECOND]
    assert {name: df.count() > 0 for name, df in panels.items()} == dict.fromkeys(
        ["trend", "heatmap", "heatmap_matrix", "top_stores", "rev_mix", "rev_mix_top",
         "campaign_perf", "kpis", "status", "by_type", "coverage", "top_failures",
         "failures_over_time", "detail"], True)
    [kpis] = panels["kpis"].collect()
    assert (kpis.total_checks, kpis.failed_checks) == (runs[1].total_checks, runs[1].failed_checks)

    report = run_declared_checks(warehouse, SECOND, as_of=datetime(2024, 1, 30)).collect()
    assert len(report) == 21 == report[0].total
    assert report[0].passed + report[0].failed == 21
    [ingest] = spark.read.json(warehouse.report("ingest_summary")).collect()
    assert len(ingest.tables) == 8 and ingest.raw_dir == csv_folder


def test_sample_keeps_dimensions_and_cuts_facts(spark, csv_folder, tmp_path) -> None:
    target = str(tmp_path / "sample")
    make_sample(spark, csv_folder, target, n=100)
    whole = {n: read_csv(spark, f"{csv_folder}/{n}").count() for n in MANIFEST}
    cut = {n: read_csv(spark, f"{target}/{n}").count() for n in MANIFEST}
    for name in MANIFEST:
        assert cut[name] == (100 if name.startswith("fact_") else whole[name])
    again = str(tmp_path / "again")
    make_sample(spark, csv_folder, again, n=100)
    first, second = (read_csv(spark, f"{f}/fact_sales_normalized.csv") for f in (target, again))
    assert first.exceptAll(second).count() == 0
    assert first.exceptAll(read_csv(spark, f"{csv_folder}/fact_sales_normalized.csv")).count() == 0


def test_command_line_of_a_growing_fact(spark, tmp_path, monkeypatch, capsys) -> None:
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    star = small_star(spark)
    warehouse.mart.replace_all({t: star[t] for t in ("dim_stores", "dim_campaigns", "fct_sales")})
    export_csv(star["fct_sales"].limit(10), str(tmp_path / "new.csv"))
    monkeypatch.setattr("starmill.__main__.build_session", lambda: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    given = ["starmill", "--warehouse", warehouse.root, "--source", str(tmp_path / "new.csv"), "--scale", "2"]
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    for stages, said in ((["append", "refresh"], "2024-01, 2024-02"), (["refresh"], "none")):
        monkeypatch.setattr("sys.argv", [*given, *[x for stage in stages for x in ("--stage", stage)]])
        main()
        assert f"months rebuilt: {said}" in capsys.readouterr().out
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert warehouse.mart.read("fct_sales").count() == 610
    daily = spark.read.parquet(warehouse.report("marts/mart_store_daily"))
    assert daily.agg(F.sum("transactions")).first()[0] == 610


def test_command_line_sizes_partitions_by_the_input(spark, tmp_path) -> None:
    (tmp_path / "big.csv").write_bytes(b"x" * 1000)
    assert size(spark, str(tmp_path)) == 1000 and size(spark, str(tmp_path / "absent")) == 0
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        fit_to_input(spark, [str(tmp_path), str(tmp_path / "absent")])
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    args = arguments(["--warehouse", "w", "--schema", "fact_a=k bigint, v double", "--scale", "2"])
    assert schemas(args.schema)["fact_a"].names == ["k", "v"] and args.scale == 2

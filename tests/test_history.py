from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

import pytest

from starmill.plans import history, pipeline
from starmill.plans.discovered import discovered_suite
from starmill.sources.layers import Layer

FIRST, SECOND = datetime(2024, 1, 1, 0, 0, 0, 5), datetime(2024, 1, 2)


def suite(spark, run_ts: datetime, values: list):
    mart = {"dim_a": spark.createDataFrame([(v,) for v in values], "a_sk bigint")}
    return discovered_suite(mart, run_ts)


def test_append_is_keyed_by_run(spark, tmp_path) -> None:
    main = Layer(spark, str(tmp_path), "main")
    history.append_runs(main, suite(spark, FIRST, [1, 1, None]), "db")
    assert history.failures_over_time(history.read_runs(main)).count() == 0
    history.append_runs(main, suite(spark, FIRST, [1]), "db")
    history.append_runs(main, suite(spark, SECOND, [1]), "db")
    runs = {r.run_id: r for r in history.read_runs(main).collect()}
    assert set(runs) == {"20240101000000000005", "20240102000000000000"}
    first = runs["20240101000000000005"]
    assert (first.total_checks, first.failed_checks, first.total_failed_rows) == (2, 2, 2)
    assert history.read_checks(main).count() == 4
    shown = history.failures_over_time(history.read_runs(main)).collect()
    assert [r.run_ts for r in shown] == [FIRST, SECOND]


def test_attempts_that_were_not_committed_are_not_read(spark, tmp_path, monkeypatch) -> None:
    """A writer that stops after its tables, before its commit, leaves nothing that is read."""
    main = Layer(spark, str(tmp_path), "main")

    def stops(*_: object) -> bool:
        raise OSError("stopped")

    with monkeypatch.context() as stopped:
        stopped.setattr(history, "create_once", stops)
        with pytest.raises(OSError, match="stopped"):
            history.append_runs(main, suite(spark, FIRST, [1, 1]), "db")
    assert history.read_checks(main).count() == history.read_runs(main).count() == 0
    history.append_runs(main, suite(spark, FIRST, [1]), "db")
    assert history.read_checks(main).count() == 2
    assert [r.failed_checks for r in history.read_runs(main).collect()] == [0]


def test_latest_runs_are_ascending(spark) -> None:
    rows = [(f"r{i}", datetime(2024, 1, i), "db", 3, i, 10 * i) for i in range(1, 8)]
    runs = spark.createDataFrame(rows, history.RUNS_SCHEMA)
    assert [r.failed_checks for r in history.latest_runs(runs, 3).collect()] == [5, 6, 7]


def test_kpis_without_checks(spark) -> None:
    none = suite(spark, FIRST, [1]).where("false")
    row = history.kpis(none).collect()[0]
    assert (row.total_checks, row.failed_checks, row.total_failed_rows) == (0, 0, 0)
    assert (row.pass_rate, row.pass_rate_text) == (1.0, "100.0%")


def test_run_log_appends(spark, tmp_path) -> None:
    mart = Layer(spark, str(tmp_path), "mart")
    history.log_pipeline_run(mart, FIRST, "build_marts")
    history.log_pipeline_run(mart, SECOND, "build_marts")
    assert sorted(r.run_utc for r in mart.read("pipeline_runs").collect()) == [
        "2024-01-01T00:00:00+00:00",
        "2024-01-02T00:00:00+00:00",
    ]


def test_absent_history_is_empty(spark, tmp_path) -> None:
    fresh = Layer(spark, str(tmp_path), "main")
    assert history.read_runs(fresh).columns == [
        "run_id", "run_ts", "db_name", "total_checks", "failed_checks", "total_failed_rows"
    ]
    assert history.read_runs(fresh).count() == history.read_checks(fresh).count() == 0
    assert history.failures_over_time(history.read_runs(fresh)).count() == 0


def test_two_writers_of_a_run_leave_details_and_row_of_one(spark, tmp_path, monkeypatch) -> None:
    """Both saw no such run and wrote both tables; whichever commits first is the run."""
    main = Layer(spark, str(tmp_path), "main")
    create, nested = history.create_once, []

    def forestalled(spark_, path: str, text: str) -> bool:
        if not nested:
            nested.append(path)
            history.append_runs(main, suite(spark, FIRST, [1, 1, None]), "fast")
        return create(spark_, path, text)

    monkeypatch.setattr(history, "create_once", forestalled)
    history.append_runs(main, suite(spark, FIRST, [1]), "slow")
    [run] = history.read_runs(main).collect()
    details = history.read_checks(main).collect()
    assert (run.run_id, run.db_name, run.total_checks, run.failed_checks) == ("20240101000000000005", "fast", 2, 2)
    assert sorted(d.failed_rows for d in details) == [1, 1]
    # The late writer took its directories away.
    for table in (history.RUNS, history.CHECKS):
        assert len(list((tmp_path / "main" / table).glob("attempt=*/**/*.parquet"))) >= 1
        assert len({p.parts for p in (tmp_path / "main" / table).glob("attempt=*/**/run_id=*")}) == 1


def test_writers_at_once(spark, tmp_path) -> None:
    main = Layer(spark, str(tmp_path), "main")
    suites = {"a": [1], "b": [1, 1], "c": [None]}
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda name: history.append_runs(main, suite(spark, SECOND, suites[name]), name), suites))
    [run] = history.read_runs(main).collect()
    expected = sorted(r.failed_rows for r in suite(spark, SECOND, suites[run.db_name]).collect())
    assert sorted(r.failed_rows for r in history.read_checks(main).collect()) == expected
    assert run.total_checks == len(expected) == 2


def test_several_runs_of_one_call_are_added_one_by_one(spark, tmp_path) -> None:
    main = Layer(spark, str(tmp_path), "main")
    history.append_runs(main, suite(spark, FIRST, [1]), "db")
    both = suite(spark, FIRST, [1, 1]).unionByName(suite(spark, SECOND, [1, 1]))
    history.append_runs(main, both, "later")
    assert {(r.run_ts, r.db_name) for r in history.read_runs(main).collect()} == {(FIRST, "db"), (SECOND, "later")}
    assert history.read_checks(main).count() == 4


def test_zoned_run_returns_its_own_checks(spark, tmp_path) -> None:
    warehouse = pipeline.Warehouse(spark, str(tmp_path))
    warehouse.mart.replace("dim_a", spark.createDataFrame([(1,)], "a_sk bigint"))
    zoned = datetime(2024, 1, 1, 1, 30, tzinfo=timezone(timedelta(hours=5)))
    checks = pipeline.run_discovered_checks(warehouse, zoned, "db")
    assert {(r.run_id, r.run_ts) for r in checks.collect()} == {
        ("20231231203000000000", datetime(2023, 12, 31, 20, 30))
    }
    assert checks.count() == 2

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest

from starmill.sources.csv_ingest import (
    SampledCsv,
    ingest,
    ingest_summary,
    read_csv,
    write_ingest_summary,
)
from starmill.sources.exports import export_all, export_csv
from starmill.sources.layers import Layer, catalog_tables

STORES = 'store_sk,store_name,store_type,opened\n1,"Tea, Coffee",Market ,2024-01-31\n2,"Say ""hi""",,\n'


def write(folder: Path, name: str, text: str) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(folder / name)


def test_csv_types_quotes_and_blanks(spark, tmp_path) -> None:
    df = read_csv(spark, write(tmp_path, "s.csv", STORES))
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "string", "string", "date"]
    first, second = df.orderBy("store_sk").collect()
    assert (first.store_name, first.store_type) == ("Tea, Coffee", "Market ")
    assert (second.store_name, second.store_type, second.opened) == ('Say "hi"', None, None)


def test_timestamps_come_without_a_zone(spark, tmp_path) -> None:
    df = read_csv(spark, write(tmp_path, "t.csv", "at\n2024-01-31 10:20:30\n"))
    assert df.schema["at"].dataType.simpleString() == "timestamp_ntz"
    assert df.collect()[0].at == datetime(2024, 1, 31, 10, 20, 30)


def test_bad_row_raises(spark, tmp_path) -> None:
    path = write(tmp_path, "b.csv", "k,v\n1,2\nx,3\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        read_csv(spark, path, spark.createDataFrame([], "k bigint, v bigint").schema).collect()


def test_types_come_from_the_first_lines_and_every_row_is_checked(spark, tmp_path) -> None:
    text = "k,v,d,at,flag,note\n" + "".join(f'{i},{i}.5,2024-01-0{i},2024-01-01 00:00:0{i},true,"a, b"\n' for i in range(1, 9))
    path = write(tmp_path, "c.csv", text + "9,,,,,\n")
    read = SampledCsv(spark, path, lines=3)
    assert [f.dataType.simpleString() for f in read.schema] == ["bigint", "double", "date", "timestamp_ntz", "boolean", "string"]
    rows = sorted(read.df.collect())
    assert read.misfits() == {} and read.require_fit() is None
    assert rows[0].at == datetime(2024, 1, 1, 0, 0, 1) and rows[0].note == "a, b"
    assert tuple(rows[-1]) == (9, None, None, None, None, None)
    assert rows == sorted(read_csv(spark, path).collect())


def test_late_values_that_do_not_fit_are_named(spark, tmp_path) -> None:
    """The table stays as it was, whatever the file's later rows hold."""
    folder = tmp_path / "in"
    write(folder, "a.csv", "k,d\n1,2024-01-01\n")
    raw = Layer(spark, str(tmp_path), "raw")
    ingest(raw, [str(folder)], ["a.csv"])
    late = "".join(f"{i},2024-01-01\n" for i in range(20)) + "x,2024-01-01\nyy,2024\n"
    write(folder, "a.csv", "k,d\n" + late)
    with pytest.raises(ValueError, match="2 values of k are no bigint, such as 'x'; 1 values of d are no date, such as '2024'"):
        raw.replace("a", (sampled := SampledCsv(spark, str(folder / "a.csv"), lines=5)).df, verify=sampled.require_fit)
    assert raw.read("a").count() == 1
    ingest(raw, [str(folder)], ["a.csv"], {"a": spark.createDataFrame([], "k string, d string").schema})
    assert raw.read("a").count() == 22


def test_file_is_scanned_once(spark, tmp_path) -> None:
    """Inference looks at the first lines only; the rows are read by the pass that writes them."""
    lines = 30_000
    path = write(tmp_path, "big.csv", "k,v\n" + "".join(f"{i},{i}\n" for i in range(lines)))
    tracker, before = spark.sparkContext.statusTracker(), None
    spark.sparkContext.setJobGroup("ingest", "one file")
    sampled = SampledCsv(spark, path, lines=100)
    before = len(tracker.getJobIdsForGroup("ingest"))
    Layer(spark, str(tmp_path), "raw").replace("big", sampled.df, verify=sampled.require_fit)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert before <= 6 and len(tracker.getJobIdsForGroup("ingest")) == before + 1


def test_file_without_rows_or_with_empty_columns(spark, tmp_path) -> None:
    none = SampledCsv(spark, write(tmp_path, "n.csv", "a,b\n"))
    assert none.df.collect() == [] and none.df.columns == ["a", "b"]
    empty = SampledCsv(spark, write(tmp_path, "e.csv", "a,b\n1,\n2,\n"))
    assert [f.dataType.simpleString() for f in empty.schema] == ["bigint", "string"]


def test_missing_files_are_all_named_before_any_load(spark, tmp_path) -> None:
    write(tmp_path / "in", "a.csv", "k\n1\n")
    raw = Layer(spark, str(tmp_path), "raw")
    with pytest.raises(FileNotFoundError, match="(?s)b.csv.*c.csv"):
        ingest(raw, [str(tmp_path / "in")], ["a.csv", "b.csv", "c.csv"])
    assert raw.names() == []


def test_first_existing_source_wins(spark, tmp_path) -> None:
    write(tmp_path / "sample", "a.csv", "k\n1\n2\n")
    raw = Layer(spark, str(tmp_path), "raw")
    sources = [str(tmp_path / "full"), str(tmp_path / "sample")]
    assert ingest(raw, sources, ["a.csv"]) == sources[1]
    write(tmp_path / "full", "a.csv", "k,j\n1,1\n")
    assert ingest(raw, sources, ["a.csv"]) == sources[0]
    [row] = ingest_summary(raw, ["a.csv"]).collect()
    assert tuple(row) == ("a.csv", "raw.a", 1, 2)
    with pytest.raises(FileNotFoundError):
        ingest(raw, [str(tmp_path / "nowhere")], ["a.csv"])


def test_summary_document(spark, tmp_path) -> None:
    write(tmp_path / "in", "a.csv", "k\n1\n2\n")
    raw = Layer(spark, str(tmp_path), "raw")
    ingest(raw, [str(tmp_path / "in")], ["a.csv"])
    path = str(tmp_path / "summary")
    write_ingest_summary(ingest_summary(raw, ["a.csv"]), path, datetime(2024, 1, 1), "in", "db")
    [row] = spark.read.json(path).collect()
    assert row.run_utc == "2024-01-01T00:00:00+00:00"
    assert [(t.file, t.table, t.rows, t["columns"]) for t in row.tables] == [("a.csv", "raw.a", 2, 1)]


def test_replace_rebuilds_also_from_the_table_itself(spark, tmp_path) -> None:
    layer = Layer(spark, str(tmp_path), "mart")
    layer.replace("t", spark.range(5).toDF("k"))
    layer.replace("t", spark.range(3).toDF("j"))
    assert (layer.read("t").columns, layer.read("t").count()) == (["j"], 3)
    layer.replace("t", layer.read("t").where("j > 0"))
    assert layer.read("t").count() == 2
    assert layer.names() == ["t"]


def test_failed_rebuild_keeps_the_old_table(spark, tmp_path) -> None:
    layer = Layer(spark, str(tmp_path), "mart")
    layer.replace("t", spark.range(5).toDF("k"))
    with pytest.raises(Exception, match="no good"):
        layer.replace("t", spark.range(1).selectExpr("CAST(raise_error('no good') AS int) AS k"))
    assert layer.read("t").count() == 5
    assert layer.names() == ["t"]


def test_first_error_of_side_by_side_writes_is_raised(spark, tmp_path) -> None:
    layer = Layer(spark, str(tmp_path), "mart")
    bad = spark.range(1).selectExpr("raise_error('no good') AS k")
    with pytest.raises(Exception, match="no good"):
        layer.replace_all({"good": spark.range(2).toDF("k"), "bad": bad.selectExpr("CAST(k AS int) k")})
    assert layer.read("good").count() == 2


def test_exports_in_both_formats(spark, tmp_path) -> None:
    df = spark.createDataFrame(
        [(1, 'a "quoted", text', None), (2, None, datetime(2024, 1, 2, 3, 4, 5))],
        "k bigint, t string, at timestamp_ntz",
    )
    export_all({"t": df}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "t.parquet")).orderBy("k").collect() == df.collect()
    assert read_csv(spark, str(tmp_path / "t.csv"), df.schema).orderBy("k").collect() == df.collect()
    text = "".join(p.read_text() for p in sorted((tmp_path / "t.csv").glob("part-*.csv")))
    assert text.startswith("k,t,at\n")


def test_header_is_checked_against_a_given_schema(spark, tmp_path) -> None:
    export_csv(spark.createDataFrame([(1, 2)], "a int, b int"), str(tmp_path / "x.csv"))
    swapped = spark.createDataFrame([], "b int, a int").schema
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "x.csv"), swapped).collect()


def test_catalog_layer(spark, tmp_path) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shop LOCATION '{tmp_path}/shop'")
    spark.range(2).write.mode("overwrite").saveAsTable("shop.dim_b")
    spark.range(3).write.mode("overwrite").saveAsTable("shop.dim_a")
    spark.range(1).createOrReplaceTempView("passing")
    tables = catalog_tables(spark, "shop")
    assert {name: df.count() for name, df in tables.items()} == {"dim_a": 3, "dim_b": 2}
    assert list(tables) == ["dim_a", "dim_b"]
    spark.sql("DROP DATABASE shop CASCADE")


def test_unfinished_first_build_is_no_table(spark, tmp_path) -> None:
    layer = Layer(spark, str(tmp_path), "mart")
    with pytest.raises(Exception, match="no good"):
        layer.replace("t", spark.range(1).selectExpr("CAST(raise_error('no good') AS int) AS k"))
    assert not layer.exists("t") and layer.names() == []

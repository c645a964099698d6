"""Tables that are read while they are rebuilt, and commits of several writers."""

from __future__ import annotations

import json
import os
import threading
import time
from pathlib import Path

import pytest

from starmill.sources import commits
from starmill.sources.commits import CommitLog, create_once, rename_once
from starmill.sources.files import read_text, write_text
from starmill.sources.layers import Layer


def data_of(folder: Path) -> set[str]:
    return {p.name for p in folder.glob("data-*")}


def test_reader_never_misses_a_table_that_is_replaced(spark, tmp_path) -> None:
    """Every read finds one whole version: as many rows as each of them names."""
    layer = Layer(spark, str(tmp_path), "mart")

    def version(n: int):
        return spark.range(n).selectExpr("id", f"{n}L AS n")

    layer.replace("t", version(1))
    seen, failed, done = [], [], threading.Event()

    def read() -> None:
        other = Layer(spark, str(tmp_path), "mart")
        while not done.is_set():
            try:
                assert other.exists("t") and other.names() == ["t"]
                rows = other.read("t").collect()
                assert {r.n for r in rows} == {len(rows)}
                seen.append(len(rows))
            except Exception as error:  # noqa: BLE001
                failed.append(error)
                return

    readers = [threading.Thread(target=read) for _ in range(2)]
    for reader in readers:
        reader.start()
    for n in range(2, 22):
        layer.replace("t", version(n))
    done.set()
    for reader in readers:
        reader.join()
    assert not failed and seen == sorted(seen) or len(set(seen)) > 1
    assert not failed and layer.read("t").count() == 21


def test_replaced_data_goes_when_no_reader_can_need_it(spark, tmp_path) -> None:
    folder = tmp_path / "mart/_tables/t"
    layer = Layer(spark, str(tmp_path), "mart", retained=3600)
    old = layer.replace("t", spark.range(5))
    layer.replace("t", spark.range(3))
    assert len(data_of(folder)) == 2 and old.count() == 5
    # Both commits were made long ago: the first one's data is needed by nobody.
    for commit in (folder / "commits").iterdir():
        os.utime(commit, (time.time() - 7200,) * 2)
    (folder / "data-failed").mkdir()
    layer.replace("t", spark.range(2))
    assert layer.read("t").count() == 2
    assert len(data_of(folder) - {"data-failed"}) == 2 and (folder / "data-failed").exists()
    os.utime(folder / "data-failed", (time.time() - 8 * 3600,) * 2)
    layer.sweep("t")
    assert not (folder / "data-failed").exists() and layer.read("t").count() == 2


def test_table_may_be_rebuilt_from_itself_and_by_partitions(spark, tmp_path) -> None:
    layer = Layer(spark, str(tmp_path), "mart", retained=0)
    layer.replace("t", spark.range(6).selectExpr("id", "id % 2 AS part"), ["part"])
    layer.replace("t", layer.read("t").where("part = 1"), ["part"])
    assert sorted(r.id for r in layer.read("t").collect()) == [1, 3, 5]


def test_writers_that_append_at_once_add_all_their_rows(spark, tmp_path) -> None:
    layer = Layer(spark, str(tmp_path), "mart")
    writers = [threading.Thread(target=layer.append, args=("log", spark.range(i, i + 1))) for i in range(6)]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    assert sorted(r.id for r in layer.read("log").collect()) == list(range(6))


def test_last_of_two_replacements_counts(spark, tmp_path, monkeypatch) -> None:
    """A commit that another writer forestalls follows that one's."""
    layer = Layer(spark, str(tmp_path), "mart")
    layer.replace("t", spark.range(1))
    create, met = commits.create_once, []

    def late(spark_, path: str, text: str) -> bool:
        if not met:
            met.append(path)
            assert create(spark_, path, json.dumps(["data-of-another"]))
        return create(spark_, path, text)

    monkeypatch.setattr(commits, "create_once", late)
    layer.replace("t", spark.range(4))
    assert layer.read("t").count() == 4
    assert CommitLog(spark, f"{tmp_path}/mart/_tables/t/commits").numbers() == [1, 2, 3]


def test_plain_tables_are_read_appended_to_and_replaced(spark, tmp_path) -> None:
    layer = Layer(spark, str(tmp_path), "mart")
    spark.range(2).write.parquet(layer.path("t"))
    assert layer.names() == ["t"] and layer.exists("t")
    layer.append("t", spark.range(3))
    assert layer.read("t").count() == 5
    layer.replace("t", layer.read("t").where("id = 0"))
    assert layer.names() == ["t"] and layer.read("t").count() == 2
    with pytest.raises(FileNotFoundError, match="no table other"):
        layer.read("other")


def test_of_many_writers_of_a_commit_one_wins(spark, tmp_path) -> None:
    path = f"{tmp_path}/log/one"
    won: list[int] = []
    start = threading.Barrier(8)

    def write(i: int) -> None:
        start.wait()
        if create_once(spark, path, f"writer {i}"):
            won.append(i)

    writers = [threading.Thread(target=write, args=(i,)) for i in range(8)]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    assert len(won) == 1 and read_text(spark, path) == f"writer {won[0]}"
    assert os.listdir(tmp_path / "log") == ["one"]


def test_rename_to_a_free_name_only(spark, tmp_path) -> None:
    """The way of file systems without links."""
    for name in ("a", "b"):
        write_text(spark, f"{tmp_path}/{name}", name)
    assert rename_once(spark, f"{tmp_path}/a", f"{tmp_path}/target")
    assert not rename_once(spark, f"{tmp_path}/b", f"{tmp_path}/target")
    assert read_text(spark, f"{tmp_path}/target") == "a"

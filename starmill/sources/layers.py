"""Layers of tables (raw, mart, analytics, history) kept as Parquet.

A table that is replaced or appended to is a folder of data directories and a log of commits. A commit names
the directories that are the table from then on; it is one small file, created whole or not at all. Data is
written before it is committed and never moved, so a reader finds the whole old table or the whole new one, at
any moment and on any store, and a job that stops half-way leaves nothing that is read. Directories that
a later commit no longer names stay for readers that began before it, until they are ``RETAINED`` seconds old.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starmill.session import side_by_side
from starmill.sources.commits import CommitLog
from starmill.sources.files import age_seconds, child_directories, exists, remove

#: How long data and commits stay after a later commit replaced them.
RETAINED = 24 * 3600.0
#: How much longer than that data stays that was never committed: its job may still run.
UNCOMMITTED = 7
#: Committed tables, each with its data directories and its log.
TABLES, LOG = "_tables", "commits"


class Layer:
    """One schema of tables.

    A table is either committed (see above) or a plain Parquet directory ``path`` that something else wrote; a
    committed one of the same name comes first.
    """

    def __init__(self, spark: SparkSession, warehouse: str, name: str, retained: float = RETAINED) -> None:
        self.spark = spark
        self.name = name
        self.root = f"{warehouse.rstrip('/')}/{name}"
        self.retained = retained

    def path(self, table: str) -> str:
        """Where a plain table is."""
        return f"{self.root}/{table}"

    def _folder(self, table: str) -> str:
        return f"{self.root}/{TABLES}/{table}"

    def _log(self, table: str) -> CommitLog:
        return CommitLog(self.spark, f"{self._folder(table)}/{LOG}")

    def paths(self, table: str) -> list[str]:
        """The directories that hold the rows of a table now; none if there is no such table."""
        last = self._log(table).last()
        if last is not None:
            return [f"{self._folder(table)}/{name}" for name in json.loads(last[1])]
        return [self.path(table)] if exists(self.spark, self.path(table)) else []

    def exists(self, table: str) -> bool:
        return bool(self._log(table).numbers()) or exists(self.spark, self.path(table))

    def names(self) -> list[str]:
        committed = child_directories(self.spark, f"{self.root}/{TABLES}")
        plain = child_directories(self.spark, self.root)
        return sorted({*plain, *(name for name in committed if self._log(name).numbers())})

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        found = self.paths(table)
        if not found:
            raise FileNotFoundError(f"no table {table} in {self.root}")
        return self._rows(found, schema)

    def _rows(self, paths: Sequence[str], schema: T.StructType | None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*paths)

    def tables(self) -> dict[str, DataFrame]:
        """All tables of the layer by name, in name order."""
        return {name: self.read(name) for name in self.names()}

    def _written(self, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> str:
        name = f"data-{uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(f"{self._folder(table)}/{name}")
        return name

    def replace(
        self,
        table: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        verify: Callable[[], None] | None = None,
    ) -> DataFrame:
        """Rebuild a table from a query, which may read the table itself; of several writers the last one counts.

        ``verify`` is called when the data is written and may raise, which leaves the table as it was.
        """
        name = self._written(table, df, partition_by)
        if verify is not None:
            verify()
        log = self._log(table)
        while not log.commit_after(max(log.numbers(), default=0), json.dumps([name])):
            pass
        self.sweep(table)
        return self._rows([f"{self._folder(table)}/{name}"], None if partition_by else df.schema)

    def replace_all(self, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Rebuild several independent tables side by side."""
        return side_by_side({t: partial(self.replace, t, df) for t, df in tables.items()})

    def append(self, table: str, df: DataFrame) -> DataFrame:
        """Add rows to a table, all of them or none; of several writers every one adds its rows once."""
        log = self._log(table)
        if not log.numbers() and exists(self.spark, self.path(table)):
            df.write.mode("append").parquet(self.path(table))
            return self.read(table, df.schema)
        name = self._written(table, df)
        while True:
            number, text = log.last() or (0, "[]")
            names = [*json.loads(text), name]
            if log.commit_after(number, json.dumps(names)):
                self.sweep(table)
                return self._rows([f"{self._folder(table)}/{n}" for n in names], df.schema)

    def sweep(self, table: str) -> None:
        """Delete what the last commit does not name and no reader of a recent one can need."""
        log, folder = self._log(table), self._folder(table)
        numbers = log.numbers()

        def age(path: str) -> float:
            return age_seconds(self.spark, path)

        # A commit is needed until its successor is old, and so is the data that it names.
        old = [n for n, later in zip(numbers, numbers[1:]) if age(log.path(later)) > self.retained]
        kept = {name for n in numbers[len(old) :] for name in json.loads(log.text(n))}
        known = {name for n in old for name in json.loads(log.text(n))}
        for name in child_directories(self.spark, folder, "data-"):
            if name in kept:
                continue
            if name in known or age(f"{folder}/{name}") > self.retained * UNCOMMITTED:
                remove(self.spark, f"{folder}/{name}")
        for number in old:
            remove(self.spark, log.path(number))


def catalog_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The base tables of a catalog database by name: the same view of a layer kept in a catalog."""
    found = spark.catalog.listTables(database)
    names = sorted(t.name for t in found if not t.isTemporary and t.tableType != "VIEW")
    return {name: spark.table(f"`{database}`.`{name}`") for name in names}

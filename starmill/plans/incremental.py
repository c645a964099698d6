"""Totals of a growing fact, kept by month and rebuilt only for months whose input files changed.

A refresh lists the fact's files and compares them with the manifest of the last one, which names the months that
each file holds. Files that are new or changed are scanned for their months; months of files that went, changed
or came are affected. Only files that hold an affected month are read, only those months are totalled and
written, and one commit swaps them in together with the new manifest. So a day's new file costs its
months and not the history, and a reader sees the whole state before or after.

What is stored are partial totals by month and key: exact, and added up further by whoever reads them. Names
join when the totals are read, so a changed dimension needs no refresh.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions import schema_rules as rules
from starmill.functions.columns import quoted
from starmill.operators.totals import partial_totals
from starmill.plans import marts
from starmill.session import side_by_side
from starmill.sources.commits import CommitLog
from starmill.sources.files import age_seconds, child_directories, remove
from starmill.sources.layers import RETAINED, UNCOMMITTED

#: The month of rows without a date.
NO_MONTH = "none"
#: More affected files than this, or than half of all, are read as the whole table with a filter.
MOST_FILES = 10_000
MANIFEST = "path string, length bigint, modified timestamp, month string"
SAME = ["path", "length", "modified"]

#: Partial totals of fact rows by month and whatever keys; every month of the rows has some.
Build = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class State:
    """What the last commit names: a manifest, and for each month the directory of its totals."""

    number: int
    manifest: str | None
    months: Mapping[str, str]


def month_of(moment: Column) -> Column:
    return F.coalesce(F.date_format(moment, "yyyy-MM"), F.lit(NO_MONTH))


def _one_slash(path: Column) -> Column:
    """Paths as both the listing and the rows' metadata give them."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")


class MonthlyTotals:
    """Partial totals by month of a Parquet fact, one table for each of ``builds``."""

    def __init__(
        self, spark: SparkSession, folder: str, moment: str, builds: Mapping[str, Build], retained: float = RETAINED
    ) -> None:
        self.spark, self.folder, self.builds, self.retained = spark, folder.rstrip("/"), dict(builds), retained
        self.month = month_of(F.col(moment))
        self.log = CommitLog(spark, f"{self.folder}/commits")

    def state(self) -> State:
        last = self.log.last()
        if last is None:
            return State(0, None, {})
        said = json.loads(last[1])
        return State(last[0], said["manifest"], said["months"])

    def totals(self, name: str) -> DataFrame | None:
        """The stored totals of one build; None before the first refresh of a fact with rows."""
        months = self.state().months
        if not months:
            return None
        return self.spark.read.parquet(*[f"{self.folder}/{held}/{name}/month={m}" for m, held in months.items()])

    def refresh(self, paths: Sequence[str]) -> list[str]:
        """Bring the totals up to the files under ``paths``; returns the months that were rebuilt."""
        while True:
            state = self.state()
            months, committed = self._refresh_after(state, list(paths))
            if committed:
                self.sweep()
                return months

    def _files(self, paths: list[str]) -> DataFrame:
        """(path, length, modified) of the fact's files; their content is not read."""
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(paths)
        return listed.select("path", "length", F.col("modificationTime").alias("modified"))

    def _months_of(self, files: Sequence[str]) -> DataFrame:
        """(path, month) of some files."""
        where = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        rows = self.spark.read.parquet(*files)
        return rows.select(where.alias("path"), self.month.alias("month")).distinct()

    def _refresh_after(self, state: State, paths: list[str]) -> tuple[list[str], bool]:
        spark, attempt = self.spark, f"data-{uuid.uuid4().hex}"
        before = spark.createDataFrame([], MANIFEST)
        if state.manifest:
            before = spark.read.schema(MANIFEST).parquet(f"{self.folder}/{state.manifest}")
        now = self._files(paths)
        new, gone = now.join(before, SAME, "left_anti"), before.join(now, SAME, "left_anti")
        # The files that came since the last refresh; the first one reads the table as a whole.
        came = [row.path for row in new.select("path").collect()] if state.manifest else paths
        affected = {row.month for row in gone.select("month").distinct().collect()}
        manifest = before.join(now, SAME, "left_semi")
        if came:
            held = self._months_of(came).select(_one_slash(F.col("path")).alias("key"), "month")
            keyed = new.withColumn("key", _one_slash(F.col("path")))
            # A file without rows has no month.
            manifest = manifest.unionByName(keyed.join(held, "key", "left").drop("key"))
        manifest.write.parquet(f"{self.folder}/{attempt}/manifest")
        manifest = spark.read.schema(MANIFEST).parquet(f"{self.folder}/{attempt}/manifest")
        arrived = manifest.join(before, SAME, "left_anti").select("month").distinct()
        affected = {month for month in {*affected, *(row.month for row in arrived.collect())} if month is not None}
        if not affected and not came and state.manifest:
            remove(spark, f"{self.folder}/{attempt}")
            return [], True
        held = {month: name for month, name in state.months.items() if month not in affected}
        if affected:
            # None if all files that held these months are gone.
            rows = self._rows(manifest, sorted(affected), paths)
            if rows is not None:
                self._write(rows, attempt)
                name = next(iter(self.builds))
                written = child_directories(spark, f"{self.folder}/{attempt}/{name}", "month=")
                held |= {child.removeprefix("month="): attempt for child in written}
        said = json.dumps({"manifest": f"{attempt}/manifest", "months": held})
        if not self.log.commit_after(state.number, said):
            # Another refresh came first, perhaps of other files.
            remove(spark, f"{self.folder}/{attempt}")
            return [], False
        return sorted(affected), True

    def _rows(self, manifest: DataFrame, months: list[str], paths: list[str]) -> DataFrame | None:
        """The fact's rows of some months, from the files that hold any."""
        files = manifest.where(F.col("month").isin(months)).select("path").distinct()
        n, most = files.count(), min(MOST_FILES, manifest.select("path").distinct().count() // 2)
        if not n:
            return None
        chosen = paths if n > most else [row.path for row in files.collect()]
        return self.spark.read.parquet(*chosen).withColumn("month", self.month).where(F.col("month").isin(months))

    def _write(self, rows: DataFrame, attempt: str) -> None:
        def job(name: str, build: Build) -> Callable[[], None]:
            target = f"{self.folder}/{attempt}/{name}"
            return lambda: build(rows).write.partitionBy("month").parquet(target)

        side_by_side({name: job(name, build) for name, build in self.builds.items()})

    def sweep(self) -> None:
        """Delete directories that neither the last commit names nor a reader of a recent one can need."""
        numbers = self.log.numbers()
        old = [
            n
            for n, later in zip(numbers, numbers[1:])
            if age_seconds(self.spark, self.log.path(later)) > self.retained
        ]

        def named(number: int) -> set[str]:
            said = json.loads(self.log.text(number))
            return {*said["months"].values(), said["manifest"].split("/")[0]}

        kept = set().union(*(named(n) for n in numbers[len(old) :]))
        known = set().union(*(named(n) for n in old))
        for name in child_directories(self.spark, self.folder, "data-"):
            path = f"{self.folder}/{name}"
            if name in kept:
                continue
            if name in known or age_seconds(self.spark, path) > self.retained * UNCOMMITTED:
                remove(self.spark, path)
        for number in old:
            remove(self.spark, self.log.path(number))


def retail_builds(scale: int | None = None) -> dict[str, Build]:
    """What the summary marts and the calendar panels are made of, by month.

    The totals by date key are those of a fact with such a key.
    """
    month = F.col("month")

    def by_date_key(rows: DataFrame) -> DataFrame:
        key = rules.date_key(rows.columns)
        day = quoted(key) if key else F.to_date("sales_date")
        return partial_totals(rows, [month, day.alias("_key")], marts.amount_of(rows, scale))

    return {
        "store_days": lambda rows: marts.store_days(rows, scale, month),
        "campaigns": lambda rows: marts.campaign_totals(rows, scale, month),
        "date_keys": by_date_key,
    }

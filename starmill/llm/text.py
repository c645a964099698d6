"""Column expressions and scratch tables shared by the operators."""

from __future__ import annotations

import io
import math
import string
import uuid
import zipfile
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import starmill
from starmill.session import fresh_path
from starmill.sources.files import remove


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def whole(column: Column | str) -> Column:
    """A text, null counting as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def one_blank(column: Column) -> Column:
    """The words of a text joined by one blank; words are runs of other than blank and 0x09-0x0D."""
    spaced = F.regexp_replace(column, r"[\x20\x09-\x0D]+", " ")
    return F.trim(spaced)


def own(name: str) -> str:
    """A column name that no given table has."""
    return f"_{name}_{uuid.uuid4().hex[:8]}"


#: Whether a query's shuffle files are removed when it ends.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once for each application, by way of the shared folder."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(starmill.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    path = f"{fresh_path(spark, 'package', scoped=False)}/starmill.zip"
    target: Any = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(packed.getvalue()))
    stream.close()
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


class Scratch:
    """Tables written to the shared folder, each readable by every executor.

    A written table ends the lineage, so a lost executor costs the tasks of the running job only.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        ship(spark)
        self.spark, self.base, self._n = spark, fresh_path(spark, label), 0

    def path(self) -> str:
        self._n += 1
        return f"{self.base}/{self._n:03d}"

    def keep(self, df: DataFrame) -> DataFrame:
        path = self.path()
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_only(self, df: DataFrame) -> DataFrame:
        """``keep``, and what was shuffled for it goes at once, not when the driver collects its garbage."""
        before = self.spark.conf.get(SHUFFLES_END, None)
        self.spark.conf.set(SHUFFLES_END, "true")
        try:
            return self.keep(df)
        finally:
            if before is None:
                self.spark.conf.unset(SHUFFLES_END)
            else:
                self.spark.conf.set(SHUFFLES_END, before)

    def clear(self) -> None:
        """Remove the tables, once nothing reads them any more."""
        remove(self.spark, self.base)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts, to size partitions by."""
    return docs.agg(F.sum(F.octet_length(column))).first()[0] or 0


def partitions_for(spark: SparkSession, amount: int, per_partition: int) -> int:
    """Enough partitions for ``amount``, and as many as the session's shuffles have at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(amount / per_partition))

"""Profiles of keys kept in buckets, so that keys of facts and dimensions meet without a shuffle.

A profile has one row for each key with the number of its rows: a key that a third of a fact's rows share is one
row here. It is stored by the hash of the key, as many files as buckets, each sorted. Two profiles of
as many buckets are joined bucket by bucket: neither side is moved again, however many checks are run. New rows
of a fact are profiled alone and added as further files of the buckets.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.columns import quoted
from starmill.sources.files import exists, read_text, write_text

#: Buckets of all profiles that meet; one holds some ten million keys at a trillion rows.
BUCKETS = 64


class KeyProfile:
    """(key, n) of one column, stored in buckets under a path; the path holds all that reading it needs."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._about = f"{self.path}-buckets.json"
        # The session's catalog knows bucketed files by a table's name only.
        self.name = f"key_profile_{hashlib.sha256(self.path.encode()).hexdigest()[:24]}"

    def add(self, rows: DataFrame, column: str, kind: T.DataType = T.LongType(), buckets: int = BUCKETS) -> None:
        """Profile a column of some rows and add it to what is stored; null is no key."""
        if exists(self.spark, self._about):
            said = json.loads(read_text(self.spark, self._about))
            if (said["kind"], said["buckets"]) != (kind.simpleString(), buckets):
                raise ValueError(f"{self.path} holds {said['kind']} keys in {said['buckets']} buckets")
            self._register(said)
        key = quoted(column).cast(kind).alias("key")
        counted = rows.select(key).where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n"))
        # Partitioned as the buckets are: every task writes one file.
        dealt = counted.repartition(buckets, "key")
        writer = dealt.write.format("parquet").bucketBy(buckets, "key").sortBy("key")
        writer.option("path", self.path).mode("append").saveAsTable(self.name)
        write_text(self.spark, self._about, json.dumps({"kind": kind.simpleString(), "buckets": buckets}))

    def _register(self, said: dict) -> None:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{self.name}` (key {said['kind']}, n bigint) USING parquet "
            f"CLUSTERED BY (key) SORTED BY (key) INTO {said['buckets']} BUCKETS LOCATION '{self.path}'"
        )

    def read(self) -> DataFrame:
        """(key, n), one row for each key: added up within the buckets."""
        self._register(json.loads(read_text(self.spark, self._about)))
        return self.spark.table(self.name).groupBy("key").agg(F.sum("n").alias("n"))


def orphans(fact: KeyProfile, dimension: KeyProfile) -> DataFrame:
    """One row: keys, orphan_keys and failed_rows of a fact's column without a parent in a dimension's.

    Only the counts of each bucket are shuffled.
    """
    keys, parents = fact.read(), dimension.read().select(F.col("key").alias("parent"))
    met = keys.join(parents.hint("merge"), F.col("key") == F.col("parent"), "left")
    orphan = F.col("parent").isNull()
    return met.agg(
        F.count("*").alias("keys"),
        F.count_if(orphan).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("failed_rows"),
    )

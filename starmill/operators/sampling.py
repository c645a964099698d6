"""A reproducible sample of an exact size, without replacement."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from starmill.functions.columns import quoted
from starmill.sources.scratch import written_once

HASH_DIGITS = 12


def exact_sample(
    df: DataFrame, n: int, keys: Sequence[str], seed: int = 42, oversample: float = 1.2
) -> DataFrame:
    """min(n, rows) rows: those with the smallest md5 of seed and keys, ties by the whole row.

    Every task of a plain ``orderBy(hash).limit(n)`` sends n rows to one last task, which then reads
    n rows for each input split. The hash is uniform, so a cut a little above n / rows leaves about
    n candidates for the whole table. They are written once to the shared folder; should they be
    fewer than n, the cut is raised and the pass repeated, so the size is exact in any case. Copies
    of one row share a hash and are kept as one row with a count, however many there are.
    """
    rows = df.agg(F.count("*")).first()[0]
    wanted = min(n, rows)
    ticket = F.md5(F.concat_ws("|", F.lit(str(seed)), *[quoted(k).cast("string") for k in keys]))
    hashed = df.withColumn("_ticket", ticket)
    share = min(1.0, (oversample * n + 100) / max(rows, 1))
    while True:
        candidates = hashed
        if share < 1.0:
            cut = format(math.ceil(share * 16**HASH_DIGITS), f"0{HASH_DIGITS}x")
            candidates = hashed.where(F.col("_ticket") < cut)
        counted = candidates.groupBy("_ticket", *[quoted(c) for c in df.columns]).agg(
            F.count("*").alias("_copies")
        )
        stored = written_once(counted, "sample-candidates")
        found = stored.agg(F.coalesce(F.sum("_copies"), F.lit(0))).first()[0]
        if found >= wanted or share >= 1.0:
            break
        share = min(1.0, share * 4)

    order = ["_ticket", *[quoted(c) for c in df.columns]]
    # At most n distinct rows: the running count needs no partitioning.
    smallest = stored.orderBy(*order).limit(n)
    before = F.sum("_copies").over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    taken = smallest.withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") < n)
    copies = F.least(F.col("_copies"), F.lit(n) - F.col("_before")).cast("int")
    return taken.select(
        *[quoted(c) for c in df.columns], F.explode(F.array_repeat(F.lit(1), copies)).alias("_copy")
    ).drop("_copy")

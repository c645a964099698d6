"""Connected components of a graph of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starmill.llm.text import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node that ``links`` (a, b) name; the root is the component's least node.

    Each round points every larger neighbour of a node at its least one (large star), then a node and its
    smaller neighbours at the least of them (small star), until nothing changes: a few rounds, each an
    aggregation combined before its shuffle and a join. Links stay distributed; rounds are written.
    """
    edges, mark = _kept(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), scratch)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b"))
        )
        after, after_mark = _kept(small, scratch)
        if mark == after_mark:
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        edges, mark = after, after_mark


def _kept(edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, tuple]:
    """The distinct edges, stored, and what tells them from others: their number and a sum of hashes.

    The sum is taken as they are written, so a round is one job.
    """
    found = Observation()
    hashed = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    distinct = edges.where("a <> b").distinct()
    stored = scratch.keep(distinct.observe(found, F.count("*").alias("n"), hashed.alias("s")))
    return stored, (found.get["n"], found.get["s"])


def with_links(roots: DataFrame | None, links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) after more links: those of earlier ones (None: none yet) carried on.

    Only the new links are contracted, between the roots they join, which is a small graph.
    """
    if roots is None:
        return components(links, scratch)
    if links.isEmpty():
        return roots
    ends = roots.select(F.col("node").alias("held"), F.col("root").alias("top"))
    for end in ("a", "b"):
        links = links.join(ends, F.col(end) == F.col("held"), "left")
        links = links.withColumn(end, F.coalesce("top", end)).drop("held", "top")
    joined = scratch.keep(components(links, scratch))
    moved = joined.select(F.col("node").alias("old"), F.col("root").alias("new"))
    carried = roots.join(moved, F.col("root") == F.col("old"), "left")
    carried = carried.select("node", F.coalesce("new", "root").alias("root"))
    return scratch.keep(carried.unionByName(joined.join(roots.select("node"), "node", "left_anti")))

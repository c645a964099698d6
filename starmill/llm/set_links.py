"""Links between sets of tokens: the measure, verification of pairs, and blocks of sets compared as a whole."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Nodes of a block, and tokens that are compared at once.
BLOCK = 48
TOKENS_AT_ONCE = 4096


@dataclass(frozen=True)
class Similarity:
    """Sets link when 100 * intersection >= percent * union."""

    words: int = 5
    percent: int = 75

    def needed(self, size: int) -> int:
        return -(-self.percent * size // 100)


def block_links(entries: DataFrame, nodes: DataFrame, similarity: Similarity) -> DataFrame:
    """Links between the components that meet in entries, by comparing blocks of their nodes.

    ``entries`` are (entry, node, root), ``nodes`` (node, n, tokens); nodes and roots are of one type, which
    the links (a, b) have too.
    """
    kind = nodes.schema["node"].dataType
    shape, arrow = f"a {kind.simpleString()}, b {kind.simpleString()}", to_arrow_type(kind)
    sizes = entries.groupBy("entry").agg(F.count("*").alias("size"))
    # Nodes that meet in many entries have their largest entry in common, mostly.
    hub = F.max(F.struct("size", F.col("entry").alias("hub"))).alias("h")
    placed = entries.join(sizes, "entry").groupBy("node", "root").agg(hub)
    placed = placed.select("node", "root", F.col("h.hub").alias("hub"))
    large = (
        placed.groupBy("hub", "root")
        .agg(F.count("*").alias("members"))
        .where(F.col("members") >= BLOCK)
        .select(F.col("hub").alias("large_hub"), F.col("root").alias("large_root"), "members")
    )
    strays = (
        placed.groupBy("hub", "root")
        .agg(F.count("*").alias("members"))
        .where(F.col("members") < BLOCK)
        .groupBy(F.col("hub").alias("stray_hub"))
        .agg(F.sum("members").alias("stray_members"))
    )
    dealt = (
        placed.join(large, (F.col("hub") == F.col("large_hub")) & (F.col("root") == F.col("large_root")), "left")
        .join(strays, F.col("hub") == F.col("stray_hub"), "left")
        .withColumn("parts", F.ceil(F.coalesce("members", "stray_members") / BLOCK))
    )
    share = F.pmod(F.xxhash64("node"), F.col("parts"))
    block_of = dealt.select(
        F.col("node").alias("block_node"),
        "root",
        F.xxhash64("hub", F.col("large_root").isNull(), "large_root", share).alias("block"),
        F.col("large_root").alias("pure"),
    )
    met = (
        entries.select("entry", "node")
        .join(block_of, F.col("node") == F.col("block_node"))
        .select("entry", "block", "pure")
        .distinct()
    )
    other = met.select("entry", F.col("block").alias("other"), F.col("pure").alias("other_pure"))
    one = F.coalesce(F.col("pure") == F.col("other_pure"), F.lit(False))
    pairs = met.join(other, "entry").where((F.col("block") <= F.col("other")) & ~one)
    pairs = pairs.select("block", "other").distinct()
    members = F.collect_list(F.struct("node", "n", "root", "tokens"))
    blocks = (
        nodes.select("node", "n", "tokens")
        .join(block_of, F.col("node") == F.col("block_node"))
        .groupBy("block")
        .agg(members.alias("members"))
    )
    others = blocks.select(F.col("block").alias("other"), F.col("members").alias("other_members"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                left = batch.column("members")[i].as_py()
                right = batch.column("other_members")[i].as_py()
                found = list(spanning_links(left, right, similarity))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[k] for f in found], arrow) for k in (0, 1)], ["a", "b"]
                )

    both = pairs.join(blocks, "block").join(others, "other").select("members", "other_members")
    return both.mapInArrow(compare, shape)


def spanning_links(left: list[dict], right: list[dict], similarity: Similarity) -> Iterator[tuple[Any, Any]]:
    """Verified links between nodes of two blocks that connect all roots that are linked there."""
    common = intersections([m["tokens"] for m in left], [m["tokens"] for m in right])
    n, m = np.array([x["n"] for x in left]), np.array([x["n"] for x in right])
    links = 100 * common >= similarity.percent * (n[:, None] + m[None, :] - common)
    joined: dict[Any, Any] = {}

    def top(root: Any) -> Any:
        while joined.get(root, root) != root:
            root = joined[root]
        return root

    for i, j in zip(*np.nonzero(links)):
        a, b = top(left[i]["root"]), top(right[j]["root"])
        if a != b:
            joined[max(a, b)] = min(a, b)
            yield left[i]["node"], right[j]["node"]


def intersections(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Sizes of the intersections of every set of one block with every one of another."""
    sets = [np.frombuffer(t, dtype=np.uint64) for t in (*left, *right)]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    tokens = np.concatenate(sets)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    column = np.cumsum(np.concatenate([[False], tokens[1:] != tokens[:-1]]))
    total = np.zeros((len(left), len(right)))
    # A few thousand tokens at a time, so that a block of huge sets needs no more memory.
    for at in range(0, int(column[-1]) + 1, TOKENS_AT_ONCE):
        a, b = np.searchsorted(column, (at, at + TOKENS_AT_ONCE))
        held = np.zeros((len(sets), TOKENS_AT_ONCE), dtype=np.float32)
        held[owner[a:b], column[a:b] - at] = 1
        total += held[: len(left)] @ held[len(left) :].T
    return total.astype(np.int64)


def judged(pairs: DataFrame, nodes: DataFrame, similarity: Similarity) -> DataFrame:
    """Pairs with whether they link, by the intersection of their shared tokens."""
    kind = nodes.schema["node"].dataType.simpleString()
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("tokens_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("tokens_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = []
            for a, b, n, m in zip(
                batch.column("tokens_a"), batch.column("tokens_b"), batch.column("n_a"), batch.column("n_b")
            ):
                x = np.frombuffer(a.as_py(), dtype=np.uint64)
                y = np.frombuffer(b.as_py(), dtype=np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                union = n.as_py() + m.as_py() - common
                similar.append(100 * common >= similarity.percent * union)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(similar, pa.bool_())], ["a", "b", "similar"]
            )

    return pairs.join(left, "a").join(right, "b").mapInArrow(compare, f"a {kind}, b {kind}, similar boolean")

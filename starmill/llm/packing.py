"""Packing of documents into sequences by cutting-stock column generation.

Documents become token ids with an end id, cut into pieces of a whole sequence and a remainder. Lengths are
rounded up to a grid; their histogram, a few hundred numbers whatever the table's size, is all that the
driver sees. There a linear program chooses how often to use which pattern (a multiset of lengths that fit
one sequence): it starts with patterns of one length each, and a knapsack dynamic program prices further
columns with the duals until none is worth entering. Rounded down, the solution covers all but a few
hundred pieces, which first fit decreasing packs.

Pieces are ranked within their length class, by buckets of a hash so that no class is one task, and a piece's
rank names its sequence and place by the patterns' counts. Offsets are running sums within a sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.llm.text import Scratch, partitions_for, whole
from starmill.llm.token_segments import text_ids
from starmill.llm.word_hash import small_batches, texts_of

SEQUENCE = 2048
END_ID = 1
GRID = 8
BATCH_BYTES = 2 << 20
BUCKET_PIECES = 250_000
MOST_PIVOTS = 20_000
#: A column must be worth this much more than a sequence to enter: the bound on what the program misses.
TOLERANCE = 1e-4


@dataclass(frozen=True)
class Pattern:
    """So many sequences with so many pieces of each length class."""

    count: int
    pieces: dict[int, int]


def priced_pattern(worth: np.ndarray, classes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of the greatest worth within the capacity, by dynamic programming over it."""
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = int(np.searchsorted(classes, room, side="right"))
        best[room] = best[room - 1]
        if fits:
            with_one = worth[:fits] + best[room - classes[:fits]]
            i = int(np.argmax(with_one))
            if with_one[i] > best[room] + 1e-12:
                best[room], taken[room] = with_one[i], i
    pattern, room = np.zeros(len(classes)), capacity
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            pattern[taken[room]] += 1
            room -= classes[taken[room]]
    return float(best[capacity]), pattern


def fractional_patterns(
    classes: np.ndarray, demand: np.ndarray, capacity: int
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used to make exactly the demand in fewest sequences."""
    columns = np.diag((capacity // classes).astype(float))
    inverse = np.diag(1 / np.diag(columns))
    used = inverse @ demand
    for _ in range(MOST_PIVOTS):
        worth = inverse.sum(axis=0)
        value, pattern = priced_pattern(worth, classes, capacity)
        if value <= 1 + TOLERANCE:
            break
        step = inverse @ pattern
        grows = step > 1e-9
        if not grows.any():
            break
        ratio = np.where(grows, used / np.where(grows, step, 1), np.inf)
        leaves = int(np.argmin(ratio))
        columns[:, leaves] = pattern
        pivot = inverse[leaves] / step[leaves]
        inverse = inverse - np.outer(step, pivot)
        inverse[leaves] = pivot
        used = np.maximum(inverse @ demand, 0)
    return columns, used


def packing_plan(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that together hold exactly the pieces of the histogram (length class to count)."""
    if not histogram:
        return []
    classes = np.array(sorted(histogram))
    demand = np.array([histogram[c] for c in classes], dtype=float)
    columns, used = fractional_patterns(classes, demand, capacity)
    whole_uses = np.floor(used + 1e-6).astype(np.int64)
    left = demand.astype(np.int64)
    plan = []
    for i in np.argsort(-whole_uses, kind="stable"):
        column = columns[:, i].astype(np.int64)
        some = column > 0
        count = min(int(whole_uses[i]), int((left[some] // column[some]).min())) if some.any() else 0
        if count > 0:
            left -= count * column
            plan.append(Pattern(count, {int(c): int(k) for c, k in zip(classes, column) if k}))
    bins: list[tuple[int, dict[int, int]]] = []
    for c, n in zip(classes[::-1].tolist(), left[::-1].tolist()):
        for _ in range(n):
            at = next((i for i, (room, _) in enumerate(bins) if room >= c), None)
            if at is None:
                bins.append((capacity - c, {c: 1}))
            else:
                room, pieces = bins[at]
                pieces[c] = pieces.get(c, 0) + 1
                bins[at] = room - c, pieces
    return plan + [Pattern(1, pieces) for _, pieces in bins]


PIECE_SQL = (
    "doc_id {}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, class int"
)


def pieces_of(docs: DataFrame, path: str, id_column: str, text_column: str, sequence: int, end_id: int) -> DataFrame:
    """One row for each piece: whole sequences from the start, then the remainder."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH_BYTES):
            ids, first = text_ids(texts_of(batch.column("text")), path)
            rows, start, length, crc, total = [], [], [], [], []
            for i in range(batch.num_rows):
                own_ids = np.append(ids[first[i] : first[i + 1]], np.uint32(end_id)).astype("<u4")
                for at in range(0, len(own_ids), sequence):
                    piece = own_ids[at : at + sequence]
                    rows.append(i)
                    start.append(at)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(own_ids))
            sizes = np.array(length, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(start, pa.int64()),
                    pa.array(sizes),
                    pa.array(crc, pa.int64()),
                    pa.array(total, pa.int64()),
                    pa.array((-(-sizes // GRID)).astype(np.int32)),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class"],
            )

    texts = docs.select(F.col(f"`{id_column}`").alias("doc_id"), whole(text_column).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(cut, PIECE_SQL.format(kind))


def packed_sequences(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
) -> DataFrame:
    """One row for each piece of a document: where it lies in the document and in which sequence.

    ``path`` names a byte-level tokenizer file that every executor can read. Null counts as empty: a document of
    the end id alone. Documents are cut only at multiples of ``sequence``. Repeated rows are packed as
    often as they occur. Other columns are not returned. An empty table gives an empty result. Sequences
    are numbered from 0 without gaps.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    pieces = scratch.keep(pieces_of(docs, path, id_column, text_column, sequence, end_id))
    counts = pieces.groupBy("class").count().collect()
    histogram = {r["class"]: r["count"] for r in counts}
    plan = packing_plan(histogram, sequence // GRID)
    # Of each class, by pattern: ranks begin, pieces in a sequence, first sequence.
    slots: dict[int, list[tuple[int, int, int]]] = {c: [] for c in histogram}
    taken, sequences = dict.fromkeys(histogram, 0), 0
    for pattern in plan:
        for c, k in pattern.pieces.items():
            slots[c].append((taken[c], k, sequences))
            taken[c] += pattern.count * k
        sequences += pattern.count
    tables = {c: np.array(rows, dtype=np.int64).T for c, rows in slots.items()}

    buckets = partitions_for(spark, sum(histogram.values()), BUCKET_PIECES)
    bucket = F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets))
    held = pieces.withColumn("bucket", bucket)
    within = Window.partitionBy("class", "bucket").orderBy("doc_id", "start", "ids_crc32")
    before = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        held.groupBy("class", "bucket")
        .count()
        .withColumn("begin", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .drop("count")
    )
    ranked = held.withColumn("rank", F.row_number().over(within) - 1).join(begins, ["class", "bucket"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("begin")).drop("begin", "bucket")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, ranks = batch.column("class").to_numpy(), batch.column("rank").to_numpy()
            sequence_id, slot = np.zeros(len(ranks), dtype=np.int64), np.zeros(len(ranks), dtype=np.int64)
            for c in np.unique(kinds):
                mine = kinds == c
                begin, each, first = tables[int(c)]
                i = np.searchsorted(begin, ranks[mine], side="right") - 1
                k = ranks[mine] - begin[i]
                sequence_id[mine] = first[i] + k // each[i]
                slot[mine] = int(c) * sequence + k % each[i]
            columns = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence_id), pa.array(slot)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"],
            )

    fields = [f for f in pieces.schema.fields if f.name != "class"]
    schema = T.StructType(
        [*fields, T.StructField("sequence_id", T.LongType()), T.StructField("slot", T.LongType())]
    )
    placed = ranked.mapInArrow(place, schema)
    earlier = (
        Window.partitionBy("sequence_id")
        .orderBy(F.col("slot").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("length").over(earlier), F.lit(0))
    return placed.withColumn("offset", offset).drop("slot").withColumnRenamed("doc_id", id_column)

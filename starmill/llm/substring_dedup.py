"""Substring duplicates: words in runs of ``window`` words that also start anywhere else are removed.

1. Every text is cut into reference blocks of (window + 1) // 2 words that do not overlap. Any window
   contains a whole block of its text, so a repeated window shares a block with every other occurrence.
2. Blocks are probed with the runs of a block's length at every word of every text
   (``shared_hashes``). A block that is met at two places or more is an anchor; hits at places that
   follow each other grow together to stretches, and the windows around them are the candidates.
3. A candidate window is verified by its own 64-bit hash, exchanged the same way: those that start at two
   places or more cover the words of maximal exact repeats, which are removed.

The result does not depend on which occurrence is seen first: all are removed, judged on the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.llm.shared_hashes import PARTITION_HASHES, Hashed, shared_hashes, short_hash
from starmill.llm.text import Scratch, own, partitions_for, text_bytes
from starmill.llm.word_hash import run_hashes, small_batches, texts_of

WINDOW = 35
#: Bytes by which a run is known among those of its partition: blocks, where a false hit only costs a
#: verification, and windows.
PROBE_WIDTH, WINDOW_WIDTH = 4, 6
BYTES_PER_WORD = 6
KEY_TYPE = T.StructType([T.StructField("key", T.LongType()), T.StructField("hits", T.BinaryType())])


def starts_within(first: np.ndarray, length: int, total: int) -> np.ndarray:
    """At which of ``total`` words a run of ``length`` begins that stays in its text."""
    ok = np.zeros(total, dtype=bool)
    lengths = np.diff(first)
    room = np.maximum(lengths - length + 1, 0)
    text = np.repeat(np.arange(len(lengths)), lengths)
    ok[:] = (np.arange(total) - first[:-1][text]) < room[text]
    return ok


def _marked(text_counts: np.ndarray, first: np.ndarray, mask: np.ndarray) -> np.ndarray:
    running = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=running[1:])
    return running[first[1:]] - running[first[:-1]]


def covered(starts: np.ndarray, length: int) -> np.ndarray:
    """Words within ``length`` of a marked start, itself included."""
    steps = np.zeros(len(starts) + 1, dtype=np.int64)
    at = np.flatnonzero(starts)
    np.add.at(steps, at, 1)
    np.add.at(steps, np.minimum(at + length, len(starts)), -1)
    return np.cumsum(steps[:-1]) > 0


def _names(batch: pa.RecordBatch) -> list[bytes]:
    return [k.to_bytes(8, "little", signed=True) for k in batch.column("key").to_pylist()]


def _hits(name: bytes, figure: int, hashes: np.ndarray, totals: np.ndarray) -> tuple:
    return int.from_bytes(name, "little", signed=True), hashes.tobytes() if len(hashes) else None


def _known(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The shared hashes of a batch's rows; which row has which does not matter, as they are shared."""
    return [np.frombuffer(h, dtype=np.uint64) for hits in batch.column("hits").to_pylist() for h in hits or []]


def repeated_runs_removed(
    docs: DataFrame,
    text_column: str = "text",
    window: int = WINDOW,
    shown: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Every row of ``docs``; ``text_column`` without repeated runs, and n_words and n_removed.

    A word is a run of characters other than blank and 0x09-0x0D, compared as it is. A word is removed if
    a window of ``window`` successive words covers it whose sequence also starts elsewhere, in the same
    text or another. A text that loses words is its kept words joined by one blank, any other is
    unchanged. Null counts as a text without words and stays null. Repeated rows repeat each other.
    ``shown`` replaces the text by an expression of it (a digest), so that whole texts need not be stored
    between the steps. Columns named n_words or n_removed are replaced, others of any type stay. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    block = (window + 1) // 2
    words = text_bytes(docs, text_column) // BYTES_PER_WORD
    partitions = partitions_for(spark, words, PARTITION_HASHES)
    others = [c for c in docs.columns if c not in {text_column, "n_words", "n_removed"}]
    # Rows of equal content share a key, and with it their hits; so do other rows of one key, if there are any.
    plain = {f.name for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType)}
    told = [c for c in others if c in plain and not isinstance(docs.schema[c].dataType, T.VariantType)]
    keyed = docs.select(
        F.xxhash64(*[F.col(f"`{c}`") for c in [*told, text_column]]).alias("key"),
        F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias(own("fill"))).alias("row"),
        F.col(f"`{text_column}`").alias("text"),
    )

    def probes(batch: pa.RecordBatch) -> Hashed:
        hashes, first = texts_of(batch.column("text")).word_hashes()
        ok = starts_within(first, block, len(hashes))
        runs = run_hashes(hashes, block)[ok[: max(len(hashes) - block + 1, 0)]]
        place = np.arange(len(hashes)) - np.repeat(first[:-1], np.diff(first))
        anchored = (place % block == 0)[ok]
        return Hashed(runs, _marked(hashes, first, ok), np.diff(first), _names(batch), anchored)

    # Each step's result is stored, so that its shuffle files and the next step's are never on disk together.
    hits = scratch.keep_only(
        shared_hashes(
            keyed.select("key", "text"), probes, _hits, KEY_TYPE, partitions, PROBE_WIDTH, by_reference=True
        ).where("hits IS NOT NULL")
    )
    hits = hits.groupBy("key").agg(F.collect_set("hits").alias("hits"))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 1 << 20):
            hashes, first = texts_of(batch.column("text")).word_hashes()
            found = _known(batch)
            masks: list[bytes | None] = [None] * batch.num_rows
            if found and len(hashes) >= window:
                known = np.unique(np.concatenate(found))
                ok = starts_within(first, block, len(hashes))
                short = short_hash(run_hashes(hashes, block), partitions, PROBE_WIDTH)
                place = np.minimum(np.searchsorted(known, short), len(known) - 1)
                hit = np.zeros(len(hashes), dtype=bool)
                hit[: len(short)] = (known[place] == short) & ok[: len(short)]
                # Windows that contain a hit start at it or up to window - block words before.
                near = covered(hit[::-1], window - block + 1)[::-1] & starts_within(first, window, len(hashes))
                for i in range(batch.num_rows):
                    mine = near[first[i] : first[i + 1]]
                    if mine.any():
                        masks[i] = np.packbits(mine).tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("row"),
                    batch.column("text"),
                    pa.array(np.diff(first).astype(np.int64)),
                    pa.array(masks, pa.binary()),
                ],
                ["key", "row", "text", "n_words", "mask"],
            )

    row_type = keyed.schema["row"].dataType
    with_masks = T.StructType(
        [
            T.StructField("key", T.LongType()),
            T.StructField("row", row_type),
            T.StructField("text", T.StringType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("mask", T.BinaryType()),
        ]
    )
    show = shown or (lambda text: text)
    masked = keyed.join(hits, "key", "left").mapInArrow(candidates, with_masks)
    final = F.when(F.col("mask").isNull(), show(F.col("text"))).otherwise(F.col("text"))
    seen = scratch.keep_only(masked.withColumn("text", final))

    def windows(batch: pa.RecordBatch) -> Hashed:
        hashes, first = texts_of(batch.column("text")).word_hashes()
        chosen = _unmasked(batch, first, len(hashes))
        runs = run_hashes(hashes, window)
        return Hashed(runs[chosen[: len(runs)]], _marked(hashes, first, chosen), np.diff(first), _names(batch))

    suspects = seen.where("mask IS NOT NULL")
    repeats = scratch.keep_only(
        shared_hashes(
            suspects.select("key", "text", "mask"), windows, _hits, KEY_TYPE, partitions, WINDOW_WIDTH
        ).where("hits IS NOT NULL")
    )
    repeats = repeats.groupBy("key").agg(F.collect_set("hits").alias("hits"))

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 1 << 20):
            texts = texts_of(batch.column("text"))
            start, end, first = texts.words()
            hashes, _ = texts.word_hashes()
            found = _known(batch)
            out = batch.column("text").to_pylist()
            gone = np.zeros(len(hashes), dtype=bool)
            runs = short_hash(run_hashes(hashes, window), partitions, WINDOW_WIDTH)
            if found and len(runs):
                known = np.unique(np.concatenate(found))
                place = np.minimum(np.searchsorted(known, runs), len(known) - 1)
                hit = np.zeros(len(hashes), dtype=bool)
                hit[: len(runs)] = known[place] == runs
                gone = covered(hit & starts_within(first, window, len(hashes)), window)
            for i in range(batch.num_rows):
                a, b = first[i], first[i + 1]
                if gone[a:b].any():
                    keep = np.flatnonzero(~gone[a:b]) + a
                    out[i] = b" ".join(
                        texts.data[s:e].tobytes() for s, e in zip(start[keep], end[keep])
                    ).decode()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(out, pa.string()),
                    batch.column("n_words"),
                    pa.array(_marked(hashes, first, gone).astype(np.int64)),
                ],
                ["row", "text", "n_words", "n_removed"],
            )

    after = T.StructType(
        [
            T.StructField("row", row_type),
            T.StructField("text", T.StringType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
        ]
    )
    cut = suspects.select("key", "row", "text", "n_words").join(repeats, "key", "left").mapInArrow(removed, after)
    cut = cut.withColumn("text", show(F.col("text")))
    whole = seen.where("mask IS NULL").select(
        "row", "text", "n_words", F.lit(0).cast("long").alias("n_removed")
    )
    return whole.unionByName(cut).select(
        *[
            F.col("text").alias(c) if c == text_column else F.col(f"row.`{c}`").alias(c)
            for c in docs.columns
            if c not in {"n_words", "n_removed"}
        ],
        "n_words",
        "n_removed",
    )


def _unmasked(batch: pa.RecordBatch, first: np.ndarray, total: int) -> np.ndarray:
    chosen = np.zeros(total, dtype=bool)
    for i, mask in enumerate(batch.column("mask").to_pylist()):
        n = first[i + 1] - first[i]
        if mask is not None:
            chosen[first[i] : first[i + 1]] = np.unpackbits(np.frombuffer(mask, dtype=np.uint8), count=n)
    return chosen

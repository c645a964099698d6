"""Which hashes of a text also occur elsewhere in the table, exchanged in packed form.

Texts are hashed in batches. Hashes go to the partition that their upper bits name, a few
bytes each, packed in one row for each batch and partition; a hash that occurs several times in a batch
is sent once with its count. The partition adds the counts up and answers each batch with those that
occur at least twice, and the answers are regrouped by batch and handed out by document. A partition
gets the hashes of a fixed amount of words, whatever the table's size, and at most one copy of a hash from
each batch, so neither common words nor large groups of copies make it large.

A shared hash is known by its partition and its lowest ``width`` bytes: ``short_hash``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starmill.llm.word_hash import small_batches

#: Texts that are sent together: more for many partitions, each of which gets a row of every batch.
BATCH_BYTES, MOST_BATCH_BYTES, BYTES_PER_ROW = 4 << 20, 16 << 20, 1 << 10
#: Texts that are hashed at once: what is computed on the way takes many times their bytes.
HASH_BYTES = 1 << 18
#: Hashes that one partition compares.
PARTITION_HASHES = 1_500_000
HASHES, DOCUMENTS, REPEATS, ANSWER = 0, 1, 2, 3


@dataclass
class Hashed:
    """Hashes of a batch's texts, in the order of the texts, and figures of each text.

    ``reference`` marks hashes of which only those shared with some other position count (all if null).
    """

    hashes: np.ndarray
    counts: np.ndarray
    figure: np.ndarray
    name: list[bytes]
    reference: np.ndarray | None = None


def joined(parts: Iterable[Hashed]) -> Hashed:
    """The hashes of successive texts that were hashed in parts."""
    parts = list(parts)
    if len(parts) == 1:
        return parts[0]
    reference = [p.reference for p in parts if p.reference is not None]
    return Hashed(
        np.concatenate([p.hashes for p in parts]),
        np.concatenate([p.counts for p in parts]),
        np.concatenate([p.figure for p in parts]),
        [name for p in parts for name in p.name],
        np.concatenate(reference) if reference else None,
    )


def fitting_width(partitions: int, width: int) -> int:
    """At most ``width`` bytes, so that they and a partition's number fit into 64 bits."""
    return min(width, (64 - (partitions - 1).bit_length()) // 8)


def short_hash(hashes: np.ndarray, partitions: int, width: int) -> np.ndarray:
    """Partition and lowest bytes of each hash in one number."""
    width = fitting_width(partitions, width)
    part = ((hashes >> np.uint64(40)) * np.uint64(partitions)) >> np.uint64(24)
    low = hashes & np.uint64((1 << 8 * width) - 1)
    return (part << np.uint64(8 * width)) | low


def _pack(short: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(short.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unpack(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(width, -1)
    wide = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    wide[:, :width] = planes.T
    return wide.reshape(-1).view(np.uint64)


def _by_text(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)


def _owners(owner: np.ndarray, n_texts: int) -> bytes:
    """Whose each hash is, in rising order: hashes of each text, or the text of each hash if that is shorter."""
    if len(owner) < n_texts:
        return b"\x01" + _u4(owner)
    return b"\x00" + _u4(np.bincount(owner, minlength=n_texts))


def _owner_of(data: bytes) -> np.ndarray:
    numbers = np.frombuffer(data, dtype=np.uint32, offset=1).astype(np.int64)
    return numbers if data[:1] == b"\x01" else _by_text(numbers)


ROW = pa.schema(
    [
        ("part", pa.int32()),
        ("src", pa.int64()),
        ("kind", pa.int32()),
        ("counts", pa.binary()),
        ("hashes", pa.binary()),
        ("extra", pa.binary()),
        ("names", pa.list_(pa.binary())),
    ]
)
ROW_SQL = (
    "part int, src bigint, kind int, counts binary, hashes binary, extra binary, names array<binary>"
)


def _u4(values: np.ndarray) -> bytes:
    return values.astype(np.uint32).tobytes()


def _sends(src: int, batch: Hashed, partitions: int, width: int) -> Iterator[tuple]:
    short = short_hash(batch.hashes, partitions, width)
    text = _by_text(batch.counts)
    n_texts = len(batch.counts)
    order = np.argsort(short, kind="stable")
    ranked = short[order]
    fresh = np.ones(len(short), dtype=bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    first = np.flatnonzero(fresh)
    weight = np.diff(np.append(first, len(short)))
    repeated = np.sort(order[~fresh])
    sent = order[first]
    back = np.argsort(sent)
    sent, weight = sent[back], weight[back]
    del ranked, fresh, first, order, back
    part = (short[sent] >> np.uint64(8 * width)).astype(np.int64)
    by_part = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[by_part], np.arange(partitions + 1))
    if batch.reference is not None:
        known = np.unique(short[batch.reference])
        known_edges = np.searchsorted(known >> np.uint64(8 * width), np.arange(partitions + 1, dtype=np.uint64))
    for p in range(partitions):
        rows = by_part[edges[p] : edges[p + 1]]
        if not len(rows):
            continue
        at = sent[rows]
        reference = b""
        if batch.reference is not None:
            reference = _pack(np.ascontiguousarray(known[known_edges[p] : known_edges[p + 1]]), width)
        owners = _owners(text[at], n_texts)
        packed = _pack(np.ascontiguousarray(short[at]), width)
        yield p, src, HASHES, owners, packed, _u4(weight[rows]), [reference]
    home = src % partitions
    yield home, src, DOCUMENTS, _u4(batch.figure), b"", b"", batch.name
    if len(repeated):
        yield home, src, REPEATS, _owners(text[repeated], n_texts), short[repeated].tobytes(), b"", []


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [dict(zip(ROW.names, row)) for row in rows], schema=ROW
    )


def _answers(rows: list[tuple[int, bytes, bytes, bytes, list]], part: int, width: int, by_reference: bool):
    short = np.concatenate([_unpack(r[2], width) for r in rows])
    weight = np.concatenate([np.frombuffer(r[3], dtype=np.uint32) for r in rows])
    order = np.argsort(short, kind="stable")
    ranked = short[order]
    fresh = np.ones(len(short), dtype=bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    first = np.flatnonzero(fresh)
    total = np.add.reduceat(weight[order].astype(np.int64), first)
    shared = total >= 2
    if by_reference:
        known = np.unique(np.concatenate([_unpack(r[4][0], width) for r in rows]))
        if len(known):
            place = np.minimum(np.searchsorted(known, ranked[first]), len(known) - 1)
            shared &= known[place] == ranked[first]
        else:
            shared[:] = False
    group = np.cumsum(fresh) - 1
    total_at = np.empty(len(short), dtype=np.int64)
    total_at[order] = np.where(shared, total, 0)[group]
    at = 0
    for src, owners, packed, _, _ in rows:
        n = len(packed) // width
        here = total_at[at : at + n]
        hit = here > 0
        if hit.any():
            owner = _owner_of(owners)[hit]
            hashes = short[at : at + n][hit] | np.uint64(part << 8 * width)
            # As many texts as the last that is named: the rest have none.
            yield part, src, ANSWER, _owners(owner, int(owner[-1]) + 1), hashes.tobytes(), _u4(np.minimum(here[hit], 2**32 - 1)), []
        at += n


def shared_hashes(
    docs: DataFrame,
    hashed: Callable[[pa.RecordBatch], Hashed],
    finish: Callable[[bytes, int, np.ndarray, np.ndarray], tuple],
    result: T.StructType,
    partitions: int,
    width: int,
    by_reference: bool = False,
) -> DataFrame:
    """For each row of ``docs`` what ``finish`` makes of (name, figure, shared short hashes, their counts).

    ``docs`` needs a column ``text``, by whose size batches are made. Hashes come in the order of
    neither the text nor their values. ``finish`` gives one tuple of the ``result`` schema.
    """
    arrow_result = to_arrow_schema(result)
    width = fitting_width(partitions, width)
    batch_bytes = min(MOST_BATCH_BYTES, max(BATCH_BYTES, partitions * BYTES_PER_ROW))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        for i, batch in enumerate(small_batches(batches, "text", batch_bytes)):
            found = joined(hashed(part) for part in small_batches(iter([batch]), "text", HASH_BYTES))
            yield _rows(list(_sends(base + i, found, partitions, width)))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list] = {}
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            others = np.flatnonzero(kinds != HASHES)
            if len(others):
                yield batch.take(pa.array(others))
            for i in np.flatnonzero(kinds == HASHES):
                row = {c: batch.column(c)[int(i)].as_py() for c in ROW.names}
                kept.setdefault(row["part"], []).append(
                    (row["src"], row["counts"], row["hashes"], row["extra"], row["names"])
                )
        for part, rows in kept.items():
            for answer in _answers(rows, part, width, by_reference):
                yield _rows([answer])

    def hand_out(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        about = next(r for r in rows if r["kind"] == DOCUMENTS)
        answers = [r for r in rows if r["kind"] == ANSWER]
        figure = np.frombuffer(about["counts"], dtype=np.uint32)
        none = np.zeros(0, dtype=np.uint64)
        hashes = np.concatenate([none, *[np.frombuffer(r["hashes"], dtype=np.uint64) for r in answers]])
        totals = np.concatenate(
            [none.astype(np.uint32), *[np.frombuffer(r["extra"], dtype=np.uint32) for r in answers]]
        )
        text = np.concatenate(
            [none.astype(np.int64), *[_owner_of(r["counts"]) for r in answers]]
        )
        for r in rows:
            if r["kind"] == REPEATS and len(hashes):
                again = np.frombuffer(r["hashes"], dtype=np.uint64)
                owner = _owner_of(r["counts"])
                order = np.argsort(hashes, kind="stable")
                place = order[np.minimum(np.searchsorted(hashes, again, sorter=order), len(order) - 1)]
                found = hashes[place] == again
                hashes = np.concatenate([hashes, again[found]])
                totals = np.concatenate([totals, totals[place[found]]])
                text = np.concatenate([text, owner[found]])
        order = np.argsort(text, kind="stable")
        hashes, totals = hashes[order], totals[order]
        edges = np.searchsorted(text[order], np.arange(len(figure) + 1))
        made = [
            finish(name, int(figure[i]), hashes[edges[i] : edges[i + 1]], totals[edges[i] : edges[i + 1]])
            for i, name in enumerate(about["names"])
        ]
        return pa.Table.from_pylist([dict(zip(result.names, row)) for row in made], schema=arrow_result)

    sent = docs.mapInArrow(send, ROW_SQL)
    answered = sent.repartitionById(partitions, "part").mapInArrow(match, ROW_SQL)
    return answered.groupBy("src").applyInArrow(hand_out, result)

"""Totals of subtrees by time-forward processing: nodes in reverse level order, messages in a priority queue.

Nodes come deepest first. A node takes the messages that its children have left for it from the queue, adds them to
its own figures and leaves the sum for its parent, which comes later. The queue holds one entry for each
parent that still waits, ordered as the nodes are; entries beyond a limit go to sorted runs on the
task's own disk, which are merged as they are read. Nothing outside the task needs those runs: they have
no name, and a task that is lost starts anew.
"""

from __future__ import annotations

import heapq
import pickle
import tempfile
from collections.abc import Iterator
from typing import IO

import pyarrow as pa

#: Entries of a queue in memory.
QUEUE = 200_000
CHUNK = 4096

#: (-depth, first half, second half of a node's key): less comes first.
Key = tuple[int, int, int]
Entry = tuple[Key, list[int]]

NODE_COLUMNS = ("depth", "h1", "h2", "up_depth", "up1", "up2", "sends", "children", "leaves", "saved")
TOTALS = "depth bigint, h1 bigint, h2 bigint, children bigint, leaves bigint, saved bigint"
TOTAL_COLUMNS = ("depth", "h1", "h2", "children", "leaves", "saved")


class SpillingQueue:
    """Sums of messages by key, taken in the order of keys."""

    def __init__(self, limit: int = QUEUE) -> None:
        self.limit = limit
        self.sums: dict[Key, list[int]] = {}
        self.order: list[Key] = []
        #: The first entry of each run that is left, with the run's number.
        self.heads: list[tuple[Key, int, list[int]]] = []
        self.runs: list[Iterator[Entry]] = []

    def add(self, key: Key, children: int, leaves: int, saved: int) -> None:
        held = self.sums.get(key)
        if held is not None:
            held[0] += children
            held[1] += leaves
            held[2] += saved
            return
        self.sums[key] = [children, leaves, saved]
        heapq.heappush(self.order, key)
        if len(self.sums) > self.limit:
            self._spill()

    def take(self, key: Key) -> list[int]:
        """The sums for a key; keys are asked for in their order, and none may be left out."""
        found = [0, 0, 0]
        while self.order and self.order[0] <= key:
            first = heapq.heappop(self.order)
            self._met(first, key)
            found = [a + b for a, b in zip(found, self.sums.pop(first))]
        while self.heads and self.heads[0][0] <= key:
            first, run, sums = heapq.heappop(self.heads)
            self._met(first, key)
            found = [a + b for a, b in zip(found, sums)]
            self._advance(run)
        return found

    def empty(self) -> bool:
        return not self.order and not self.heads

    @staticmethod
    def _met(first: Key, key: Key) -> None:
        if first != key:
            raise ValueError(f"no node came for the messages to {first}")

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        entries = sorted(self.sums.items())
        for at in range(0, len(entries), CHUNK):
            pickle.dump(entries[at : at + CHUNK], file)
        file.seek(0)
        self.sums, self.order = {}, []
        self.runs.append(self._read(file))
        self._advance(len(self.runs) - 1)

    @staticmethod
    def _read(file: IO[bytes]) -> Iterator[Entry]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _advance(self, run: int) -> None:
        following = next(self.runs[run], None)
        if following is not None:
            heapq.heappush(self.heads, (following[0], run, following[1]))


def subtree_totals(batches: Iterator[pa.RecordBatch], limit: int = QUEUE) -> Iterator[pa.RecordBatch]:
    """The totals of nodes sorted by falling depth, then by key.

    A node that ``sends`` passes its totals to the node (up_depth, up1, up2), which must be of this task.
    """
    queue = SpillingQueue(limit)
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in NODE_COLUMNS]
        out: list[tuple[int, ...]] = []
        for depth, h1, h2, up_depth, up1, up2, sends, children, leaves, saved in zip(*columns):
            more = queue.take((-depth, h1, h2))
            children, leaves, saved = children + more[0], leaves + more[1], saved + more[2]
            if sends:
                queue.add((-up_depth, up1, up2), 1, leaves, saved)
            out.append((depth, h1, h2, children, leaves, saved))
        arrays = [pa.array(column, pa.int64()) for column in zip(*out)] if out else [pa.array([], pa.int64())] * 6
        yield pa.RecordBatch.from_arrays(arrays, list(TOTAL_COLUMNS))
    if not queue.empty():
        raise ValueError("messages are left for nodes that never came")

"""Token ids of whole batches of texts by a byte-level tokenizer of the tokenizers library.

Texts are cut before every blank that follows a visible ASCII character or a Latin letter, and between
such a letter and a point, comma or line end. There the tokenizer always begins a new piece of its own:
none of its patterns continues over such a place, none looks back, the only one that looks ahead ends at
a run of white space, and no special string contains such a place. So a text's ids are those of its segments in order, and a segment that
has been seen is not encoded again. Each worker keeps a bounded table of segments; when it is full it
starts anew. Segments are found again by 64-bit hashes.
"""

from __future__ import annotations

import gc
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
from tokenizers import Tokenizer

from starmill.llm.word_hash import Texts, span_hashes

MOST_SEGMENTS = 2_000_000
#: Bytes that end a word of letters; not those that occur in special strings.
POINTS = np.zeros(256, dtype=bool)
POINTS[list(b".,;:!?\n")] = True


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def segment_starts(texts: Texts) -> np.ndarray:
    """Where segments begin, the begin of every text that is not empty among them."""
    data = texts.data
    cut = np.zeros(len(data), dtype=bool)
    if len(data) > 2:
        before = data[1:-1]
        visible = (before > 0x20) & (before < 0x7F)
        letter = (before >= 0x80) & (data[:-2] >= 0xC3) & (data[:-2] <= 0xC9)
        # Only the letters of these two blocks: not the multiplication and division signs.
        letter &= ~((data[:-2] == 0xC3) & ((before == 0x97) | (before == 0xB7)))
        plain = (before | 0x20) - np.uint8(0x61) < 26
        cut[2:] = ((data[2:] == 0x20) & (visible | letter)) | (POINTS[data[2:]] & (plain | letter))
    begins = texts.offsets[:-1][np.diff(texts.offsets) > 0]
    cut[begins] = True
    return np.flatnonzero(cut)


class SegmentTable:
    """Ids of the segments met so far, sorted by hash."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]]) -> None:
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.where = np.zeros(0, dtype=np.uint32)
        self.size = np.zeros(0, dtype=np.uint32)
        self.ids = np.zeros(0, dtype=np.uint32)

    def add(self, hashes: np.ndarray, segments: list[str]) -> None:
        """Segments that are not in the table, in the order of their hashes."""
        # Millions of short lists come and go here, none of them in cycles.
        collecting = gc.isenabled()
        gc.disable()
        try:
            lists = self.encode(segments)
            size = np.fromiter(map(len, lists), dtype=np.uint32, count=len(lists))
            new = np.fromiter(chain.from_iterable(lists), dtype=np.uint32, count=int(size.sum()))
            del lists
        finally:
            if collecting:
                gc.enable()
        where = (np.cumsum(size, dtype=np.int64) - size + len(self.ids)).astype(np.uint32)
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.where = np.insert(self.where, at, where)
        self.size = np.insert(self.size, at, size)
        self.ids = np.concatenate([self.ids, new])

    def places(self, texts: Texts, starts: np.ndarray) -> np.ndarray:
        """The row of every segment, after the missing ones were encoded."""
        if not len(starts):
            return np.zeros(0, dtype=np.int64)
        ends = np.append(starts[1:], len(texts.data))
        hashes = span_hashes(texts.data, starts, ends)
        order = np.argsort(hashes)
        ranked = hashes[order]
        fresh = np.ones(len(ranked), dtype=bool)
        fresh[1:] = ranked[1:] != ranked[:-1]
        unique, first = ranked[fresh], order[fresh]
        missing = self._missing(unique)
        if len(self.hashes) + len(missing) > MOST_SEGMENTS:
            self.clear()
            missing = np.arange(len(unique))
        if len(missing):
            at = first[missing]
            body = texts.data.tobytes()
            spans = zip(starts[at].tolist(), ends[at].tolist())
            self.add(unique[missing], [body[a:b].decode() for a, b in spans])
        place = np.empty(len(hashes), dtype=np.int64)
        place[order] = np.searchsorted(self.hashes, unique)[np.cumsum(fresh) - 1]
        return place

    def _missing(self, unique: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.arange(len(unique))
        place = np.minimum(np.searchsorted(self.hashes, unique), len(self.hashes) - 1)
        return np.flatnonzero(self.hashes[place] != unique)


@lru_cache(maxsize=4)
def segment_table(path: str) -> SegmentTable:
    def encode(segments: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer(path).encode_batch_fast(segments, add_special_tokens=False)]

    return SegmentTable(encode)


def ids_at(
    table: SegmentTable, texts: Texts, starts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts by a table, and where each text's begin."""
    place = table.places(texts, starts)
    size, where = table.size[place].astype(np.int64), table.where[place].astype(np.int64)
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) - np.repeat(ends - size - where, size)
    running = np.concatenate([[0], ends])
    return table.ids[at], running[np.searchsorted(starts, texts.offsets)]


def text_ids(texts: Texts, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts one after the other, and where each text's begin."""
    return ids_at(segment_table(path), texts, segment_starts(texts))


def text_counts(texts: Texts, path: str) -> np.ndarray:
    """How many tokens each text has."""
    table, starts = segment_table(path), segment_starts(texts)
    place = table.places(texts, starts)
    running = np.concatenate([[0], np.cumsum(table.size[place], dtype=np.int64)])
    first = running[np.searchsorted(starts, texts.offsets)]
    return np.diff(first)

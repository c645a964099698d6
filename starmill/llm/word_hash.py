"""Hashes of words and of runs of words for whole batches of texts, as numpy arrays.

A word is a maximal run of bytes that are neither blank nor 0x09-0x0D. Hashes are polynomials modulo the
prime 2^61 - 1, taken from differences of running sums, so the cost is a few vector operations a
byte whatever the lengths of words and runs. (Modulo a power of two there are texts, such as the words of
Thue and Morse, that share a hash for every base.) Long texts are hashed block by block: what stays in
memory is eight bytes a word or span.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute

PIECE = 1 << 17
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit values spread evenly (one to one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Polynomials are taken modulo this prime, 2^61 - 1.
PRIME = (1 << 61) - 1
_P = np.uint64(PRIME)
_U29, _U32, _U61 = np.uint64(29), np.uint64(32), np.uint64(61)
_LOW29, _LOW32 = np.uint64((1 << 29) - 1), np.uint64((1 << 32) - 1)
#: Bytes, or words, over which one running sum is taken: it stays below 2^61. Small enough that what is computed on
#: the way takes a few megabytes, and more than a piece and the rest of its last word, mostly.
BLOCK = 1 << 18


def reduced(x: np.ndarray) -> np.ndarray:
    """64-bit values modulo the prime."""
    x = (x & _P) + (x >> _U61)
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of values below it, by halves of 32 bits."""
    a1, a0, b1, b0 = a >> _U32, a & _LOW32, b >> _U32, b & _LOW32
    cross = a1 * b0 + a0 * b1
    low = a0 * b0
    return reduced(
        ((a1 * b1) << np.uint64(3)) + (cross >> _U29) + ((cross & _LOW29) << _U32) + (low & _P) + (low >> _U61)
    )


def _joined(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """high * 2^32 + low modulo the prime, for values below 2^61."""
    return reduced((high >> _U29) + ((high & _LOW29) << _U32) + low)


class Powers:
    """base^i and base^-i modulo the prime, grown as needed; the former in halves of 32 bits."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base % PRIME, pow(base, -1, PRIME)
        self.down = self.high = self.low = np.ones(0, dtype=np.uint64)

    def upto(self, n: int) -> Powers:
        if len(self.down) < n:
            size = 1 << max(16, (n - 1).bit_length())
            up, self.down = (self._series(value, size) for value in (self.base, self.inverse))
            self.high, self.low = up >> _U32, up & _LOW32
        return self

    @staticmethod
    def _series(value: int, size: int) -> np.ndarray:
        found = np.ones(1, dtype=np.uint64)
        while len(found) < size:
            found = np.concatenate([found, times(found, np.uint64(pow(value, len(found), PRIME)))])
        return found


_BYTES, _WORDS = Powers(BYTE_BASE), Powers(WORD_BASE)


def _running(data: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of byte * base^i, in halves, for at most BLOCK bytes."""
    high, low = np.zeros((2, len(data) + 1), dtype=np.uint64)
    digits = data.astype(np.uint64) + np.uint64(1)
    np.cumsum(digits * powers.high[: len(data)], out=high[1:])
    np.cumsum(digits * powers.low[: len(data)], out=low[1:])
    return high, low


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes of ``data``; starts and ends do not fall."""
    powers = _BYTES.upto(min(len(data), BLOCK) + 1)
    if len(data) <= BLOCK:
        high, low = _running(data, powers)
        total = _joined(high[ends] - high[starts], low[ends] - low[starts])
        return mixed(times(total, powers.down[starts]))
    # Sums up to a position: those within its block, shifted to the block's place, and those before the block.
    at_start, at_end = np.zeros(len(starts), dtype=np.uint64), np.zeros(len(ends), dtype=np.uint64)
    before, base, back = 0, 1, np.zeros(len(starts), dtype=np.uint64)
    for at in range(0, len(data) + 1, BLOCK):
        high, low = _running(data[at : at + BLOCK], powers)
        for places, sums in ((starts, at_start), (ends, at_end)):
            i, j = np.searchsorted(places, (at, at + BLOCK))
            here = places[i:j] - at
            sums[i:j] = reduced(times(_joined(high[here], low[here]), np.uint64(base)) + np.uint64(before))
        i, j = np.searchsorted(starts, (at, at + BLOCK))
        back[i:j] = times(powers.down[starts[i:j] - at], np.uint64(pow(base, -1, PRIME)))
        whole = int(_joined(high[-1:], low[-1:])[0])
        before = (before + whole * base) % PRIME
        base = base * pow(powers.base, BLOCK, PRIME) % PRIME
    return mixed(times(reduced(at_end + _P - at_start), back))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` successive word hashes, whatever text they are of."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    powers = _WORDS.upto(min(n, BLOCK) + length)
    found = np.empty(n, dtype=np.uint64)
    for at in range(0, n, BLOCK):
        to = min(at + BLOCK, n)
        own = reduced(words[at : to + length - 1])
        own = times(own, (powers.high[: len(own)] << _U32) | powers.low[: len(own)])
        high, low = np.zeros((2, len(own) + 1), dtype=np.uint64)
        np.cumsum(own >> _U32, out=high[1:])
        np.cumsum(own & _LOW32, out=low[1:])
        m = to - at
        total = _joined(high[length:] - high[:m], low[length:] - low[:m])
        found[at:to] = mixed(times(total, powers.down[:m]) + np.uint64(length))
    return found


#: Bytes that end a word: blank and 0x09-0x0D.
BLANKS = np.zeros(256, dtype=bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Texts:
    """Successive texts of a batch: their bytes and where each begins and ends."""

    data: np.ndarray
    offsets: np.ndarray
    ends_word: np.ndarray = field(default_factory=lambda: BLANKS)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every word, and where in those each text's words begin."""
        starts, ends = [], []
        for at, to in self._pieces():
            data = self.data[at:to]
            inside = ~self.ends_word[data]
            before, after = np.zeros_like(inside), np.zeros_like(inside)
            before[1:], after[:-1] = inside[:-1], inside[1:]
            edges = self.offsets[np.searchsorted(self.offsets, at) : np.searchsorted(self.offsets, to)] - at
            before[edges] = False
            after[edges[edges > 0] - 1] = False
            starts.append(np.flatnonzero(inside & ~before) + at)
            ends.append(np.flatnonzero(inside & ~after) + 1 + at)
        none = np.zeros(0, dtype=np.int64)
        start = np.concatenate(starts) if starts else none
        end = np.concatenate(ends) if ends else none
        return start, end, np.searchsorted(start, self.offsets)

    def word_hashes(self, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word, and where in those each text's words begin."""
        start, end, first = self.words()
        hashes = np.zeros(len(start), dtype=np.uint64)
        for at, to in self._pieces():
            data = self.data[at:to]
            if lower:
                data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
            i, j = np.searchsorted(start, (at, to))
            if j > i:
                hashes[i:j] = span_hashes(data, start[i:j] - at, end[i:j] - at)
        return hashes, first

    def _pieces(self) -> Iterator[tuple[int, int]]:
        """Ranges of about PIECE bytes that cut no word; the texts' ends may be cut into them."""
        at, n = 0, len(self.data)
        while at < n:
            to = min(at + PIECE, n)
            while to < n:
                near = self.ends_word[self.data[to : to + PIECE]]
                gap = int(np.argmax(near)) if near.any() else -1
                i = np.searchsorted(self.offsets, to)
                border = int(self.offsets[i])
                if gap >= 0 or border < to + len(near):
                    to = min(to + gap if gap >= 0 else n, border)
                    break
                to += len(near)
            yield at, to
            at = to


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """The texts of an Arrow column; null counts as empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if array.null_count:
        array = array.fill_null("")
    kind = np.int64 if pa.types.is_large_string(array.type) else np.int32
    _, offsets, data = array.buffers()
    where = np.frombuffer(offsets, dtype=kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return Texts(body[where[0] : where[-1]], where - where[0])


def small_batches(
    batches: Iterator[pa.RecordBatch], column: str, most_bytes: int
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most so many bytes of text (a longer text is alone).

    Memory of earlier batches that Arrow keeps for later ones goes back with each batch that comes in: a worker
    lives on after its task, beside the JVM's own needs.
    """
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)
        total = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, base + most_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to
        del batch
        pa.default_memory_pool().release_unused()

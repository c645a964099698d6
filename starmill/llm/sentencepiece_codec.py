"""Encoding and decoding with a SentencePiece BPE model, by suffix-array matching.

The new words of a batch are concatenated and their suffixes sorted. Every piece of the vocabulary is
looked up by binary search, one character after the other, which gives the range of suffixes that begin
with it: its occurrences. Each is an edge from its first to its last character; edges are sorted by position
and relaxed from left to right.

For a unigram model relaxing would keep the best score. A BPE model's segmentation is not the best by score
but the outcome of merges in order of rank, and this can be relaxed exactly: the last token of a prefix is
the one edge whose token stays beside the last token of the prefix before it, that is, no merge over the seam
comes before the merges that made the two (``seam_holds``). Runs of blanks, which the model merges last and
all at one rank, are grouped after that from the left. Characters outside the vocabulary become bytes.

Words (with the blanks before them) do not influence each other, so a word met before is not matched again;
each worker keeps a bounded table of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.llm.text import own, ship, whole
from starmill.llm.token_segments import SegmentTable, ids_at
from starmill.llm.word_hash import Texts, small_batches, texts_of

BLANK = "▁"
NEVER = 1 << 40
BATCH_BYTES = 4 << 20
#: Characters of one suffix array.
ARRAY_CHARACTERS = 1 << 20


class Pieces:
    """A model's vocabulary: characters, ranks and how each piece is made of two others."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        special = [
            model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)
            for i in range(len(self.names))
        ]
        self.byte = {int(n[3:5], 16): i for i, n in enumerate(self.names) if model.is_byte(i)}
        self.runs = {len(n): i for i, n in enumerate(self.names) if not n.strip(BLANK) and not special[i]}
        self.ids = {
            n: i for i, n in enumerate(self.names) if not special[i] and (n.strip(BLANK) or n == BLANK)
        }
        self.first_unknown = len(self.names)
        order = sorted((i for n, i in self.ids.items() if len(n) > 1), key=lambda i: -model.get_score(i))
        self.rank = np.full(len(self.names) + 1, -1, dtype=np.int64)
        self.rank[order] = np.arange(len(order))
        self.left = np.full(len(self.names) + 1, -1, dtype=np.int64)
        self.right = self.left.copy()
        splits: list[tuple[int, int, int]] = []
        for name, i in self.ids.items():
            for at in range(1, len(name)):
                a, b = self.ids.get(name[:at]), self.ids.get(name[at:])
                if a is not None and b is not None:
                    splits.append((a, b, i))
        table = np.array(splits, dtype=np.int64).reshape(-1, 3)
        keys = table[:, 0] * len(self.names) + table[:, 1]
        by_key = np.argsort(keys)
        self.pair_keys, self.pair_rank = keys[by_key], self.rank[table[by_key, 2]]
        self._split(table)
        self.words = sorted(n for n in self.ids if len(n) == 1 or self.left[self.ids[n]] >= 0)
        self.longest = max(map(len, self.words), default=1)
        self.codes = np.zeros((len(self.words), self.longest), dtype=np.uint32)
        for row, name in enumerate(self.words):
            self.codes[row, : len(name)] = np.frombuffer(name.encode("utf-32-le"), dtype=np.uint32)
        self.length = np.array([len(n) for n in self.words])
        self.word_ids = np.array([self.ids[n] for n in self.words])

    def _split(self, table: np.ndarray) -> None:
        """The two parts of each piece that merges make it of; pieces that none make stay without."""
        length = np.array([len(n) for n in self.names])
        for size in range(2, int(length[table[:, 2]].max(initial=1)) + 1):
            rows = table[length[table[:, 2]] == size]
            made = [(self.rank[rows[:, k]] < 0) | (self.left[rows[:, k]] >= 0) for k in (0, 1)]
            rows = rows[made[0] & made[1]]
            holds = self.seam_holds(rows[:, 0], rows[:, 1], self.rank[rows[:, 2]])
            self.left[rows[holds, 2]], self.right[rows[holds, 2]] = rows[holds, 0], rows[holds, 1]

    def seam_holds(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether tokens a and b, side by side, are made without a merge over their seam.

        Merges are undone from the last: the token made later is taken apart, and what then meets at the seam
        must not have a merge that would have come first. Of equal ranks the left one comes first.
        """
        ok = np.ones(len(a), dtype=bool)
        at = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), NEVER) if before is None else before.copy()
        while len(at):
            keys = a * len(self.names) + b
            place = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            merges = np.where(self.pair_keys[place] == keys, self.pair_rank[place], NEVER)
            bad = merges < limit
            ok[at[bad]] = False
            rank_a, rank_b = self.rank[a], self.rank[b]
            go = ~bad & ((rank_a >= 0) | (rank_b >= 0))
            at, a, b, rank_a, rank_b = at[go], a[go], b[go], rank_a[go], rank_b[go]
            later = rank_a > rank_b
            limit = np.where(later, rank_a, rank_b + 1)
            a, b = np.where(later, self.right[a], a), np.where(later, b, self.left[b])
        return ok

    def encode(self, segments: list[str]) -> list[list[int]]:
        """Ids of segments: blanks, then characters that are none."""
        out: list[list[int]] = []
        at = 0
        while at < len(segments):
            to, total = at, 0
            while to < len(segments) and (to == at or total + len(segments[to]) < ARRAY_CHARACTERS):
                total += len(segments[to]) + 1
                to += 1
            out += self._encode(segments[at:to])
            at = to
        return out

    def _encode(self, segments: list[str]) -> list[list[int]]:
        text = "\0".join([*segments, ""]).replace(" ", BLANK)
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        # Segments may contain the character of the separator: their borders are known by length.
        size = np.array([len(s) for s in segments])
        begin = np.cumsum(size + 1) - size - 1
        start, row = self.occurrences(codes)
        token, length = self.word_ids[row], self.length[row]
        segment = np.searchsorted(begin, start, side="right") - 1
        inside = start + length <= begin[segment] + size[segment]
        start, token, length, segment = start[inside], token[inside], length[inside], segment[inside]
        single = np.ones(len(codes), dtype=bool)
        single[start[length == 1]] = False
        single[begin + size] = False
        unknown = np.flatnonzero(single)
        start = np.concatenate([start, unknown])
        token = np.concatenate([token, np.full(len(unknown), self.first_unknown)])
        length = np.concatenate([length, np.ones(len(unknown), dtype=np.int64)])
        segment = np.concatenate([segment, np.searchsorted(begin, unknown, side="right") - 1])
        # Edges by the position of their end within their segment; equal ends are relaxed together.
        end = start + length
        depth = end - begin[segment]
        order = np.argsort(depth, kind="stable")
        edges = np.searchsorted(depth[order], np.arange(1, int(size.max(initial=0)) + 2))
        last = np.full(len(codes) + 1, -1, dtype=np.int64)
        for d in range(len(edges) - 1):
            now = order[edges[d] : edges[d + 1]]
            opening = start[now] == begin[segment[now]]
            last[end[now[opening]]] = token[now[opening]]
            later = now[~opening]
            before = last[start[later]]
            some = before >= 0
            later, before = later[some], before[some]
            good = later[self.seam_holds(before, token[later])]
            last[end[good]] = token[good]
        return self._traced(codes, begin, size, last)

    def occurrences(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, vocabulary row) of every piece in a text, by its suffix array."""
        suffixes = suffix_array(codes, self.longest)
        low = np.zeros(len(self.words), dtype=np.int64)
        high = np.full(len(self.words), len(codes), dtype=np.int64)
        padded = np.concatenate([codes, np.zeros(self.longest, dtype=np.uint32)])
        for d in range(self.longest):
            rows = np.flatnonzero((self.length > d) & (low < high))
            if not len(rows):
                break
            column = padded[suffixes + d]
            wanted = self.codes[rows, d]
            low[rows], high[rows] = (
                _bound(column, wanted, low[rows], high[rows], False),
                _bound(column, wanted, low[rows], high[rows], True),
            )
        found = np.maximum(high - low, 0)
        row = np.repeat(np.arange(len(found)), found)
        at = np.arange(len(row)) - np.repeat(np.cumsum(found) - found - low, found)
        return suffixes[at], row

    def _traced(self, codes: np.ndarray, begin: np.ndarray, size: np.ndarray, last: np.ndarray) -> list[list[int]]:
        """Ids of each segment, followed back from its end."""
        token_length = np.array([len(n) for n in self.names] + [1])
        at = begin + size
        alive = np.flatnonzero(size > 0)
        found, owner, where = [], [], []
        while len(alive):
            token = last[at[alive]]
            at[alive] -= token_length[token]
            found.append(token)
            owner.append(alive)
            where.append(at[alive].copy())
            alive = alive[at[alive] > begin[alive]]
        out: list[list[int]] = [[] for _ in size]
        if not found:
            return out
        token, owner, where = np.concatenate(found), np.concatenate(owner), np.concatenate(where)
        order = np.lexsort((where, owner))
        token, where = token[order], where[order]
        edges = np.searchsorted(owner[order], np.arange(len(size) + 1))
        blank = self.ids.get(BLANK, -1)
        special = (token == self.first_unknown) | ((token == blank) & (np.append(token[1:], -1) == blank))
        marked = np.concatenate([[0], np.cumsum(special)])
        for i in range(len(size)):
            a, b = edges[i], edges[i + 1]
            ids = token[a:b].tolist()
            if marked[b] > marked[a]:
                ids = self._finished(ids, codes[where[a:b]])
            out[i] = ids
        return out

    def _finished(self, ids: list[int], codes: np.ndarray) -> list[int]:
        """Runs of blanks grouped, unknown characters as bytes."""
        blank = self.ids.get(BLANK, -1)
        done: list[int] = []
        i = 0
        while i < len(ids):
            if ids[i] == blank:
                run = i
                while run < len(ids) and ids[run] == blank:
                    run += 1
                done += [self.runs[k] for k in grouped_run(run - i, frozenset(self.runs))]
                i = run
                continue
            if ids[i] == self.first_unknown:
                done += [self.byte[b] for b in chr(int(codes[i])).encode()]
            else:
                done.append(ids[i])
            i += 1
        return done

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the blank put before it."""
        parts: list[bytes] = []
        for i in ids.tolist():
            name = self.names[i]
            parts.append(bytes([self.values[i]]) if i in self.values else name.encode())
        text = b"".join(parts).decode("utf-8", "replace").replace(BLANK, " ")
        return text[1:] if text.startswith(" ") else text

    @property
    def values(self) -> dict[int, int]:
        if not hasattr(self, "_values"):
            self._values = {i: b for b, i in self.byte.items()}
        return self._values


def grouped_run(n: int, lengths: frozenset[int]) -> list[int]:
    """How n blanks are merged: always the leftmost two neighbours that make a known run."""
    done: list[int] = []
    for _ in range(n):
        done.append(1)
    i = 0
    out: list[int] = []
    while i < len(done):
        out.append(done[i])
        i += 1
        while len(out) > 1 and out[-2] + out[-1] in lengths:
            out[-2:] = [out[-2] + out[-1]]
    return out


def _bound(column: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray, after: bool) -> np.ndarray:
    """In each range of a column that is sorted there: the first place not before (or after) a value."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) >> 1
        value = column[np.minimum(middle, len(column) - 1)]
        right = open_ & ((value <= wanted) if after else (value < wanted))
        low = np.where(right, middle + 1, low)
        high = np.where(open_ & ~right, middle, high)


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ordered by their first ``depth`` characters at least, by doubling."""
    _, rank = np.unique(codes, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    width = 1
    order = np.argsort(rank, kind="stable")
    while width < depth:
        following = np.zeros(len(rank), dtype=np.int64)
        following[:-width] = rank[width:] if width < len(rank) else following[:-width]
        key = rank * (len(rank) + 2) + following
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        fresh = np.ones(len(ranked), dtype=np.int64)
        fresh[1:] = ranked[1:] != ranked[:-1]
        rank = np.empty(len(ranked), dtype=np.int64)
        rank[order] = np.cumsum(fresh)
        width *= 2
    return order


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


@lru_cache(maxsize=2)
def piece_table(path: str) -> SegmentTable:
    return SegmentTable(pieces(path).encode)


def word_starts(texts: Texts) -> np.ndarray:
    """Where a word's blanks begin, the begin of every text that is not empty among them."""
    blank = texts.data == 0x20
    cut = blank.copy()
    cut[1:] &= ~blank[:-1]
    cut[texts.offsets[:-1][np.diff(texts.offsets) > 0]] = True
    return np.flatnonzero(cut)


def batch_ids(texts: Texts, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts that begin with the model's blank, and where each text's begin."""
    return ids_at(piece_table(path), texts, word_starts(texts))


def with_pieces(docs: DataFrame, path: str, text_column: str = "text", ids: bool = False) -> DataFrame:
    """Every row of ``docs`` with n_tokens, ids_crc32 and round_trip (and ids) instead of its text.

    ``path`` names a SentencePiece BPE model with byte fallback, without normalisation, that every executor can read.
    ``ids_crc32`` is that of the ids as little-endian 32-bit numbers; ``round_trip`` tells that decoding
    the ids gives the text again, which fails for texts that contain the model's own blank (U+2581, read as a
    blank) only. Null counts as empty, and empty texts have no ids. Repeated rows return as often. Columns named like the
    result's are replaced. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    made = ["n_tokens", "ids_crc32", "round_trip", *(["ids"] if ids else [])]
    others = [c for c in docs.columns if c not in {text_column, *made}]
    row = own("row")
    body = whole(text_column)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        for batch in small_batches(batches, "text", BATCH_BYTES):
            texts = texts_of(batch.column("text"))
            found, first = batch_ids(texts, path)
            crc, same, marked = [], [], batch.column("marked")
            for i in range(len(texts)):
                mine = found[first[i] : first[i + 1]]
                crc.append(zlib.crc32(mine.astype("<u4").tobytes()))
                same.append(not marked[i].as_py() and vocabulary.decode(mine) == texts.text(i).decode()[1:])
            columns = [batch.column(row), pa.array(np.diff(first)), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())]
            if ids:
                columns.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(found.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, [row, *made])

    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias(own("fill"))).alias(row),
        # The model reads its own blank as one.
        F.when(body != "", F.concat(F.lit(" "), F.translate(body, BLANK, " "))).otherwise("").alias("text"),
        F.contains(body, F.lit(BLANK)).alias("marked"),
    )
    kinds = [T.LongType(), T.LongType(), T.BooleanType(), T.ArrayType(T.IntegerType())]
    result = T.StructType(
        [T.StructField(row, packed.schema[row].dataType)]
        + [T.StructField(n, k) for n, k in zip(made, kinds)]
    )
    return packed.mapInArrow(code, result).select(*[F.col(f"{row}.`{c}`").alias(c) for c in others], *made)

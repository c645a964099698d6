"""Token counts of documents, with overlap resynchronisation for huge ones.

A document longer than a chunk is encoded in chunks that overlap. Each chunk's encoding gives the character
offsets at which the tokenizer begins a new piece of text (a word, not a token within it). From such a
position on, the encoding of a byte-level tokenizer depends on what follows only. A position of
the overlap at which both chunks begin a piece, far enough from the end of the first chunk that nothing
beyond it was looked at, is therefore a stable boundary: tokens are counted from the first chunk up to it
and from the second one after it. If the overlap has no such position (one huge word), it is widened, in the
end to the whole rest.

Documents of one chunk are encoded as they are, by segments that workers remember (``token_segments``).
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.llm.text import own, ship, whole
from starmill.llm.token_segments import text_counts, tokenizer
from starmill.llm.word_hash import Texts, small_batches, texts_of

CHUNK = 1 << 15
OVERLAP = 256
#: No piece's end depends on more than this many characters after it: the longest special string.
MARGIN = 64
BATCH_BYTES = 1 << 20


def piece_starts(encoding) -> dict[int, int]:
    """Character offset of each piece to the number of tokens before it."""
    words, offsets = encoding.word_ids, encoding.offsets
    found: dict[int, int] = {}
    for i, (word, (start, _)) in enumerate(zip(words, offsets)):
        if word is None or i == 0 or word != words[i - 1]:
            found.setdefault(start, i)
    return found


def huge_count(text: str, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of one text, encoded in overlapping chunks."""
    encode = tokenizer(path)
    n, begin, counted_to, total = len(text), 0, 0, 0
    current = encode.encode(text[:chunk], add_special_tokens=False)
    end = min(chunk, n)
    while end < n:
        starts, skipped = piece_starts(current), 0
        ahead = sorted(starts)
        width = overlap
        while True:
            next_begin = max(begin, end - width)
            next_end = min(n, next_begin + max(chunk, 2 * width))
            follower = encode.encode(text[next_begin:next_end], add_special_tokens=False)
            after = piece_starts(follower)
            # The first chunk's positions in the overlap, latest first, that both chunks begin a piece at.
            low = bisect.bisect_left(ahead, max(next_begin, counted_to) - begin + (next_begin > begin))
            high = bisect.bisect_right(ahead, end - begin - MARGIN)
            common = next(
                (p for p in reversed(ahead[low:high]) if p + begin - next_begin in after), None
            )
            if common is not None:
                break
            if next_begin == begin:
                # The overlap is the whole chunk: the longer encoding from the same begin replaces it.
                skipped = 1
                break
            width *= 4
        if skipped:
            current, end = follower, next_end
            continue
        before = starts.get(counted_to - begin, 0) if counted_to > begin else 0
        total += starts[common] - before
        counted_to = common + begin
        begin, end, current = next_begin, next_end, follower
    last = piece_starts(current)
    before = last.get(counted_to - begin, 0) if counted_to > begin else 0
    return total + len(current.ids) - before


def with_token_counts(
    docs: DataFrame, path: str, text_column: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """Every row of ``docs`` with n_bytes (UTF-8) and n_tokens instead of its text.

    ``path`` names a byte-level tokenizer file that every executor can read. Null counts as empty and has
    no tokens. Special strings inside texts are encoded as the library does by default; none is added.
    Repeated rows return as often. Columns named n_bytes or n_tokens are replaced. An empty table gives
    an empty result. A text is not bounded in length: what is held of a huge one is its characters and
    one chunk's encoding, unless it has no boundary at all.
    """
    ship(docs.sparkSession)
    others = [c for c in docs.columns if c not in {text_column, "n_bytes", "n_tokens"}]
    row = own("row")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH_BYTES):
            texts = texts_of(batch.column("text"))
            sizes = np.diff(texts.offsets)
            tokens = np.zeros(len(texts), dtype=np.int64)
            huge = sizes > chunk
            for i in np.flatnonzero(huge):
                tokens[i] = huge_count(texts.text(i).decode(), path, chunk, overlap)
            small = np.flatnonzero(~huge)
            if len(small):
                parts = [texts.data[texts.offsets[i] : texts.offsets[i + 1]] for i in small]
                rest = Texts(np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes[small])]))
                tokens[small] = text_counts(rest, path)
            yield pa.RecordBatch.from_arrays(
                [batch.column(row), pa.array(sizes.astype(np.int64)), pa.array(tokens)],
                [row, "n_bytes", "n_tokens"],
            )

    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias(own("fill"))).alias(row),
        whole(text_column).alias("text"),
    )
    result = T.StructType(
        [
            T.StructField(row, packed.schema[row].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )
    counted = packed.mapInArrow(count, result)
    return counted.select(*[F.col(f"{row}.`{c}`").alias(c) for c in others], "n_bytes", "n_tokens")

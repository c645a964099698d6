"""Document fingerprints: a homomorphic hash of the multiset of a text's paragraphs.

Every paragraph is hashed to a wide vector of integers; the fingerprint is the sum of the vectors, each
component modulo a power of two. The order of paragraphs does not matter, and a paragraph is inserted
or deleted by adding or subtracting its vector (``combined``, ``without``).

A paragraph here is a run of text up to and including a line end or sentence end. Its vector has

* ``EXACT`` lanes of 32 bits each, slices of SHA-256, summed modulo 2^32: equality;
* ``LANES`` one-bit lanes from xxhash64 with several seeds, each summed modulo 2^62 as the weights are:
  likeness. Paragraphs of more than ``WIDEST`` bytes are cut further for these, at borders that the letters beside
  them decide, so that an edit costs the pieces it touches; equal pieces of one paragraph are told apart by number,
  else n of them would weigh as n^2 bytes. A piece's bits count w, the square root of its bytes. A lane's sum s and the total
  weight W give t = 2s - W, a projection of the weighted pieces on random signs, so the squared
  distance of two texts' projections estimates the bytes of the pieces that they do not share, and
  ``likeness`` is 1 - distance / (squares of both), cut to 0..1.

All of it is evaluated within a row by built-in functions, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.text import own, partitions_for, text_bytes, whole

#: A paragraph ends after a line end or after a full stop, exclamation or question mark.
PARAGRAPH_END = r"(?<=[\n.!?])"
EXACT = 4
SEEDS = 2
ROOM = (1 << 62) - 1
LANES = 64 * SEEDS
#: While one text is summed, its lanes share longs, so many bits apart: the first for texts whose weights sum up to
#: less than 2^15, the other for all others. A text has less than 2^31 bytes, and its weights are at most that.
APART = (16, 32)
#: Where longer paragraphs are cut, and what is still longer at the next: blanks after some letters, after more, all
#: blanks, marks and some letters of unspaced text, every code point.
WIDEST = 96
PIECE_ENDS = (
    r"(?<=[dglmpuy|][\x20\x09-\x0D])",
    r"(?<=[^ehinst\x20\x09-\x0D][\x20\x09-\x0D])",
    r"(?<=[\x20\x09-\x0D])",
    r"(?<=[\u3001\u3002\uFF01\uFF0C\uFF1B\uFF1F\u0964\u061F\u060C\u06D4,;:/&=0-3aeimquyAEIMQUY])",
    r"(?s)(?<=.)",
)
#: Quantiles of the ids that one expression holds; more ranges than that lie between them.
MOST_CUTS = 255


def _cut(text: Column, ends: tuple[str, ...]) -> Column:
    """The pieces of a paragraph."""
    if not ends:
        return F.array(text)
    parts = F.filter(F.split(text, ends[0]), lambda p: p != "")
    finer = F.flatten(F.transform(parts, lambda p: _cut(p, ends[1:])))
    return F.when(F.octet_length(text) > WIDEST, finer).otherwise(F.array(text))


def _numbered(paragraph: Column) -> Column:
    """(p, k) of all pieces of a paragraph, k counting equal ones from 0."""

    def runs(pieces: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(pieces) - 1)
        starts = F.filter(at, lambda i: (i == 0) | (F.get(pieces, i) != F.get(pieces, i - 1)))
        return F.get(F.transform(F.array(starts), lambda s: F.flatten(F.transform(s, run_of(pieces, s)))), F.lit(0))

    def run_of(pieces: Column, starts: Column):
        def run(start: Column, j: Column) -> Column:
            last = F.coalesce(F.get(starts, j + 1), F.size(pieces)) - start - 1
            return F.transform(
                F.sequence(F.lit(0), last), lambda k: F.struct(F.get(pieces, start).alias("p"), k.alias("k"))
            )

        return run

    several = F.get(F.transform(F.array(F.sort_array(_cut(paragraph, PIECE_ENDS))), runs), F.lit(0))
    one = F.array(F.struct(paragraph.alias("p"), F.lit(0).alias("k")))
    return F.when(F.octet_length(paragraph) > WIDEST, several).otherwise(one)


def paragraph_hashes(text: Column) -> Column:
    """The digests of a text's paragraphs and a struct of hashes for each of their pieces; none for an empty text."""

    def hashed(paragraphs: Column) -> Column:
        pieces = F.flatten(F.transform(paragraphs, _numbered))
        return F.struct(
            F.transform(paragraphs, lambda p: F.sha2(p.cast("binary"), 256)).alias("digests"),
            F.transform(
                pieces,
                lambda p: F.struct(
                    F.floor(F.sqrt(F.octet_length(p["p"]))).cast("long").alias("w"),
                    *[F.xxhash64(p["p"], p["k"], F.lit(seed)).alias(f"h{seed}") for seed in range(SEEDS)],
                ),
            ).alias("pieces"),
        )

    paragraphs = F.filter(F.split(text, PARAGRAPH_END), lambda p: p != "")
    return F.get(F.transform(F.array(paragraphs), hashed), F.lit(0))


def _sum(hashes: Column, value) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda total, h: total + value(h))


def _lanes(pieces: Column, seed: int, apart: int) -> Column:
    """The sums of the 64 one-bit lanes of a seed, in the order of the bits."""
    spread = F.lit(sum(1 << at for at in range(0, 64, apart)))
    packed = [
        _sum(pieces, lambda h, i=i: F.shiftrightunsigned(h[f"h{seed}"], i).bitwiseAND(spread) * h["w"])
        for i in range(apart)
    ]

    def lane(sums: Column, at: int) -> Column:
        return F.transform(sums, lambda x: F.shiftrightunsigned(x, at).bitwiseAND(F.lit((1 << apart) - 1)))

    bound = F.transform(F.array(F.array(*packed)), lambda sums: F.concat(*[lane(sums, k) for k in range(0, 64, apart)]))
    return F.get(bound, F.lit(0))


def vector(hashes: Column) -> Column:
    """The fingerprint as an array of longs: total weight, exact lanes, one-bit lanes."""
    return F.get(F.transform(F.array(hashes), _vector), F.lit(0))


def _vector(hashes: Column) -> Column:
    exact = [
        _sum(
            hashes["digests"],
            lambda digest, i=i: F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long"),
        ).bitwiseAND(F.lit((1 << 32) - 1))
        for i in range(EXACT)
    ]
    pieces = hashes["pieces"]
    weight = _sum(pieces, lambda h: h["w"])
    light, any_weight = (F.concat(*[_lanes(pieces, s, apart) for s in range(SEEDS)]) for apart in APART)
    return F.concat(F.array(weight, *exact), F.when(weight < 1 << 15, light).otherwise(any_weight))


def combined(a: Column, b: Column) -> Column:
    """The vector of two texts together."""
    return _mod(F.zip_with(a, b, lambda x, y: x + y))


def without(a: Column, b: Column) -> Column:
    """The vector of a text from which the paragraphs of ``b`` are taken away."""
    return _mod(F.zip_with(a, b, lambda x, y: x - y))


def _mod(sums: Column) -> Column:
    def power(i: Column) -> Column:
        exact = i.between(1, EXACT)
        return F.when(i == 0, F.lit(ROOM)).when(exact, F.lit((1 << 32) - 1)).otherwise(F.lit(ROOM))

    return F.transform(sums, lambda x, i: x.bitwiseAND(power(i)))


def printed(v: Column) -> Column:
    """The vector as text: sixteen hexadecimal digits a component."""
    return F.lower(F.array_join(F.transform(v, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def projections(v: Column) -> Column:
    """t = 2s - W of every one-bit lane."""
    def signed(v: Column) -> Column:
        n = F.get(v, F.lit(0))
        return F.transform(F.slice(v, 2 + EXACT, LANES), lambda x: (x * 2 - n).cast("double"))

    return F.get(F.transform(F.array(v), signed), F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two vectors, 0 to 1; 1 for equal ones, also for two empty texts."""

    def squares(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x)

    pa, pb = projections(a), projections(b)
    apart = squares(F.zip_with(pa, pb, lambda x, y: x - y))
    both = squares(pa) + squares(pb)
    close = F.when(both > 0, 1 - apart / both).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), close)))


def _range_of(docs: DataFrame, id_column: str, parts: int) -> Column:
    """Number of the range of ids a row is in, ascending with the id and from 1; 0 without id.

    Quantiles cut the ids into at most ``MOST_CUTS`` + 1 stretches of about equally many rows, each of which is divided
    evenly between its ends, so that the expression does not grow with the number of ranges.
    """
    ident = F.col(id_column)
    ends = docs.agg(F.min(id_column), F.max(id_column)).first()
    if ends[0] is None:
        return F.lit(0).cast("long")
    stretches = min(parts, MOST_CUTS + 1)
    shares = [i / stretches for i in range(1, stretches)]
    found = docs.approxQuantile(id_column, shares, 0.25 / stretches) if shares else []
    cuts = sorted({math.floor(x) for x in found if ends[0] <= math.floor(x) < ends[1]})
    each = math.ceil(parts / (len(cuts) + 1))
    edges = F.array(*[F.lit(c).cast("long") for c in (max(ends[0] - 1, -(1 << 63)), *cuts, ends[1])])
    stretch = F.greatest(F.size(F.filter(edges, lambda c: c < ident)) - 1, F.lit(0))
    low, high = (F.get(edges, stretch + i).cast("double") for i in (0, 1))
    step = F.floor((ident.cast("double") - low) / F.greatest(high - low, F.lit(1.0)) * each)
    within = F.greatest(F.lit(0), F.least(F.lit(each - 1), step))
    number = stretch.cast("long") * each + within + 1
    return F.when(ident.isNull(), F.lit(0).cast("long")).otherwise(number)


def with_next(
    docs: DataFrame, columns: Mapping[str, str], id_column: str = "doc_id", parts: int | None = None
) -> DataFrame:
    """Every row with columns of the next row by descending id; after the last row comes the first.

    ``columns`` maps columns to the names of their copies from the next row. The table is cut into
    ranges of ids; each range also gets the first row of the range below it, found beforehand, so no
    row's successor is in another range and nothing passes through one task. Rows without id come last.
    Rows of equal id follow each other by the copied columns.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    part, guest, extra, top, goes = (own(n) for n in ("part", "guest", "extra", "top", "goes"))
    number = _range_of(docs, id_column, parts)
    # Two numbers for each range, so many as there are partitions: small enough for one task and a broadcast.
    tops = docs.select(number.alias("range"), F.col(id_column).alias(top)).groupBy("range").agg(F.max(top).alias(top))
    upwards = Window.orderBy("range")
    around = upwards.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # A range's first row is also needed at the end of the range above, that of the highest at the end of the lowest.
    guests = tops.select(
        F.col("range").alias(own("range")),
        top,
        F.coalesce(F.lead("range").over(upwards), F.first("range").over(around)).alias(goes),
    )
    placed = docs.withColumn(part, number)
    same = (F.col(part) == F.col(guests.columns[0])) & F.col(id_column).eqNullSafe(F.col(top))
    stays = F.struct(F.col(part).alias("p"), F.lit(0).alias("g"))
    visits = F.struct(F.col(goes).alias("p"), F.lit(1).alias("g"))
    both = (
        placed.join(F.broadcast(guests), same, "left")
        .withColumn(extra, F.when(F.col(goes).isNull(), F.array(stays)).otherwise(F.array(stays, visits)))
        .select(*[f"`{c}`" for c in docs.columns], F.inline(extra).alias(part, guest))
    )
    window = Window.partitionBy(part).orderBy(
        F.col(guest), F.col(id_column).desc_nulls_last(), *[F.col(c) for c in columns]
    )
    following = {new: F.lead(F.col(old)).over(window) for old, new in columns.items()}
    return both.withColumns(following).where(F.col(guest) == 0).drop(part, guest)


def edit_comparison(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    In the edited text the last third of the code points (rounded down) is replaced by as many of the
    first ones of the next document by descending id, or all it has. Null counts as empty. Repeated rows
    are each a document. An empty table gives an empty result; a single document is its own successor.
    Other columns of ``docs`` are not returned.
    """
    spark = docs.sparkSession
    parts = partitions_for(spark, text_bytes(docs, text_column), 32 << 20)
    texts = docs.select(id_column, whole(text_column).alias("text"))
    hashed = texts.withColumn("hashes", paragraph_hashes(F.col("text")))
    printed_texts = hashed.select(id_column, "text", vector(F.col("hashes")).alias("v"))
    followed = with_next(printed_texts, {"text": "next_text", "v": "next_v"}, id_column, parts)
    k = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - k),
        F.substring(F.col("next_text"), F.lit(1), k),
    )
    return (
        followed.withColumn("n_chars", F.char_length("text").cast("long"))
        .withColumn("edited", edited)
        .withColumn("edited_hashes", paragraph_hashes(F.col("edited")))
        .select(
            id_column,
            "n_chars",
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            "v",
            "next_v",
            vector(F.col("edited_hashes")).alias("edited_v"),
        )
        .select(
            id_column,
            "n_chars",
            "edited_sha256",
            printed(F.col("v")).alias("fingerprint"),
            printed(F.col("edited_v")).alias("edited_fingerprint"),
            likeness(F.col("v"), F.col("edited_v")).alias("near_edited"),
            likeness(F.col("v"), F.col("next_v")).alias("near_next"),
        )
    )


"""Near-duplicates by fast similarity sketches, banding and exact verification.

1. A text is the set of its shingles. Its sketch has ``COORDINATES`` coordinates, filled in rounds: in round
   i every element is dealt to a coordinate by the round's own hash, with the value i plus a fraction, and a
   coordinate keeps the least value it ever gets. Rounds end when no coordinate is empty. From round
   ``COORDINATES`` on a round deals all elements to one coordinate each, so that every coordinate fills, for a
   set of one element too. A coordinate agrees in two sets with their similarity as probability, and
   the number that agree is as concentrated as for independent ones; long texts need one round, so the cost is
   their length plus COORDINATES * log(COORDINATES), not their product.
2. Equal sets are one node from here on. ``BANDS`` bands of ``ROWS`` coordinates each are hashed to index entries;
   nodes that share an entry are candidates. Two sets at the least similarity of 0.85 share no
   entry with a probability of (1 - 0.85^5)^32 = 7e-9; that is the only way a link can be lost.
3. The most popular node of an entry, by the sizes of all its entries, is its first pivot: a text that many others
   are copies of. All nodes of the entry are compared with it, linked ones are one component from then on, and
   the pivot leaves the entry, as it has met all others. A few more pivots follow. Entries of one component
   or one node are done.
4. Entries of more than ``HEAVY`` components are cut by the other bands of their nodes: texts that share a
   common passage, but no more, seldom agree in two bands. What is left is compared in blocks.
5. Pairs are confirmed by the intersection of their full sets, which are computed from the texts again, for
   candidates only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.links import with_links
from starmill.llm.set_links import Similarity, block_links, judged
from starmill.llm.text import Scratch, own
from starmill.llm.word_hash import Texts, mixed, run_hashes, small_batches, texts_of

NEAR = Similarity(words=3, percent=85)
ROWS, BANDS = 5, 32
COORDINATES = ROWS * BANDS
BATCH_BYTES = 4 << 20
#: Pivots of an entry in the second round of comparisons.
PIVOTS = 4
#: Components of an entry, beyond which it is cut by other bands.
HEAVY = 1024
_EMPTY = np.uint64(2**64 - 1)
_LOW = np.uint64(2**32 - 1)


def shingle_sets(texts: Texts, words: int) -> list[np.ndarray]:
    """Hashes of the distinct shingles of each text; fewer words are one shingle."""
    hashes, first = texts.word_hashes(lower=True)
    runs = run_hashes(hashes, words)
    sets = []
    for i in range(len(texts)):
        a, b = first[i], first[i + 1]
        if b - a >= words:
            sets.append(np.unique(runs[a : b - words + 1]))
        else:
            sets.append(run_hashes(hashes[a:b], int(b - a)) if b > a else np.zeros(0, dtype=np.uint64))
    return sets


def set_digest(tokens: np.ndarray) -> bytes:
    """128 bits that are equal for equal sets."""
    other = mixed(tokens ^ np.uint64(0x5851F42D4C957F2D))
    return np.array([tokens.sum(dtype=np.uint64), other.sum(dtype=np.uint64)]).tobytes()


def sketches(sets: list[np.ndarray], size: int = COORDINATES) -> np.ndarray:
    """A row of ``size`` coordinates for each set; those of an empty set stay at the largest value."""
    found = np.full((len(sets), size), _EMPTY, dtype=np.uint64)
    flat = found.reshape(-1)
    counts = np.array([len(s) for s in sets], dtype=np.int64)
    tokens = np.concatenate([np.zeros(0, dtype=np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets)), counts)
    active = np.flatnonzero(counts)
    for i in range(2 * size):
        if not len(active):
            break
        h = mixed(tokens + np.uint64((i + 1) * 0x9E3779B97F4A7C15 % 2**64))
        if i < size:
            place = ((h >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            place = i - size
        place = owner * size + place
        # A coordinate that an earlier round filled has a smaller value already.
        free = flat[place] >= np.uint64(i << 32)
        np.minimum.at(flat, place[free], np.uint64(i << 32) | (h[free] & _LOW))
        still = (found[active] == _EMPTY).any(axis=1)
        if not still.all():
            active = active[still]
            left = np.isin(owner, active)
            tokens, owner = tokens[left], owner[left]
    return found


def band_hashes(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash for each band of ``rows`` coordinates, different from band to band."""
    bands = sketch.reshape(len(sketch), -1, rows)
    h = np.broadcast_to(np.arange(1, bands.shape[1] + 1, dtype=np.uint64), bands.shape[:2])
    for k in range(rows):
        h = mixed(h * np.uint64(0xD6E8FEB86659FD93) + mixed(bands[:, :, k]))
    return h


def _sketched(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text", BATCH_BYTES):
        sets = shingle_sets(texts_of(batch.column("text")), words)
        bands = band_hashes(sketches(sets)).view(np.int64)
        filled = np.array([len(s) > 0 for s in sets])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("key"),
                pa.array([set_digest(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([b.tolist() if f else [] for b, f in zip(bands, filled)], pa.list_(pa.int64())),
            ],
            ["key", "digest", "n", "bands"],
        )


def _full_sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text", BATCH_BYTES):
        sets = [s for s in shingle_sets(texts_of(batch.column("text")), words) if len(s)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([set_digest(s) for s in sets], pa.binary()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ],
            ["made", "tokens"],
        )


def near_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    similarity: Similarity = NEAR,
    heavy: int = HEAVY,
) -> DataFrame:
    """Each row's id with n_shingles, the size of its set, component_id, the least id linked to it, and kept.

    A-Z are lower-cased; words are runs of other than blank and 0x09-0x0D. Null and texts without words
    have an empty set and link with nothing, also not with each other. Links are transitive. Repeated
    rows and equal sets are linked. Ids are cast to bigint. A null id is no id: its rows take the least id of
    their component, null if it has none. A row is kept if its id is that of its component, nulls among
    them; so rows without id are kept only where no row with an id is linked. Other columns are not read.
    An empty table gives an empty result. Bands are made for similarities of 0.85 and more.
    """
    scratch = Scratch(docs.sparkSession, "sketches")
    words = similarity.words
    keyed = docs.select(F.col(f"`{id_column}`").cast("long").alias("key"), F.col(f"`{text_column}`").alias("text"))
    sets = scratch.keep(
        keyed.mapInArrow(
            lambda batches: _sketched(batches, words), "key bigint, digest binary, n bigint, bands array<bigint>"
        )
    )
    nodes = scratch.keep(
        sets.where("n > 0")
        .groupBy("digest")
        .agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.min("key").alias("key"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    roots = _roots(nodes, keyed, similarity, heavy, scratch).select(F.col("node").alias("linked"), "root")
    rooted = nodes.join(roots, F.col("node") == F.col("linked"), "left").select(
        F.col("digest").alias("set_digest"), "key", F.coalesce("root", "node").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("key").alias("low"))
    of_set = rooted.select("set_digest", "root").join(least, "root").select("set_digest", "low")
    # Rows of one set are many only in a large group of copies, which adaptive execution splits.
    named = sets.select("key", "digest", "n").join(of_set, F.col("digest") == F.col("set_digest"), "left")
    low = F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("key"))
    return named.select(
        F.col("key").alias(id_column),
        F.col("n").alias("n_shingles"),
        low.alias("component_id"),
        F.col("key").eqNullSafe(low).alias("kept"),
    )


def _roots(nodes: DataFrame, keyed: DataFrame, similarity: Similarity, heavy: int, scratch: Scratch) -> DataFrame:
    """(node, root) of all nodes with confirmed links; not every linked pair is compared, but all are joined."""
    index = nodes.select(F.explode("bands").alias("entry"), "node", "n")
    sizes = index.groupBy("entry").agg(
        F.count("*").alias("size"), F.min("node").alias("low"), F.max("node").alias("high")
    )
    shared = sizes.where("low <> high").select(F.col("entry").alias("shared"), "size")
    met = scratch.keep(
        index.join(shared, F.col("entry") == F.col("shared")).select("entry", "node", "n", "size")
    )
    fame = met.groupBy("node").agg(F.sum("size").alias("fame"))
    met = met.join(fame.withColumnRenamed("node", "famous"), F.col("node") == F.col("famous"))
    open_entries = scratch.keep(met.select("entry", "node", "n", "fame", F.col("node").alias("root")))
    full = scratch.keep(_candidates(nodes, fame, keyed, similarity))

    roots = None
    for pivots in (1, PIVOTS):
        pivot = scratch.keep(_pivots(open_entries, pivots))
        pairs = _pairs(open_entries, pivot, similarity)
        found = scratch.keep(judged(pairs, full, similarity).where("similar").select("a", "b"))
        roots = with_links(roots, found, scratch)
        open_entries = scratch.keep(_still_open(open_entries, pivot, roots))
        if open_entries.isEmpty():
            return roots
    met_there = open_entries.select("entry", "root").distinct()
    counted = met_there.groupBy("entry").agg(F.count("*").alias("size"))
    large = counted.where(F.col("size") > heavy).select(F.col("entry").alias("large"))
    cut = open_entries.join(large, F.col("entry") == F.col("large"), "left")
    light = cut.where("large IS NULL").select("entry", "node", "n", "root")
    rest = scratch.keep(_of_several(light.unionByName(_cut_by_other_bands(cut.where("large IS NOT NULL"), nodes))))
    return with_links(roots, scratch.keep(block_links(rest, full, similarity)), scratch)


def _candidates(nodes: DataFrame, met: DataFrame, keyed: DataFrame, similarity: Similarity) -> DataFrame:
    """(node, n, tokens) of the nodes that share an entry, from the texts of one row of each."""
    chosen = nodes.join(met.select(F.col("node").alias("met")), F.col("node") == F.col("met"))
    chosen = chosen.select("node", "n", "digest", F.col("key").alias("chosen"))
    words = similarity.words
    # Several rows may have the id of the chosen one; their digests tell them apart.
    texts = keyed.join(chosen.select("chosen").distinct(), F.col("key").eqNullSafe(F.col("chosen")), "left_semi")
    made = texts.select("text").mapInArrow(lambda batches: _full_sets(batches, words), "made binary, tokens binary")
    full = made.join(chosen, F.col("made") == F.col("digest")).groupBy("node")
    return full.agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))


def _pivots(entries: DataFrame, pivots: int) -> DataFrame:
    """The most popular nodes of each entry."""
    if pivots == 1:
        best = F.max(F.struct("fame", "node", "n", "root")).alias("p")
        chosen = entries.groupBy("entry").agg(best).select("entry", "p.node", "p.n", "p.root")
    else:
        place = F.row_number().over(Window.partitionBy("entry").orderBy(F.desc("fame"), F.desc("node")))
        chosen = entries.withColumn("place", place).where(F.col("place") <= pivots)
    return chosen.select(
        F.col("entry").alias("held"),
        F.col("node").alias("pivot"),
        F.col("n").alias("pivot_n"),
        F.col("root").alias("pivot_root"),
    )


def _pairs(entries: DataFrame, pivot: DataFrame, similarity: Similarity) -> DataFrame:
    """Pairs of a node and a pivot of an entry of it that are not of one component yet and may link."""
    near = (F.least("n", "pivot_n") * 100) >= (F.greatest("n", "pivot_n") * similarity.percent)
    return (
        entries.join(pivot, F.col("entry") == F.col("held"))
        .where((F.col("root") != F.col("pivot_root")) & near)
        .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
        .distinct()
    )


def _still_open(entries: DataFrame, pivot: DataFrame, roots: DataFrame) -> DataFrame:
    """Entries of several components, without their pivots, which have met all their nodes."""
    done = (F.col("entry") == F.col("held")) & (F.col("node") == F.col("pivot"))
    roots = roots.select(F.col("node").alias("linked"), F.col("root").alias("joined"))
    left = entries.join(pivot, done, "left_anti").drop("root")
    rooted = left.join(roots, F.col("node") == F.col("linked"), "left")
    return _of_several(rooted.select("entry", "node", "n", "fame", F.coalesce("joined", "node").alias("root")))


def _of_several(entries: DataFrame) -> DataFrame:
    """The entries whose nodes are of several components."""
    ends = entries.groupBy("entry").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return entries.join(ends.where("low <> high"), "entry", "left_semi")


def _cut_by_other_bands(entries: DataFrame, nodes: DataFrame) -> DataFrame:
    """Entries of the nodes that agree in a second band as well."""
    bands = nodes.select(F.col("node").alias("of"), F.explode("bands").alias("band"))
    both = entries.join(bands, F.col("node") == F.col("of")).where("band <> entry")
    pair = F.xxhash64(F.least("entry", "band"), F.greatest("entry", "band"))
    return both.select(pair.alias("entry"), "node", "n", "root").distinct()


def one_of_near_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: Similarity = NEAR
) -> DataFrame:
    """The rows of ``docs`` without those that a near copy of a smaller id stands for, unchanged.

    Rows that repeat one id stay or go together.
    """
    found = near_copies(docs.select(f"`{id_column}`", f"`{text_column}`"), id_column, text_column, similarity)
    gone = own("gone")
    dropped = found.where(~F.col("kept")).select(F.col(f"`{id_column}`").alias(gone)).distinct()
    ident = F.col(f"`{id_column}`").cast("long")
    return docs.join(dropped, ident.eqNullSafe(F.col(gone)), "left_anti")

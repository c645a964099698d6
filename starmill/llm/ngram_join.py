"""Similarity join of documents on word shingles, by token-combination prefixes.

A token is a shingle of ``words`` words. Two texts whose sets x, y link at similarity t share at least
ceil(t * |x|) tokens of x, so at most e = |x| - ceil(t * |x|) tokens of x may be missing in y.

1. ``shared_hashes`` counts every token over the table and tells each text which of its tokens occur
   elsewhere. Tokens of one text only need no index, and with more than e of them a text has no link.
2. Tokens are ordered rarest first. Rare tokens are one class, indexed singly. Frequent tokens
   are dealt by hash to classes in which only pairs of tokens are indexed. A prefix that holds p_1 rare
   tokens and p_c tokens of each frequent class is extended until p_1 + sum of max(0, p_c - 1) > e. If
   two linked sets shared no rare token and at most one token of each frequent class of the shorter
   prefix, more than e tokens would be missing: so they share an indexed token or pair.
   Sets of fewer than ``SMALL`` tokens are indexed singly. The number of classes depends on a set's
   size by powers of two; a set whose partners may fall in the next lower power is indexed for both.
3. Sets in one index entry are first compared with pivots of the entry only: one of each entry, then a
   few of a sample of the entries. Sets linked with a pivot are one component from then on, and entries
   within one component are done. So a large group of copies costs a few comparisons a member.
4. What is left are entries with several components. Their sets are dealt to blocks of about ``BLOCK``, sets
   of one component together and stray ones together; two blocks that meet in an entry are compared as a
   whole, but for sets of one component. No link between components is missed, and a pair of blocks is
   compared once, in however many entries its sets meet.
5. A pair is verified by the size of the intersection of its tokens.

Equal sets are one node from the start. Only ids, sets and links of texts with possible links are kept,
in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.llm.links import with_links
from starmill.llm.set_links import Similarity, block_links, judged
from starmill.llm.shared_hashes import PARTITION_HASHES, Hashed, shared_hashes
from starmill.llm.text import Scratch, own, partitions_for, text_bytes
from starmill.llm.word_hash import mixed, run_hashes, texts_of

WIDTH = 6
BYTES_PER_WORD = 6
#: Tokens in more texts than this are frequent.
RARE = 8
#: Smaller sets are indexed by single tokens only.
SMALL = 32
#: About so many frequent tokens of a prefix fall in one class.
CLASS_TOKENS = 2
#: Rounds of comparisons with pivots: which share of the entries, and how many pivots of each.
STAR_ROUNDS = ((1, 1), (8, 4), (32, 16))


def shingle_sets(batch: pa.RecordBatch, words: int) -> Hashed:
    """The distinct shingles of each text; a text of fewer words has all of them as one shingle."""
    hashes, first = texts_of(batch.column("text")).word_hashes(lower=True)
    runs = run_hashes(hashes, words)
    sets, names = [], []
    for i, key in enumerate(batch.column("key").to_pylist()):
        a, b = first[i], first[i + 1]
        if b - a >= words:
            own_set = np.unique(runs[a : b - words + 1])
        elif b > a:
            own_set = run_hashes(hashes[a:b], int(b - a))
        else:
            own_set = np.zeros(0, dtype=np.uint64)
        digest = np.array(
            [own_set.sum(dtype=np.uint64), mixed(own_set ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)]
        )
        names.append(key.to_bytes(8, "little", signed=True) + digest.tobytes())
        sets.append(own_set)
    counts = np.array([len(s) for s in sets], dtype=np.int64)
    none = np.zeros(0, dtype=np.uint64)
    return Hashed(np.concatenate([none, *sets]), counts, counts, names)


SETS = T.StructType(
    [
        T.StructField("key", T.LongType()),
        T.StructField("node", T.BinaryType()),
        T.StructField("n", T.LongType()),
        T.StructField("rare", T.LongType()),
        T.StructField("tokens", T.BinaryType()),
    ]
)


def index_entries(n: int, rare: int, tokens: np.ndarray, similarity: Similarity) -> np.ndarray:
    """The index entries of a set of ``n`` tokens, of which ``tokens`` are shared, rarest first.

    The first ``rare`` of those are rare; the n - len(tokens) tokens of this set alone precede them.
    """
    alone = n - len(tokens)
    missing = n - similarity.needed(n)
    entries = []
    if similarity.needed(n) < SMALL:
        # The set or a partner of it is small.
        entries.append(mixed(tokens[: max(0, missing + 1 - alone)] ^ np.uint64(1)))
    if n >= SMALL:
        for scale in {n.bit_length(), similarity.needed(n).bit_length()}:
            entries.append(_scaled(alone, rare, tokens, missing, scale))
    return np.unique(np.concatenate(entries))


def _scaled(alone: int, rare: int, tokens: np.ndarray, missing: int, scale: int) -> np.ndarray:
    """Entries with as many frequent classes as sets of ``scale`` bits of size have."""
    salt = np.uint64(scale * 2 + 1000)
    single = tokens[: max(0, min(rare, missing + 1 - alone))]
    parts = [mixed(mixed(single) + salt)]
    left = missing + 1 - alone - rare
    if left > 0:
        classes = max(1, int((1 << scale) / (4 * CLASS_TOKENS)))
        frequent = tokens[rare:]
        kind = (mixed(frequent ^ np.uint64(0xA5A5)) % np.uint64(classes)).astype(np.int64)
        # A class's first token adds nothing to the bound, each later one adds one.
        order = np.argsort(kind, kind="stable")
        opening = np.zeros(len(kind), dtype=bool)
        opening[order[np.flatnonzero(np.diff(kind[order], prepend=-1))]] = True
        gained = np.cumsum(~opening)
        end = int(np.searchsorted(gained, left)) + 1
        kind, frequent = kind[:end], frequent[:end]
        for c in np.unique(kind):
            mine = mixed(frequent[kind == c])
            if len(mine) > 1:
                i, j = np.triu_indices(len(mine), 1)
                low, high = np.minimum(mine[i], mine[j]), np.maximum(mine[i], mine[j])
                parts.append(mixed(mixed(low) + mixed(high ^ np.uint64(0x77)) * np.uint64(3) + salt))
    return np.concatenate(parts)


def shingle_components(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    similarity: Similarity = Similarity(),
) -> DataFrame:
    """Each row's id with n_shingles, the size of its set, and component_id, the least id linked to it.

    A-Z are lower-cased; words are runs of other than blank and 0x09-0x0D. Null and texts without words
    have an empty set and link with nothing, also not with each other. Links are transitive. Repeated
    rows and equal sets are linked. Ids are cast to bigint, so texts that are no numbers raise. A null id is no
    id, and neither is -2^63: such rows take the least id of their component.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram")
    words = text_bytes(docs, text_column) // BYTES_PER_WORD
    partitions = partitions_for(spark, words, PARTITION_HASHES)
    least = similarity

    def hashed(batch: pa.RecordBatch) -> Hashed:
        return shingle_sets(batch, least.words)

    def finish(name: bytes, n: int, hashes: np.ndarray, totals: np.ndarray) -> tuple:
        key = int.from_bytes(name[:8], "little", signed=True)
        if not n or len(hashes) < least.needed(n):
            return key, name[8:], n, 0, None
        order = np.lexsort((hashes, totals))
        return key, name[8:], n, int((totals <= RARE).sum()), hashes[order].tobytes()

    keyed = docs.select(
        F.col(id_column).cast("long").alias("key0"), F.col(f"`{text_column}`").alias("text")
    )
    null_id = -(1 << 63)
    sets = scratch.keep(
        shared_hashes(
            keyed.select(F.coalesce("key0", F.lit(null_id)).alias("key"), "text"),
            hashed,
            finish,
            SETS,
            partitions,
            WIDTH,
        )
    )
    nodes = scratch.keep(
        sets.where("tokens IS NOT NULL")
        .groupBy("node")
        .agg(*[F.first(c).alias(c) for c in ("n", "rare", "tokens")])
    )

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                found = index_entries(
                    row["n"], row["rare"], np.frombuffer(row["tokens"], dtype=np.uint64), least
                )
                if len(found):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(found.view(np.int64)),
                            pa.array([row["node"]] * len(found), pa.binary()),
                            pa.array(np.full(len(found), row["n"])),
                        ],
                        ["entry", "node", "n"],
                    )

    index = nodes.mapInArrow(entries, "entry bigint, node binary, n bigint")
    roots = _linked(index, nodes, similarity, scratch).withColumnRenamed("node", "linked_node")
    named = sets.select("key", "node", "n").join(
        roots, F.col("node") == F.col("linked_node"), "left"
    )
    named = named.select("key", "n", F.coalesce("root", "node").alias("root"))
    lowest = (
        named.where((F.col("n") > 0) & (F.col("key") != null_id))
        .groupBy("root")
        .agg(F.min("key").alias("low"))
        .withColumnRenamed("root", "low_root")
    )
    # Most components are one row; the join's large ones are split by adaptive execution.
    full = named.join(lowest, (F.col("root") == F.col("low_root")) & (F.col("n") > 0), "left")
    ident = F.when(F.col("key") != null_id, F.col("key"))
    return full.select(
        ident.alias(id_column),
        F.col("n").alias("n_shingles"),
        F.coalesce("low", ident).alias("component_id"),
    )


def _linked(index: DataFrame, nodes: DataFrame, similarity: Similarity, scratch: Scratch) -> DataFrame:
    """(node, root) of all nodes with verified links; not every linked pair is compared, but all are joined."""
    sizes = index.groupBy("entry").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    held = sizes.where("low <> high").select(F.col("entry").alias("held"))
    open_entries = scratch.keep(
        index.join(held, F.col("entry") == F.col("held")).select("entry", "node", "n", F.col("node").alias("root"))
    )
    roots = None
    for share, pivots in STAR_ROUNDS:
        some = open_entries.where(F.pmod(F.xxhash64("entry"), F.lit(share)) == 0)
        pairs = _pivot_pairs(some, pivots, similarity)
        found = scratch.keep(judged(pairs, nodes, similarity).where("similar").select("a", "b"))
        roots = with_links(roots, found, scratch)
        joined = roots.select(F.col("node").alias("linked"), F.col("root").alias("joined"))
        rooted = open_entries.drop("root").join(joined, F.col("node") == F.col("linked"), "left")
        rooted = rooted.select("entry", "node", "n", F.coalesce("joined", "node").alias("root"))
        several = (
            rooted.groupBy("entry")
            .agg(F.min("root").alias("low"), F.max("root").alias("high"))
            .where("low <> high")
            .select("entry")
        )
        open_entries = scratch.keep(rooted.join(several, "entry", "left_semi"))
        if open_entries.isEmpty():
            return roots
    return with_links(roots, scratch.keep(block_links(open_entries, nodes, similarity)), scratch)


def _pivot_pairs(entries: DataFrame, pivots: int, similarity: Similarity) -> DataFrame:
    """Pairs of a node and one of the first ``pivots`` nodes of its entry that may link and do not yet."""
    if pivots == 1:
        first = F.min(F.struct(F.xxhash64("node").alias("h"), "node", "n", "root")).alias("p")
        chosen = entries.groupBy("entry").agg(first).select("entry", "p.node", "p.n", "p.root")
    else:
        rank = F.row_number().over(Window.partitionBy("entry").orderBy(F.xxhash64("node"), "node"))
        chosen = entries.withColumn("rank", rank).where(F.col("rank") <= pivots).drop("rank")
    pivot = chosen.select(
        "entry", F.col("node").alias("pivot"), F.col("n").alias("pivot_n"), F.col("root").alias("pivot_root")
    )
    near = (F.least("n", "pivot_n") * 100) >= (F.greatest("n", "pivot_n") * similarity.percent)
    return (
        entries.join(pivot, "entry")
        .where((F.col("root") != F.col("pivot_root")) & near)
        .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
        .distinct()
    )


def one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: Similarity = Similarity()
) -> DataFrame:
    """The rows of ``docs`` without those that a linked row of a smaller id stands for.

    Rows of equal id stay or go together, and rows without id stay only where no row with an id is linked.
    """
    found = shingle_components(docs.select(id_column, text_column), id_column, text_column, similarity)
    gone_id = own("gone")
    gone = (
        found.where("component_id IS NOT NULL")
        .groupBy(F.col(id_column).alias(gone_id))
        .agg(F.min("component_id").alias("low"))
        .where(~F.col(gone_id).eqNullSafe(F.col("low")) & F.col(gone_id).isNotNull())
        .select(gone_id)
    )
    return docs.join(gone, F.col(id_column) == F.col(gone_id), "left_anti")

"""The prefix trie of conversations, with totals of every subtree by time-forward processing.

1. Turns are numbered and conversations rebuilt. Both, and the running hash of prefixes, are window functions within
   (conversation, band of turns) plus the sums of earlier bands, so no conversation is one task's work,
   however many of the rows it has. After the numbering texts are gone: a turn is 120 bits of its SHA-256.
2. A node is known by its depth and the exclusive or of its turns' hashes, each of them mixed with its place. One
   aggregation, combined before its shuffle, makes nodes of member rows; a node's parent is known by
   leaving out the last turn's hash.
3. Nodes are dealt to shards. A node with more members than a limit is heavy; there are at most rows / limit of
   them. Every other node belongs to the shard of its highest ancestor (or itself) that is not heavy and in the
   same band of levels. So a shard is a subtree slice of bounded members and levels.
4. Within shards: nodes are sorted externally by reverse level order (Spark's sort) and their totals passed to
   parents through a spilling priority queue (``time_forward``). Messages within a shard never leave its task.
5. Across shard roots: roots and heavy nodes form a contracted tree. Those without children in it are added up by
   parent, combined before the shuffle; what remains, heavy nodes and shards with others below them, is one
   more time-forward run. Shards below which other bands hang are then run again with what those send.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.text import Scratch, partitions_for
from starmill.llm.time_forward import NODE_COLUMNS, QUEUE, TOTALS, subtree_totals

WORD = r"[^\x20\x09-\x0D]+"
#: A conversation takes its first turns from the first one of its family.
FAMILY, HEADS = 20, 4
#: Levels of a band, and turns numbered at once, as a power of two.
BAND_BITS = 10
#: A node with more members is heavy, at the least; and how many heavy nodes there may be.
MEMBERS, HEAVY_NODES = 1024, 100_000
#: Nodes of a task.
TASK_NODES = 500_000
#: Ids hashed as one row, as a power of two.
ID_BITS = 8
NONE = hashlib.sha256().hexdigest()
KEY = ["depth", "h1", "h2"]


def _hex_long(digits: Column) -> Column:
    """Fifteen hexadecimal digits as a number."""
    return F.conv(digits, 16, 10).cast("long")


def numbered(turns: DataFrame, band_bits: int = BAND_BITS) -> DataFrame:
    """(conv, i, a1, a2, words): the turns of each conversation from 0, by turn (null first), then role and text.

    a1 and a2 are 120 bits of the SHA-256 of role and text, null counting as empty.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    # Bands of null turns come before all others.
    band = F.coalesce(F.shiftright(F.col("turn").cast("long"), band_bits), F.lit(-(1 << 62)))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), text.alias("text"), band.alias("band")
    )
    counts = rows.groupBy("conv", "band").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("conv").orderBy("band").rowsBetween(Window.unboundedPreceding, -1))
    before = counts.withColumn("before", earlier).where("before > 0").select("conv", "band", "before")
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    place = F.row_number().over(Window.partitionBy("conv", "band").orderBy(*order))
    body = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    digest = F.sha2(body.cast("binary"), 256)
    within = rows.withColumn("place", place).select(
        "conv", "band", "place", digest.alias("digest"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")
    )
    return within.join(before, ["conv", "band"], "left").select(
        "conv",
        (F.coalesce("before", F.lit(0)) + F.col("place") - 1).cast("long").alias("i"),
        _hex_long(F.substring("digest", 1, 15)).alias("a1"),
        _hex_long(F.substring("digest", 16, 15)).alias("a2"),
        "words",
    )


def rebuild_plan(rows: DataFrame) -> DataFrame:
    """(conv, h, head, taken, length): which turns each conversation takes from its family's first one.

    ``head`` holds those of them that exist, ``taken`` is their number, ``length`` that of all rebuilt turns.
    """
    heads = (
        rows.where((F.col("conv") % FAMILY == 0) & (F.col("i") < HEADS - 1))
        .groupBy(F.col("conv").alias("donor"))
        .agg(F.sort_array(F.collect_list(F.struct("i", "a1", "a2", "words"))).alias("turns"))
    )
    plan = rows.groupBy("conv").agg(F.count("*").alias("n"))
    plan = plan.withColumns(
        {
            "h": F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS,
            "donor": F.col("conv") - F.col("conv") % FAMILY,
        }
    ).join(heads, "donor", "left")
    none = F.array().cast("array<struct<i:bigint,a1:bigint,a2:bigint,words:bigint>>")
    head = F.slice(F.coalesce("turns", none), F.lit(1), F.col("h").cast("int"))
    plan = plan.select("conv", "h", "n", head.alias("head"))
    taken = F.size("head").cast("long")
    return plan.select(
        "conv", "h", "head", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")
    )


def sequences(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(conv, depth, a1, a2, words, length) of all rebuilt turns."""
    heads = plan.select("conv", "length", F.posexplode("head").alias("pos", "t")).select(
        "conv", (F.col("pos") + 1).cast("long").alias("depth"), "t.a1", "t.a2", "t.words", "length"
    )
    own = rows.join(plan.select("conv", "h", "taken", "length"), "conv").where(F.col("i") >= F.col("h"))
    own = own.select("conv", (F.col("taken") + F.col("i") - F.col("h") + 1).alias("depth"), "a1", "a2", "words", "length")
    return heads.unionByName(own)


def prefixes(turns: DataFrame, band_bits: int = BAND_BITS) -> DataFrame:
    """(conv, depth, h1, h2, x1, x2, words, last): each row with the hash of the prefix it ends and its own."""
    band = F.shiftright(F.col("depth") - 1, band_bits)
    rows = turns.select(
        "conv",
        "depth",
        *[F.xxhash64(F.lit(k), "depth", "a1", "a2").alias(f"x{k}") for k in (1, 2)],
        "words",
        "length",
        band.alias("band"),
    )
    so_far = Window.partitionBy("conv", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = (
        rows.where(F.col("length") > (1 << band_bits))
        .groupBy("conv", "band")
        .agg(F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"))
        .select("conv", "band", F.bit_xor("b1").over(earlier).alias("b1"), F.bit_xor("b2").over(earlier).alias("b2"))
        .where("band > 0")
    )
    hashed = rows.withColumns({f"w{k}": F.bit_xor(f"x{k}").over(so_far) for k in (1, 2)})
    whole = hashed.join(bands, ["conv", "band"], "left")
    return whole.select(
        "conv",
        "depth",
        *[F.col(f"w{k}").bitwiseXOR(F.coalesce(f"b{k}", F.lit(0))).alias(f"h{k}") for k in (1, 2)],
        "x1",
        "x2",
        "words",
        (F.col("depth") == F.col("length")).alias("last"),
    )


def ends_digests(ends: DataFrame, partitions: int) -> DataFrame:
    """(depth, h1, h2, ends_sha256) of the nodes at which conversations end.

    Ids of a node are sorted and joined in ranges, and the ranges are hashed in their order as a stream.
    """
    ids = F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))
    pieces = ends.groupBy(*KEY, F.shiftright("conv", ID_BITS).alias("range")).agg(F.array_join(ids, ",").alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []
        for batch in batches:
            for depth, h1, h2, ids in zip(*[batch.column(c).to_pylist() for c in (*KEY, "ids")]):
                if (depth, h1, h2) == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = (depth, h1, h2), hashlib.sha256(ids.encode())
            yield _digest_rows(out)
            out = []
        if node is not None:
            yield _digest_rows([(*node, state.hexdigest())])

    sorted_pieces = pieces.repartition(partitions, *KEY).sortWithinPartitions(*KEY, "range")
    return sorted_pieces.mapInArrow(hashed, "depth bigint, h1 bigint, h2 bigint, ends_sha256 string")


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], [*KEY, "ends_sha256"]
    )


def trie_nodes(
    turns: DataFrame, band_bits: int = BAND_BITS, members: int = MEMBERS, queue: int = QUEUE
) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations, the root included.

    ``turns`` needs conv_id, turn, role and text; other columns are not read. Rows without conv_id are left out. Turns
    of a conversation are ordered by turn, null first, equal turns by role and text; repeated rows are
    turns of their own. Null role or text is empty. conv_id is cast to bigint. An empty table gives an empty
    result. ``band_bits``, ``members`` and ``queue`` change the work's layout, not its result.
    """
    spark = turns.sparkSession
    scratch = Scratch(spark, "trie")
    rows = scratch.keep(numbered(turns, band_bits))
    plan = scratch.keep(rebuild_plan(rows))
    paths = scratch.keep(prefixes(sequences(rows, plan), band_bits))
    top = plan.agg(
        F.min("conv").alias("conv"), F.count("*").alias("n"), F.sum("length").alias("rows"), F.count_if(F.col("length") == 0).alias("ends")
    ).first()
    nodes = scratch.keep(_nodes(paths, top))
    limit = max(members, (top.rows or 0) // HEAVY_NODES)
    partitions = partitions_for(spark, nodes.count(), TASK_NODES)
    totals = _totals(nodes, paths, limit, band_bits, partitions, queue, scratch)
    ends = paths.where("last").select(*KEY, "conv").unionByName(
        plan.where("length = 0").select(*[F.lit(0).cast("long").alias(c) for c in KEY], "conv")
    )
    parents = nodes.select(
        F.col("depth").alias("up_depth"), F.col("h1").alias("up1"), F.col("h2").alias("up2"), F.col("conv").alias("parent_conv_id")
    )
    found = nodes.join(totals, KEY).join(ends_digests(ends, partitions), KEY, "left")
    # A parent of very many children is a join that adaptive execution splits.
    return found.join(parents, ["up_depth", "up1", "up2"], "left").select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NONE)).alias("ends_sha256"),
    )


def _nodes(paths: DataFrame, top: object) -> DataFrame:
    """(depth, h1, h2, up_depth, up1, up2, conv, n_convs, leaf, own): nodes with their own figures."""
    made = paths.groupBy(*KEY).agg(
        F.min("conv").alias("conv"),
        F.count("*").alias("n_convs"),
        F.count_if("last").alias("ends"),
        *[F.min(c).alias(c) for c in ("x1", "x2", "words")],
    )
    nodes = made.select(
        *KEY,
        (F.col("depth") - 1).alias("up_depth"),
        F.col("h1").bitwiseXOR(F.col("x1")).alias("up1"),
        F.col("h2").bitwiseXOR(F.col("x2")).alias("up2"),
        "conv",
        "n_convs",
        (F.col("ends") == F.col("n_convs")).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("own"),
    )
    if not top.n:
        return nodes
    zero = F.lit(0).cast("long")
    root = paths.sparkSession.range(1).select(
        *[zero.alias(c) for c in KEY],
        F.lit(-1).cast("long").alias("up_depth"),
        *[zero.alias(c) for c in ("up1", "up2")],
        F.lit(top.conv).cast("long").alias("conv"),
        F.lit(top.n).cast("long").alias("n_convs"),
        F.lit(int(top.ends == top.n)).cast("long").alias("leaf"),
        zero.alias("own"),
    )
    return nodes.unionByName(root)


def _run(nodes: DataFrame, partitions: int, by: list[str], queue: int) -> DataFrame:
    """Totals of nodes, those of equal ``by`` in one task; all in one without it."""
    dealt = nodes.repartition(partitions, *by) if by else nodes.repartition(1)
    ordered = dealt.sortWithinPartitions(F.desc("depth"), "h1", "h2").select(*NODE_COLUMNS)
    return ordered.mapInArrow(partial(subtree_totals, limit=queue), TOTALS)


def _totals(
    nodes: DataFrame, paths: DataFrame, limit: int, band_bits: int, partitions: int, queue: int, scratch: Scratch
) -> DataFrame:
    """(depth, h1, h2, children, leaves, saved) of every node."""
    deep = bool(nodes.where(F.col("depth") > (1 << band_bits)).limit(1).count())
    is_heavy = (F.col("n_convs") > limit) | (F.col("depth") == 0)
    # At most HEAVY_NODES, as each has a share of the rows; 24 bytes each.
    heavy = nodes.where(is_heavy & (F.col("depth") > 0)).select(*KEY)
    reach = paths.join(F.broadcast(heavy), KEY).groupBy("conv").agg(F.max("depth").alias("k"))
    reach = scratch.keep(reach)
    start = F.greatest(
        F.coalesce("k", F.lit(0)) + 1, F.shiftleft(F.shiftright(F.col("depth") - 1, band_bits), band_bits) + 1
    )
    # The prefixes at which shards begin, by conversation.
    starts = paths.join(reach, "conv", "left").where(F.col("depth") == start)
    starts = starts.select(
        F.col("conv").alias("of"), F.col("depth").alias("s"), F.col("h1").alias("s1"), F.col("h2").alias("s2")
    )
    zero = F.lit(0).cast("long")
    shaped = nodes.select(
        *KEY, "up_depth", "up1", "up2", zero.alias("children"), F.col("leaf").alias("leaves"), F.col("own").alias("saved"), "conv", "n_convs"
    )
    light = shaped.where(~is_heavy).join(reach, "conv", "left").withColumn("start", start)
    light = light.join(starts, (F.col("conv") == F.col("of")) & (F.col("start") == F.col("s"))).select(
        *shaped.columns, "k", "s", "s1", "s2", (F.col("depth") > F.col("s")).alias("sends")
    )
    light = scratch.keep(light)
    shard, up, figures = ["s", "s1", "s2"], ["up_depth", "up1", "up2"], [*KEY, "children", "leaves", "saved"]
    hung = [F.col(c).alias(f"node_{c}") for c in up]
    local = scratch.keep(_run(light, partitions, shard, queue))

    # The contracted tree: shard roots with their shards' totals, and heavy nodes with their own figures.
    roots = light.where("NOT sends").select(*KEY, *up, "conv", "k").join(local, KEY)
    above = F.shiftleft(F.shiftright(F.col("depth") - 2, band_bits), band_bits) + 1
    hangs = F.col("depth") > F.coalesce("k", F.lit(0)) + 1
    roots = roots.withColumn("hangs", hangs).withColumn("start", F.greatest(F.coalesce("k", F.lit(0)) + 1, above))
    on_heavy = roots.where("NOT hangs").select(*figures, *up, *hung, F.lit(False).alias("hangs"))
    tree = shaped.where(is_heavy).select(*figures, *up, *hung, F.lit(False).alias("hangs")).unionByName(on_heavy)
    if deep:
        # Roots of lower bands hang on a node within a shard, whose root stands for it in the tree.
        below = roots.where("hangs").join(starts, (F.col("conv") == F.col("of")) & (F.col("start") == F.col("s")))
        shard_keys = [F.col(a).alias(b) for a, b in zip(shard, up)]
        tree = tree.unionByName(below.select(*figures, *shard_keys, *hung, "hangs"))
    tree = scratch.keep(tree)
    parents = tree.select(*[F.col(a).alias(b) for a, b in zip(up, KEY)]).distinct()
    outer = tree.join(parents, KEY, "left_anti")
    sent = outer.groupBy(*[F.col(a).alias(b) for a, b in zip(up, KEY)]).agg(
        F.count("*").alias("c"), F.sum("leaves").alias("l"), F.sum("saved").alias("t")
    )
    more = {"children": "c", "leaves": "l", "saved": "t"}
    inner = tree.join(parents, KEY, "left_semi").join(sent, KEY, "left")
    inner = inner.withColumns({a: F.col(a) + F.coalesce(b, F.lit(0)) for a, b in more.items()})
    inner = inner.withColumn("sends", F.col("up_depth") >= 0)
    across = scratch.keep(_run(inner, 1, [], queue).unionByName(outer.select(*figures)))
    heavy_totals = across.join(shaped.where(is_heavy).select(*KEY), KEY, "left_semi")
    if not deep:
        return local.unionByName(heavy_totals)

    # Shards with others below them once more, with what those send to their nodes.
    sent_down = tree.where("hangs").select(
        *KEY, *[f"node_{c}" for c in up], *[F.col(a).alias(b) for a, b in zip(up, shard)]
    )
    sent_down = sent_down.join(across.select(*KEY, "leaves", "saved"), KEY)
    gained = sent_down.groupBy(*[F.col(f"node_{a}").alias(b) for a, b in zip(up, KEY)]).agg(
        F.count("*").alias("c"), F.sum("leaves").alias("l"), F.sum("saved").alias("t")
    )
    repeated = light.join(sent_down.select(*shard).distinct(), shard, "left_semi").join(gained, KEY, "left")
    repeated = repeated.withColumns({a: F.col(a) + F.coalesce(b, F.lit(0)) for a, b in more.items()})
    renewed = scratch.keep(_run(repeated, partitions, shard, queue))
    kept = local.join(renewed.select(*KEY), KEY, "left_anti")
    return kept.unionByName(renewed).unionByName(heavy_totals)

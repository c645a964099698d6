"""Exact duplicates by distributed MSD radix partitioning; no digest decides equality.

All texts start in one group. A round splits every group by the next bytes of its texts and sets aside
the rows that are alone or whose text has ended: an ended text is equal to all that share its group. A
digit is a run of successive bytes, four times wider each round, as fewer and fewer texts are left and
what is left is mostly copies: the rounds grow with the logarithm of the longest text.

The first round is one pass over the table that keeps the whole text only of rows that share their
first digit with others. Each later round reads and writes only what is still undecided, written to the
shared folder. A group's size and its largest id come from an aggregation that is combined before the
shuffle; they go back to its rows by a join that adaptive execution splits where a group is large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.text import Scratch, lower_ascii, own, whole

FIRST_DIGIT = 128
WIDENING = 4
WIDEST_DIGIT = 1 << 20


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row of ``docs`` with keep_id, group_size, kept and text_sha256 instead of its text.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the row
    with the largest id stays (null ids are smallest). Rows repeated with one id and one text are counted
    one by one and share the decision of their id. Columns named like the result's are replaced. An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "radix")
    result = ["keep_id", "group_size", "kept", "text_sha256"]
    others = [F.col(f"`{c}`") for c in docs.columns if c not in {text_column, *result}]
    body, digit, uid, group, following = (own(n) for n in ("body", "digit", "uid", "group", "next"))
    carried = [c for c in docs.columns if c not in {text_column, *result}] + ["text_sha256"]

    rows = docs.select(*others, lower_ascii(whole(text_column)).cast("binary").alias(body))
    rows = rows.withColumn(digit, F.substring(body, 1, FIRST_DIGIT))
    shared = (
        rows.groupBy(digit).agg(F.count("*").alias("n")).where("n > 1").select(F.col(digit).alias(group))
    )
    rows = rows.join(shared, F.col(digit) == F.col(group), "left")
    undecided = F.col(group).isNotNull()
    first = scratch.keep(
        rows.select(
            *[f"`{c}`" for c in carried if c != "text_sha256"],
            F.sha2(body, 256).alias("text_sha256"),
            F.when(undecided, F.col(body)).alias(body),
            F.monotonically_increasing_id().alias(uid),
        )
    )
    alone = first.where(F.col(body).isNull())
    done = [
        alone.select(
            *[f"`{c}`" for c in carried], F.col(id_column).alias("keep_id"), F.lit(1).cast("long").alias("group_size")
        )
    ]
    left = first.where(F.col(body).isNotNull()).withColumn(group, F.lit(0).cast("long"))
    width = FIRST_DIGIT
    while True:
        keyed = left.withColumn(digit, F.substring(body, 1, width))
        sizes = keyed.groupBy(group, digit).agg(
            F.count("*").alias("group_size"),
            F.max(id_column).alias("keep_id"),
            F.max(uid).alias(following),
        )
        split = keyed.alias("r").join(
            sizes.alias("s"),
            (F.col(f"r.{group}") == F.col(f"s.{group}")) & (F.col(f"r.{digit}") == F.col(f"s.{digit}")),
        )
        ended = (F.col("group_size") == 1) | (F.octet_length(F.col(f"r.{digit}")) < width)
        decided = scratch.keep(
            split.select(
                *[f"r.`{c}`" for c in carried],
                "keep_id",
                "group_size",
                F.when(~ended, F.expr(f"substring(r.{body}, {width + 1})")).alias(body),
                f"r.{uid}",
                F.col(following).alias(group),
            )
        )
        ready = decided.where(F.col(body).isNull())
        done.append(ready.select(*[f"`{c}`" for c in carried], "keep_id", "group_size"))
        left = decided.where(F.col(body).isNotNull())
        if left.isEmpty():
            break
        left = left.select(*[f"`{c}`" for c in carried], body, uid, group)
        width = min(width * WIDENING, WIDEST_DIGIT)
    union = done[0]
    for part in done[1:]:
        union = union.unionByName(part)
    kept = F.col(id_column).eqNullSafe(F.col("keep_id"))
    return union.withColumn("kept", kept).select(
        *[f"`{c}`" for c in carried if c != "text_sha256"], *result
    )


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text no row with a larger id repeats, unchanged.

    Rows that repeat one id and one text all stay or all go, as they share the decision.
    """
    groups = exact_groups(docs.select(id_column, text_column), id_column, text_column)
    gone_id, gone_text, digest = own("gone"), own("text"), own("digest")
    gone = (
        groups.where(~F.col("kept"))
        .select(F.col(id_column).alias(gone_id), F.col("text_sha256").alias(gone_text))
        .distinct()
    )
    same = F.col(id_column).eqNullSafe(F.col(gone_id)) & (F.col(digest) == F.col(gone_text))
    digests = F.sha2(lower_ascii(whole(text_column)).cast("binary"), 256)
    return docs.withColumn(digest, digests).join(gone, same, "left_anti").drop(digest)

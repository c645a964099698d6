"""The corpus pipeline: five stages over ``documents``, each on all its predecessor kept.

toxicity rejects documents, exact dedup and the n-gram join keep one of each group of copies, substring dedup
cuts repeated runs of words out of the texts, packing turns what is left into sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.exact_dedup import without_copies
from starmill.llm.ngram_join import one_of_each
from starmill.llm.packing import packed_sequences
from starmill.llm.queries import TOKENIZER, TOXIC_FROM, toxicity_model
from starmill.llm.substring_dedup import repeated_runs_removed
from starmill.llm.text import Scratch, own, table
from starmill.llm.toxicity import scored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the limit, by a model of the folder's labelled documents."""
    score = own("score")
    judged = scored(docs, toxicity_model(spark, sf_dir), score=score)
    return judged.where(F.col(score) < TOXIC_FROM).select(*[f"`{c}`" for c in docs.columns])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (A-Z lower-cased) the one with the largest id."""
    return without_copies(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar shingles the one with the smallest id."""
    return one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the runs of words that occur elsewhere too; n_chars follows."""
    cut = repeated_runs_removed(docs)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, length).otherwise(F.col("n_chars")))
    return cut.select(*[f"`{c}`" for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return packed_sequences(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_join", ngram_join),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: Training, components and packing are no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""One thin query for each operator: its whole table through the operator, as digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.conversation_trie import trie_nodes
from starmill.llm.exact_dedup import exact_groups
from starmill.llm.fingerprints import edit_comparison
from starmill.llm.host_reputation import Rule, judged_urls, path_of
from starmill.llm.near_copies import near_copies
from starmill.llm.ngram_join import shingle_components
from starmill.llm.packing import packed_sequences
from starmill.llm.sentencepiece_codec import with_pieces
from starmill.llm.substring_dedup import repeated_runs_removed
from starmill.llm.toxicity import Model, scored, trained
from starmill.llm.token_counts import with_token_counts
from starmill.llm.text import one_blank, table, whole
from starmill.llm.warc import archived_pages
from starmill.llm.whitening import whitened

URL_RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


PIECES = "piece_bpe_32k.model"
TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024
TOXIC_FROM = 0.7


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def toxicity_model(spark: SparkSession, folder: str) -> Model:
    """Fitted on the labelled documents that are not held out."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label"))
    texts = table(spark, folder, "documents").select("doc_id", "text")
    # One way to join, whatever the labels' size; rows that are held out never leave their scan.
    labels = labels.where(~held_out(F.col("doc_id"))).hint("merge")
    return trained(texts.where(~held_out(F.col("doc_id"))).join(labels, "doc_id").select("text", "label"))


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = scored(docs, toxicity_model(spark, folder))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = with_token_counts(docs, public_tokenizers.path(TOKENIZER))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packed_sequences(docs, public_tokenizers.path(TOKENIZER))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archived_pages(table(spark, folder, "pages"))


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return with_pieces(docs, public_tokenizers.path(PIECES))


def op3_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return shingle_components(table(spark, folder, "documents").select("doc_id", "text"))


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact_groups(table(spark, folder, "documents").select("doc_id", "text"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edit_comparison(table(spark, folder, "documents"))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = repeated_runs_removed(
        table(spark, folder, "documents").select("doc_id", "text"),
        shown=lambda text: F.sha2(one_blank(whole(text)).cast("binary"), 256),
    )
    return cut.select("doc_id", "n_words", "n_removed", F.col("text").alias("kept_sha256"))


def op10_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    """A page's outcome is the label of the document that its url numbers: bad if poor or toxic."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    outcomes = table(spark, folder, "labels").groupBy("doc_id").agg(F.max(bad).alias("outcome"))
    pages = table(spark, folder, "pages").select("page_id", "url")
    number = F.regexp_extract(path_of(F.col("url")), "/([0-9]{1,18})", 1)
    labelled = pages.withColumn("doc_id", F.when(number != "", number).cast("long")).join(
        outcomes, "doc_id", "left"
    )
    judged = judged_urls(labelled, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie_nodes(table(spark, folder, "conversations"))


def op12_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(table(spark, folder, "documents").select("doc_id", "text"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened(table(spark, folder, "embeddings").select("vec_id", "embedding"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_warc": op2_warc,
    "op3_ngram_join": op3_ngram_join,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_token_counts": op5_token_counts,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_packing": op7_packing,
    "op8_fingerprints": op8_fingerprints,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_host_reputation": op10_host_reputation,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_minhash": op12_minhash,
    "op13_whitening": op13_whitening,
}

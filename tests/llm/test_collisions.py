"""Texts that hashes confuse easily: the words of Thue and Morse share every polynomial modulo a power of two."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from starmill.llm import word_hash
from starmill.llm.ngram_join import shingle_components
from starmill.llm.packing import packed_sequences
from starmill.llm.sentencepiece_codec import with_pieces
from starmill.llm.shared_hashes import HASH_BYTES, Hashed, _sends, fitting_width, joined, shared_hashes, short_hash
from starmill.llm.substring_dedup import repeated_runs_removed
from starmill.llm.token_counts import with_token_counts
from tests.llm.corpus import corpus, words
from tests.llm.test_operators import BYTES, PIECES

SWAP = str.maketrans("ab", "ba")


def morse(length: int) -> str:
    word = "a"
    while len(word) < length:
        word += word.translate(SWAP)
    return word


@pytest.fixture(scope="module")
def pairs() -> list[tuple[int, str]]:
    found = []
    for i, length in enumerate((1024, 2048, 4096)):
        found += [(2 * i, morse(length)), (2 * i + 1, morse(length).translate(SWAP))]
    return found


def test_similar_and_counted(spark, pairs) -> None:
    docs = corpus(spark, pairs)
    assert all(r.component_id == r.doc_id and r.n_shingles == 1 for r in shingle_components(docs).collect())
    library = Tokenizer.from_file(BYTES)
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in pairs}
    assert {r.doc_id: r.n_tokens for r in with_token_counts(docs, BYTES).collect()} == {
        i: len(found) for i, found in ids.items()
    }
    crc = {i: zlib.crc32(np.array([*found, 1], dtype="<u4").tobytes()) for i, found in ids.items()}
    packed = packed_sequences(docs, BYTES).collect()
    assert {r.doc_id: r.ids_crc32 for r in packed if r.length == r.doc_tokens} == {
        i: c for i, c in crc.items() if len(ids[i]) < 2048
    }
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert {r.doc_id: r.ids for r in with_pieces(docs, PIECES, ids=True).collect()} == {
        i: model.encode(t) for i, t in pairs
    }


def test_repeated_runs(spark, pairs) -> None:
    """Documents that differ in their middle word only have no window of 35 words in common."""
    around = words(9, 40)
    texts = [(i, " ".join([*around[:20], t, *around[20:]])) for i, t in pairs]
    assert all(r.n_removed == 0 for r in repeated_runs_removed(corpus(spark, texts)).collect())


def test_runs_of_rows_that_share_a_key(spark, monkeypatch) -> None:
    """Columns that cannot be hashed are carried, and rows of one key lose no hit."""
    passages = [" ".join(words(20 + k, 40)) for k in range(3)]
    texts = [(i, f"{passages[i % 3]} tail {i}") for i in range(9)] + [(50, None), (51, "alone")]
    docs = corpus(spark, texts).withColumn("tags", F.create_map(F.lit("a"), F.col("doc_id")))
    expected = {i: 41 if i < 9 else 0 for i, _ in texts}
    found = repeated_runs_removed(docs).collect()
    assert {r.doc_id: r.n_removed for r in found} == expected and all(r.tags == {"a": r.doc_id} for r in found)
    monkeypatch.setattr("starmill.llm.substring_dedup.F.xxhash64", lambda *_: F.lit(7).cast("long"))
    assert {r.doc_id: r.n_removed for r in repeated_runs_removed(docs).collect()} == expected


def test_pieces_of_texts_with_the_models_blank(spark) -> None:
    rng = random.Random(6)
    texts = [(i, "".join(rng.choice(["▁", " ", "  ", "a", "the", "é", "日", "\n"]) for _ in range(rng.randint(0, 25)))) for i in range(1000)]
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = {r.doc_id: r for r in with_pieces(corpus(spark, texts), PIECES, ids=True).collect()}
    for i, t in texts:
        assert found[i].ids == model.encode(t), t
        assert found[i].round_trip == ("▁" not in t)


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_hashes_are_polynomials_modulo_the_prime(monkeypatch, block) -> None:
    """Whatever the blocks they are computed in."""
    monkeypatch.setattr(word_hash, "BLOCK", block)
    rng = random.Random(2)
    data = rng.randbytes(700)
    starts = np.sort(np.array([rng.randrange(600) for _ in range(50)]))
    ends = np.maximum.accumulate(starts + np.array([rng.randrange(0, 100) for _ in starts]))
    prime = word_hash.PRIME

    def slow(span: bytes) -> int:
        value = sum((b + 1) * pow(word_hash.BYTE_BASE, i, prime) for i, b in enumerate(span)) % prime
        return int(word_hash.mixed(np.array([value], dtype=np.uint64))[0])

    found = word_hash.span_hashes(np.frombuffer(data, dtype=np.uint8), starts, ends)
    assert found.tolist() == [slow(data[a:b]) for a, b in zip(starts, ends)]
    values = np.array([rng.randrange(1 << 64) for _ in range(300)], dtype=np.uint64)
    runs = word_hash.run_hashes(values, 7)
    for i in range(len(runs)):
        total = sum(int(values[i + k]) * pow(word_hash.WORD_BASE, k, prime) for k in range(7)) % prime
        assert runs[i] == word_hash.mixed(np.array([total + 7], dtype=np.uint64))[0]


def batch_of(texts: int, each: int, seed: int = 1) -> Hashed:
    rng = np.random.default_rng(seed)
    hashes = word_hash.mixed(rng.integers(0, 2**62, texts * each).astype(np.uint64))
    counts = np.full(texts, each)
    return Hashed(hashes, counts, counts, [i.to_bytes(8, "little") for i in range(texts)])


def test_what_is_sent_grows_with_the_texts_and_not_with_the_partitions() -> None:
    """Bytes of hashes and of whose they are, for 1,550 texts of 450 words, as a batch of given texts has."""

    def sent(partitions: int) -> int:
        rows = _sends(0, batch_of(1550, 450), partitions, fitting_width(partitions, 6))
        return sum(len(r[3]) + len(r[4]) + len(r[5]) for r in rows)

    assert max(sent(p) for p in (2000, 20_000)) < 2 * sent(200)


def test_partitions_beyond_two_bytes() -> None:
    """Every hash keeps its partition's number, and a hash its lowest bytes."""
    hashes = batch_of(10, 1000).hashes
    for partitions in (8, 65_536, 65_537, 100_000, 1 << 20):
        width = fitting_width(partitions, 6)
        part = short_hash(hashes, partitions, 6) >> np.uint64(8 * width)
        expected = [(int(h) >> 40) * partitions >> 24 for h in hashes]
        assert part.tolist() == expected and len(np.unique(short_hash(hashes, partitions, 6))) == len(hashes)
    rows = list(_sends(0, batch_of(10, 1000), 100_000, fitting_width(100_000, 6)))
    assert {r[0] for r in rows if r[2] == 0} == set(((hashes >> np.uint64(40)) * np.uint64(100_000) >> np.uint64(24)).tolist())


def test_texts_are_hashed_a_few_at_a_time(spark) -> None:
    """What a worker needs on the way grows with the texts it hashes at once, not with the batch it sends."""

    def hashed(batch) -> Hashed:
        assert batch.num_rows == 1 or sum(len(t) for t in batch.column("text").to_pylist()) <= HASH_BYTES
        hashes = np.array([hash(k) % 3 for k in batch.column("key").to_pylist()], dtype=np.uint64)
        counts = np.ones(batch.num_rows, dtype=np.int64)
        return Hashed(hashes, counts, counts, [k.to_bytes(8, "little") for k in batch.column("key").to_pylist()])

    def finish(name: bytes, figure: int, hashes: np.ndarray, totals: np.ndarray) -> tuple:
        return int.from_bytes(name, "little"), figure, totals.tolist()

    schema = T.StructType.fromDDL("key bigint, n bigint, totals array<bigint>")
    docs = spark.range(30, numPartitions=1).selectExpr("id AS key", f"repeat('x', {HASH_BYTES // 3}) AS text")
    found = shared_hashes(docs, hashed, finish, schema, 4, 6).collect()
    assert sorted((r.key, r.n, r.totals) for r in found) == [(i, 1, [10]) for i in range(30)]


def test_parts_are_joined_with_their_references() -> None:
    one, other = batch_of(3, 4), batch_of(2, 4, seed=2)
    one.reference, other.reference = one.hashes % 2 == 0, other.hashes % 2 == 0
    both = joined([one, other])
    assert both.hashes.tolist() == [*one.hashes, *other.hashes] and both.name == one.name + other.name
    assert both.reference.tolist() == (both.hashes % 2 == 0).tolist() and both.counts.tolist() == [4] * 5

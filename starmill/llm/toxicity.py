"""Toxicity scores by a counterfactually regularised classifier.

Features are the words of a text and their beginnings of four, five and six bytes, hashed, present or not.
Counts of every feature over all labelled texts choose those that tell the classes apart. A logistic
regression on them is fitted on a bounded sample of labelled texts, with a penalty on how the score of a
sentence moves when an identity term in it is replaced by another one of its list: a group's name
is then no evidence, however often it occurs in toxic sentences.

Counts, sentences and scores are Spark jobs; the driver gets the counts of hashed features (their number is
fixed) and the chosen features of the sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.llm.text import Scratch, own, ship, whole
from starmill.llm.word_hash import Texts, mixed, small_batches, span_hashes, texts_of

#: Neutral names of groups, by list; terms of one list replace each other.
IDENTITY_TERMS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("immigrant", "refugee", "foreigner", "citizen"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("muslime", "christen", "juden", "hindus", "buddhisten"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas"),
    ("mujeres", "hombres", "chicas", "chicos"),
)
#: Features are known by 40 bits, which leaves room for the number of a batch's text in the same 64.
SPACE = 1 << 40
#: Features that a task counts before it hands its counts on.
TASK_FEATURES = 1 << 19
BEGINNINGS = (4, 5, 6)
#: Texts that are looked at together: what is computed on the way takes over a hundred times their bytes.
BATCH_BYTES = 1 << 18
#: Words of the corpus that may be swapped, in how many texts at the least, and how many replace each other.
TERM = re.compile(r"\b[^\W\d_]{4,16}\b")
LEAST_TERM_TEXTS, TERMS_OF_A_LIST = 30, 6

#: Bytes that are no part of a word: ASCII other than letters and digits.
NOT_IN_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


@dataclass(frozen=True)
class Fit:
    """Bounds and strengths of the fit. ``sample`` bounds the labelled texts that the weights are fitted on and
    ``pairs`` the swapped sentences of those texts; counts of features use all labelled texts. ``corpus_terms`` is the
    number of neutral words of the corpus that are swapped beside the given terms."""

    sample: int = 12_000
    pairs: int = 20_000
    corpus_terms: int = 48
    features: int = 512
    least_texts: int = 3
    ridge: float = 1e-5
    counterfactual: float = 1.0
    steps: int = 1000


@dataclass(frozen=True)
class Model:
    """Hashed features, ascending, with weights; and the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def text_features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every word and word beginning, repeated as they occur."""
    texts = Texts(texts.data, texts.offsets, NOT_IN_WORD)
    start, end, first = texts.words()
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    if not len(start):
        return text, text
    data = np.where((texts.data >= 65) & (texts.data <= 90), texts.data + 32, texts.data).astype(np.uint8)
    found, owners = [], []
    for salt, length in enumerate((0, *BEGINNINGS)):
        long_enough = np.flatnonzero(end - start >= length)
        stop = start[long_enough] + length if length else end[long_enough]
        hashes = span_hashes(data, start[long_enough], stop)
        found.append((mixed(hashes + np.uint64(salt)) % np.uint64(SPACE)).astype(np.int64))
        owners.append(text[long_enough])
    return np.concatenate(owners), np.concatenate(found)


def present(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature), ordered."""
    text, feature = text_features(texts)
    both = np.unique(text * SPACE + feature)
    return both // SPACE, both % SPACE


def word_features(words: list[str]) -> np.ndarray:
    """The feature of each word as a whole."""
    texts = texts_of(pa.array(words, pa.string()))
    hashes = span_hashes(texts.data, texts.offsets[:-1], texts.offsets[1:])
    return (mixed(hashes) % np.uint64(SPACE)).astype(np.int64)


def identity_features(terms: Sequence[Sequence[str]]) -> np.ndarray:
    names = sorted({t for group in terms for t in group})
    return np.unique(present(texts_of(pa.array(names, pa.string())))[1]) if names else np.zeros(0, int)


def feature_counts(labelled: DataFrame) -> DataFrame:
    """(feature, texts, toxic) over all rows of (text, label)."""

    def rows(counts: list[np.ndarray]) -> pa.RecordBatch:
        feature, texts, toxic = (np.concatenate(c) for c in zip(*counts))
        unique, place = np.unique(feature, return_inverse=True)
        sums = [np.bincount(place, weights=c).astype(np.int64) for c in (texts, toxic)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (unique, *sums)], ["feature", "texts", "toxic"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = [], 0
        for batch in small_batches(batches, "text", BATCH_BYTES):
            label = batch.column("label").to_numpy(zero_copy_only=False).astype(bool)
            text, feature = present(texts_of(batch.column("text")))
            unique, place = np.unique(feature, return_inverse=True)
            counts.append((unique, np.bincount(place), np.bincount(place, weights=label[text])))
            held += len(unique)
            if held > TASK_FEATURES:
                yield rows(counts)
                counts, held = [], 0
        if held:
            yield rows(counts)

    counted = labelled.mapInArrow(count, "feature bigint, texts bigint, toxic bigint")
    return counted.groupBy("feature").agg(F.sum("texts").alias("texts"), F.sum("toxic").alias("toxic"))


def chosen_features(counts: DataFrame, n: int, toxic: int, fit: Fit, always: np.ndarray) -> np.ndarray:
    """The features of the greatest chi-square, and those of identity terms."""
    share = toxic / max(n, 1)
    expected = F.col("texts") * share
    spread = expected * (1 - share) * (1 - F.col("texts") / max(n, 1)) + 1e-9
    # How surely a feature is toxic counts beside how much it explains: rare telling words stay.
    off = F.col("toxic") - expected
    best = (
        counts.where(F.col("texts") >= fit.least_texts)
        .select("feature", (off * off / spread).alias("score"))
        .orderBy(F.desc("score"), "feature")
        .limit(fit.features)
        .collect()
    )
    return np.union1d(np.array([r.feature for r in best], dtype=np.int64), always).astype(np.int64)


def _positions(feature: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(features, feature), len(features) - 1)
    known = features[place] == feature
    return known, place[known]


def chosen_of(texts: Texts, features: np.ndarray) -> list[list[int]]:
    """Which of the features each text has."""
    text, feature = present(texts)
    known, place = _positions(feature, features)
    edges = np.searchsorted(text[known], np.arange(len(texts) + 1))
    return [place[edges[i] : edges[i + 1]].tolist() for i in range(len(texts))]


def neutral_terms(
    counts: DataFrame, sample: DataFrame, n: int, toxic: int, fit: Fit
) -> tuple[tuple[str, ...], ...]:
    """Lists of frequent words that texts of both labels hold alike, words of similar frequency together.

    Such words name what texts are about, as names of groups do; a score should not depend on which of them a
    sentence holds. Counts are of all labelled texts; the words themselves are looked up in the sample.
    """
    share = toxic / n
    off = F.abs(F.col("toxic") - F.col("texts") * share)
    alike = off <= F.sqrt(F.col("texts") * share * (1 - share))
    common = (F.col("texts") >= max(LEAST_TERM_TEXTS, n // 500)) & (F.col("texts") <= n // 4)
    # Beginnings of words are features too; most of them are found here and left out below.
    best = counts.where(common & alike).orderBy(F.desc("texts"), "feature").limit(8 * fit.corpus_terms).collect()
    rank = {r.feature: i for i, r in enumerate(best)}
    wanted = np.array(sorted(rank), dtype=np.int64)
    if not len(wanted):
        return ()

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH_BYTES):
            words = sorted({w for text in batch.column("text").to_pylist() for w in TERM.findall(text.lower())})
            feature = word_features(words)
            known = np.flatnonzero(np.isin(feature, wanted))
            yield pa.RecordBatch.from_arrays(
                [pa.array(feature[known]), pa.array([words[i] for i in known], pa.string())], ["feature", "word"]
            )

    found = sample.mapInArrow(spelled, "feature bigint, word string").distinct().collect()
    words = [r.word for r in sorted(found, key=lambda r: (rank[r.feature], r.word))][: fit.corpus_terms]
    return tuple(tuple(words[i : i + TERMS_OF_A_LIST]) for i in range(0, len(words), TERMS_OF_A_LIST))


def swapped_sentences(
    labelled: DataFrame, features: np.ndarray, terms: Sequence[Sequence[str]], pairs: int
) -> DataFrame:
    """(plus, minus): chosen features that a sentence gains and loses when its identity terms are swapped.

    A sentence has as many counterparts as its terms' lists have other terms: in each, every term is replaced
    by the one so many places further in its list. Sentences are drawn by a hash, for ``pairs`` counterparts.
    """
    place = {term: (group, i) for group in terms for i, term in enumerate(group)}
    turns = range(1, max((len(group) for group in terms), default=1))
    pattern = r"(?i)\b(" + "|".join(sorted(place, key=len, reverse=True)) + r")\b"
    sentences = labelled.select(F.explode(F.split("text", r"(?<=[.!?\n])")).alias("text"))
    named = sentences.where(F.col("text").rlike(pattern))
    named = named.orderBy(F.xxhash64("text"), "text").limit(max(1, pairs // max(1, len(turns))))
    find = re.compile(pattern)

    def turned(sentence: str, turn: int) -> str:
        def other(match: re.Match) -> str:
            group, i = place.get(match[0].lower(), ((match[0],), 0))
            return group[(i + turn) % len(group)]

        return find.sub(other, sentence)

    def swap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int32())
        for batch in batches:
            before = batch.column("text").to_pylist()
            own_features = chosen_of(texts_of(batch.column("text")), features)
            for turn in turns:
                after = pa.array([turned(s, turn) for s in before], pa.string())
                changed = chosen_of(texts_of(after), features)
                moved = [(sorted(set(y) - set(x)), sorted(set(x) - set(y))) for x, y in zip(own_features, changed)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m[0] for m in moved], kind), pa.array([m[1] for m in moved], kind)],
                    ["plus", "minus"],
                )

    moved = named.mapInArrow(swap, "plus array<int>, minus array<int>")
    return moved.where("size(plus) + size(minus) > 0")


def _matrix(rows: pa.ChunkedArray, width: int, sign: float = 1.0, out: np.ndarray | None = None) -> np.ndarray:
    """A row of ``width`` for each list of places, with ``sign`` there (in ``out``, if given)."""
    lists = rows.combine_chunks()
    if out is None:
        out = np.zeros((len(lists), width), dtype=np.float32)
    if len(lists):
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        out[np.repeat(np.arange(len(lists)), sizes), lists.flatten().to_numpy(zero_copy_only=False)] = sign
    return out


def largest_square(x: np.ndarray) -> float:
    """The largest eigenvalue of x'x, by repeated multiplication, from above."""
    v = np.ones(x.shape[1], dtype=np.float32)
    size = 0.0
    for _ in range(60):
        v = x.T @ (x @ (v / max(np.linalg.norm(v), 1e-30)))
        size = float(np.linalg.norm(v))
    return 1.05 * size


def fitted(x: np.ndarray, y: np.ndarray, moved: np.ndarray, fit: Fit) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated gradient steps; ``moved`` are rows whose score should be 0."""
    n, width = x.shape
    weights = np.zeros(width + 1)
    ahead, t = weights.copy(), 1.0
    pull = fit.counterfactual / max(len(moved), 1)
    # The column of ones for the bias adds n to the largest eigenvalue at most.
    steep = 0.25 * (largest_square(x) + n) / n + fit.ridge
    if len(moved):
        steep += 2 * pull * largest_square(moved)
    for _ in range(fit.steps):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead[:-1].astype(np.float32) + ahead[-1], -40, 40)))
        off = p - y
        slope = np.append((x.T @ off.astype(np.float32)).astype(float), off.sum()) / n
        slope[:-1] += fit.ridge * ahead[:-1]
        if len(moved):
            slope[:-1] += 2 * pull * (moved.T @ (moved @ ahead[:-1].astype(np.float32)))
        following = ahead - slope / steep
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = following + (t - 1) / t_next * (following - weights)
        weights, t = following, t_next
    return weights[:-1], float(weights[-1])


def trained(
    labelled: DataFrame, fit: Fit = Fit(), terms: Sequence[Sequence[str]] = IDENTITY_TERMS
) -> Model:
    """The model of all rows of ``labelled`` (text, label 0 or 1); null labels are left out.

    Without both labels every text scores the same.
    """
    scratch = Scratch(labelled.sparkSession, "labelled")
    # Read several times: stored once, so that whatever joined texts and labels is not done again.
    rows = scratch.keep(
        labelled.where("label IS NOT NULL").select(
            whole("text").alias("text"),
            F.col("label").cast("int").alias("label"),
            F.xxhash64("text", F.monotonically_increasing_id()).alias("draw"),
        )
    )
    total = rows.agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).first()
    n, toxic = total["n"], total["toxic"] or 0
    if not 0 < toxic < n:
        return Model(np.zeros(1, dtype=np.int64), np.zeros(1), -3.0 if not toxic else 3.0)
    counts = scratch.keep(feature_counts(rows))
    sample = scratch.keep(_drawn(rows, {0: n - toxic, 1: toxic}, fit.sample))
    terms = (*terms, *neutral_terms(counts, sample, n, toxic, fit))
    features = chosen_features(counts, n, toxic, fit, identity_features(terms))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH_BYTES):
            found = chosen_of(texts_of(batch.column("text")), features)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), batch.column("label")], ["found", "label"]
            )

    drawn = sample.mapInArrow(chosen, "found array<int>, label int").toArrow()
    pairs = swapped_sentences(sample, features, terms, fit.pairs).toArrow()
    x = _matrix(drawn.column("found"), len(features))
    y = drawn.column("label").to_numpy().astype(float)
    moved = _matrix(pairs.column("minus"), len(features), -1.0)
    moved = _matrix(pairs.column("plus"), len(features), 1.0, moved)
    scratch.clear()
    weights, bias = fitted(x, y, moved, fit)
    return Model(features, weights, bias)


def _drawn(rows: DataFrame, sizes: dict[int, int], bound: int) -> DataFrame:
    """At most ``bound`` rows by their draw, of each label its share, but both labels where there are any."""
    total = sum(sizes.values())
    parts = []
    for label, size in sizes.items():
        share = max(1, bound * size // total)
        # Draws are even: few rows beyond the share lie below this one, and only those are moved.
        below = min(1.0, (share + 5 * share**0.5 + 20) / size)
        drawn = rows.where(F.col("label") == label)
        if below < 1:
            drawn = drawn.where(F.col("draw") <= int((below - 0.5) * (2**64 - 2**12)))
        parts.append(drawn.orderBy("draw").limit(share))
    return parts[0].unionByName(parts[1]).select("text", "label")


def scored(docs: DataFrame, model: Model, text_column: str = "text", score: str = "score") -> DataFrame:
    """Every row of ``docs`` with its score appended, 0 to 1, higher: likelier toxic.

    Whole texts are scored, in one pass without a shuffle. Null and empty texts score the bias alone. Equal
    texts score the same. A column named like the score is replaced. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    others = [c for c in docs.columns if c != score]
    # Texts go through the workers once: as they are beside the row, not a second time within it.
    beside = text_column in others and docs.schema[text_column].dataType == T.StringType()
    row, body = own("row"), own("body")
    features, weights, bias = model.features, model.weights, model.bias

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH_BYTES):
            text, feature = text_features(texts_of(batch.column("text")))
            known, place = _positions(feature, features)
            both = np.unique(text[known] * len(features) + place)
            logit = bias + np.bincount(
                both // len(features), weights=weights[both % len(features)], minlength=batch.num_rows
            )
            values = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
            given = [batch.column(row), *([batch.column("text")] if beside else [])]
            yield pa.RecordBatch.from_arrays([*given, pa.array(values)], names)

    inside = [c for c in others if not (beside and c == text_column)]
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in inside], F.lit(0).alias(own("fill"))).alias(row),
        (F.col(f"`{text_column}`") if beside else whole(text_column)).alias("text"),
    )
    fields = [T.StructField(row, packed.schema[row].dataType), T.StructField(score, T.DoubleType())]
    if beside:
        fields.insert(1, T.StructField(body, T.StringType()))
    names = [f.name for f in fields]
    scores = packed.mapInArrow(judge, T.StructType(fields))
    back = [F.col(f"{row}.`{c}`" if c in inside else body).alias(c) for c in others]
    return scores.select(*back, score)

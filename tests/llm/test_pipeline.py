"""The corpus pipeline and the queries on small tables, against brute force and SQL."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from starmill.llm import word_hash
from starmill.llm.oracle import ORACLE
from starmill.llm.queries import QUERIES, TOXIC_FROM, op1_toxicity, toxicity_model
from starmill.llm.toxicity import BEGINNINGS, SPACE, Model, scored, word_features
from tests.compare import multiset
from tests.llm.corpus import corpus, rows, words
from tests.llm.tables import folder_of
from tests.llm.test_operators import BYTES, WORD, expected_components, lower

SMALL = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def labelled_rows() -> list[tuple[int, str]]:
    rude, calm = ["moron", "idiot", "scum"], ["lamp", "river", "stone"]
    return [
        (1000 + i, f"{' '.join(words(900 + i, 12))} a {(rude if i % 2 else calm)[i % 3]} and {(rude if i % 2 else calm)[i % 2]}.")
        for i in range(150)
    ]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory) -> str:
    """The odd corpus, labelled texts and one text that is toxic and not labelled."""
    texts = [*rows(), *labelled_rows(), (5000, "what a moron and an idiot and scum")]
    labels = spark.createDataFrame(
        [(i, 1, i % 2) for i, _ in labelled_rows()] + [(1001, None, None), (None, 1, 1), (999_999, 0, 1)],
        "doc_id bigint, quality int, toxic int",
    )
    return folder_of(tmp_path_factory.mktemp("corpus"), documents=corpus(spark, texts), labels=labels)


def documents(spark, folder: str):
    return spark.read.parquet(f"{folder}/documents.parquet")


def logit_of(text: str | None, model: Model) -> float:
    """The score of one text from its words, one by one."""
    found = set()
    for word in re.findall(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower(text).encode()):
        for salt, length in enumerate((0, *BEGINNINGS)):
            if len(word) >= length:
                part = np.frombuffer(word[:length] if length else word, dtype=np.uint8)
                h = word_hash.span_hashes(part, np.array([0]), np.array([len(part)]))
                found.add(int(word_hash.mixed(h + np.uint64(salt))[0]) % SPACE)
    weights = dict(zip(model.features.tolist(), model.weights.tolist()))
    return model.bias + sum(weights.get(f, 0.0) for f in found)


def test_toxicity_query_and_stage(spark, folder) -> None:
    docs, model = documents(spark, folder), toxicity_model(spark, folder)
    scores = {}
    for row in docs.collect():
        scores[row.doc_id, row.text] = 1 / (1 + math.exp(-max(-40, min(40, logit_of(row.text, model)))))
    texts = Counter((row.doc_id, row.text) for row in docs.collect())
    found = op1_toxicity(spark, folder).collect()
    assert len(found) == sum(texts.values())
    expected = sorted((i is None, i or 0, s) for (i, t), s in scores.items() for _ in range(texts[i, t]))
    for (none, i, score), row in zip(expected, sorted(found, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.score))):
        assert row.score == pytest.approx(score, abs=1e-9) and row.predicted == int(row.score >= TOXIC_FROM)
        assert row.held_out == (None if none else zlib.crc32(str(i).encode()) % 3 == 1)
    judged = {r.doc_id: r.predicted for r in found}
    assert judged[5000] == 1 and judged[1] == judged[5] == 0
    held = [i for i, _ in labelled_rows() if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([judged[i] == i % 2 for i in held]) > 0.9
    stage = STAGES["toxicity"](spark, docs, folder)
    assert stage.columns == docs.columns
    kept = Counter((r.doc_id, r.text) for r in stage.collect())
    assert kept == Counter({key: n for key, n in texts.items() if scores[key] < TOXIC_FROM})


def deduplicated(texts: list[tuple]) -> list[tuple]:
    keep: dict[str, int | None] = {}
    for i, t in texts:
        old = keep.setdefault(lower(t), i)
        keep[lower(t)] = max((x for x in (old, i) if x is not None), default=None)
    return [(i, t) for i, t in texts if i == keep[lower(t)]]


def one_of_linked(texts: list[tuple]) -> list[tuple]:
    gone = {i for i, _, low in expected_components(texts) if i is not None and low is not None and low < i}
    without = {i: low for i, _, low in expected_components(texts) if i is None}
    assert not any(without.values())
    return [(i, t) for i, t in texts if i not in gone]


def cut(texts: list[tuple]) -> list[tuple]:
    split = [WORD.findall(t or "") for _, t in texts]
    seen = Counter(tuple(w[k : k + 35]) for w in split for k in range(len(w) - 34))
    out = []
    for (i, t), w in zip(texts, split):
        gone = {k + d for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for d in range(35)}
        out.append((i, " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t))
    return out


def pairs(df) -> list[tuple]:
    return [(r.doc_id, r.text) for r in df.collect()]


def lengths(texts: list[tuple]) -> Counter:
    library = Tokenizer.from_file(BYTES)
    return Counter((i, len(library.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in texts)


def test_stages_and_run(spark, folder) -> None:
    docs = documents(spark, folder)
    kept = STAGES["toxicity"](spark, docs, folder)
    texts = pairs(kept)
    for name, brute in (("exact_dedup", deduplicated), ("ngram_join", one_of_linked), ("substring_dedup", cut)):
        stage = STAGES[name](spark, kept, folder)
        texts = brute(texts)
        assert stage.columns == docs.columns and Counter(pairs(stage)) == Counter(texts), name
        kept = spark.createDataFrame(stage.collect(), docs.schema)
    changed = {i for (i, t), (_, u) in zip(sorted(pairs(kept), key=str), sorted(texts, key=str)) if t != u}
    assert not changed
    assert all(r.n_chars is None or r.n_chars == len(r.text) for r in kept.where("text IS NOT NULL").collect())
    packed = corpus_pipeline.run(spark, folder).collect()
    pieces: Counter = Counter()
    for p in packed:
        pieces[p.doc_id, p.doc_tokens] += p.length
    assert Counter({key: n // key[1] for key, n in pieces.items()}) == lengths(texts)


def test_stages_on_an_empty_table(spark, folder) -> None:
    none = documents(spark, folder).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).collect() == [], name


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name) -> None:
    """Every query on the smallest given tables, against its SQL where there is some."""
    df = QUERIES[name](spark, SMALL)
    found = multiset(df.columns, [tuple(r) for r in df.collect()])
    assert found
    if name in ORACLE:
        con = duckdb.connect()
        for file in Path(SMALL).glob("*.parquet"):
            con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        result = con.execute(ORACLE[name])
        columns = [d[0] for d in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert multiset(columns, result.fetchall()) == found


def test_texts_pass_the_workers_once_when_scored(spark) -> None:
    docs = spark.createDataFrame([(1, None, 7), (2, "", 8), (3, "a moron", 9)], "doc_id bigint, text string, n int")
    model = Model(word_features(["moron"]), np.array([2.0]), -1.0)
    found = scored(docs, model)
    assert "text, text#" not in found._jdf.queryExecution().analyzed().toString()
    low, high = 1 / (1 + math.e), 1 / (1 + 1 / math.e)
    rows = [(r.doc_id, r.text, r.n, round(r.score, 9)) for r in found.orderBy("doc_id").collect()]
    assert rows == [(1, None, 7, round(low, 9)), (2, "", 8, round(low, 9)), (3, "a moron", 9, round(high, 9))]
    assert found.columns == ["doc_id", "text", "n", "score"]
    other = scored(docs.select(docs.n.cast("string").alias("body"), "text"), model, "body", "text")
    assert other.columns == ["body", "text"] and {round(r.text, 9) for r in other.collect()} == {round(low, 9)}

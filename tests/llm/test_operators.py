"""Each operator against a brute-force version, on odd rows, and on an empty table."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starmill.llm.exact_dedup import exact_groups, without_copies
from starmill.llm.fingerprints import (
    combined,
    edit_comparison,
    likeness,
    paragraph_hashes,
    printed,
    vector,
    with_next,
    without,
)
from starmill.llm.host_reputation import Rule, judged_urls, site_levels
from starmill.llm.ngram_join import one_of_each, shingle_components
from starmill.llm.packing import Pattern, packed_sequences, packing_plan
from starmill.llm.sentencepiece_codec import with_pieces
from starmill.llm.substring_dedup import repeated_runs_removed
from starmill.llm.text import SHUFFLES_END
from starmill.llm.token_counts import huge_count, with_token_counts
from starmill.llm.toxicity import Fit, scored, trained
from starmill.llm.warc import WarcError, archive_bytes, archive_records, archived_pages, parsed_record, written_record
from tests.llm.corpus import corpus, rows

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


@pytest.fixture(scope="module")
def docs(spark):
    return corpus(spark)


def lower(text: str | None) -> str:
    return (text or "").translate(LOWER)


def test_exact_groups(docs) -> None:
    low = [(i, lower(t)) for i, t in rows()]
    size = Counter(t for _, t in low)
    keep = {t: max((i for i, u in low if u == t and i is not None), default=None) for _, t in low}
    expected = Counter(
        (i, keep[t], size[t], i == keep[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in low
    )
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(tuple(r[c] for c in names) for r in exact_groups(docs).collect()) == expected
    kept = without_copies(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        (i, t) for i, t in rows() if i == keep[lower(t)]
    )


def shingles(text: str | None) -> frozenset:
    found = WORD.findall(lower(text))
    if len(found) < 5:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4))


def expected_components(pairs: list[tuple[int | None, str | None]]) -> Counter:
    sets = [(i, shingles(t)) for i, t in pairs]
    top = list(range(len(sets)))

    def root(x: int) -> int:
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                top[root(a)] = root(b)
    least: dict[int, int | None] = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            old = least.get(root(k))
            least[root(k)] = i if old is None else min(i, old)
    return Counter((i, len(s), least.get(root(k)) if s else i) for k, (i, s) in enumerate(sets))


def test_shingle_components(docs) -> None:
    found = shingle_components(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, found)) == expected_components(rows())
    stay = one_of_each(docs)
    assert stay.columns == docs.columns
    ids = {r.doc_id for r in stay.collect()}
    assert {1, 7, 12, None} <= ids and not {2, 8} & ids


def test_shingle_components_of_many_near_copies(spark) -> None:
    """Chains of texts that link with some of their group only."""
    import random

    rng = random.Random(4)
    base = [f"w{i}" for i in range(160)]
    many = []
    for i in range(150):
        text = list(base)
        for at in rng.sample(range(160), rng.randint(0, 5)):
            text[at] = f"x{rng.randint(0, 999)}"
        many.append((i, " ".join(text)))
    many += [(500 + i, " ".join(f"s{k}" for k in range(i % 3, 30 + i % 7))) for i in range(40)]
    found = shingle_components(corpus(spark, many)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == expected_components(many)


def test_repeated_runs_removed(docs) -> None:
    texts = [(i, WORD.findall(t or "")) for i, t in rows()]
    seen = Counter(tuple(w[k : k + 35]) for _, w in texts for k in range(len(w) - 34))
    expected: Counter = Counter()
    for (i, w), (_, text) in zip(texts, rows()):
        gone = {k + d for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for d in range(35)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        expected[i, len(w), len(gone), kept if gone else text] += 1
    found = repeated_runs_removed(docs)
    assert found.columns == [*docs.columns, "n_words", "n_removed"]
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in found.collect()) == expected


def shuffle_files(spark) -> set[str]:
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}


def test_repeated_runs_leave_no_shuffle_files(spark, docs, monkeypatch) -> None:
    """What a step shuffled goes when it ends, without waiting for any garbage to be collected."""
    monkeypatch.setattr("starmill.llm.substring_dedup.release", lambda _: None, raising=False)
    monkeypatch.setattr("starmill.llm.substring_dedup.text_bytes", lambda *_: 1000)  # its sum is shuffled, too
    setting = spark.conf.get(SHUFFLES_END)
    before = shuffle_files(spark)
    cut = repeated_runs_removed(docs)
    ends = time.monotonic() + 20
    while shuffle_files(spark) - before and time.monotonic() < ends:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(SHUFFLES_END) == setting
    # The steps before the last one are not run again with it.
    assert "hand_out" not in cut._jdf.queryExecution().optimizedPlan().toString()
    assert any(r.n_removed for r in cut.collect())


def test_token_counts(docs) -> None:
    library = Tokenizer.from_file(BYTES)
    expected = Counter(
        (i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows()
    )
    found = with_token_counts(docs, BYTES, chunk=3000, overlap=16)
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in found.collect()) == expected
    for text in ("y" * 9000, " a\n\n b" * 900, "<|endoftext|>" * 300, "don't " * 500 + "é" * 3000):
        for chunk, overlap in ((200, 16), (500, 64)):
            assert huge_count(text, BYTES, chunk, overlap) == len(library.encode(text, add_special_tokens=False).ids)


def test_pieces(docs) -> None:
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = Counter((i, tuple(library.encode(t or ""))) for i, t in rows())
    found = with_pieces(docs, PIECES, ids=True).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in found) == expected
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in found)


def test_packing(docs) -> None:
    library = Tokenizer.from_file(BYTES)
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows() if i != 7 and i}
    found = packed_sequences(docs, BYTES).toPandas()
    for p in found[found.doc_id.notna() & (found.doc_id != 7)].itertuples():
        piece = np.array(ids[p.doc_id][p.start : p.start + p.length], dtype="<u4")
        assert len(piece) == p.length and zlib.crc32(piece.tobytes()) == p.ids_crc32
        assert p.doc_tokens == len(ids[p.doc_id])
    once = found[found.doc_id.isin(list(ids))]
    assert once.length.sum() == sum(map(len, ids.values()))
    assert len(found[found.doc_id == 7]) == 3 and len(found[found.doc_id.isna()]) == 2
    ordered = found.sort_values(["sequence_id", "offset"])
    runs = ordered.groupby("sequence_id").length
    assert (ordered.offset == runs.cumsum() - ordered.length).all() and runs.sum().max() <= 2048
    assert set(found.sequence_id) == set(range(found.sequence_id.nunique()))


def test_packing_plan_is_exact_and_tight() -> None:
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 65, 4000)
    histogram = {int(k): int((lengths == k).sum()) for k in np.unique(lengths)}
    plan = packing_plan(histogram, 64)
    made: Counter = Counter()
    for p in plan:
        assert sum(c * k for c, k in p.pieces.items()) <= 64
        for c, k in p.pieces.items():
            made[c] += p.count * k
    assert made == Counter(histogram)
    used = sum(p.count for p in plan)
    assert used * 64 <= 1.02 * lengths.sum() + 64
    assert packing_plan({}, 256) == [] and packing_plan({256: 3}, 256) == [Pattern(3, {256: 1})]


def test_fingerprints(docs, spark) -> None:
    texts = sorted(
        ((i, t or "") for i, t in rows()), key=lambda x: (x[0] is None, -(x[0] or 0), x[1])
    )
    expected: Counter = Counter()
    for k, (i, t) in enumerate(texts):
        n = len(t) // 3
        edited = t[: len(t) - n] + texts[(k + 1) % len(texts)][1][:n]
        expected[i, len(t), hashlib.sha256(edited.encode()).hexdigest()] += 1
    found = edit_comparison(docs).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == expected
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    prints = {r.fingerprint for r in found if r.doc_id == 7}
    assert len(prints) == 1
    one = spark.createDataFrame([("a. b!\nc? rest", "c? rest a. b!\n", "a. b!\n", "c? rest")], "x string, y string, p string, q string")
    v = {c: vector(paragraph_hashes(F.col(c))) for c in "xypq"}
    row = one.select(
        (v["x"] == combined(v["p"], vector(paragraph_hashes(F.lit("c? rest"))))).alias("added"),
        (without(v["x"], v["q"]) == v["p"]).alias("deleted"),
        printed(v["x"]).alias("x"),
        printed(v["y"]).alias("y"),
    ).first()
    assert row.x != row.y  # " a." is not "a."
    swapped = spark.createDataFrame([("a.b!", "b!a.")], "x string, y string")
    assert swapped.select(vector(paragraph_hashes(F.col("x"))) == vector(paragraph_hashes(F.col("y")))).first()[0]
    assert row.added and row.deleted


def test_likeness_of_texts_of_several_megabytes(spark) -> None:
    """Two thirds of equal short lines are kept; weights sum up to more than 2^20."""
    n = 220_000
    line = "a line of short words ok\n"
    other = "".join(f"{i:024d}\n" for i in range(n // 3))
    frame = spark.createDataFrame([(line * n,), (line * (n - n // 3) + other,)], "text string")
    hashed = frame.select(paragraph_hashes(F.col("text")).alias("hashes"))
    vectors = [r[0] for r in hashed.select(vector(F.col("hashes"))).collect()]
    pair = spark.createDataFrame([tuple(vectors)], "a array<bigint>, b array<bigint>")
    # Squares of n equal lines are n^2, those of n other lines n.
    assert abs(pair.select(likeness(F.col("a"), F.col("b"))).first()[0] - (1 - 1 / 13)) < 0.02


def test_likeness_without_sentence_ends(spark) -> None:
    """Two thirds of one long paragraph stay: words, repeated words, unspaced and spaced scripts, one letter."""
    rng = random.Random(5)
    letters = {"han": [chr(0x4E00 + i) for i in range(900)], "faces": [chr(0x1F600 + i) for i in range(60)]}
    kinds = {
        "words": " ".join("".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(2, 9))) for _ in range(300)),
        "repeated": "buying " * 200 + "then " * 200,
        "greek": " ".join("".join(rng.choices("αβγδεζηθικλμ", k=6)) for _ in range(200)),
        "han": "".join(rng.choices(letters["han"], k=600)),
        "faces": "".join(rng.choices(letters["faces"], k=600)),
        "hexadecimal": "".join(rng.choices("0123456789abcdef", k=1500)),
        "letter": "x" * 3000,
    }
    edited = {k: t[: len(t) - len(t) // 3] + "#" * (len(t) // 3) for k, t in kinds.items()}
    frame = spark.createDataFrame([(k, kinds[k], edited[k], "a b. " + kinds[k]) for k in kinds], "k string, a string, b string, c string")
    hashed = frame.select("k", *[paragraph_hashes(F.col(c)).alias(c) for c in "abc"])
    vectors = hashed.select("k", *[vector(F.col(c)).alias(c) for c in "abc"])
    for r in vectors.select("k", likeness(F.col("a"), F.col("b")), likeness(F.col("a"), F.col("c"))).collect():
        assert r[1] > 0.1 and r[2] > 0.85, r


def test_next_row_over_any_number_of_ranges(spark, monkeypatch) -> None:
    """Ids in clusters, more ranges than quantiles, more ranges than rows."""
    monkeypatch.setattr("starmill.llm.fingerprints.MOST_CUTS", 3)
    ids = [*range(-5, 40), *range(10**12, 10**12 + 30), 2**63 - 1, -(2**62)]
    frame = spark.createDataFrame([(i, str(i)) for i in ids], "doc_id bigint, text string")
    down = sorted(ids, reverse=True)
    expected = {i: str(down[(k + 1) % len(down)]) for k, i in enumerate(down)}
    for parts in (1, 2, 7, 50, 1000):
        found = with_next(frame, {"text": "next"}, "doc_id", parts).collect()
        assert len(found) == len(ids) and {r.doc_id: r.next for r in found} == expected


def test_toxicity(spark, docs) -> None:
    """Two groups of which one is named in rude sentences mostly: the penalty closes the gap of their scores."""
    rude, calm = ["moron", "idiot", "scum"], ["lamp", "river", "stone"]
    labelled = []
    for i in range(240):
        toxic = i % 2
        term = "muslim" if toxic or i % 10 == 0 else "catholic"
        labelled.append((f"the {term} people saw a {(rude if toxic else calm)[i % 3]} {i}.", toxic))
    labelled += [(None, 0), ("", 0), ("no label", None)]
    frame = spark.createDataFrame(labelled, "text string, label int")
    model = trained(frame, Fit(counterfactual=30.0))
    loose = trained(frame, Fit(counterfactual=0.0))
    probe = spark.createDataFrame(
        [("the muslim people saw a lamp.",), ("the catholic people saw a lamp.",), ("what a moron",), ("",), (None,)],
        "text string",
    )
    a, b, moron, empty, null = (r.score for r in scored(probe, model).collect())
    c, d, *_ = (r.score for r in scored(probe, loose).collect())
    logit = lambda p: math.log(p / (1 - p))
    assert abs(logit(a) - logit(b)) < 0.5 * abs(logit(c) - logit(d)) and a < 0.5 and moron > 0.7 and empty == null
    # The strength that the query uses narrows the gap, too.
    e, f, *_ = (r.score for r in scored(probe, trained(frame)).collect())
    assert abs(logit(e) - logit(f)) < 0.8 * abs(logit(c) - logit(d))
    found = scored(docs, model)
    assert found.columns == [*docs.columns, "score"] and found.count() == docs.count()
    assert scored(docs, trained(frame.limit(0))).where("score >= 0.7").count() == 0


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("block", "net", "/es/"),
)


def test_judged_urls(spark) -> None:
    urls = [
        (1, "http://A.Example.com/en/x?y", 0, 9.0),
        (2, "http://notexample.com/en/", 0, 9.0),
        (3, "http://com", None, 9.0),
        (4, "https://x.net/es/1#z", None, 9.0),
        (5, "no scheme", None, 9.0),
        (6, None, None, 9.0),
        (7, "http://?q://z/", None, 9.0),
    ]
    urls += [(100 + i, f"http://bad.org/{i}", 1, 9.0) for i in range(40)]
    urls += [(200 + i, f"http://good.org/{i}", 0, 9.0) for i in range(40)]
    urls += [(300, "http://bad.org/new", None, 9.0), (300, "http://bad.org/new", None, 9.0)]
    frame = spark.createDataFrame(urls, "page_id bigint, url string, outcome int, bad_rate double")
    found = judged_urls(frame, RULES)
    assert found.columns == ["page_id", "url", "bad_rate", "host", "path", "rule", "verdict"]
    rows_ = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}
    assert rows_[1] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert rows_[2] == ("notexample.com", "/en/", "com/", "allow")
    assert rows_[3][:3] == ("com", "", None)
    assert rows_[4] == ("x.net", "/es/1", "net/es/", "block")
    assert rows_[5][:3] == ("", "", None) and rows_[6][:3] == ("", "", None) and rows_[7][:3] == ("", "", None)
    assert rows_[300][3] == "block" and rows_[205][3] == "allow" and found.count() == len(urls)


def test_site_levels(spark) -> None:
    """Registered domain and suffix: of two labels, of addresses, with ports and user names."""
    expected = {
        "a.b.example.com": ("example.com", "com"),
        "example.com:8080": ("example.com", "com"),
        "me@shop.example.co.uk:1": ("example.co.uk", "co.uk"),
        "co.uk": ("co.uk", "co.uk"),
        "10.0.0.1:80": ("10.0.0.1", ""),
        "[::1]": ("[::1]", ""),
        "localhost": ("localhost", "localhost"),
        "": ("", ""),
    }
    hosts = spark.createDataFrame([(h,) for h in expected], "host string")
    found = hosts.select("host", *site_levels(F.col("host"))).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == expected
    own_suffix = hosts.select("host", site_levels(F.col("host"), ["example.com"])[0]).collect()
    assert {r[0]: r[1] for r in own_suffix}["a.b.example.com"] == "b.example.com"


def test_host_counts_are_taken_once(spark) -> None:
    """The pages are aggregated once and read once more for the result."""
    pages = spark.range(50).selectExpr("id AS page_id", "concat('http://h', id % 7, '.example.com/') AS url", "CAST(id % 2 AS int) AS outcome")
    plan = judged_urls(pages, RULES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 50") == 1 and "FileScan parquet" in plan


def test_archived_pages(spark) -> None:
    page = "<p>" + "é" * 90
    pages = [(5, "u\r\nX: y", page), (3, None, page), (9, "u", page), (3, None, page)]
    pages += [(1, "u", None), (2, "u", ""), (4, "u", "short"), (6, "u", "short"), (None, "u", page)]
    frame = spark.createDataFrame([(*p, "z") for p in pages], "page_id bigint, url string, html string, digest string")
    found = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in archived_pages(frame).collect())
    expected: Counter = Counter()
    for i, _, html in pages:
        body = (html or "").encode()
        again = len(body) >= 100 and i != 3
        kind = ("revisit", 3) if again else ("response", None)
        expected[(i, len(body), hashlib.sha256(body).hexdigest(), *kind)] += 1
    assert found == expected
    assert archived_pages(frame.limit(0)).collect() == []


def test_archive_format() -> None:
    headers = {"WARC-Type": "resource", "WARC-Record-ID": "<urn:x>", "WARC-Date": "2026-01-01T00:00:00Z"}
    records = [written_record(headers, f"block {i}".encode() * i) for i in range(300)]
    archive = archive_bytes(records)
    assert archive[:4] == b"\x5d\x2a\x4d\x18"
    assert [r.block for r in archive_records(archive)] == [f"block {i}".encode() * i for i in range(300)]
    assert list(archive_records(b"")) == [] and len(list(archive_records(archive_bytes(records[:2])))) == 2
    for broken in (archive[:-3], archive[:9], archive + b"junk!", archive[:-9] + b"\0" * 9):
        with pytest.raises(WarcError):
            list(archive_records(broken))
    good = records[3]
    for bad in (good.replace(b"WARC/1.1", b"HTTP/1.1"), good[:-1], good.replace(b"WARC-Date", b"X-Date"), good + b"\n"):
        with pytest.raises(WarcError):
            parsed_record(bad)


def test_empty_tables(spark) -> None:
    none = corpus(spark, [])
    assert exact_groups(none).collect() == [] and without_copies(none).collect() == []
    assert shingle_components(none).collect() == []
    assert repeated_runs_removed(none).collect() == []
    assert edit_comparison(none).collect() == []
    assert with_token_counts(none, BYTES).collect() == [] and with_pieces(none, PIECES).collect() == []
    assert packed_sequences(none, BYTES).collect() == []
    pages = spark.createDataFrame([], "page_id bigint, url string, outcome int")
    assert judged_urls(pages, RULES).collect() == []

"""Near-duplicates by sketches against all pairs compared, and the sketch's own properties."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from starmill.llm.near_copies import COORDINATES, band_hashes, near_copies, one_of_near_copies, set_digest, sketches
from starmill.llm.queries import op12_minhash
from starmill.llm.word_hash import mixed
from tests.llm.corpus import corpus, rows
from tests.llm.tables import folder_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})
NAMES = ["doc_id", "n_shingles", "component_id", "kept"]


def shingles(text: str | None) -> frozenset:
    found = WORD.findall((text or "").translate(LOWER))
    if len(found) < 3:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + 3]) for i in range(len(found) - 2))


def expected(pairs: list[tuple[int | None, str | None]]) -> Counter:
    sets = [(i, shingles(t)) for i, t in pairs]
    top = list(range(len(sets)))

    def root(x: int) -> int:
        while top[x] != x:
            x = top[x]
        return x

    for a, (_, x) in enumerate(sets):
        for b in range(a):
            y = sets[b][1]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                top[root(a)] = root(b)
    least: dict[int, int] = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    found = [(i, len(s), least.get(root(k)) if s else i) for k, (i, s) in enumerate(sets)]
    return Counter((i, n, low, i == low) for i, n, low in found)


def answers(result) -> Counter:
    assert result.columns == NAMES
    return Counter(map(tuple, result.collect()))


def edited(rng: random.Random, base: list[str], edits: int) -> str:
    text = list(base)
    for at in rng.sample(range(len(base)), edits):
        text[at] = f"x{rng.randint(0, 10**6)}"
    return " ".join(text)


def family() -> list[tuple[int, str]]:
    """Near copies of a text, texts that share a passage with it, and chains of small texts."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    many = [(i, edited(rng, base, rng.randint(0, 4))) for i in range(120)]
    passage = " ".join(f"p{i}" for i in range(40))
    many += [(500 + i, passage + " " + " ".join(f"q{rng.randint(0, 9999)}" for _ in range(25))) for i in range(90)]
    many += [(800 + i, " ".join(f"c{k}" for k in range(i, i + 40))) for i in range(30)]
    many += [(900 + i, " ".join(f"s{k}" for k in range(i % 12))) for i in range(24)]
    return many


def test_odd_rows(spark) -> None:
    assert answers(near_copies(corpus(spark))) == expected(rows())


def test_families_and_query(spark, tmp_path) -> None:
    many = family()
    docs = corpus(spark, many).repartition(7)
    assert answers(near_copies(docs)) == expected(many)
    # Entries cut by other bands, from the second node on.
    assert answers(near_copies(docs, heavy=1)) == expected(many)
    folder = folder_of(tmp_path, documents=docs)
    assert answers(op12_minhash(spark, folder)) == expected(many)


def test_one_of_near_copies(spark) -> None:
    docs = corpus(spark)
    stay = one_of_near_copies(docs)
    assert stay.columns == docs.columns
    dropped = {i for i, _, _, kept in expected(rows()) if not kept}
    found = Counter((r.doc_id, r.text) for r in stay.collect())
    assert found == Counter((i, t) for i, t in rows() if i not in dropped)


def test_texts_of_equal_polynomials(spark) -> None:
    """The words of Thue and Morse and their complements share every hash modulo a power of two."""
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    pair = [(1, word), (2, word.translate(str.maketrans("ab", "ba"))), (3, word)]
    assert answers(near_copies(corpus(spark, pair))) == expected(pair)


def test_empty(spark) -> None:
    for chosen in ([], [(None, None), (1, ""), (2, " ")]):
        assert answers(near_copies(corpus(spark, chosen))) == expected(chosen)


def random_set(rng: np.random.Generator, n: int) -> np.ndarray:
    return np.unique(mixed(rng.integers(0, 2**63, n).astype(np.uint64)))


@pytest.mark.parametrize("n", [1, 2, 7, 40, 300, 20_000])
def test_every_coordinate_fills(n) -> None:
    rng = np.random.default_rng(n)
    made = sketches([random_set(rng, n), np.zeros(0, dtype=np.uint64), random_set(rng, n)])
    empty = np.uint64(2**64 - 1)
    assert (made[[0, 2]] != empty).all() and (made[1] == empty).all()


def test_sketch_is_of_the_set_alone() -> None:
    """Whatever texts a batch holds, and however long they are."""
    rng = np.random.default_rng(1)
    sets = [random_set(rng, n) for n in (3, 5000, 1, 77)]
    together = sketches(sets)
    for i, s in enumerate(sets):
        assert (sketches([s])[0] == together[i]).all()
    assert set_digest(sets[0]) != set_digest(sets[3])


@pytest.mark.parametrize("size", [20, 400])
def test_agreement_estimates_similarity(size) -> None:
    """The mean is the similarity, and the spread no more than that of independent coordinates."""
    rng = np.random.default_rng(size)
    shares = []
    for _ in range(300):
        common, rest = random_set(rng, size * 7 // 10), random_set(rng, size * 3 // 10)
        half = len(rest) // 2
        a, b = np.concatenate([common, rest[:half]]), np.concatenate([common, rest[half:]])
        made = sketches([a, b])
        shares.append((made[0] == made[1]).mean())
    truth = 0.7
    assert abs(np.mean(shares) - truth) < 0.02
    assert np.std(shares) < 1.25 * np.sqrt(truth * (1 - truth) / COORDINATES)


def test_linked_sets_share_an_entry() -> None:
    rng = np.random.default_rng(5)
    for n in (7, 20, 100, 1000):
        for _ in range(100):
            s = random_set(rng, n)
            cut = len(s) - int(len(s) * 0.85 + 0.999999)
            bands = band_hashes(sketches([s, s[cut:]]))
            assert np.isin(bands[0], bands[1]).any()
            assert len(np.unique(bands[0])) == len(bands[0])

"""The trie against one built in memory and against SQL, whatever the layout of its shards."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest

from starmill.llm.conversation_trie import trie_nodes
from starmill.llm.oracle import ORACLE
from starmill.llm.queries import op11_conversation_trie
from starmill.llm.time_forward import NODE_COLUMNS, SpillingQueue, subtree_totals
from tests.llm.tables import folder_of

SHAPE = "conv_id bigint, turn bigint, role string, text string, h int, depth string, conv int, i int, words int"
NAMES = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, turns):
    return spark.createDataFrame([(*t, 1, "d", 2, 3, 4) for t in turns], SHAPE)


def rebuilt(turns):
    own = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    lists = {c: [t[2:] for t in sorted(found)] for c, found in own.items()}
    out = {}
    for c, found in lists.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        out[c] = lists.get(first, [])[:h] + found[h:]
    return out


def expected(turns) -> Counter:
    whole = rebuilt(turns)
    members = defaultdict(list)
    for c, found in whole.items():
        for d in range(len(found) + 1):
            members[tuple(found[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, of in members.items():
        cost = (len(of) - 1) * len(WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += cost
    rows = Counter()
    for p, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(whole[c]) == len(p))
        digest = hashlib.sha256(ends.encode()).hexdigest()
        above = min(members[p[:-1]]) if p else None
        rows[(min(of), len(p), above, len(of), children[p], leaves[p], saved[p], digest)] += 1
    return rows


def answers(result) -> Counter:
    assert result.columns == NAMES
    return Counter(map(tuple, result.collect()))


def odd_turns():
    rng = random.Random(11)
    turns = []
    for c in [*range(0, 130), *range(-45, 0), 2000, 2001, 2019, 7777]:
        kind = rng.randint(0, 3)
        for t in range(rng.randint(1, 9)):
            text = f"common {t}" if kind == 0 else f"text {rng.randint(0, 1)} {t % 2}"
            turns.append((c, t, ("user", "assistant")[t % 2], text))
    # A hot first conversation, all of whose family share it; ties, repeated rows, nulls and empty texts.
    turns += [(300 + i, t, "user", f"hot {t}") for i in range(60) for t in range(4)]
    turns += [(400, None, "user", "no turn"), (400, 1, None, None), (400, 1, "", ""), (400, 2, "b", "tie"), (400, 2, "a", "tie")]
    turns += [(401, 1, "user", "same"), (401, 1, "user", "same"), (402, None, None, None), (None, 1, "user", "no id")]
    turns += [(440, t, "user", f"step {t % 3}") for t in range(90)] + [(441, t, "user", f"step {t % 3}") for t in range(70)]
    turns += [(460, 0, "user", " \n\t"), (461, 0, "us", "er x"), (462, 0, "user", " x"), (480, 5, "user", "y " * 20_000)]
    rng.shuffle(turns)
    return turns


@pytest.fixture(scope="module")
def turns():
    return odd_turns()


@pytest.mark.parametrize(
    ("band_bits", "members", "queue"), [(10, 1024, 200_000), (2, 1024, 2), (3, 5, 1), (0, 0, 3), (10, 20, 2)]
)
def test_odd_rows(spark, turns, band_bits, members, queue) -> None:
    """Single shards and many, bands that hang on each other, heavy nodes, queues that spill."""
    assert answers(trie_nodes(table(spark, turns).repartition(5), band_bits, members, queue)) == expected(turns)


def test_query_and_sql(spark, turns, tmp_path) -> None:
    folder = folder_of(tmp_path, conversations=table(spark, turns))
    found = answers(op11_conversation_trie(spark, folder))
    assert found == expected(turns)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    result = con.execute(ORACLE["op11_conversation_trie"])
    assert [d[0] for d in result.description] == NAMES
    assert Counter(result.fetchall()) == found


def test_empty(spark) -> None:
    assert answers(trie_nodes(table(spark, []))) == Counter()
    assert answers(trie_nodes(table(spark, [(None, 1, "user", "x")]))) == Counter()


def test_turnless(spark) -> None:
    """A conversation that gives its only turns away, and whose family has no first one."""
    alone = [(c, 0, "user", "x") for c in range(1, 20)]
    found = expected(alone)
    assert any(n == 0 and d == 0 for _, d, _, _, n, _, _, _ in found) or len(found) > 1
    assert answers(trie_nodes(table(spark, alone))) == found


@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_queue(limit) -> None:
    rng = random.Random(limit)
    queue, waiting = SpillingQueue(limit), Counter()
    keys = sorted({(-rng.randint(0, 9), rng.randint(0, 30), 0) for _ in range(200)})
    for at, key in enumerate(keys):
        for _ in range(3):
            if at + 1 < len(keys):
                later = rng.choice(keys[at:])
                queue.add(later, 1, 2, 3)
                waiting[later] += 1
        assert queue.take(key) == [waiting[key] * k for k in (1, 2, 3)]
    assert queue.empty()


def test_messages_that_nobody_takes() -> None:
    """A node that is missing is an error, never a lost total."""
    row = dict(zip(NODE_COLUMNS, (3, 1, 1, 2, 9, 9, True, 0, 1, 5)))
    other = dict(zip(NODE_COLUMNS, (1, 1, 1, 0, 0, 0, False, 0, 1, 5)))
    for rows in ([row], [row, other]):
        with pytest.raises(ValueError, match="never came|no node came"):
            list(subtree_totals(iter([pa.RecordBatch.from_pylist(rows)])))

"""Every registered query equals its SQL counterpart on the given tables."""

from __future__ import annotations

import pytest

from starmill.registry.oracle import ORACLE
from starmill.registry.queries import QUERIES
from tests.compare import both

FOLDER = "/root/testdata/sf0.01"


def test_each_query_has_a_counterpart() -> None:
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name: str) -> None:
    ours, theirs = both(spark, name, FOLDER)
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]

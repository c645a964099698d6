"""Whitening against numpy's eigenvectors, on odd rows and on empty tables."""

from __future__ import annotations

import math

import numpy as np
import pytest

from starmill.llm.queries import op13_whitening
from starmill.llm.whitening import leading_components, whitened
from tests.llm.tables import folder_of

SHAPE = "vec_id bigint, embedding array<float>, component string, n string, x int, i int, part int, key int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "c", "n", 1, 2, 3, 4) for i, v in rows], SHAPE)


def usable(rows, dims):
    found = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v):
            found.append((i, tuple(int(math.floor(256 * float(np.float32(c)))) for c in v)))
    return found


def check(result, rows, dims):
    """Every row of a result against eigenvectors of the distinct vectors' covariance."""
    kept = usable(rows, dims)
    fit = np.array(sorted({x for _, x in kept}), dtype=np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    y = fit - sums / n
    covariance = y.T @ y / n
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1], basis[:, ::-1]
    size = min(4, dims)
    assert len(result) == len(kept) * size
    signs = {}
    left = {}
    for r in result:
        left.setdefault((r.vec_id, r.deviation, r.component), []).append(r)
    for i, x in kept:
        off = n * np.array(x, dtype=object) - sums.astype(object)
        deviation = int((off * off).sum())
        for k in range(1, size + 1):
            same = left[(i, deviation, k)]
            expected = float((np.array(x) - sums / n) @ basis[:, k - 1]) / math.sqrt(values[k - 1])
            at = min(range(len(same)), key=lambda j: abs(abs(same[j].whitened) - abs(expected)))
            row = same.pop(at)
            assert row.n == n
            assert abs(row.whitened) == pytest.approx(abs(expected), abs=1e-7)
            if abs(expected) > 1e-3:
                assert signs.setdefault(k, row.whitened * expected > 0) == (row.whitened * expected > 0)
            assert row.explained == pytest.approx(values[k - 1] / values.sum(), rel=1e-9)
            assert 0 <= row.identity_error < 1e-6


def odd_rows():
    rng = np.random.default_rng(3)
    scale = np.linspace(1.5, 0.1, 9)
    rows = [(i, [float(c) for c in rng.standard_normal(9) * scale]) for i in range(120)]
    hot = rows[5][1]
    rows += [(200 + i, hot) for i in range(60)]
    rows += [(5, hot), (5, hot), (None, hot), (300, None), (301, [])]
    for bad in (None, math.nan, math.inf, -math.inf):
        rows.append((302, [*hot[:8], bad]))
    rows += [(303, hot[:4]), (304, [*hot, 1.0]), (305, [-0.0] * 9), (306, [0.0] * 9)]
    return rows


def test_odd_rows(spark) -> None:
    rows = odd_rows()
    result = whitened(vectors(spark, rows).repartition(7))
    assert result.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    ]
    check(result.collect(), rows, 9)


def test_query(spark, tmp_path) -> None:
    rows = odd_rows()
    folder = folder_of(tmp_path, embeddings=vectors(spark, rows))
    check(op13_whitening(spark, folder).collect(), rows, 9)


def test_fewer_dimensions_than_components(spark) -> None:
    rows = [(i, [float(i % 7), float(i % 3)]) for i in range(30)]
    check(whitened(vectors(spark, rows)).collect(), rows, 2)


def test_without_variance(spark) -> None:
    """One distinct vector has no variance; of dependent dimensions one component has."""
    single = whitened(vectors(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).collect()
    assert {(r.vec_id, r.component, r.n, r.deviation) for r in single} == {
        (i, k, 1, 0) for i in (1, 2) for k in (1, 2)
    }
    assert all(r.whitened is None and r.explained is None and r.identity_error is None for r in single)
    line = whitened(vectors(spark, [(i, [float(i), float(i)]) for i in range(5)])).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in line)
    assert all(r.identity_error < 1e-9 for r in line)


def test_large_entries(spark) -> None:
    """Deviations are exact, and null where no long holds them; huge entries count as not finite."""
    rows = [(i, [float(2**k) * (1 + i), float(i * i)]) for i, k in enumerate((3, 20, 30, 39))]
    rows.append((9, [2.0**41, 0.0]))
    kept = usable(rows[:3], 2)
    found = {r.vec_id: r.deviation for r in whitened(vectors(spark, rows)).collect()}
    assert set(found) == {0, 1, 2} and found[2] is None
    small = {r.vec_id: r.deviation for r in whitened(vectors(spark, rows[:2])).collect()}
    fit = [x for _, x in kept[:2]]
    sums = [a + b for a, b in zip(*fit)]
    assert small == {i: sum((2 * a - s) ** 2 for a, s in zip(x, sums)) for i, x in enumerate(fit)}


def test_empty(spark) -> None:
    for rows in ([], [(1, None), (2, [])]):
        result = whitened(vectors(spark, rows))
        assert result.collect() == [] and result.schema["vec_id"].dataType.simpleString() == "bigint"


@pytest.mark.parametrize("seed", range(6))
def test_leading_components(seed) -> None:
    """Clustered, repeated, dependent and widely spread eigenvalues."""
    rng = np.random.default_rng(seed)
    size = int(rng.integers(2, 70))
    spectrum = [
        np.repeat([5.0, 1.0], size)[:size],
        np.exp(-np.arange(size) / 2.0),
        rng.random(size),
        np.concatenate([[3.0, 3.0 + 1e-12], np.zeros(size)])[:size],
        np.ones(size),
        np.zeros(size),
    ][seed]
    basis = np.linalg.qr(rng.standard_normal((size, size)))[0]
    matrix = basis * spectrum @ basis.T
    matrix = (matrix + matrix.T) / 2
    wanted = min(5, size)
    values, found = leading_components(matrix, wanted)
    largest = max(1.0, spectrum.max())
    assert np.allclose(values, np.sort(np.linalg.eigvalsh(matrix))[::-1][:wanted], atol=1e-13 * size * largest)
    assert np.allclose(found.T @ found, np.eye(wanted), atol=1e-13 * size)
    assert np.allclose(matrix @ found, found * values, atol=1e-13 * size * largest)

"""Whitening against a dense solver, and eigenvectors against planted ones."""

import math
from fractions import Fraction

import numpy as np
import pytest

from civicpanel.llm import whitening
from tests.llm.conftest import same

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def turned(rng, d):
    return np.linalg.qr(rng.normal(size=(d, d)))[0]


@pytest.mark.parametrize(
    "values",
    [
        [1000, 400, 399.9999999, 399.9999998, 5, 5, 1e-3, 1e-9],  # clusters, and two that are equal
        list(np.linspace(60, 61, 40)),
        [1 + 1e-12 * k for k in range(10)] + [2, 3],
        [1e9, 1, 1 - 1e-10, 1e-6],
        [3, 3, 3, 3],
        [0, 0, 0, 7],
    ],
)
def test_eigenvectors_to_double_precision(values):
    rng = np.random.default_rng(3)
    d = len(values)
    # An orthogonal matrix to extended precision, so that the matrix has the planted values.
    q = turned(rng, d).astype(np.longdouble)
    for _ in range(4):
        q = q @ (3 * np.eye(d, dtype=np.longdouble) - q.T @ q) / 2
    a = (q * np.array(values, np.longdouble)) @ q.T
    a = (a + a.T) / 2
    found, x = whitening.eigenpairs(a)
    top = max(values)
    assert np.abs(found - sorted(values, reverse=True)).max() <= 4e-16 * top
    assert np.abs(x.T @ x - np.eye(d)).max() < 1e-15 * d
    y = x.astype(np.longdouble)
    assert np.abs(a @ y - y * found).max() <= 2e-15 * top
    for k, v in enumerate(sorted(values, reverse=True)):
        gap = min((abs(v - o) for j, o in enumerate(sorted(values, reverse=True)) if j != k), default=1)
        if gap > 1e-11 * top:
            own = q[:, sorted(range(d), key=lambda i: -values[i])[k]]
            assert 1 - abs(float(own @ y[:, k])) < 1e-12


def by_hand(rows, components):
    good = [(i, v) for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in good]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    y = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(r, sums, strict=True)] for r in x])
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    dev = [sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    return [i for i, _ in good], n, dev, (y @ u) / np.sqrt(e), e / np.trace(v)


@pytest.fixture
def rows():
    rng = np.random.default_rng(11)
    base = rng.normal(size=(700, 12)) * np.linspace(1, 3, 12) @ turned(rng, 12)
    rows = [(i, [float(c) for c in v], i % 3) for i, v in enumerate(base)]
    odd = [None, [None] * 12, [math.nan, *[1.0] * 11], [*[0.0] * 11, math.inf], [-math.inf] * 12]
    rows += [(1000 + k, v, 0) for k, v in enumerate(odd)]
    return [*rows, rows[5], rows[5], (None, rows[6][1], None)]


def test_whitened_rows_equal_a_dense_solver(frame, rows):
    found = whitening.whiten(frame(rows, SCHEMA), 8).toPandas()
    ids, n, dev, w, explained = by_hand(rows, 8)
    assert len(found) == 8 * len(ids) and set(found["n"]) == {n}
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-9
    assert sorted(found[found.component == 1].deviation) == sorted(dev)
    for k in range(8):
        own = found[found.component == k + 1]
        assert np.allclose(own.explained, explained[k], rtol=1e-10)
        got = own.set_index("vec_id").whitened
        want = {i: w[at, k] for at, i in enumerate(ids) if i is not None}
        sign = np.sign(got.loc[0] * want[0])
        for i in (0, 1, 99, 500, 699):
            assert got.loc[i] == pytest.approx(sign * want[i], rel=1e-9, abs=1e-9)


def test_tasks_do_not_change_the_result(frame, rows):
    df = frame(rows, SCHEMA)
    columns = ["vec_id", "component", "n", "deviation", "explained"]
    assert same(whitening.whiten(df.repartition(7), 4).select(columns), whitening.whiten(df.coalesce(1), 4).select(columns))


def test_large_entries_are_exact(frame):
    """Products and deviations that no double and no long can hold."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=3) * 2.0**50], 0) for i in range(40)]
    found = whitening.whiten(frame(rows, SCHEMA), 3).toPandas()
    assert found.deviation.isna().all() and found.identity_error[0] < 1e-9
    small = [(i, [v * 2.0**-36 for v in r], 0) for i, r, _ in rows]
    _, _, dev, _, _ = by_hand(small, 3)
    found = whitening.whiten(frame(small, SCHEMA), 3).toPandas()
    assert sorted(set(found.deviation)) == sorted(d for d in dev if d < 2**63)


def test_odd_tables(frame, rows):
    df = frame(rows, SCHEMA)
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(frame([(1, None, 0), (2, [], 0)], SCHEMA)).count() == 0
    clash = df.selectExpr("*", "1 AS n", "2 AS component", "3 AS size", "4 AS whitened")
    assert same(whitening.whiten(df, 2).drop("identity_error"), whitening.whiten(clash, 2).drop("identity_error"))
    one = whitening.whiten(frame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (3, [9.0], 0)], SCHEMA)).collect()
    assert {(r.vec_id, r.component) for r in one} == {(1, 1), (1, 2), (2, 1), (2, 2)}
    assert all(r.whitened is None and r.explained == 0 and r.deviation == 0 and r.identity_error == 0 for r in one)
    flat = whitening.whiten(frame([(i, [float(i), 5.0], 0) for i in range(9)], SCHEMA)).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in flat)

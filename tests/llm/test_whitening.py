"""Whitening against a dense decomposition of the same vectors."""

import math

import numpy as np
import pytest
from frames import clashing

from marketbars.llm import queries, whitening
from marketbars.llm.whitening import Spectrum, rank_one, secular_roots, whiten

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def dense(rows):
    """Kept (vec_id, x) rows, n, sums, values and vectors, by falling value."""
    kept = [
        (i, [math.floor(256 * float(np.float32(c))) for c in v])
        for i, v, *_ in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = np.array(sorted({tuple(x) for _, x in kept}), float)
    sums = [sum(int(r[j]) for r in fit) for j in range(fit.shape[1])]
    centred = fit - np.array([s / len(fit) for s in sums])
    values, vectors = np.linalg.eigh(centred.T @ centred / len(fit))
    return kept, len(fit), sums, values[::-1], vectors[:, ::-1]


def check(result, rows, tolerance=1e-9, components=4):
    kept, n, sums, values, vectors = dense(rows)
    got = result.collect()
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    assert len(got) == len(kept) * k
    mean = np.array([s / n for s in sums])
    want = {}
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        for c in range(k):
            white = float((np.array(x) - mean) @ vectors[:, c] / math.sqrt(values[c]))
            want.setdefault((i, c + 1), []).append((deviation, white))
    signs = {}
    for c in range(1, k + 1):
        i, x = max(kept, key=lambda r: abs(want[r[0], c][0][1]))
        mine = next(r.whitened for r in got if (r.vec_id, r.component) == (i, c))
        options = [w for _, w in want[i, c]]
        signs[c] = 1 if min(abs(mine - w) for w in options) < 1e-6 else -1
    for r in got:
        assert r.n == n
        options = want[r.vec_id, r.component]
        assert any(
            r.deviation == d and abs(r.whitened - signs[r.component] * w) < tolerance
            for d, w in options
        )
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-10)
        assert 0 <= r.identity_error < 1e-9
    return got


def test_secular_roots_lie_between_the_poles():
    rng = np.random.default_rng(1)
    for k in (1, 2, 5, 40):
        poles = np.sort(rng.normal(size=k)) * 100
        squares = rng.random(k) ** 8 + 1e-12
        roots, distance = secular_roots(poles, squares)
        assert (roots > poles).all() and (roots[:-1] < poles[1:]).all()
        value = 1 - (squares / distance).sum(axis=1)
        slope = (squares / distance**2).sum(axis=1)
        assert (np.abs(value) / slope <= 1e-11).all()


@pytest.mark.parametrize(
    "values",
    [
        np.zeros(6),
        np.array([0, 0, 1, 1, 1, 5.0]),
        np.arange(6.0),
        np.array([1, 1 + 1e-15, 2, 2 + 1e-9, 3, 1e6]),
    ],
)
@pytest.mark.parametrize("u", ["random", "unit", "zero", "tiny", "along"])
def test_rank_one_update_with_deflation(values, u):
    rng = np.random.default_rng(2)
    vectors = np.linalg.qr(rng.normal(size=(6, 6)))[0]
    u = {
        "random": rng.normal(size=6),
        "unit": np.eye(6)[2] * 3,
        "zero": np.zeros(6),
        "tiny": rng.normal(size=6) * 1e-170,
        "along": vectors[:, 3] * 2,
    }[u]
    whole = vectors * values @ vectors.T + np.outer(u, u)
    new_values, new_vectors = rank_one(values, vectors, u)
    size = max(1, np.abs(whole).max())
    assert np.abs(new_vectors.T @ new_vectors - np.eye(6)).max() < 1e-13
    assert np.abs(new_vectors * new_values @ new_vectors.T - whole).max() < 1e-13 * size
    assert (np.diff(new_values) >= 0).all()


def test_spectra_of_parts_are_that_of_the_whole():
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(size=(900, 12)) * [*range(1, 12), 0] * 20)
    x[100:130] = x[0]
    parts = [Spectrum(12) for _ in range(5)]
    for i, row in enumerate(x):
        parts[i % 4].add(row)
    whole = Spectrum(12)
    for part in parts:
        whole.join(part)
    centred = x - x.mean(axis=0)
    want = np.linalg.eigvalsh(centred.T @ centred)
    assert whole.n == 900 and np.allclose(whole.mean, x.mean(axis=0))
    assert np.abs(whole.values - want).max() < 1e-10 * want[-1]


def test_sums_and_deviations_are_exact():
    big = (1 << 62) + 12345
    x = np.array([[big, -big, 1], [big - 7, -big, -3], [big, -big, 1]], np.int64)
    assert whitening.column_sums(x) == [3 * big - 7, -3 * big, -1]
    model = whitening.Whitening(2, [2 * big - 7, -2 * big, -2], None, None, 1.0, 0.0)
    assert whitening.deviations(x, model) == [49 + 16, 49 + 16, 65]
    far = whitening.Whitening(2, [0, 0, 0], None, None, 1.0, 0.0)
    assert whitening.deviations(x, far) == [None] * 3


@pytest.mark.parametrize("vectors, fan", [(4096, 16), (30, 2)])
def test_odd_rows(spark, vectors, fan):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=5).astype(np.float32).tolist(), 0) for i in range(200)]
    rows += [
        (1, rows[1][1], 1), (1, rows[1][1], 1), (1, [0.5] * 5, 1), (None, [0.25] * 5, None),
        (300, None, 1), (301, [None, 1.0, 1.0, 1.0, 1.0], 1), (302, [math.nan] * 5, 1),
        (303, [math.inf, 1.0, 1.0, 1.0, 1.0], 1), (304, [-0.0] * 5, 1),
    ]
    # A third of all rows is one vector.
    rows += [(1000 + i, [9.0, 0.0, 0.0, 0.0, 1.0], 1) for i in range(100)]
    other = [(400, [1.0, 2.0], 1), (401, [], 1)]
    frame = clashing(spark.createDataFrame(rows + other, SCHEMA))
    check(whiten(frame, vectors=vectors, fan=fan), rows)


def test_no_variance_and_no_rows(spark):
    for rows in ([], [(1, None, 1)], [(1, [], 1)], [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)]):
        assert whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []
    rows = [(1, [1.0, 2.0, 3.0], 1), (2, [1.0, 2.5, 3.0], 1), (3, [1.0, 2.5, 3.0], 1)]
    got = check(whiten(spark.createDataFrame(rows, SCHEMA)), rows)
    assert {r.component for r in got} == {1}


def test_query_on_the_test_table(spark, sf_dir):
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "embeddings").collect()]
    check(queries.QUERIES["op11_embedding_whitening"](spark, sf_dir), rows)

"""Whitening against numpy's dense eigenvectors, the solver on hard matrices."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.conftest import SF_SMALL
from tickwise.llm import whitening as W
from tickwise.llm.queries import op13

SCHEMA = "vec_id bigint, embedding array<float>, n int, x int"


def brute(rows, components=16):
    """Per width: (vec_id, component) -> n, deviation, |whitened|, explained, from
    the covariance in exact fractions and a dense eigensolver."""
    sound = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    out, values = [], {}
    for w in {len(v) for _, v in sound}:
        own = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in sound if len(v) == w]
        fit = sorted({tuple(x) for _, x in own})
        n, s = len(fit), [sum(c) for c in zip(*fit)]
        centred = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(x, s)] for x in fit])
        cov = centred.T @ centred / n
        e, z = np.linalg.eigh(cov)
        e, z = e[::-1], z[:, ::-1]
        values[w] = e
        for i, x in own:
            y = np.array([float(Fraction(n * a - b, n)) for a, b in zip(x, s)]) @ z
            for k in range(min(components, w)):
                out.append((i, k + 1, n, sum((n * a - b) ** 2 for a, b in zip(x, s)),
                            abs(y[k]) / math.sqrt(e[k]) if e[k] > 1e-20 * e[0] and e[0] > 0 else None,
                            e[k] / e.sum() if e[0] > 0 else 0.0))
    return out


def close(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:4])
    got = sorted([(r.vec_id, r.component, r.n, r.deviation, r.whitened and abs(r.whitened), r.explained) for r in got], key=key)
    want = sorted(want, key=key)
    assert [g[:4] for g in got] == [x[:4] for x in want]
    for g, x in zip(got, want):
        assert (g[4] is None) == (x[4] is None)
        assert g[4] is None or g[4] == pytest.approx(x[4], rel=1e-6, abs=1e-6)
        assert g[5] == pytest.approx(x[5], rel=1e-8, abs=1e-12)


def test_query_against_dense_solver(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = op13(spark, SF_SMALL).collect()
    close(got, brute(rows))
    assert max(r.identity_error for r in got) < 1e-9
    assert len({r.identity_error for r in got}) == 1
    signs = {}
    again = {(r.vec_id, r.component): r.whitened for r in op13(spark, SF_SMALL).collect()}
    for r in got:
        signs.setdefault(r.component, set()).add(np.sign(r.whitened * again[r.vec_id, r.component]))
    assert all(len(s) == 1 for s in signs.values())


def test_odd_rows(spark):
    """Null and empty vectors, null and non-finite entries, null and repeated
    ids, copies, another width, clashing columns."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(size=3)]) for i in range(40)]
    rows += [(40, rows[0][1]), (40, rows[0][1]), (None, rows[1][1]), (41, None), (42, []), (43, [1.0, None, 2.0]),
             (44, [float("nan"), 0.0, 0.0]), (45, [float("inf"), 0.0, 0.0])]
    rows += [(50 + i, [float(c) for c in rng.normal(size=18)]) for i in range(60)]
    rows = [(i, v and [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    df = spark.createDataFrame([(*r, 7, 8) for r in rows], SCHEMA).repartition(5)
    got = W.whiten(df).collect()
    close(got, brute(rows))
    assert max(r.identity_error for r in got) < 1e-9


def test_no_direction_and_no_rows(spark):
    """A constant dimension and few vectors leave components without variance."""
    rows = [(1, [1.0, 5.0, 0.0]), (2, [2.0, 5.0, 0.0]), (3, [3.0, 5.0, 1.0])]
    got = W.whiten(spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)).collect()
    close(got, brute(rows))
    assert {r.component for r in got if r.whitened is None} == {3}
    one = W.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0, 0)], SCHEMA)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == \
        [(1, 1, 0, None, 0.0, 0.0), (2, 1, 0, None, 0.0, 0.0)]
    assert W.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert W.whiten(spark.createDataFrame([(1, None, 0, 0)], SCHEMA)).collect() == []


def test_large_entries(spark):
    """Deviations are exact up to a long's end and null beyond; entries beyond
    a long leave the row out."""
    rows = [(1, [1e7]), (2, [-1e7]), (3, [3e15]), (4, [1e18]), (5, [0.0])]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in rows]
    got = W.whiten(spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)).collect()
    want = brute([r for r in rows if r[0] != 4])
    assert {r.vec_id: r.deviation for r in got} == {w[0]: w[3] if w[3] < 2 ** 63 else None for w in want}
    assert got[0].identity_error < 1e-9
    near = W.whiten(spark.createDataFrame([(i, [float(i)], 0, 0) for i in range(4)], SCHEMA)).collect()
    assert [r.deviation for r in sorted(near)] == [(4 * 64 * i - 64 * 6) ** 2 for i in range(4)]


def test_rounds_of_reduction(spark):
    """Stacking two triangles at a time over many tasks changes nothing."""
    rng = np.random.default_rng(6)
    data = rng.normal(size=(300, 6)) @ np.diag([9, 5, 3, 2, 1, 0.1]) + 1000
    fit = W.vectors(spark.createDataFrame([(i, v.tolist(), 0, 0) for i, v in enumerate(data)], SCHEMA)).select("x").repartition(11)
    sums = W.fit_sums(fit)
    r = W.triangles(fit, sums, fan_in=2)[6]
    x = np.array([[math.floor(64 * float(np.float32(c))) for c in v] for v in data])
    assert np.allclose(r.T @ r, np.cov(x.T, bias=True), rtol=1e-10)


def hard_matrices():
    rng = np.random.default_rng(0)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    yield np.eye(20)
    yield np.zeros((8, 8))
    yield np.linalg.qr(rng.normal(size=(200, 64)), mode="r")
    yield np.linalg.qr(rng.normal(size=(200, 5)) @ rng.normal(size=(5, 40)), mode="r")
    yield np.triu(rng.normal(size=(64, 64))) @ np.diag(10.0 ** -np.arange(64))
    yield np.linalg.qr(q @ np.diag([5.0] * 10 + [3] * 20 + [1] * 10) @ q.T, mode="r")
    yield np.linalg.qr(q @ np.diag(1 + 1e-9 * rng.random(40)) @ q.T, mode="r")
    for m in (10, 25):  # pairs of values that agree to working precision
        n = 2 * m + 1
        t = np.diag(np.abs(np.arange(-m, m + 1.0)) + 2) + np.diag(np.ones(n - 1), 1) + np.diag(np.ones(n - 1), -1)
        yield np.linalg.cholesky(t).T


@pytest.mark.parametrize("r", list(hard_matrices()))
def test_solver(r):
    check(r, min(16, len(r)))


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 12).flatmap(lambda d: st.lists(st.lists(st.integers(-2, 2), min_size=d, max_size=d),
                                                     min_size=d, max_size=d)))
def test_solver_on_small_integers(rows):
    check(np.triu(np.array(rows, dtype=float)), len(rows))


def check(r, k):
    values, z, trace = W.right_vectors(r, k)
    want = np.linalg.svd(r, compute_uv=False) ** 2
    top = max(want[0], 1e-300)
    assert np.abs(values - want[:k]).max() <= 1e-13 * top * len(r)
    assert np.abs(z.T @ z - np.eye(k)).max() <= 1e-10
    assert np.abs(r.T @ (r @ z) - z * values).max() <= 1e-12 * top
    assert trace == pytest.approx(want.sum())


def test_tiny_values_keep_their_digits():
    """dqds: relative accuracy of all values of a graded bidiagonal matrix, the
    squares of which a covariance would lose."""
    diag, over = 10.0 ** -np.arange(12), 0.5 * 10.0 ** -np.arange(11)
    product = math.prod(Fraction(float(d)) ** 2 for d in diag)
    got = W.singular_squares(diag, over)
    assert math.prod(Fraction(float(v)) for v in got) / product == pytest.approx(1, rel=1e-12)

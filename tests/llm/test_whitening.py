"""Operator 12 against exact fractions and numpy's own eigenvectors; the QDWH solver on hard spectra."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from llm_data import SF
from statflow.llm.qdwh import eigen, polar_factor
from statflow.llm.whitening import products, whiten

VECTORS = "vec_id long, embedding array<double>"


def matrices():
    rng = np.random.default_rng(0)
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    yield np.cov(rng.standard_normal((300, 40)).T)
    yield np.diag([1.0, 2.0, 3.0])
    yield np.diag([3.0, 3.0, 1.0, 1.0, 2.0, 3.0])
    yield np.zeros((4, 4))
    yield np.ones((5, 5))
    yield np.array([[7.0]])
    yield q @ np.diag(10.0 ** -np.arange(40)) @ q.T
    yield q @ np.diag(1 + 1e-9 * np.arange(40)) @ q.T
    yield q @ np.diag(np.arange(40) - 20.0) @ q.T


@pytest.mark.parametrize("a", list(matrices()))
def test_eigen(a):
    a = (a + a.T) / 2
    values, x = eigen(a)
    scale = max(np.abs(a).max(), 1e-300) * len(a)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], rtol=0, atol=1e-14 * scale)
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-11
    assert np.abs(a @ x - x * values).max() < 1e-14 * scale


def test_polar_factor_is_the_matrix_sign():
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((6, 6)))[0]
    d = np.array([5.0, 1e-9, 2.0, -3.0, -1e-7, -1.0])
    u = polar_factor(q @ np.diag(d) @ q.T)
    assert np.allclose(u, q @ np.diag(np.sign(d)) @ q.T, atol=1e-6)


def test_products_are_exact():
    z = np.array([[3, -5], [1 << 40, 7], [-(1 << 55), (1 << 55) + 1]], np.int64)
    want = [[sum(int(r[i]) * int(r[j]) for r in z) for j in range(2)] for i in range(2)]
    assert products(z).tolist() == want


def reference(rows, k=16):
    """{row number: (deviation, whitened of each component)}, n, explained; signs are free."""
    kept = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, (_, v) in enumerate(rows) if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    fit = sorted(set(map(tuple, kept.values())))
    n, dim = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(dim)]
    cov = np.array([[float(Fraction(sum((n * x[i] - s[i]) * (n * x[j] - s[j]) for x in fit), n**3)) for j in range(dim)] for i in range(dim)])
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    out = {}
    for i, x in kept.items():
        off = [n * a - b for a, b in zip(x, s)]
        out[i] = (sum(o * o for o in off), (np.array([o / n for o in off]) @ q) / np.sqrt(e))
    return out, n, e / np.trace(cov)


def check(rows, got, k=16):
    want, n, explained = reference(rows, k)
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    assert sum(len(x) for c in by_id.values() for x in c.values()) == len(want) * len(explained)
    signs = None
    for i, (deviation, whitened) in want.items():
        mine = by_id[rows[i][0]]
        values = np.array([mine[c + 1][0]["whitened"] for c in range(len(explained))])
        if signs is None:
            signs = np.where(values * whitened >= 0, 1, -1)
        assert np.allclose(values * signs, whitened, atol=1e-8)
        for c in range(len(explained)):
            assert mine[c + 1][0]["deviation"] == deviation and mine[c + 1][0]["n"] == n
            assert math.isclose(mine[c + 1][0]["explained"], explained[c], rel_tol=1e-9)
            assert mine[c + 1][0]["identity_error"] < 1e-8


def test_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(rows, whiten(spark.read.parquet(f"{SF}/embeddings.parquet")).collect())


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=5) * [5, 4, 3, 2, 1]]) for i in range(60)]
    rows += [(100, rows[0][1]), (None, rows[1][1]), ((1 << 53) + 1, rows[2][1]), ((1 << 53) + 3, rows[3][1])]
    rows += [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0]), (202, [float("nan")] * 5), (203, [float("inf")] + [0.0] * 4)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS + ", component string, x int").repartition(7)
    got = whiten(df).collect()
    check(rows, got)
    assert {r["vec_id"] for r in got} >= {None, (1 << 53) + 1, (1 << 53) + 3}
    one = whiten(df.coalesce(1)).collect()  # the same model however the rows are dealt
    key = lambda r: (r["vec_id"] is None, r["vec_id"] or 0, r["component"])
    strip = lambda rs: [(r["vec_id"], r["component"], r["whitened"], r["explained"]) for r in sorted(rs, key=key)]
    assert strip(one) == strip(got)


def test_other_lengths_no_variance_and_large_entries(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 5.0]), (3, [1.0, 2.0]), (4, [1.0]), (5, []), (6, [1.0, 1e300])]
    got = {(r["vec_id"], r["component"]): r for r in whiten(spark.createDataFrame(rows, VECTORS)).collect()}
    assert sorted(got) == [(i, c) for i in (1, 2, 3, 4, 5) for c in (1, 2)]
    assert abs(abs(got[1, 1]["whitened"]) - 1) < 1e-12 and got[1, 1]["deviation"] == (64 * 3) ** 2
    assert got[1, 2]["whitened"] is None and got[4, 1]["whitened"] is None and got[4, 1]["deviation"] is None
    assert got[1, 1]["explained"] == 1 and got[1, 2]["explained"] == 0
    wide = whiten(spark.createDataFrame([(1, [1e15]), (2, [-1e15]), (3, [0.0])], VECTORS)).collect()
    assert [r["deviation"] for r in wide] == [None, None, 0]
    assert all(r["identity_error"] < 1e-12 for r in wide)


def test_single_and_no_rows(spark):
    (r,) = whiten(spark.createDataFrame([(1, [0.5])], VECTORS)).collect()
    assert (r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) == (1, 0, None, None, None)
    assert whiten(spark.createDataFrame([], VECTORS)).collect() == []
    assert whiten(spark.createDataFrame([(1, None), (2, [])], VECTORS)).collect() == []

from __future__ import annotations

import math

import numpy as np
import pytest

from dealweave.llm import whitening as W


def brute(rows, components=16):
    """What the contract asks for, by a dense eigenvalue solver: {vec_id: (deviation, whitened row)}, n, explained."""
    rows = [(i, v) for i, v in rows if v is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows], np.int64)
    distinct = np.unique(x, axis=0)
    n, s = len(distinct), distinct.sum(0)
    c = (n * distinct - s) / n
    cov = c.T @ c / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    d = n * x - s
    return [i for i, _ in rows], n, (d * d).sum(1).tolist(), (d / n) @ (u / np.sqrt(e)), e / np.trace(cov)


@pytest.mark.parametrize("d,components", [(24, 16), (60, 5), (7, 16)])
def test_against_dense_solver(spark, d, components):
    rng = np.random.default_rng(d)
    base = rng.normal(size=(300, d)) * np.linspace(3, 0.5, d) + 50
    rows = [(i, [float(np.float32(c)) for c in base[i % 250 if i < 290 else i]]) for i in range(300)]  # repeated vectors under other ids
    rows += [(1000, None), (1001, [None] * d), (1002, [float("nan")] * d), (1003, [float("inf")] * d), (1004, []), (1005, [1.0] * (d - 1)), (2003, rows[3][1])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, n long, x string").repartition(3)
    got = W.whiten(df, components).toPandas().sort_values(["vec_id", "component"])
    ids, n, deviation, whitened, explained = brute([r for r in rows if r[0] != 1005], components)
    k = min(components, d)
    assert list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    order = np.argsort(ids, kind="stable")
    assert got["vec_id"].tolist() == np.repeat(np.array(ids)[order], k).tolist() and set(got["n"]) == {n}
    assert got["component"].tolist() == list(range(1, k + 1)) * len(ids)
    assert got["deviation"].tolist() == np.repeat(np.array(deviation)[order], k).tolist()
    mine, want = got["whitened"].to_numpy().reshape(-1, k), whitened[order]
    sign = np.sign((mine * want).sum(0))
    assert np.abs(mine * sign - want).max() < 1e-9
    assert np.allclose(got["explained"].to_numpy().reshape(-1, k)[0], explained, rtol=1e-9)
    assert got["identity_error"].max() < 1e-9


def test_eigenpairs_of_a_larger_operator():
    rng = np.random.default_rng(0)
    d = 400
    q = np.linalg.qr(rng.normal(size=(d, d)))[0]
    values = np.r_[np.linspace(100, 60, 20), np.linspace(59.5, 0, d - 20)]
    a = (q * values) @ q.T
    widths = []

    def product(z):
        widths.append(z.shape[1])
        return a @ z

    e, u, residuals = W.eigenpairs(product, d, 16)
    assert np.abs(e - values[:16]).max() < 1e-11 and residuals.max() < 1e-11
    assert np.abs(np.abs((u * q[:, :16]).sum(0)) - 1).max() < 1e-11
    assert max(widths) <= 18 and len(widths) < 200  # matrix-free: never the whole operator at once


def test_minres_solves():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(12, 12))
    a = a + a.T
    b = rng.normal(size=(12, 3))
    x = W.minres(lambda z: a @ z, b, 40)
    assert np.abs(a @ x - b).max() < 1e-6


def test_degenerate_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert W.whiten(spark.createDataFrame([], schema)).count() == 0
    one = W.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.0, 2.0])], schema)).collect()
    assert len(one) == 4 and all(r.whitened is None and r.explained is None and r.deviation == 0 and r.n == 1 and r.identity_error is None for r in one)
    flat = W.whiten(spark.createDataFrame([(i, [float(i), 5.0, 0.0]) for i in range(10)], schema)).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in flat) and flat[0].identity_error < 1e-9


def test_numbers_beyond_64_bits(spark):
    rows = [(1, [3e30, 1.0]), (2, [-3e30, 2.0]), (3, [0.0, 3.0])]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 6 and all(r.deviation is None for r in got if r.vec_id != 3)

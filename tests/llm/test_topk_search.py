from __future__ import annotations

import math

import numpy as np
import pytest

from dealweave.llm import topk_search as K


def brute(rows, top=10):
    ok = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in ok:
        if q % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:top])]
    return sorted(out)


@pytest.mark.parametrize("n,block", [(700, 32), (7, 256)])
def test_against_brute_force(spark, monkeypatch, n, block):
    monkeypatch.setattr(K, "BLOCK", block)
    monkeypatch.setattr(K, "GROUP", 128)
    monkeypatch.setattr(K, "SEED_VECTORS", 50)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(20, 8))
    rows = [(int(i), [float(np.float32(x)) for x in base[i % 20] + (0 if i % 3 else rng.normal(size=8))]) for i in range(n)]
    rows += [(1001, None), (1002, [1.0, None]), (1100, [float("nan")] * 8), (1003, [float("inf")] * 8), (1200, []), (1300, [1.0, -2.0]), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = K.search(df, df.filter("vec_id % 100 = 0"))
    assert [t for _, t in got.dtypes] == ["bigint", "int", "bigint", "bigint"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert K.search(df, df).count() == 0


def test_bounds_prune():
    ids, m = np.arange(64), np.zeros((64, 4))
    m[:32] = 100
    most, least = np.maximum.reduceat(m, [0, 32]), np.minimum.reduceat(m, [0, 32])
    K_BLOCK, K.BLOCK = K.BLOCK, 32
    try:
        near, score = K._scan(-1, np.ones(4), None, ids, m, most, least, 10)
    finally:
        K.BLOCK = K_BLOCK
    assert list(near) == list(range(10)) and set(score) == {400}

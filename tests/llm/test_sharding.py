from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np

from dealweave.llm import sharding as S


def test_sizes_checksums_and_gapless_places(spark):
    rows = [(i, "é" * (i % 97)) for i in range(500)] + [(1, None), (1, None), (None, ""), (None, ""), (None, "x" * 20000)]
    out = S.op4(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows)
    want = sorted((repr(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in out) == want
    places, load = defaultdict(list), defaultdict(int)
    for r in out:
        places[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert all(sorted(v) == list(range(len(v))) for v in places.values()) and set(places) <= set(range(16))
    rest = [v for v in load.values() if v < 20000]
    assert max(rest) - min(rest) <= 0.01 * np.mean(rest) + 2


def test_rebalancing_moves_little_and_fills_new_shards():
    rng = np.random.default_rng(1)
    load = rng.integers(0, 1000, 4096)
    first = S.rebalance(S.even_map(4096, 16), load, 16)
    sizes = np.bincount(first, weights=load, minlength=16)
    assert sizes.max() - sizes.min() <= 0.001 * sizes.mean() + 1
    grown = S.rebalance(first, load, 17)
    moved = load[grown != first].sum()
    assert moved < 1.3 * load.sum() / 17
    again = S.rebalance(grown, load, 17)
    assert (again == grown).all()


def test_empty_and_clashing_columns(spark):
    assert S.op4(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert S.shard(spark.createDataFrame([(1, "a", 9)], "doc_id long, text string, __slot int")).count() == 1

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa

from dealweave.llm import quality as Q
from dealweave.llm.common import texts


def made(n=400):
    rng = random.Random(1)
    words = [a + b for a in ("th", "er", "on", "an", "re") for b in ("ing", "ed", "a", "ou", "ly")]
    docs, labels = [], []
    for i in range(n):
        good = [rng.choice(words) for _ in range(rng.randrange(20, 200))]
        bad = [f"{w}%%%" for w in good] if i % 4 else good[:3] * 30
        y = int(i % 3 > 0)
        docs.append((i, " ".join(good if y else bad)))
        labels.append((i, y, 0))
    return docs, labels


def test_separates_and_holds_out(spark):
    docs, labels = made()
    docs += [(9001, None), (9002, ""), (None, "no id"), (5, docs[5][1])]
    labels += [(None, 1, 0), (7, None, None), (123456, 1, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    la = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = Q.op7(d, la).collect()
    assert len(got) == len(docs)
    truth = {i: y for i, y, _ in labels}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out and r.doc_id in truth and r.doc_id < 9000]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    again = {(r.doc_id, r.score) for r in Q.op7(d.repartition(3), la.repartition(2)).collect()}
    assert again == {(r.doc_id, r.score) for r in got}


def test_flat_forest_equals_walking_each_tree():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(500, 4)), rng.integers(0, 2, 500).astype(float)
    f = Q.grow(x, y)
    for row, got in zip(x[:50], f.score(x[:50])):
        z = f.start
        for t in range(len(f.leaf)):
            node = 0
            while node < 2**Q.DEPTH - 1:
                node = 2 * node + 1 + (row[f.feature[t, node]] > f.threshold[t, node])
            z += f.leaf[t, node - (2**Q.DEPTH - 1)]
        assert abs(got - 1 / (1 + np.exp(-z))) < 1e-9


def test_statistics_do_not_depend_on_neighbours():
    rows = ["One two two. THREE!!", None, "", "a\na\nb", "é " * 50]
    whole = np.vstack([Q.statistics(p) for p in texts(pa.array(rows))])
    alone = np.vstack([Q.statistics(p) for r in rows for p in texts(pa.array([r], pa.string()))])
    assert np.allclose(whole, alone) and np.isfinite(whole).all() and whole.shape == (5, len(Q.STATISTICS))


def test_no_labels_and_no_rows(spark):
    d = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in Q.op7(d, none).collect()] == [0.5]
    assert Q.op7(d.limit(0), none).count() == 0

from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from dealweave.llm import simhash_dedup as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    """Component ids by a plain search over all pairs."""
    fps = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2 and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    least = {k: min((r[0] for r, x in zip(rows, label) if x == k and r[0] is not None), default=None) for k in label}
    return sorted(((r[0], f"{f:016x}", least[k]) for r, f, k in zip(rows, fps, label)), key=repr)


def corpus():
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "abcdé" for b in "xyzÀß"]
    rows = []
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 40, 900]))]
        rows.append((i, " ".join(words)))
        for _ in range(rng.choice([0, 0, 1, 3])):
            w = list(words)
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((1000 + len(rows), "\t".join(w).upper() if rng.random() < 0.3 else "  ".join(w)))
    return rows + [(5000, None), (5001, ""), (5002, " \n"), (None, ""), (None, "one lone row"), (7, "one lone row again"), (7, "one lone row again")]


def test_components_against_all_pairs(spark):
    rows = corpus()
    got = S.op10(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_anchors_cover_every_pair_within_two_bits(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << k for k in rng.sample(range(64), n)) for b in base for n in (1, 2, 3)]
    signed = lambda x: int(np.uint64(x).astype(np.int64))
    points = spark.createDataFrame([(signed(x),) for x in {*base, *near}], "fp long")
    rows = S.anchored(points).collect()
    own = {}
    for r in rows:
        own.setdefault(r.fp, set()).add(r.anchor)
    assert {len(v) for v in own.values()} <= {2, 33}
    fps = sorted(own)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= 2:
                assert own[a] & own[b]


def test_one_of_each_group_stays(spark):
    rows = [(3, "a b c d", 1), (1, "a b c d", 2), (2, "x y z w", 3), (None, "", 4), (None, None, 5), (2, "q r s t", 6), (2, "x y z w", 7), (9, "q r s t", 8)]
    got = S.deduplicate(spark.createDataFrame(rows, "doc_id long, text string, n int"))
    assert got.columns == ["doc_id", "text", "n"]
    kept = sorted(((r.doc_id, r.text or "") for r in got.collect()), key=repr)
    assert kept == sorted([(1, "a b c d"), (2, "x y z w"), (None, ""), (2, "q r s t")], key=repr)


def test_long_chain_and_empty_input(spark, tmp_path):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90)], "a long, b long")
    assert {(r.node, r.root) for r in S.components(edges, str(tmp_path)).collect()} == {*((i, 0) for i in range(1, 41)), (100, 90)}
    assert S.op10(spark.createDataFrame([], "doc_id long, text string")).count() == 0

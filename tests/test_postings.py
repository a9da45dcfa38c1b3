"""Phrases in texts against a plain search, phrases that share beginnings, and long ones."""

from __future__ import annotations

import random
import re

import pytest

from dealweave.operators import postings as P


def brute(texts, phrases):
    out = []
    for i, t in texts:
        for e, p in phrases:
            if t is None or not p or not p.strip() or p not in t:
                continue
            at = t.index(p)
            before, after = t[at - 1:at] if at else "", t[at + len(p):at + len(p) + 1]
            whole = any(
                bool(re.match(r"\w", t[m:m + 1], re.A)) != bool(m and re.match(r"\w", t[m - 1], re.A))
                and bool(re.match(r"\w", t[m + len(p) - 1], re.A)) != bool(re.match(r"\w", t[m + len(p):m + len(p) + 1], re.A))
                for m in range(len(t)) if t.startswith(p, m)
            )
            out.append((i, e, whole, not before.isalnum() and not after.isalnum()))
    return sorted(out)


def data(seed):
    rng = random.Random(seed)
    words = ["ana", "banana", "nova", "renovated", "x", "of", "c++", "a-b", "the", "ananas", "no", "va1"]
    sep = [" ", " ", " ", ", ", "-", "  ", ". "]
    make = lambda n: "".join(rng.choice(words) + rng.choice(sep) for _ in range(n)).strip()
    texts = [(i, make(rng.randint(1, 12))) for i in range(120)] + [(500, None), (501, ""), (502, "   "), (503, "nova"), (504, "nova nova nova " * 40)]
    phrases = sorted({make(rng.randint(1, 3)) for _ in range(60)} | {w for w in words} | {"ov", "n", "va 1", " of ", "b-", "- "})
    return texts, list(enumerate(phrases)) + [(900, None), (901, ""), (902, "nova " * 13 + "nova")]


@pytest.mark.parametrize("seed,sent", [(1, P.SENT_PAIRS), (2, P.SENT_PAIRS), (2, 5)])
def test_against_a_plain_search(spark, monkeypatch, seed, sent):
    monkeypatch.setattr(P, "SENT_PAIRS", sent)
    texts, phrases = data(seed)
    t = spark.createDataFrame(texts, "id long, text string")
    p = spark.createDataFrame(phrases, "entry long, phrase string")
    want = brute(texts, phrases)
    assert sorted(map(tuple, P.find(t, p).collect())) == want
    words = {(i, e) for i, e, whole, _ in want if whole}
    got = P.find(t, p, inside_words=False).filter("whole").collect()
    assert {(r.id, r.entry) for r in got} == {(i, e) for i, e in words if any(re.search(r"\w", x, re.A) for j, x in phrases if j == e)} & words


def test_a_shared_beginning_is_not_an_anchor(spark):
    phrases = spark.createDataFrame([(i, f"nova {i:04d}") for i in range(300)] + [(1000 + i, f"novatech{i:04d}") for i in range(300)], "entry long, phrase string")
    probes = P.anchors(phrases, True)
    assert probes.groupBy("anchor").count().agg({"count": "max"}).first()[0] <= 2
    texts = spark.createDataFrame([(i, f"nova {i % 300:04d} and novatech{i % 7:04d}x nova") for i in range(200)], "id long, text string")
    got = P.find(texts, phrases)
    assert got.count() == 400 and got.filter("entry >= 1000 and (whole or alone)").isEmpty()


def test_no_texts_no_phrases(spark):
    t, p = spark.createDataFrame([], "id long, text string"), spark.createDataFrame([], "entry long, phrase string")
    assert P.find(t, p).isEmpty()
    assert P.find(spark.createDataFrame([(1, "a b")], "id long, text string"), p).isEmpty()

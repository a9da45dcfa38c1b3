from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from dealweave.llm import spelling_variants as V

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(count: dict[str, int]) -> list[tuple]:
    near = {w: [v for v in count if one_edit(w, v)] for w in count}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= 2 * count[w] else None
    out = []
    for w, n in count.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), count.get(form[w])))
    return sorted(out)


def rows(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


@pytest.mark.parametrize("most", [3, 40, 5000])
def test_variants_against_all_pairs(spark, most):
    rng = random.Random(5)
    words = set()
    for _ in range(120):
        w = "".join(rng.choice("abé") for _ in range(rng.randint(5, 9)))
        words.add(w)
        for _ in range(3):
            i = rng.randrange(len(w))
            words.add(rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abÿ") + w[i:], w[:i] + rng.choice("abÿ") + w[i + 1:]]))
    words |= {"p" * 5 + "".join(x) for x in itertools.product("xyz", repeat=3)}  # a third of all words under one prefix
    count = {w: rng.choice([3, 3, 4, 6, 12, 25]) for w in words}
    df = spark.createDataFrame(list(count.items()), "word string, n long")
    assert rows(V.variants(df, most=most)) == brute(count)


def test_groups_stay_small(spark):
    words = ["p" * 6 + "".join(x) for x in itertools.product("uvwxyz", repeat=4)]
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    met = V.groups(df, most=50)
    assert met.groupBy("m", "front", "back", "part").count().agg({"count": "max"}).first()[0] <= 50


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert V.variants(empty).count() == 0
    assert rows(V.variants(spark.createDataFrame([("words", 3)], "word string, n long"))) == [("words", None, "words", 3, 0, None)]


def test_query_against_brute_force(spark):
    rng = random.Random(11)
    base = ["Stränge", "strange", "stranger", "Colour", "color", "colours", "müller", "mueller", "abcde", "abcdf"]
    texts = []
    for i in range(400):
        own = rng.choices(base, k=12)
        own = [w if rng.random() < 0.8 else w[: (k := rng.randrange(len(w)))] + rng.choice("aeoß×÷") + w[k:] for w in own]
        texts.append((i, rng.choice([" ", "-", "\n", "1", "Ā"]).join(own)))
    texts += [(400, None), (401, ""), (402, "12 34"), (None, "strange strange colour"), (7, texts[7][1]), (403, "longword" * 3000 + " " + "strange " * 5000)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, word string, n int")
    count = Counter()
    for i, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    want = brute({w: n for w, n in count.items() if len(w) >= 5 and n >= 3})
    got = V.op13(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows(got) == want and any(r[1] for r in want)
    assert V.op13(docs.limit(0)).count() == 0


def test_ranges_are_skipped():
    words = sorted("".join(x) for x in itertools.product("abcdef", repeat=4))
    codes = np.array([[ord(c) for c in w] for w in words], np.int32)
    q, y = V._near(codes, np.full(len(words), 4), np.zeros(len(words), np.int64))
    assert sorted(zip(q.tolist(), y.tolist())) == [(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_edit(a, b)]

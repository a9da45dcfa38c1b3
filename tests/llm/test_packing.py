from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from dealweave.llm import packing as P

pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

ODD = [
    None, "", " ", "a", "Don't stop, it's <|endoftext|> here.", "x<|startoftext|>y <|ENDOFTEXT|>", "ÉCOLE, École; école! ΣΑΣ σας, İstanbul.", "é, q́, á.b", "a b c\x1cd\x85e",
    "12,345.67 (see p.9)...", "×,÷,é,ß. ÿ;", "word,word.Word)WORD", "don',t ',s 's. .'s", "z" * 5000, "日本語、テキスト。", "퟿\U0001f600,\U0001f600", "tab\tnew\nline\r\n, ,", "K,", "ﬁ, ﬁ.",
]


def expected(texts):
    tokenizer = Tokenizer.from_file(P.vocabulary_file())
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_ids_are_those_of_the_whole_text():
    rng = random.Random(2)
    parts = [x for t in ODD if t for x in t.split(" ")] + [",", ".", "'s", "é", "́", "<", "|>", "\n"]
    texts = ODD + ["".join(rng.choice(parts) + rng.choice(["", "", " "]) for _ in range(rng.randint(1, 30))) for _ in range(400)]
    coder = P.WordCoder(P.vocabulary_file())
    for _ in range(2):  # the second time from memory
        ids, at = coder.encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == expected(texts)
    assert all(len(w) <= P.LONGEST_WORD for w in coder.place)


def test_memory_is_cleared(monkeypatch):
    monkeypatch.setattr(P, "MOST_WORDS", 20)
    coder = P.WordCoder(P.vocabulary_file())
    for t in ("one two three " * 5, " ".join(f"w{i}x" for i in range(50)), "one two three", "four " + "q" * 90):
        ids, at = coder.encode(pa.array([t]))
        assert ids.tolist() == expected([t])[0]


def brute_best_fit(lengths, size):
    windows = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        rooms = [(size - sum(lengths[j] for j in w), -n) for n, w in enumerate(windows)]
        fits = [r for r in rooms if r[0] >= lengths[i]]
        if fits:
            least = min(r for r, _ in fits)
            windows[_first_with(windows, lengths, size, least)].append(i)
        else:
            windows.append([i])
    return windows


def _first_with(windows, lengths, size, room):
    return next(n for n, w in enumerate(windows) if size - sum(lengths[j] for j in w) == room)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_is_best_fit(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 65, 200)
    got = P.best_fit(lengths, 64)
    assert sorted(i for w in got for i in w) == list(range(200))
    room = lambda w: 64 - sum(int(lengths[i]) for i in w)
    # windows of equal room are alike for all that follows, so what is left in them is the same for any choice among them
    assert sorted(map(room, got)) == sorted(map(room, brute_best_fit(lengths.tolist(), 64)))


@pytest.mark.parametrize("lengths", [[], [1], [64], [40] * 50, [33, 33, 33], list(range(1, 64)), [63] * 9, [5]])
def test_arrange(lengths):
    got = P.arrange(np.array(lengths, np.int64), 64, 2)
    parts = defaultdict(list)
    for s in got:
        n = sum(b - a for _, a, b in s)
        assert 62 <= n <= 64 or n & (n - 1) == 0
        for i, a, b in s:
            parts[i].append((a, b))
    for i, n in enumerate(lengths):
        at = 0
        for a, b in sorted(parts[i]):
            assert a == at and b > a
            at = b
        assert at == n


@pytest.mark.parametrize("held", [3000, P.HELD_TOKENS])
def test_pieces(spark, held):
    rng = random.Random(4)
    texts = ODD + [" ".join(rng.choice(["alpha", "beta,", "Gamma."]) for _ in range(rng.choice([1, 5, 80, 300]))) for _ in range(60)] + ["long words " * 9000]
    rows = [(i, t, 5, "s") for i, t in enumerate(texts)] + [(3, texts[3], 5, "s"), (None, "no id", 5, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length long, ids string").repartition(3)
    want = defaultdict(list)
    for (i, *_), ids in zip(rows, expected([r[1] for r in rows])):
        want[i].append(ids)
    pieces = P.pack(docs, held=held).cache()
    by, seq = defaultdict(list), defaultdict(list)
    for r in pieces.collect():
        by[r.doc_id].append(r)
        seq[r.sequence_id].append(r)
    assert set(by) == set(want)
    for i, own in by.items():
        assert all(r.doc_tokens == len(want[i][0]) and P.numbers(r.ids) == want[i][0][r.start:r.start + r.length] for r in own)
        at = sorted((r.start, r.start + r.length) for r in own)
        for copies in [len(want[i])]:
            assert sum(b - a for a, b in at) == copies * len(want[i][0])
    padding = tokens = 0
    for own in seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= P.WINDOW
        tokens += at
        padding += 0 if at & (at - 1) == 0 else P.WINDOW - at
    assert padding <= tokens * 0.002
    whole = {r.sequence_id: r for r in P.sequences(pieces).collect()}
    for s, own in seq.items():
        assert P.numbers(whole[s].ids) == [x for r in sorted(own, key=lambda r: r.offset) for x in P.numbers(r.ids)]


def test_query(spark):
    docs = spark.createDataFrame([(1, "One text."), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in P.op11(docs).collect()}
    ids = expected(["One text.", ""])
    assert got[2].doc_tokens == 1 and got[2].ids_crc32 == zlib.crc32(np.array([2], "<u4").tobytes())
    assert got[1].doc_tokens == len(ids[0])
    assert P.op11(docs.limit(0)).count() == 0

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from dealweave.llm import suffix_dedup as S
from dealweave.llm.common import texts


def brute(rows):
    raws = [(t or "").encode() for _, t in rows]
    count = Counter(r[i:i + 200] for r in raws for i in range(len(r) - 199))
    out = []
    for (doc_id, _), r in zip(rows, raws):
        gone = bytearray(len(r))
        for i in range(len(r) - 199):
            if count[r[i:i + 200]] > 1:
                gone[i:i + 200] = b"\x01" * 200
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(60) for _ in range(4)] + [("x" * 199), ("y" * 200), ("z" * 450)]
    rows = []
    for i in range(40):
        parts = [prose(rng.randrange(0, 120))]
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            cut = rng.randrange(0, max(1, len(s) - 180))
            parts += [s[cut:], prose(rng.randrange(0, 40))]
        rows.append((i, " ".join(parts)))
    near = list(rows[3][1])
    for k in range(12):  # near copies with a changed character here and there
        own = list(near)
        for _ in range(2):
            own[rng.randrange(len(own))] = "#"
        rows.append((100 + k, "".join(own)))
    return rows + [(200, rows[5][1]), (5, rows[5][1]), (201, None), (202, ""), (203, "short"), (None, "no id " * 60), (None, None), (204, "ab" * 400), (205, "q" * 1000)]


@pytest.mark.parametrize("batches,piece", [(1, 4 << 20), (3, 300)])
def test_against_brute_force(spark, monkeypatch, batches, piece):
    rows = corpus()
    if piece == 300:  # one long text, cut into pieces in the workers too
        rows = rows + [(300, " ".join(f"{i * i}" for i in range(3000)) + rows[7][1])]
        monkeypatch.setattr(S, "PIECE_BYTES", piece)
    got = S.op9(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), batches=batches).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_pieces_cover_every_string_once():
    raw = bytes(np.random.default_rng(0).integers(97, 100, 5000, dtype=np.uint8)).decode()
    part = next(texts(pa.array([raw])))
    whole = S.Anchors(part)
    assert sorted(p for a, b in zip(whole.first, whole.last) for p in range(a, b + 1)) == list(range(len(raw) - 199))
    at, lo, hi, _ = whole.blocks(np.arange(len(whole.key)))
    assert sorted(p for a, b in zip(lo, hi) for p in range(a, b + 1)) == list(range(len(raw) - 199)) and (hi - lo < S.BLOCK).all()
    assert ((whole.anchor >= whole.last) & (whole.anchor + S.KEY <= whole.first + S.WIDTH)).all()
    S_PIECE, S.PIECE_BYTES = S.PIECE_BYTES, 700
    try:
        cut = [(S.Anchors(p), off) for p, off in S.pieces(part)]
    finally:
        S.PIECE_BYTES = S_PIECE
    assert sorted(p + off for c, off in cut for a, b in zip(c.first, c.last) for p in range(a, b + 1)) == list(range(len(raw) - 199))


def test_levels_stay_logarithmic(spark, tmp_path):
    docs = S.keyed(spark.createDataFrame([(i, f"{i} " * 100) for i in range(14)], "doc_id long, text string"))
    family = S.SuffixFamily(spark, str(tmp_path), 2)
    sizes = []
    for i in range(7):
        family.add(docs.filter(f"__id % 7 = {i}"))
        sizes.append([n for n, _ in family.levels])
    family.close()
    assert sizes == [[1], [2], [2, 1], [4], [4, 1], [4, 2], [4, 2, 1]]


def test_texts_lose_repeats_and_columns_stay(spark):
    passage = " ".join(f"wort{i}ü" for i in range(60))
    rows = [(1, f"Anfang hier. {passage} Ende eins", 7, "a"), (2, f"Etwas anderes {passage}", 8, "b"), (3, None, None, "c"), (4, "allein", 6, "d")]
    got = {r.doc_id: r for r in S.deduplicate(spark.createDataFrame(rows, "doc_id long, text string, n_chars long, lo string")).collect()}
    assert got[1].text.startswith("Anfang hier.") and got[1].text.endswith("Ende eins") and "wort9" not in got[1].text and got[1].n_chars == len(got[1].text)
    assert got[2].text.startswith("Etwas anderes") and got[3].text is None and got[4].text == "allein" and got[4].lo == "d"
    assert S.op9(spark.createDataFrame([], "doc_id long, text string")).count() == 0

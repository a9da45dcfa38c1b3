from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa

from dealweave.llm import language_id as L
from dealweave.llm.common import texts

PARTS = {"en": ["the", "ing", "wh", "tion", "ly"], "de": ["sch", "ung", "über", "keit", "pf"], "ru": ["при", "вет", "ст", "ого", "ла"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(1)
    counts = np.array([3, 0, 5, 1, 4])
    scores = rng.normal(size=(counts.sum(), 3)) * 3
    got = L.viterbi(scores, counts, 2.0)
    at = 0
    for n in counts:
        s = scores[at:at + n]
        cost = lambda path: sum(s[i, k] for i, k in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))  # noqa: B023, E731
        if n:
            assert cost(got[at:at + n]) == max(cost(p) for p in itertools.product(range(3), repeat=n))
        at += n


def test_learns_languages_and_spans(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, lang, rng.randrange(5, 60)), lang) for i, lang in enumerate(["en", "de", "ru"] * 60)]
    mixed = prose(rng, "en", 40) + ". " + prose(rng, "de", 25) + "! " + prose(rng, "en", 30)
    rows += [(900, mixed, "en"), (901, None, "en"), (902, "123 ... 4", "de"), (903, "", None), (904, prose(rng, "ru", 9), None), (None, prose(rng, "de", 20), "de"), (5, rows[5][1], rows[5][2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = L.op2(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert held and all(r.lang_pred == rows[r.doc_id][2] for r in held)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert by[901].lang_pred == by[902].lang_pred == by[903].lang_pred == "und" and by[901].score == 0
    assert by[900].lang_pred == "en" and 0 < by[900].score < 1 and by[900].n_spans == 3
    assert by[904].lang_pred == "ru" and by[None].lang_pred == "de"
    model = L.train(docs)
    spans = L.label(docs.filter("doc_id = 900"), model).first().lang_spans
    assert [s.lang for s in spans] == ["en", "de", "en"] and mixed[spans[0].end] == "." and spans[-1].end == len(mixed)


def test_scripts_narrow_candidates():
    part = next(texts(pa.array(["abc при 漢字 שלום x"])))
    assert [L.SCRIPTS[s] for s in L.words(part).script] == ["latin", "cyrillic", "han", "hebrew", "latin"]


def test_no_teachers_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in L.op2(docs).collect()] == ["und"]
    assert L.op2(docs.limit(0)).count() == 0

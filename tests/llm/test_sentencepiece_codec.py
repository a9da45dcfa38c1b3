from __future__ import annotations

import os
import random

import pytest
import sentencepiece

from dealweave.llm import sentencepiece_codec as S

pytestmark = pytest.mark.skipif(not os.path.exists(S.MODEL), reason="no public model file")
ODD = [None, "", " ", "  two  spaces ", "日本語テキスト\n\nxx", "cuneiform 𒀀 \t tab", "\n", " \n x", "é" * 50, "x" * 30000, "é combined", "trailing ", "\x00 nul"]


@pytest.fixture(scope="module")
def model():
    return S.Model(S.load())


def test_trie_finds_every_key_and_no_other():
    keys = {w.encode(): i for i, w in enumerate(["a", "ab", "abc", "b", "é", "éa", "zz"])}
    trie = S.DoubleArray.of(keys)

    def look(word):
        state = 0
        for b in word:
            to = trie.base[state] + b
            if trie.check[to] != state or to == 0:
                return -1
            state = to
        return trie.value[state]

    assert all(look(k) == v for k, v in keys.items())
    assert all(look(w.encode()) == -1 for w in ("", "z", "abcd", "ba", "è", "c"))


def test_best_paths_equal_the_library_lattice(model):
    # the same pieces as a unigram model: a second trainer_spec message sets the type; the n-best search is exact
    library = sentencepiece.SentencePieceProcessor(model_proto=S.load() + bytes([0x12, 2, 0x18, 1]))
    rng = random.Random(4)
    parts = ["th", "er", "in", "tion", "é", "über", "the", "stra", "ß", "of", "."]
    for _ in range(300):
        text = " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(1, 8)))
        want = library.nbest_encode_as_ids(text, 2)[0]
        got = model.encode(text).tolist()
        if sum(model.weights[i] for i in got) > -(2**24):  # beyond, the library's single-precision sums are rounded
            assert sum(model.weights[i] for i in got) == sum(model.weights[i] for i in want)
        assert model.decode(got) == library.decode(got) == text


def test_chunks_do_not_change_the_best_path(model):
    rng = random.Random(9)
    for _ in range(100):
        text = "".join(rng.choice("ab th\n é日  ") for _ in range(30))
        marked = model.normalised(text)
        assert sum(model.weights[i] if model.kinds[i] != S.BYTE else 0 for i in model.encode(text)) == sum(model.weights[i] if model.kinds[i] != S.BYTE else 0 for i in model.best(marked))


def test_many_chunks_at_once_equal_one_by_one(model):
    rng = random.Random(11)
    chunks = ["".join(rng.choice("▁abthßé日😀𒀀.in") for _ in range(rng.randrange(1, 20))) for _ in range(3000)] + ["▁the", "x" * 60, "▁"]
    assert model.best_of(chunks) == [model.best(c) for c in chunks]
    assert model.best_of([]) == []


def test_round_trips_and_columns(spark, model):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] + [(None, "no id", "x"), (1, "", "x")], "doc_id long, text string, ids string")
    out = S.op5(docs).collect()
    assert len(out) == len(ODD) + 2 and all(r.round_trip for r in out)
    assert all((r.ids is None) == (r.n_ids == 0 and r.doc_id == 0) for r in out)
    by = {r.doc_id: r for r in out}
    assert by[5].n_byte_ids >= 4 and by[1].ids == []
    back = S.decode(S.encode(docs, S.load()), S.load())
    assert sorted(back.columns) == ["doc_id", "ids", "text"]
    assert sorted(map(repr, ((r.doc_id, r.text) for r in back.collect()))) == sorted(map(repr, ((r.doc_id, r.text) for r in docs.collect())))
    assert S.op5(docs.limit(0)).count() == 0

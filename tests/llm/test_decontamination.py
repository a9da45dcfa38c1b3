from __future__ import annotations

import re

import pytest

from dealweave.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        w, hit, names = words(text), set(), set()
        for name, item in items:
            iw = words(item)
            n = min(window, len(iw))
            wins = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if n else set()
            for i in range(len(w) - n + 1 if n else 0):
                if tuple(w[i:i + n]) in wins:
                    hit |= set(range(i, i + n))
                    names |= {str(name)} if name is not None else set()
        out.append((doc_id, len(w), len(hit), len(names), D.digest(list(names)), bool(hit)))
    return sorted(out, key=repr)


LONG = " ".join(f"w{i}" for i in range(14))
ITEMS = [(1, LONG), (2, "Short, ITEM two."), (3, None), (4, "?!"), (10, LONG), (None, "nobody's own words"), (5, "é_é über-straße"), (2, "again two")]
DOCS = [
    (1, "before " + LONG.upper() + " after"), (2, "short item. two SHORT item two"), (3, None), (4, ""), (5, "É_é é_é Über über STRASSE straße über straße"), (6, "w0 w1 w2"),
    (7, "nobody s own words"), (1, "before " + LONG.upper() + " after"), (None, "again two"), (8, "x " * 5000 + LONG + " y" * 3000), (9, " ".join(f"w{i}" for i in range(9)) + "."),
    (11, "é_é über straße"),
]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_against_brute_force(spark, block_bytes):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = D.match(docs, items, block_bytes=block_bytes)
    got = [(r.doc_id, r.n_words, r.n_hit, len(r.hit_items), D.digest(r.hit_items), r.n_hit > 0) for r in out.collect()]
    assert sorted(got, key=repr) == brute(DOCS, ITEMS)
    if block_bytes > 60:
        assert sorted(map(tuple, D.op1(docs, items).collect()), key=repr) == brute(DOCS, ITEMS)


def test_passages_are_cut_and_columns_stay(spark):
    docs = spark.createDataFrame([(1, f"keep this. {LONG} And this one here with many more words to keep it alive", 5, "x"), (2, LONG, 3, "y"), (3, None, None, None)], "doc_id long, text string, n_chars long, hit_items string")
    items = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    got = {r.doc_id: r for r in D.decontaminate(docs, items, drop_share=0.8).collect()}
    assert set(got) == {1, 3} and got[1].text.startswith("keep this. ") and "w5" not in got[1].text and got[1].hit_items == "x"
    assert got[1].n_chars == len(got[1].text) and got[3].text is None
    assert {r.doc_id for r in D.decontaminate(docs, items, "documents").collect()} == {3}


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert not [r for r in D.op1(docs, none).collect() if r.contaminated]
    assert D.op1(docs.limit(0), none).count() == 0

from __future__ import annotations

import random
import zlib

import numpy as np

from dealweave.llm import toxicity as X


def weight(text, insults=None):
    """A plain reading of the grammar, clause by clause."""
    symbols = {w: s for s, ws in X.CLOSED.items() for w in ws}
    total = []
    for clause in text.replace("!", ".").split("."):
        w, left, said, target, here = 0.0, 0, False, False, False
        for word in clause.lower().split():
            s = symbols.get(word, X.INSULT if word in insults else X.OTHER)
            if s in (X.INSULT, X.THREAT):
                f = insults.get(word, X.THREAT_WEIGHT) * (0.25 if left else 1) * (0.5 if said else 1)
                f *= 0.1 if s == X.THREAT and not target else 1
                w, here = w + f, True
            left = 3 if s == X.NEGATION else max(0, left - 1)
            said |= s == X.REPORT
            target |= s == X.TARGET
        if here:
            total.append(w * (1.3 if target else 1))
    return total


def test_composed_machine_equals_plain_reading():
    import pyarrow as pa

    from dealweave.llm.common import texts

    insults = {"moron": 3.0, "scum": 5.0}
    lexicon = X.Lexicon.of({(0, w.encode()): v for w, v in insults.items()})
    rng = random.Random(0)
    words = ["moron", "scum", "you", "not", "said", "kill", "tree", "the", "never", "they"]
    for _ in range(200):
        text = ". ".join(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, 4)))
        want = weight(text, insults)
        got = X.clause_features(next(texts(pa.array([text]))), lexicon)[0]
        assert abs(got[0] - np.log1p(sum(want))) < 1e-9 and abs(got[1] - min(20, max(want, default=0))) < 1e-9


def made():
    rng = random.Random(1)
    plain = [a + b for a in ("ta", "mo", "li", "ru") for b in ("sen", "der", "pi", "ko", "")]
    docs, labels = [], []
    for i in range(600):
        w = [rng.choice(plain) for _ in range(rng.randrange(15, 80))]
        toxic = i % 5 == 0
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["blargh", "snark", "zorgfoo", "zorgbar", "zorgé"]))
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_learns_held_out_and_word_beginnings(spark):
    docs, labels = made()
    docs += [(9000, "tasen zorgnew moder. lipi zorgold"), (9001, None), (9002, ""), (None, "snark snark blargh"), (3, docs[3][1])]
    got = X.op6(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels + [(None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(docs)
    by = {r.doc_id: r for r in got}
    held = [r for r in got if r.held_out and r.doc_id < 9000]
    assert np.mean([r.predicted == int(r.doc_id % 5 == 0) for r in held]) > 0.97
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert by[9000].predicted == 1 and by[9001].predicted == by[9002].predicted == 0 and by[None].predicted == 1


def test_without_labels_and_rows(spark):
    docs = spark.createDataFrame([(1, "you are not here")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.predicted for r in X.op6(docs, none).collect()] == [0]
    assert X.op6(docs.limit(0), none).count() == 0

from __future__ import annotations

import hashlib
from collections import Counter

import corpus_pipeline as P
from dealweave.llm import decontamination, quality, sentencepiece_codec
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_simhash_dedup import brute as components

SF = "/root/testdata/sf0.001"


def kept_text(rows):
    raws = {i: (t or "").encode() for i, t in rows}
    count = Counter(r[k:k + 200] for r in raws.values() for k in range(len(r) - 199))
    out = {}
    for i, r in raws.items():
        gone = bytearray(len(r))
        for k in range(len(r) - 199):
            if count[r[k:k + 200]] > 1:
                gone[k:k + 200] = b"\x01" * 200
        out[i] = bytes(b for b, g in zip(r, gone) if not g).decode("utf-8", "ignore")
    return out


def test_each_stage_against_brute_force_on_its_input(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for i, (name, stage) in enumerate(P.STAGES):
        before = docs
        docs = stage(spark, docs, SF)
        docs.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert name == P.STAGES[-1][0] or docs.columns == columns
        seen[i] = ([(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()], docs.collect())
    before, after = seen[0]
    forest = quality.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    scored = quality.score(spark.createDataFrame(before, "doc_id long, text string"), forest).collect()
    assert {r.doc_id for r in after} == {r.doc_id for r in scored if r.score >= 0.5}
    before, after = seen[1]
    assert {r.doc_id for r in after} == {c for _, _, c in components(before)} and len(after) == len({r.doc_id for r in after})
    before, after = seen[2]
    assert {r.doc_id: r.text for r in after} == kept_text(before)
    before, after = seen[3]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    was = {d: (n, hit) for d, n, hit, *_ in contaminated(before, items)}
    assert {r.doc_id for r in after} == {d for d, (n, hit) in was.items() if hit == 0 or hit < decontamination.DROP_SHARE * n}
    assert not any(hit for _, _, hit, *_ in contaminated([(r.doc_id, r.text) for r in after if not was[r.doc_id][1]], items))
    before, after = seen[4]
    model = sentencepiece_codec.Model(sentencepiece_codec.load())
    assert {r.doc_id: model.decode(r.ids) for r in after} == dict(before) and all(r.round_trip for r in after)
    assert hashlib.sha256(repr(sorted(r.doc_id for r in P.run(spark, SF).collect())).encode()).digest() == hashlib.sha256(repr(sorted(r.doc_id for r in after)).encode()).digest()


def test_stages_are_named_as_dealt():
    assert [n for n, _ in P.STAGES] == ["quality classifier", "SimHash near-dedup", "suffix-array dedup", "benchmark decontamination", "SentencePiece encoding and decoding"]

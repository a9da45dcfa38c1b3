"""Copies of query blocks stay between executors."""

from __future__ import annotations

from pyspark.sql import functions as F

from dealweave.llm import topk_search


def test_copies_of_query_blocks_do_not_go_through_the_driver(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(topk_search, "GROUP", 64)  # several lanes
    rows = spark.range(400).select(F.col("id").alias("vec_id"), F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.sin(F.col("id") * (i + 1))).alias("embedding"))
    rows.write.parquet(f"{tmp_path}/v")
    vectors = spark.read.parquet(f"{tmp_path}/v")
    out = topk_search.search(vectors, vectors.filter("vec_id % 100 = 0"))
    assert "BroadcastExchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in out.collect()}
    assert len(got) == 40
    v = {r["vec_id"]: [int(x * 1024 // 1) for x in r["embedding"]] for r in vectors.collect()}
    for q in range(0, 400, 100):
        best = sorted((-sum(a * b for a, b in zip(v[q], v[d])), d) for d in v if d != q)[:10]
        assert [got[q, i + 1] for i in range(10)] == [d for _, d in best]

"""Costly expressions are worked out once a row, and only where they can match."""

from __future__ import annotations

from pyspark.sql import functions as F

from dealweave.functions import classify, entities
from dealweave.operators import funding, quality, ranking, signals


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


SIGNALS = "id int, data_json string, source string, company_id int, detected_at timestamp_ntz"
COMPANIES = "company_id int, name string, slug string, website string, x_handle string, github_org string"


def landed(spark):
    rows = [(1, '{"title": "Acme Corp raises $5m", "summary": "With Beta"}', "x", None), (2, '{"title": "Zeta Labs launches Nova"}', "rss", 1)]
    s = spark.createDataFrame([(*r, None) for r in rows], SIGNALS).withColumn("detected_at", F.lit("2001-01-01").cast("timestamp_ntz"))
    return s, spark.createDataFrame([(1, "Beta", "beta", "beta.io", "@beta", "beta")], COMPANIES)


def test_payload_is_parsed_once_for_all_fields_of_a_text(spark):
    s, _ = landed(spark)
    out = signals.parse_payloads(s).select("id", F.split(signals.payload_blob("title", "summary", "content"), " ").alias("words"))
    out = out.select("id", F.filter("words", lambda w: w != "").alias("words"))
    assert optimized(out).count("from_json") == 1
    assert {r["id"]: r["words"][0] for r in out.collect()} == {1: "Acme", 2: "Zeta"}


def test_names_in_headlines_are_looked_for_in_texts_with_a_verb(spark):
    texts = ["Acme Corp raises $5m", "Big Co-op & Sons\tAcquired it", "Raises", "No verb In This Text", "A raises", "x" * 60 + " raised", "Foo Bar Baz Qux Quux Corge Grault hits", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    plain = F.concat(*[F.regexp_extract_all("text", F.lit(p), F.lit(1)) for p in entities.HEADLINE_PATTERNS])
    plain = F.array_sort(F.array_distinct(F.filter(F.transform(plain, entities.entity_name), entities.plausible_name)))
    got = df.select("id", entities.headline_entities(F.col("text")).alias("a"), plain.alias("b"))
    assert all(r["a"] == r["b"] for r in got.collect())
    assert optimized(got.select("a")).count("RLIKE") >= len(entities.HEADLINE_PATTERNS)


def test_classifier_is_short_enough_to_be_compiled(spark):
    import re

    df = spark.range(1).select("id", F.lit("x").alias("source"), F.col("id").cast("string").alias("text"))
    plan = classify.classify(df, "text", "source")._jdf.queryExecution().executedPlan()
    debug = getattr(getattr(spark._jvm, "org.apache.spark.sql.execution.debug.package$"), "MODULE$")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan))]
    assert max(sizes) < 8000  # longer methods are left to the interpreter


def test_names_of_signals_are_found_once(spark):
    s, c = landed(spark)
    out = ranking.mention_stats(s, c, "2001-01-02")
    assert "from_json" not in optimized(out)
    assert sorted(r["name"] for r in out.collect()) == ["Acme Corp", "Zeta Labs"]


def test_events_that_name_a_company_are_looked_for_once(spark):
    s, c = landed(spark)
    e = spark.createDataFrame([(10, 1, None, "A round"), (11, 2, 1, "Beta")], "id int, raw_signal_id int, company_id int, description string")
    out = quality.actionable_nulls(e, s, c)
    assert "from_json" not in optimized(out)
    assert [tuple(r) for r in out.collect()] == [(1, 1)]


def test_deals_are_read_once_from_a_text(spark):
    texts = ["Acme raises $5 million Series A led by Big Fund with participation from Small Fund", "no deal", None]
    df = spark.createDataFrame([(i, t, "Funding Round", None) for i, t in enumerate(texts)], "id int, text string, event_type string, event_amount long")
    out = funding.parse_deals(df)
    assert optimized(out.select("id", "lead_investor", "co_investors")).count("(?:investment|round|funding)") == 1
    rows = {r["id"]: r for r in out.collect()}
    assert list(rows) == [0] and rows[0]["lead_investor"] == "Big Fund" and rows[0]["amount_usd"] == 5_000_000


def test_the_label_of_an_alert_is_worked_out_once(spark):
    from dealweave.catalog.rank_q import RULES
    from dealweave.operators import alerts

    rows = [(1, None, "Funding Round", 0.7, 5_000_000), (2, None, "Funding Round", 0.7, 10), (3, 1, "Hiring", 0.1, None), (4, 1, None, None, None)]
    e = spark.createDataFrame(rows, "id int, company_id int, event_type string, confidence double, amount_usd long")
    out = alerts.match_rules(e, RULES).select("id", "alert_type")
    assert optimized(out).count("Big funding") == 1
    assert sorted(tuple(r) for r in out.collect()) == [(1, "Big funding"), (3, "hiring_spree"), (4, "Big funding")]


def test_registered_queries_leave_no_method_to_the_interpreter(spark):
    from dealweave.catalog.registry import Tables

    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    Tables(spark, "")
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_payloads_read_the_same_where_no_one_asks_for_strictness(spark):
    texts = ['{"title": "A", "url": null}', "{'title': None, 'name': 'b'}", "{'title': 'None, so far', 'high_signal': True}", '{"title": "True"} x', '{"title": "a", "title": "b"}',
             '{"title": "T\\\\q"}', "[1]", "no", "", None, '{"title": {"a": 1.50}, "id": False}', '{"title": ', " {'title': 'x'}"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, data_json string")
    a, b = (signals.parse_payloads(df, strict=s).select("id", "payload") for s in (True, False))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert "strict" not in signals.parse_payloads(df, strict=False).columns


def test_events_are_parsed_once_for_relinking(spark, monkeypatch):
    from dealweave.operators import repair, resolve

    s, c = landed(spark)
    e = spark.createDataFrame([(10, 1, None, "A round"), (11, 2, 1, "Beta"), (12, 2, None, "beta, again"), (13, None, None, "Betamax")], "id int, raw_signal_id int, company_id int, description string")
    seen = []
    monkeypatch.setattr(resolve, "resolve_company", lambda hints, companies: seen.append(hints) or hints.withColumn("company_id", F.lit(1)))
    out = repair.relink_orphans(e, s, c, actionable=True)
    assert "from_json" not in optimized(seen[0])
    assert sorted(r["id"] for r in out.collect()) == [10, 12, 13]


def test_bulk_claims_parse_only_their_sources(spark):
    from dealweave.operators import claims

    rows = [(1, '{"title": "x"}', "SEC_Edgar", 1), (2, '{"title": "x"}', "TechCrunch", 1), (3, '{"title": "x"}', "hackernews", None)]
    df = spark.createDataFrame([(*r, None) for r in rows], SIGNALS.replace("timestamp_ntz", "string"))
    assert [r["id"] for r in claims.bulk_rows(df).collect()] == [1]


def test_payloads_of_signals_do_not_go_through_the_driver(spark, tmp_path):
    from dealweave.operators import claims, repair

    landed(spark)[0].write.parquet(f"{tmp_path}/signals")
    s = spark.read.parquet(f"{tmp_path}/signals")
    e = spark.createDataFrame([(10, 1, 1, "Funding Round", "x", "x", "A round of Acme Corp")], "id int, raw_signal_id int, company_id int, event_type string, source string, source_url string, description string")
    e = e.withColumns({"amount_usd": F.lit(None).cast("long"), "confidence": F.lit(0.5), "announced_date": F.lit("2001-01-01"), "created_at": F.lit("2001-01-01").cast("timestamp_ntz")})
    for out in (claims.event_texts(e, s), funding.event_claims(e, s), repair.reclassify_misfunded(e, s)):
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 1


def test_keys_of_compressed_files_are_not_sent_by_the_files_size(spark, tmp_path):
    from dealweave.catalog.registry import Tables

    spark.conf.set("spark.sql.sources.fileCompressionFactor", "1.0")
    Tables(spark, "")
    for name in ("a", "b"):
        spark.range(1_000_000).select(F.xxhash64("id").alias("id"), F.lit("x" * 90).alias("text")).write.parquet(f"{tmp_path}/{name}")
    a, b = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("a", "b"))
    plan = a.join(b.select("id"), "id", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan


def test_repairs_parse_payloads_once_and_classify_general_news_only(spark, monkeypatch):
    from dealweave.functions import classify as classifier
    from dealweave.operators import repair, resolve

    s, c = landed(spark)
    rows = [(10, 1, 1, "General News", None, "x"), (11, 2, 1, "Hiring", None, "Zeta raises $3m"), (12, 1, 1, "General News", None, "older"), (13, 7, 1, "Funding Round", None, "nothing here that speaks of it")]
    e = spark.createDataFrame(rows, "id int, raw_signal_id int, company_id int, event_type string, amount_usd long, description string").withColumns({"source": F.lit("x"), "confidence": F.lit(0.5)})
    monkeypatch.setattr(resolve, "resolve_company", lambda hints, companies: hints.limit(0).withColumn("company_id", F.lit(1)))
    out = repair.repair(e, s, c)
    assert optimized(out).count("from_json") <= 2  # one for labels and amounts, one for events without a company
    got = {r["id"]: (r["event_type"], r["amount_usd"]) for r in out.collect()}
    assert got == {12: ("Funding Round", 5_000_000), 11: ("Hiring", None), 13: ("General News", None)}
    seen = []
    monkeypatch.setattr(classifier, "classify", lambda df, text, *rest: seen.append([r[0] for r in df.select(text).collect()]) or df.withColumns({"__label": F.lit("general"), "__conf": F.lit(0.1)}))
    repair.reclassify_general(e, s)
    assert sum(t is not None for t in seen[0]) == 2


def test_terms_of_a_vector_are_hashed_once(spark):
    from dealweave.operators import search

    df = spark.range(1).select("id", F.concat(F.lit("A round of "), F.col("id")).alias("text"))
    out = search.term_counts(df, F.col("text")).select("embedding")
    assert not any("md5" in line and "AS embedding" in line for line in optimized(out).splitlines())
    assert out.first()["embedding"] == search.query_vector("a round of 0")

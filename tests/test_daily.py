"""Stages of the composite jobs reach what follows them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dealweave import views
from dealweave.operators import company, quality, repair
from dealweave.plans import rollups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    raw, events, companies = (views.table(spark, SF, n) for n in ("v_signals", "v_events", "v_companies"))
    return raw.filter("id < 300").localCheckpoint(), events.filter("raw_signal_id < 300").localCheckpoint(), companies.localCheckpoint()


def test_a_profile_changes_its_company(spark):
    c = spark.createDataFrame([(1, "A", "Robotics", "a.io", None), (2, "B", "Cloud", "b.io", "entity_type=LLC"), (3, "C", "Cloud", "c.io", "x")], "company_id long, name string, industry string, website string, notes string")
    p = spark.createDataFrame([(1, "B2B", "", "Corporation", "A Inc"), (2, None, "https://b.com", "LLC", None), (4, "x", "x", "x", None)], "company_id long, industry string, website_url string, entity_type string, legal_name string")
    got = {r["company_id"]: tuple(r)[2:] for r in company.with_profiles(c, p).collect()}
    assert got == {1: ("B2B", "a.io", "entity_type=Corporation legal_name=A Inc"), 2: ("Cloud", "https://b.com", "entity_type=LLC"), 3: ("Cloud", "c.io", "x")}
    assert company.with_profiles(c.drop("notes"), p).filter("company_id = 1").first()["notes"] == "entity_type=Corporation legal_name=A Inc"


def test_company_data_rollup_gives_all_that_it_found(spark, tables):
    out = rollups.company_data_rollup(tables[1], tables[0], tables[2], "test-company")
    changed = out["companies"].filter("industry = 'B2B'")
    assert changed.count() > 0 and out["companies"].count() == tables[2].count()
    facts = {r["part"]: r["count"] for r in rollups.company_facts(out).groupBy("part").count().collect()}
    assert facts["team_members"] == out["team_members"].count() and facts["companies"] == out["companies"].count()
    assert {"products", "regulatory_licenses", "company_details"} <= set(facts)


def test_ranking_gives_companies_their_score(spark, tables):
    out = rollups.discover_and_rank(*tables, F.lit("2001-01-01").cast("timestamp_ntz"), 36500, "test-rank")
    ranked = {r["company_id"]: r["score"] for r in out["ranking"].collect()}
    assert ranked
    scores = {r["company_id"]: r["score"] for r in out["companies"].collect()}
    assert all(scores[k] == v for k, v in ranked.items())
    old = {r["company_id"]: r["score"] for r in tables[2].collect() if r["company_id"] not in ranked}
    assert all(scores[k] == v for k, v in old.items())


def test_the_brief_shows_scores_and_profiles_of_the_day(spark, tables, monkeypatch):
    raw, events, companies = tables
    scored = companies.withColumn("score", F.col("company_id") + 2.0)
    one = spark.createDataFrame([([], True)], "failed array<string>, passed boolean")
    monkeypatch.setattr(rollups, "with_children", lambda s, at: s)
    monkeypatch.setattr(rollups, "process", lambda s, e, c, run: (s, e))
    monkeypatch.setattr(repair, "repair", lambda e, s, c: e)
    monkeypatch.setattr(quality, "quality_metrics", lambda s, e, c: one)
    monkeypatch.setattr(quality, "quality_gate", lambda m: m)
    monkeypatch.setattr(rollups, "jobs_rollup", lambda *a: {})
    monkeypatch.setattr(rollups, "discover_and_rank", lambda *a, run: {"companies": scored, "ranking": scored.withColumn("recent", F.lit(1))})
    rounds = spark.createDataFrame([(1, "k", 2, 0.5)], "company_id long, cluster_key string, report_count long, corroboration_score double")
    monkeypatch.setattr(rollups, "funding_rollup", lambda e, s, c, g, run: {"events": e, "rounds": rounds})
    out = rollups.daily(raw, events, companies, None, None, F.lit("2001-01-01").cast("timestamp_ntz"), "test-daily")
    top = out["brief.top_companies"].collect()
    assert [r["score"] for r in top] == sorted((r["score"] for r in scored.collect()), reverse=True)[:10]
    after = {r["company_id"]: r["industry"] for r in out["companies"].collect()}
    assert [r["industry"] for r in top] == [after[r["company_id"]] for r in top] and "B2B" in after.values()
    report = rollups.day_report(out, "test-daily").collect()
    assert {r["cluster_key"]: r["report_count"] for r in report if r["part"].startswith("rows.")} == {name: df.count() for name, df in out.items()}
    assert [r["cluster_key"] for r in report if r["part"] == "brief.top_companies"] == [r["name"] for r in top]
    assert {"funding.rounds", "brief.signal_counts", "rank.ranking", "gate"} <= {r["part"] for r in report}

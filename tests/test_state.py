"""Merges over many reports, ids of all 64 bits, prefix matches, and what processing writes back."""

from __future__ import annotations

from dealweave.operators import keyed, resolve


def test_middle_reports_are_folded(spark):
    rows = [(1, "u", "r1", None, 1.0), (2, "u", None, "link", 3.0), (3, "u", None, None, 2.0), (1, "v", "a", "b", 1.0)]
    df = spark.createDataFrame(rows, "id long, source_url string, role string, link string, weight double")
    policy = {"role": "coalesce", "link": "coalesce", "weight": "overwrite"}
    got = {r.source_url: r for r in keyed.fold(df, ["source_url"], "id", policy).collect()}
    assert (got["u"].id, got["u"].role, got["u"].link, got["u"].weight) == (1, "r1", "link", 2.0)
    assert tuple(got["v"]) == (1, "v", "a", "b", 1.0)


def test_registry_titles_open_names_and_names_open_titles(spark):
    names = spark.createDataFrame([("Acmeco Ltd",), ("Acm",), ("Exact Co",), ("zzz",), ("",)], "name string")
    registry = spark.createDataFrame([(1, "Acme, Inc."), (2, "Acmer Group"), (3, "exact co"), (4, "Exact Co, Inc.")], "registrant_id long, title string")
    got = {r.name: (r.registrant_id, r.how) for r in resolve.registry_match(names, registry).collect()}
    assert got == {"Acmeco Ltd": (1, "prefix"), "Acm": (1, "prefix"), "Exact Co": (3, "exact")}


def test_aliases_of_companies_with_hashed_ids(spark):
    from dealweave import views

    companies = views.table(spark, "/root/testdata/sf0.001", "v_companies")
    from pyspark.sql import functions as F

    big = companies.withColumn("company_id", F.lit(-(2**63) + 5) + F.col("company_id"))
    name = big.orderBy("company_id").first().name
    titles = spark.createDataFrame([(1, f"News about {name} today")], "id long, title string")
    assert resolve.by_title_alias(titles, big).count() == 1


def test_processing_marks_signals_and_links_events(spark):
    from dealweave import views
    from dealweave.plans import rollups

    sf = "/root/testdata/sf0.001"
    raw, events, companies = (views.table(spark, sf, n) for n in ("v_signals", "v_events", "v_companies"))
    raw = raw.orderBy("id").limit(120)
    mine = events.join(raw.select(raw.id.alias("raw_signal_id")), "raw_signal_id", "left_semi").drop("status", "priority", "template", "signal_company_id")
    signals, after = rollups.process(raw, mine, companies, "test-process")
    assert signals.count() == raw.count() and signals.filter("not processed").count() == 0
    had = raw.filter("company_id is not null").count()
    assert signals.filter("company_id is not null").count() >= had
    assert after.select("raw_signal_id").distinct().count() == raw.count()

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dealweave.functions import classify, deals, entities, jobs, money, text, trust
from dealweave.functions.numbers import rounded


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select(expr(F.col("v")).alias("x"), "i").orderBy("i").collect()]


HEADLINES = [
    ("Northwind launches a routing platform for couriers", "Product Launch"),
    ("Harbor Labs partners with Tessel on freight insurance", "Partnership"),
    ("Quill acquires the map startup Overlay", "Acquisition"),
    ("Fernway hires Dana Okoro as chief revenue officer", "Hiring"),
    ("Basalt opened an office after raising $12 million Series B", "Funding Round"),
    ("rain expected in the north until Thursday", "General News"),
    ("undisclosed location of the old mill", "General News"),
]


def test_headlines(spark):
    df = spark.createDataFrame([(t, "techcrunch", e) for t, e in HEADLINES], "text string, source string, want string")
    out = classify.classify(df, "text", "source").withColumn("got", classify.label_title(F.col("label")))
    assert [(r.text, r.got) for r in out.collect()] == HEADLINES


def test_amounts(spark):
    got = column(spark, ["raised $2.5 million", "$1.2B valuation after $30M", "$ 750K seed", "$250,000 grant", "$9", "1.2.3 million", None], money.amount_usd)
    assert got == [2_500_000, 1_200_000_000, 750_000, 250_000, None, None, None]


def test_billion_wins_over_million(spark):
    assert column(spark, ["raised $20 million at a $2 billion valuation"], money.amount_usd) == [2_000_000_000]


def test_source_family(spark):
    names = ["Hacker News", "hn", "Product Hunt Daily", "https://github.com/org/repo", "https://feeds.example/rss.xml", "", "my-custom-source"]
    assert column(spark, names, classify.source_family) == ["hackernews", "hackernews", "producthunt", "github", "rss", "rss", "my-custom-source"]


def test_dedup_key_ignores_fragment_and_case(spark):
    urls = ["https://Example.com/a/", "https://example.com/a#top", "https://example.com/a?x=1", "example.com/a"]
    keys = column(spark, urls, text.url_key)
    assert keys[0] == keys[1] != keys[2]
    assert column(spark, ["HTTPS://WWW.Example.com/Path/?q=1#f", "x:me:hello"], text.canonical_url) == ["https://www.example.com/Path?q=1", "x:me:hello"]


def test_hosts(spark):
    assert column(spark, ["https://www.a.io/x", "a.io:80", "raw_signal:5", None], text.publisher_domain) == ["a.io", "a.io", "raw_signal", None]


def test_round_types(spark):
    got = column(spark, ["closes series b+", "pre-seed round", "angel cheque", "late stage growth", "raised money", "nothing"], lambda c: deals.round_type(c)["name"])
    assert got == ["Series B", "Seed", "Pre-Seed", "Growth", "Funding Round", None]


def test_investors(spark):
    texts = [
        "Acme raises $5M led by Sequoia Capital with participation from Accel, Greylock Partners",
        "round co-led by Index Ventures and Accel Partners, with others",
        "raised $3M from Alpha Fund, Beta Fund and Gamma",
        "no names here",
    ]
    got = column(spark, texts, deals.investors)
    assert (got[0]["lead"], got[0]["co"]) == ("Sequoia Capital", ["Accel", "Greylock Partners"])
    assert (got[1]["lead"], got[1]["co"]) == ("Index Ventures", ["Accel Partners"])
    assert (got[2]["lead"], got[2]["co"]) == ("Alpha Fund", ["Beta Fund", "Gamma"])
    assert (got[3]["lead"], got[3]["co"]) == (None, [])


def test_trust(spark):
    df = spark.createDataFrame(
        [("x", "https://x.com/a", True), ("rss", "https://blog.acme.io/post", False), ("rss", "https://www.sec.gov/x", False),
         ("rss", "https://news.techcrunch.com/x", False), ("zzz", "https://nobody.example/x", False)], "s string, u string, r boolean")
    rows = df.select(trust.source_trust(F.col("s"), F.col("u"), F.lit("https://acme.io"), F.col("r")).alias("t")).collect()
    assert [(r.t.tier, r.t.weight, r.t.official) for r in rows] == [
        ("social", 0.45, False), ("company_official", 1.0, True), ("regulatory", 0.95, True), ("tier1_media", 0.78, False), ("unknown", 0.5, False)]


def test_job_fields(spark):
    df = spark.createDataFrame([("Senior Backend Engineer", "Python, PostgreSQL, AWS. $160k-$190k. Remote US.")], "t string, d string")
    both = F.concat_ws(" ", "t", "d")
    r = df.select(jobs.seniority(F.col("t")), jobs.pay_range(both), jobs.skills(both), jobs.remote_policy(F.lit(None).cast("string"), F.col("d"))).first()
    assert r[0] == "senior" and (r[1].low, r[1].high) == (160_000, 190_000) and r[3] == "remote"
    assert {s.skill for s in r[2]} >= {"python", "postgresql", "aws"}


def test_entities(spark):
    got = column(spark, ["Acme Robotics raises $5M", "THE raises money", ""], entities.headline_entities)
    assert got == [["Acme Robotics"], [], []]


@pytest.mark.parametrize("value, digits, want", [(1.005, 2, 1.0), (0.1249, 3, 0.125), (1.0, 3, 1.0)])
def test_rounding_uses_the_stored_value(spark, value, digits, want):
    assert spark.range(1).select(rounded(F.lit(value), digits)).first()[0] == want

from __future__ import annotations

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from dealweave.operators import corroboration, funding, keyed, lookup, resolve, signals, social
from dealweave.sources import landed

COMPANIES = [
    (1, "Acme Robotics", "acme-robotics", "https://acme.io", "@acmebots", "acmelabs"), (2, "Blue Ring", "blue-ring", "https://www.bluering.com", None, None),
    (3, "Ringside", "ringside", None, "@ringside", "ringside"), (4, "Old Ring Co", "old-ring-co", None, None, None), (5, "Zed", "zed", None, None, None),
]


@pytest.fixture(scope="module")
def companies(spark):
    return spark.createDataFrame(COMPANIES, "company_id bigint, name string, slug string, website string, x_handle string, github_org string")


def edit_similarity(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return 1 - row[-1] / max(len(a), len(b))


def test_edit_distance_join_is_exact(spark):
    """The segment join finds every pair a full comparison finds."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 14))) for _ in range(120)]
    names = []
    for w in words:
        chars = list(w)
        for _ in range(rng.randint(0, 3)):
            spot = rng.randrange(len(chars) + 1)
            op = rng.random()
            if op < 0.4:
                chars.insert(spot, rng.choice("abcde"))
            elif chars and spot < len(chars):
                chars[spot] = rng.choice("abcde") if op < 0.7 else ""
        names.append("".join(chars) or "a")
    comps = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "company_id bigint, name string")
    probes = spark.createDataFrame([(n,) for n in set(names)], "q string")
    got = {(r.q, r.company_id) for r in resolve._edit_distance(probes, comps).collect()}
    want = {(n, i) for n, (i, w) in itertools.product(set(names), enumerate(words)) if n != w and edit_similarity(n, w) > 0.75}
    assert {p for p in got if p[0] != words[p[1]]} == want


def test_fuzzy_rules(spark, companies):
    names = spark.createDataFrame([("ACME",), ("Acme Robotic",), ("Blue Ring Ltd",), ("ring",), ("Nothing Alike",), ("x",)], "name string")
    got = {r.name: (r.company_id, round(r.score, 3)) for r in resolve.fuzzy_match(names, companies).collect()}
    assert got["ACME"] == (1, 1.0)  # alias: a longer word of the name
    assert got["Acme Robotic"][0] == 1
    assert got["Blue Ring Ltd"] == (2, round(9 / 13, 3))
    assert got["ring"] == (4, 1.0) or got["ring"] == (2, 1.0)  # alias words win, the later company
    assert "Nothing Alike" not in got and "x" not in got


def payload(**fields):
    base = dict.fromkeys(["company_ref", "company_hint", "url", "channel", "listed", "title", "headline", "blob"])
    return {**base, **fields}


def test_cascade_order(spark, companies):
    schema = "id int, company_ref bigint, company_hint string, url string, channel string, listed array<string>, title string, headline string, blob string"
    rows = [
        payload(company_ref=5, url="https://acme.io/x"), payload(url="https://github.com/AcmeLabs/app"), payload(url="https://news.bluering.com/post"),
        payload(listed=["Nobody", "Ringside"], title="About Acme Robotics"), payload(title="Hello", blob="now zed and Blue Ring here"), payload(title="quiet day"),
    ]
    df = spark.createDataFrame([(i, *[r[k] for k in list(payload())]) for i, r in enumerate(rows)], schema)
    got = {r.id: (r.company_id, r.method) for r in resolve.resolve_company(df, companies).collect()}
    assert got == {0: (5, "company_id"), 1: (1, "repo"), 2: (2, "domain"), 3: (3, "listed"), 4: (2, "name_in_text")}


def test_whole_words_only(spark, companies):
    texts = spark.createDataFrame([(1, "the blue rings"), (2, "a blue ring!"), (3, "Blue Ring")], "id int, text string")
    assert {r.id for r in resolve.by_name_in_text(texts, companies).collect()} == {2, 3}


def test_keep_rules(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z")], "k string, id int, v string")
    assert {(r.k, r.v) for r in keyed.keep_first(df, ["k"], ["id"]).collect()} == {("a", "x"), ("b", "z")}
    assert {(r.k, r.v) for r in keyed.keep_last(df, ["k"], ["id"]).collect()} == {("a", "y"), ("b", "z")}


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = keyed.top_n(df, ["k"], [F.desc("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")  # below and above the exchange


def test_merge_policies(spark):
    old = spark.createDataFrame([(1, 5, "old", None), (2, 6, "keep", "t")], "k int, score int, src string, note string")
    new = spark.createDataFrame([(1, 3, "new", "n"), (3, 9, "add", None)], "k int, score int, src string, note string")
    out = keyed.merge_upsert(old, new, ["k"], {"score": "max", "src": "keep", "note": "coalesce"})
    assert sorted(tuple(r) for r in out.collect()) == [(1, 5, "old", "n"), (2, 6, "keep", "t"), (3, 9, "add", None)]


def test_duplicates_within_window(spark):
    days = [0, 3, 9, 17, 17, 40]
    df = spark.createDataFrame([(i, 1, "T", "u", d) for i, d in enumerate(days)], "id int, company_id int, event_type string, source_url string, d int")
    df = df.withColumn("created_at", F.expr("timestamp '2024-01-01' + make_interval(0,0,0,d)"))
    got = {r.id: r.is_duplicate for r in lookup.duplicates_within(df).collect()}
    assert got == {0: False, 1: True, 2: True, 3: False, 4: True, 5: False}


def claims(spark, rows):
    base = {"id": 0, "source_url": None, "source": "rss", "source_tier": "tier1_media", "source_weight": 0.78, "is_official": False, "is_rumor": False,
            "amount_usd": None, "round_type": "Series A", "lead_investor": "Sequoia", "announced_date": "2024-01-01", "extraction_confidence": 0.8,
            "company_id": 1, "co_investors": None}
    full = [{**base, "id": i, **r} for i, r in enumerate(rows)]
    schema = ("id bigint, source_url string, source string, source_tier string, source_weight double, is_official boolean, is_rumor boolean, amount_usd bigint, "
              "round_type string, lead_investor string, announced_date string, extraction_confidence double, company_id bigint, co_investors string")
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], schema)


def score(spark, rows):
    return corroboration.corroborate(claims(spark, rows), "company_id").first()


def test_corroboration_invariants(spark):
    one = score(spark, [{"source_url": "https://a.com/1", "amount_usd": 10_000_000}])
    assert one.score <= 0.40
    same = score(spark, [{"source_url": f"https://a.com/{i}"} for i in range(6)])
    assert same.unique_domains == 1 and same.score < 0.45
    two = score(spark, [{"source_url": "https://a.com/1"}, {"source_url": "https://b.com/1", "announced_date": "2024-01-05"}])
    assert two.score >= 0.45
    five = score(spark, [{"source_url": f"https://d{i}.com/1", "announced_date": f"2024-01-{1 + 7 * i % 28:02d}", "amount_usd": 10_000_000} for i in range(5)])
    assert five.score >= 0.75
    official = score(spark, [{"source_url": "https://acme.io/1", "is_official": True, "source_weight": 1.0, "source_tier": "company_official"}])
    assert 0.45 <= official.score <= 0.60
    agree = score(spark, [{"source_url": "https://a.com/1", "amount_usd": 10_000_000}, {"source_url": "https://b.com/1", "amount_usd": 10_500_000}])
    differ = score(spark, [{"source_url": "https://a.com/1", "amount_usd": 10_000_000}, {"source_url": "https://b.com/1", "amount_usd": 50_000_000}])
    rumor = score(spark, [{"source_url": "https://a.com/1", "amount_usd": 10_000_000, "is_rumor": True}, {"source_url": "https://b.com/1", "amount_usd": 10_500_000}])
    assert agree.score > differ.score and agree.score > rumor.score


def test_two_outlets_one_round(spark):
    rows = claims(spark, [
        {"source_url": "https://a.com/1", "amount_usd": 12_000_000, "announced_date": "2024-03-01"},
        {"source_url": "https://b.com/1", "amount_usd": 12_000_000, "announced_date": "2024-04-02"},
        {"source_url": "https://c.com/1", "amount_usd": 90_000_000, "announced_date": "2024-04-02"}])
    for n in ("valuation_usd", "pre_money_valuation_usd", "post_money_valuation_usd"):
        rows = rows.withColumn(n, F.lit(None).cast("bigint"))
    rows = rows.withColumn("instrument_type", F.lit("equity")).withColumn("currency", F.lit("USD"))
    out = funding.funding_rounds(funding.merge_clusters(rows)).collect()
    assert sorted(r.report_count for r in out) == [1, 2]
    assert max(r.corroboration_score for r in out if r.report_count == 2) > 0.4


def test_rounds_do_not_depend_on_partitioning(spark):
    rng = random.Random(3)
    rows = claims(spark, [
        {"source_url": f"https://s{rng.randrange(9)}.com/{i}", "amount_usd": rng.choice([None, 10, 11, 12, 15, 40]) and rng.choice([10, 11, 12, 15, 40]) * 1_000_000,
         "announced_date": f"2024-{rng.randint(1, 12):02d}-01", "round_type": rng.choice(["Series A", "Seed", "series a ext"])} for i in range(200)])
    seen = set()
    for n in (1, 4, 50):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        merged = funding.merge_clusters(rows.repartition(n)).select("id", "merged_key").collect()
        seen.add(tuple(sorted((r.id, r.merged_key) for r in merged)))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(seen) == 1


def test_payload_forms(spark):
    texts = ['{"title": "A", "companies": ["x"]}', "{'title': 'B', 'url': None, 'high_signal': True}", "[1, 2]", "broken", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "id int, data_json string")
    got = {r.id: (r.strict, r.payload.title if r.payload else None) for r in signals.parse_payloads(df).collect()}
    assert got[0] == (True, "A") and got[1] == (False, "B") and got[2][1] is None and got[3][1] is None and got[4][1] is None


def test_fanout_skips_social_hosts(spark):
    data = '{"text": "see https://x.com/a and https://news.example.com/deal.", "urls": ["https://t.co/1", "https://blog.example.org/p"], "url": "https://twitter.com/q", "kind": "hn"}'
    df = spark.createDataFrame([(7, "hackernews", None, data)], "id bigint, source string, company_id bigint, data_json string")
    assert {r.url for r in signals.url_fanout(df).collect()} == {"https://news.example.com/deal", "https://blog.example.org/p"}


def test_sources_from_files(spark, companies, tmp_path):
    (tmp_path / "s.jsonl").write_text('{"source": "rss", "url": "https://a.com/x#1", "data": {"title": "T"}}\n\n{"source": "rss", "url": "https://a.com/x"}\n')
    staged = landed.read_staged(spark, str(tmp_path / "s.jsonl")).collect()
    assert len(staged) == 2 and staged[0].signal_type == staged[1].signal_type
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>Acme Robotics raises $5M</title><link>https://a.com/1</link><description>d</description>"
                                    "<pubDate>Mon, 01 Jan 2024 10:00:00 +0000</pubDate></item></channel></rss>")
    feed = landed.read_feed(spark, str(tmp_path / "f.xml"), "Feed", "vc")
    import datetime as dt

    rows = landed.feed_entries(feed, companies, dt.datetime(2024, 1, 10, tzinfo=dt.timezone.utc)).collect()
    assert len(rows) == 1 and rows[0].high_signal and set(rows[0].mentions) == {"Acme Robotics", "acme robotics"}
    tsv = tmp_path / "p.tsv"
    tsv.write_text("ACCESSIONNUMBER\tIS_PRIMARYISSUER_FLAG\n1\tYES\n")
    assert landed.read_tsv(spark, str(tsv)).columns == ["ACCESSIONNUMBER", "IS_PRIMARYISSUER_FLAG"]


def test_social_shapes(spark):
    lines = ['{"batches": [{"query": "q", "results": [{"post_id": "1", "text": "t"}]}]}', '{"text": "bare"}', '[{"posts": [{"url": "u"}]}]', "{}"]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    assert sorted(r.query for r in social.social_batches(df).collect()) == ["grok_query", "inline_post", "q"]


def test_texts_past_the_display_cut_decide(spark):
    long = "Acme raised $12 million in a Series A round. " + "More words about the company. " * 80
    text = long + "The round was led by Northgate Ventures. It was structured as a convertible note at a $50 million pre-money valuation."
    rows = spark.createDataFrame([(1, text, "Funding Round", None)], "id long, text string, event_type string, event_amount long")
    claim = funding.parse_deals(rows)
    want = claim.select("lead_investor", "instrument_type", "pre_money_valuation_usd").first()
    assert None not in tuple(want) and len(claim.first().snippet) <= 500
    assert funding.backfill_terms(funding.backfill_participants(claim)).select(*want.__fields__).first() == want
    post = json.dumps({"title": "t" * 300 + " raised", "text": text, "url": "https://news.example.org/a"})
    raw = spark.createDataFrame([(1, "hackernews", 5, post)], "id long, source string, company_id long, data_json string")
    child = signals.url_fanout(raw).first()
    assert child.title == "t" * 300 + " raised" and child.summary == text
    stories = spark.createDataFrame([(1, list(range(2, 12)), 10)], "id long, kids array<long>, descendants long")
    replies = spark.createDataFrame([(i, "comment", f"{i} {text}") for i in range(2, 12)], "id long, type string, text string")
    assert social.thread_comments(stories, replies).first().comments == [f"{i} {text}" for i in range(2, 12)]
    assert social.thread_comments(stories, replies, first=6).first().comments == [f"{i} {text}" for i in range(2, 8)]
    assert len(social.thread_comments(stories, replies, first=None).first().comments) == 10


def test_claims_are_clustered_once_and_names_counted_in_one_pass(spark):
    from dealweave import views
    from dealweave.operators import corroboration

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    clustered = funding.merge_clusters(views.table(spark, "/root/testdata/sf0.001", "v_claims"))
    assert "_merge_greedily" not in plan(funding.funding_rounds(clustered))  # each result clustered the claims again
    rows = spark.createDataFrame(
        [("a", "X", '["Q"]'), ("a", " x ", '["q", "Z"]'), ("a", None, None), ("b", "X", None), ("c", "X", '["Y"]'), ("c", "Y", None), (None, "X", None), (None, "X", None)],
        "k string, lead_investor string, co_investors string")
    from pyspark.sql import functions as F

    c = corroboration.prepared(rows)
    got = {r.k: (r.any, r.co) for r in corroboration._most_named(c, "k", {"any": F.concat(F.array_compact(F.array("__lead")), "__co"), "co": F.col("__co")}).collect()}
    assert got == {"a": (2, 2), "b": (1, None), "c": (2, 1), None: (2, None)}
    assert corroboration.corroborate(rows, "k")._jdf.queryExecution().optimizedPlan().collectLeaves().size() <= 3

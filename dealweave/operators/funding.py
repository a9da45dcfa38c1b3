"""Funding claims, rounds, participants and valuations."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import rounded
from ..functions import deals
from ..functions.money import amount_usd
from ..functions.text import contains_any, first_filled, publisher_domain, snippet, strip, with_once
from ..functions.trust import source_trust
from ..session import shared_folder
from . import corroboration, keyed
from .lookup import events_with_signal, unclaimed_funding_events
from .signals import field, parse_payloads

# Words that make a raw signal worth parsing for funding.
CANDIDATE_WORDS = ["raised", "funding", "million", "billion"]
MERGE_TOLERANCE = 0.18

# Implied post-money as a multiple of the round size, and valuation bounds.
ROUND_MULTIPLE = {
    "pre-seed": 10.0, "seed": 6.0, "series a": 5.0, "series b": 3.5, "series c": 2.8,
    "series d": 2.5, "series e": 2.3, "series f": 2.2, "growth": 2.0, "funding round": 5.0,
}
DEFAULT_MULTIPLE, LEAST_VALUATION, RAISED_MULTIPLE = 5.0, 3_000_000, 1.6

ROUND_FIELDS = [
    "round_type", "amount_usd", "valuation_usd", "lead_investor", "co_investors", "announced_date",
    "instrument_type", "pre_money_valuation_usd", "post_money_valuation_usd", "currency",
]

#: When a claim URL is reported again these stay as first stored; the other columns are refreshed.
FIRST_KEPT = [
    "company_id", "intelligence_event_id", "raw_signal_id", "round_type", "announced_date", "source",
    "is_rumor",
]


def prune_unclustered(rounds: DataFrame) -> DataFrame:
    return rounds.filter("cluster_key is not null")


# -- claims -----------------------------------------------------------------------------------


def funding_candidates(signals: DataFrame, limit: int | None = None) -> DataFrame:
    """Signals with money words, newest first when limited; unlimited by default."""
    out = signals.filter(contains_any(F.lower("data_json"), CANDIDATE_WORDS))
    return out if limit is None else out.orderBy(F.desc("detected_at"), F.desc("id")).limit(limit)


def parse_deals(rows: DataFrame) -> DataFrame:
    """Claim fields parsed from ``text``; rows without any funding content drop out.

    Input columns: text, event_type, event_amount and any that are carried along.
    """
    text = F.col("text")
    rows = rows.filter(F.coalesce(text, F.lit("")) != "")
    found = F.coalesce(F.nullif(F.col("event_amount"), F.lit(0)), amount_usd(text))
    rows = with_once(
        rows, __round=deals.round_type(text), __who=deals.investors(text), __terms=deals.deal_terms(text),
        __val=deals.valuation_usd(text), amount_usd=found,
    )
    funding_type = F.lower("event_type").isin([n.lower() for n in deals.FUNDING_TYPES])
    about = F.col("__round.name").isNotNull() | funding_type | contains_any(F.lower(text), ["fund", "raised"])
    some = lambda c: F.coalesce(c, F.lit(0)) != 0
    rows = rows.filter(
        about & (some(F.col("amount_usd")) | some(F.col("__val")) | F.col("__who.lead").isNotNull())
    )
    nonzero = lambda c: F.nullif(c, F.lit(0).cast("bigint"))
    co = F.col("__who.co")
    return rows.select(
        *[c for c in rows.columns if not c.startswith("__") and c not in ("text", "amount_usd", "event_amount")],
        F.coalesce(F.col("__round.name"), F.nullif("event_type", F.lit("")), F.lit("Funding Round")).alias("round_type"),
        "amount_usd",
        F.coalesce(
            nonzero(F.col("__val")), nonzero(F.col("__terms.post_money")), F.col("__terms.pre_money")
        ).alias("valuation_usd"),
        F.col("__who.lead").alias("lead_investor"),
        F.when(F.size(co) > 0, F.to_json(co)).alias("co_investors"),
        F.col("__round.confidence").alias("extraction_confidence"),
        snippet(text, 200).alias("headline"),
        snippet(text, 500).alias("snippet"),
        F.lit("USD").alias("currency"),
        F.col("__terms.instrument").alias("instrument_type"),
        F.col("__terms.pre_money").alias("pre_money_valuation_usd"),
        F.col("__terms.post_money").alias("post_money_valuation_usd"),
        snippet(text, 800).alias("deal_terms_text"),
        text.alias("deal_text"),
    )


def event_claims(events: DataFrame, signals: DataFrame) -> DataFrame:
    """Claims from funding-type events with a company, read together with their signal."""
    base = events.filter(F.col("event_type").isin(deals.FUNDING_TYPES) & F.col("company_id").isNotNull())
    rows = parse_payloads(events_with_signal(base, signals, "data_json"))
    blank = lambda k: F.coalesce(field(k), F.lit(""))
    desc = F.coalesce("description", F.lit(""))
    text = (
        F.when(F.col("data_json").isNull(), desc)
        .when(F.col("strict"), F.concat_ws(" ", desc, blank("title"), blank("summary")))
        .otherwise(F.concat_ws(" ", desc, "data_json"))
    )
    rows = rows.select(
        "company_id", F.col("id").alias("intelligence_event_id"), "raw_signal_id", "source", "source_url",
        "announced_date", "event_type", F.col("amount_usd").alias("event_amount"), text.alias("text"),
        deals.is_rumor(F.col("event_type"), text).alias("is_rumor"),
        F.struct(F.lit(0).alias("pass"), (-F.unix_micros(F.col("created_at").cast("timestamp"))).alias("at"), F.col("id").alias("id")).alias("seq"),
    )
    return parse_deals(rows).drop("event_type")


def signal_claims(signals: DataFrame, limit: int | None = None) -> DataFrame:
    """Claims straight from signals with money words."""
    rows = parse_payloads(funding_candidates(signals, limit))
    blank = lambda k: F.coalesce(field(k), F.lit(""))
    rows = rows.select(
        "company_id", F.lit(None).cast("bigint").alias("intelligence_event_id"), F.col("id").alias("raw_signal_id"),
        "source", F.when(F.col("strict"), first_filled(field("url"), field("link"))).alias("source_url"),
        F.lit(None).cast("string").alias("announced_date"), F.lit("Funding Round").alias("event_type"),
        F.lit(None).cast("bigint").alias("event_amount"),
        F.when(F.col("strict"), F.concat_ws(" ", blank("title"), blank("summary"))).otherwise(F.col("data_json")).alias("text"),
        F.lit(False).alias("is_rumor"),
        F.struct(F.lit(1).alias("pass"), (-F.unix_micros(F.col("detected_at").cast("timestamp"))).alias("at"), (-F.col("id")).alias("id")).alias("seq"),
    )
    return parse_deals(rows).drop("event_type")


def union_claims(parts: list[DataFrame], companies: DataFrame) -> DataFrame:
    """All claims of known companies, one per URL: first-kept columns from the first report,
    the rest from the last. Trust is judged on what each report says."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    synthetic = F.concat_ws(
        ":", F.lit("intel"), F.col("company_id").cast("string"), "round_type",
        F.coalesce("amount_usd", F.lit(0)).cast("string"), F.coalesce("source", F.lit("unknown")),
    )
    rows = rows.filter("company_id is not null")
    rows = rows.withColumn("source_url", F.coalesce(F.nullif(strip(F.col("source_url")), F.lit("")), synthetic))
    rows = with_trust(rows, companies)
    refreshed = [c for c in rows.columns if c not in FIRST_KEPT and c not in ("seq", "source_url")]
    best = rows.groupBy("source_url").agg(
        F.min_by(F.struct(*FIRST_KEPT), "seq").alias("a"), F.max_by(F.struct(*refreshed), "seq").alias("b")
    )
    out = best.select("source_url", "a.*", "b.*")
    return out.withColumn("id", F.xxhash64("source_url"))


def with_trust(claims: DataFrame, companies: DataFrame) -> DataFrame:
    """Source tier, weight and official flag of every claim of a known company."""
    sites = companies.select("company_id", "website")
    rows = claims.drop("source_tier", "source_weight", "is_official").join(sites, "company_id")
    trust = source_trust(F.col("source"), F.col("source_url"), F.col("website"), F.col("is_rumor"))
    rows = rows.withColumn("__trust", trust)
    return rows.select(
        *claims.drop("source_tier", "source_weight", "is_official").columns,
        F.col("__trust.tier").alias("source_tier"), F.col("__trust.weight").alias("source_weight"),
        F.col("__trust.official").alias("is_official"),
    )


def claim_text(claims: DataFrame) -> Column:
    """The whole text of a claim; headline and snippet, which are cut for display, only of claims without it."""
    shown = strip(F.concat_ws(" ", F.coalesce("headline", F.lit("")), F.coalesce("snippet", F.lit(""))))
    return F.coalesce(F.col("deal_text"), shown) if "deal_text" in claims.columns else shown


def backfill_participants(claims: DataFrame) -> DataFrame:
    """Lead and co-investors read again from the claim's text where it names any."""
    rows = with_once(claims, __who=deals.investors(claim_text(claims)))
    co = F.when(F.size("__who.co") > 0, F.to_json("__who.co"))
    return (
        rows.withColumn("lead_investor", F.coalesce("__who.lead", "lead_investor"))
        .withColumn("co_investors", F.coalesce(co, "co_investors"))
        .drop("__who")
    )


def backfill_terms(claims: DataFrame) -> DataFrame:
    """Instrument and pre/post-money read again from the claim's text."""
    rows = with_once(claims.withColumn("__text", claim_text(claims)), __terms=deals.deal_terms(F.col("__text")))
    has = F.col("__text") != ""
    pick = lambda new, old: F.when(has, F.coalesce(F.nullif(new, F.lit(0).cast("bigint")), old)).otherwise(old)
    return (
        rows.withColumn("instrument_type", F.when(has, F.col("__terms.instrument")).otherwise(F.col("instrument_type")))
        .withColumn("pre_money_valuation_usd", pick(F.col("__terms.pre_money"), F.col("pre_money_valuation_usd")))
        .withColumn("post_money_valuation_usd", pick(F.col("__terms.post_money"), F.col("post_money_valuation_usd")))
        .drop("__text", "__terms")
    )


# -- investors --------------------------------------------------------------------------------


def claim_participants(claims: DataFrame) -> DataFrame:
    """(claim_id, name, role, is_lead, position): the lead, then co-investors that are not the lead."""
    lead = F.nullif(F.col("lead_investor"), F.lit(""))
    key = lambda n: F.lower(deals.investor_name(n))
    others = F.filter(
        corroboration.co_list(F.col("co_investors")),
        lambda n: (n != "") & (lead.isNull() | (key(n) != key(lead))),
    )
    people = F.concat(
        F.when(lead.isNotNull(), F.array(F.struct(lead.alias("name"), F.lit("lead").alias("role"), F.lit(True).alias("is_lead"))))
        .otherwise(F.array().cast("array<struct<name:string,role:string,is_lead:boolean>>")),
        F.transform(others, lambda n: F.struct(n.alias("name"), F.lit("participant").alias("role"), F.lit(False).alias("is_lead"))),
    )
    out = claims.select(F.col("id").alias("claim_id"), F.posexplode(people).alias("position", "p"))
    out = out.select("claim_id", "position", "p.*").withColumn("clean", deals.investor_name(F.col("name")))
    firm = F.when(F.length("clean") >= 2, deals.investor_key(F.col("clean")))
    return out.withColumn("investor_key", firm)


def investor_firms(participants: DataFrame) -> DataFrame:
    """One row per firm: first spelling seen and the best tier of any spelling."""
    rows = participants.filter("investor_key is not null")
    return rows.groupBy("investor_key").agg(
        F.min_by("clean", F.struct("claim_id", "position")).alias("name"),
        F.min(deals.investor_tier(F.col("clean"))).alias("tier"),
    )


def participants_with_claims(participants: DataFrame, claims: DataFrame) -> DataFrame:
    side = claims.select(F.col("id").alias("claim_id"), "source_url", "source_tier", "is_official", "source_weight")
    return participants.join(side, "claim_id")


def round_participants(participants: DataFrame, claims: DataFrame, links: DataFrame) -> DataFrame:
    """Per round and investor: role, reports, domains and score.

    ``links`` maps claim_id to round_id. Claims and domains are counted by first grouping on
    them, so a much-reported investor is reduced before its counts meet.
    """
    rows = participants_with_claims(participants.filter("investor_key is not null"), claims).join(links, "claim_id")
    rows = rows.withColumn("domain", publisher_domain(F.col("source_url")))
    key = ["round_id", "investor_key"]
    out = rows.groupBy(*key).agg(
        F.bool_or("is_lead").alias("is_lead"),
        F.bool_or(F.col("role") == "co_lead").alias("__co_lead"),
        F.min_by("role", F.struct("claim_id", "position")).alias("__first"),
        F.count_distinct("claim_id").alias("report_count"),
        F.count_distinct("domain").alias("source_domain_count"),
        F.bool_or("is_official").alias("has_official_source"),
    )
    role = F.when(F.col("is_lead"), "lead").when(F.col("__co_lead"), "co_lead").otherwise(F.col("__first"))
    score = rounded(
        0.25 * F.least("source_domain_count", F.lit(4)) / 4
        + 0.20 * F.least("report_count", F.lit(5)) / 5
        + F.when(F.col("has_official_source"), 0.25).otherwise(0.0) + 0.15,
        3,
    )
    return out.select(
        *key, role.alias("role"), "is_lead", "report_count", "source_domain_count", "has_official_source",
        F.least(F.lit(1.0), score).alias("corroboration_score"),
    )


def participant_attributions(participants: DataFrame, claims: DataFrame, links: DataFrame) -> DataFrame:
    """One row per round, investor and claim; the first mention in the claim gives the role."""
    rows = participants_with_claims(participants.filter("investor_key is not null"), claims).join(links, "claim_id")
    best = F.min_by(F.struct("role", "source_url", "source_tier", "is_official"), "position").alias("m")
    return rows.groupBy("round_id", "investor_key", "claim_id").agg(best).select(
        "round_id", "investor_key", "claim_id", "m.*"
    )


# -- clusters and rounds ----------------------------------------------------------------------


def amount_bucket(amount: Column) -> Column:
    bucket = F.floor(F.log10(amount.cast("double")) * 10).cast("int").cast("string")
    return F.when(amount > 0, bucket).otherwise("undisclosed")


def cluster_key(company: Column, round_type: Column, amount: Column, announced: Column) -> Column:
    kind = deals.series_round(F.coalesce(F.nullif(round_type, F.lit("")), F.lit("Funding Round")))
    month = F.coalesce(F.substring(F.nullif(announced, F.lit("")), 1, 7), F.lit("unknown"))
    return F.concat_ws(":", company.cast("string"), kind, amount_bucket(amount), month)


def _merge_greedily(pdf: pd.DataFrame) -> pd.DataFrame:
    """Clusters of one company and round type, in order, each into the first bucket it agrees with."""
    pdf = pdf.sort_values("position", kind="stable")
    buckets: list[list] = []
    placed = []
    for low, high, count, key in zip(pdf["low"], pdf["high"], pdf["amounts"], pdf["cluster_key"], strict=True):
        for bucket in buckets:
            n = bucket[2] + count
            lo = min((v for v in (bucket[0], low) if v == v and v is not None), default=0)
            hi = max((v for v in (bucket[1], high) if v == v and v is not None), default=0)
            if n < 2 or (hi - lo) / hi <= MERGE_TOLERANCE:
                bucket[:3] = [lo or None, hi or None, n]
                placed.append(bucket[3])
                break
        else:
            buckets.append([low, high, count, key])
            placed.append(key)
    return pd.DataFrame({"cluster_key": pdf["cluster_key"], "merged_key": placed})


def merge_clusters(claims: DataFrame) -> DataFrame:
    """Claims with ``cluster_key`` and ``merged_key``.

    Claims are first reduced to clusters. A cluster only ever joins a bucket of the same company
    and round type, and agreement needs only the smallest and largest amount, so the sequential
    pass sees one small row per cluster: amount buckets times months, however many claims there are.
    What became of each cluster is written once, since results read the claims several times.
    """
    c = claims.withColumn(
        "cluster_key",
        cluster_key(F.col("company_id"), F.col("round_type"), F.col("amount_usd"), F.col("announced_date")),
    )
    # Larger means earlier: newest announcement first (missing last), heavier source, smaller id.
    c = c.withColumn("early", F.struct("announced_date", "source_weight", (-F.col("id")).alias("back")))
    amount = F.when(F.col("amount_usd") > 0, F.col("amount_usd"))
    clusters = c.groupBy("company_id", "cluster_key").agg(
        F.max_by(F.coalesce("round_type", F.lit("")), "early").alias("first_type"), F.max("early").alias("cluster_early"),
        F.min(amount).cast("double").alias("low"), F.max(amount).cast("double").alias("high"),
        F.count(amount).alias("amounts"),
    )
    from pyspark.sql import Window

    per_type = Window.partitionBy("company_id", "first_type").orderBy(F.desc("cluster_early"))
    ranked = clusters.withColumn("position", F.row_number().over(per_type))
    merged = (
        ranked.select("company_id", "first_type", "cluster_key", "position", "low", "high", "amounts")
        .groupBy("company_id", "first_type")
        .applyInPandas(_merge_greedily, "cluster_key string, merged_key string")
    )
    sides = clusters.select("cluster_key", "cluster_early").join(merged, "cluster_key")
    folder = f"{shared_folder(claims.sparkSession)}/dealweave-clusters/{uuid.uuid4().hex}"
    sides.write.parquet(folder)
    return c.join(claims.sparkSession.read.schema(sides.schema).parquet(folder), "cluster_key")


def funding_rounds(clustered: DataFrame, github: DataFrame | None = None) -> DataFrame:
    """Canonical rounds from claims that carry ``merged_key``.

    All fields come from the top claim even where it has none; two buckets that end up under the
    same key leave the later one.
    """
    rank = F.struct(
        F.coalesce("source_weight", F.lit(0.0)), F.coalesce("extraction_confidence", F.lit(0.0)), "cluster_early", "early"
    )
    heaviest = F.struct(F.coalesce("source_weight", F.lit(0.0)), "cluster_early", "early")
    picked = clustered.groupBy("merged_key").agg(
        F.max_by(F.struct("company_id", *ROUND_FIELDS), rank).alias("f"),
        F.max_by(F.struct("source", "source_url", F.col("source_tier").alias("source_tier_best")), heaviest).alias("s"),
        F.count("*").alias("report_count"),
        F.count_if("is_official").alias("official_report_count"),
        F.max("cluster_early").alias("bucket_early"),
    )
    activity = None
    if github is not None:
        active = github.filter("greatest(coalesce(star_growth_30d, 0), coalesce(commits_last_30d, 0), coalesce(contributor_count, 0)) > 0")
        owners = clustered.select("company_id", "merged_key").distinct()
        activity = owners.join(active.select("company_id").distinct(), "company_id").select("merged_key")
    scores = corroboration.corroborate(clustered, "merged_key", activity).select("merged_key", "score", "unique_domains")
    rows = picked.join(scores, "merged_key").select(
        "merged_key", "bucket_early", "f.*", "s.*", "report_count", "official_report_count",
        F.col("score").alias("corroboration_score"), "unique_domains",
    )
    rows = rows.withColumn("round_type", F.coalesce(F.nullif("round_type", F.lit("")), F.lit("Funding Round")))
    rows = rows.withColumn("currency", F.coalesce(F.nullif("currency", F.lit("")), F.lit("USD")))
    rows = rows.withColumn(
        "cluster_key",
        cluster_key(F.col("company_id"), F.col("round_type"), F.col("amount_usd"), F.col("announced_date")),
    )
    return keyed.keep_first(rows, ["cluster_key"], ["bucket_early"]).drop("bucket_early")


def claim_links(clustered: DataFrame, rounds: DataFrame | None = None) -> DataFrame:
    """(claim_id, round_id) where a round is known by its merged key."""
    return clustered.select(F.col("id").alias("claim_id"), F.col("merged_key").alias("round_id"))


def field_provenance(clustered: DataFrame, most: int = 10) -> DataFrame:
    """Per round and field: the top claim's value and tier, and who reported the field.

    Fields are unpivoted; report URLs are cut to the first ``most`` per field while counting all.
    """
    rank = F.struct(
        F.coalesce("source_weight", F.lit(0.0)), F.coalesce("extraction_confidence", F.lit(0.0)), "cluster_early", "early"
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).cast("string").alias("value")) for n in ROUND_FIELDS])
    long = clustered.select(
        "merged_key", "source_url", "source_tier", rank.alias("rank"), F.struct("cluster_early", "early").alias("order"),
        F.explode(pairs).alias("p"),
    ).select("merged_key", "source_url", "source_tier", "rank", "order", "p.*")
    best = long.groupBy("merged_key", "field").agg(
        F.max_by(F.struct("value", "source_tier"), "rank").alias("b")
    ).select("merged_key", "field", "b.*").filter("value is not null")
    urls = long.filter("coalesce(value, '') <> '' and coalesce(source_url, '') <> ''")
    urls = urls.groupBy("merged_key", "field", "source_url").agg(F.max("order").alias("order"))
    counts = urls.groupBy("merged_key", "field").agg(F.count("*").alias("reports"))
    first = keyed.top_n(urls, ["merged_key", "field"], [F.desc("order")], most, rank="n")
    lists = first.groupBy("merged_key", "field").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("n", "source_url"))), lambda x: x["source_url"]).alias("reporting_sources")
    )
    out = best.join(counts, ["merged_key", "field"], "left").join(lists, ["merged_key", "field"], "left")
    return out.withColumn("reports", F.coalesce("reports", F.lit(0)))


def investor_provenance(clustered: DataFrame, most: int = 10) -> DataFrame:
    """Per round and investor: roles, tiers and number of the reports that name it, and the first ``most`` of them.

    Two aggregates, first per report and then per investor, so that however often a round is reported no list of its claims is made.
    """
    lead = F.nullif(F.trim("lead_investor"), F.lit(""))
    person = lambda n, is_lead: F.struct(F.trim(n).alias("investor"), F.lit(is_lead).alias("is_lead"))
    named = F.concat(
        F.when(lead.isNotNull(), F.array(person(lead, True))).otherwise(F.array().cast("array<struct<investor:string,is_lead:boolean>>")),
        F.transform(F.filter(corroboration.co_list(F.col("co_investors")), lambda n: n != ""), lambda n: person(n, False)),
    )
    rows = clustered.select("merged_key", F.nullif("source_url", F.lit("")).alias("source_url"), "source_tier", F.struct("cluster_early", "early").alias("order"), F.explode(named).alias("p"))
    keys = ["merged_key", "investor"]
    reports = rows.select("merged_key", "source_url", "source_tier", "order", "p.*").groupBy(*keys, "source_url").agg(
        F.bool_or("is_lead").alias("as_lead"), F.bool_or(~F.col("is_lead")).alias("as_participant"), F.max("order").alias("order"), F.max_by("source_tier", "order").alias("tier"),
    )
    role = F.array_compact(F.array(F.when(F.bool_or("as_lead"), "lead"), F.when(F.bool_or("as_participant"), "participant")))
    out = reports.groupBy(*keys).agg(role.alias("roles"), F.count("source_url").alias("reports"), F.array_sort(F.collect_set(F.when(F.col("source_url").isNotNull(), F.col("tier")))).alias("source_tiers"))
    first = keyed.top_n(reports.filter("source_url is not null"), keys, [F.desc("order")], most, rank="n")
    lists = first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "source_url"))), lambda x: x["source_url"]).alias("reporting_sources"))
    return out.join(lists, keys, "left").withColumn("reporting_sources", F.coalesce("reporting_sources", F.array().cast("array<string>")))


# -- confidence back to events ----------------------------------------------------------------


def sync_event_confidence(events: DataFrame, claims: DataFrame, links: DataFrame, rounds: DataFrame):
    """Events take the best score of the rounds their claims belong to."""
    scores = rounds.select(F.col("merged_key").alias("round_id"), "corroboration_score")
    best = (
        claims.filter("intelligence_event_id is not null")
        .select(F.col("id").alias("claim_id"), F.col("intelligence_event_id").alias("id"))
        .join(links, "claim_id").join(scores, "round_id")
        .groupBy("id").agg(F.max("corroboration_score").alias("__score"))
    )
    out = events.join(best, "id", "left")
    return out.withColumn("confidence", F.coalesce("__score", "confidence")).drop("__score")


def event_cluster_confidence(events: DataFrame, claims: DataFrame, companies: DataFrame) -> DataFrame:
    """(id, confidence) for funding events without a claim, scored as clusters of their own."""
    rows = unclaimed_funding_events(events, claims)
    rows = rows.withColumn("is_rumor", F.lit(False))
    rows = with_trust(rows, companies)
    month = F.coalesce(F.nullif(F.substring("announced_date", 1, 7), F.lit("")), F.lit("unknown"))
    rows = rows.withColumn(
        "event_cluster",
        F.concat_ws(":", F.col("company_id").cast("string"), "event_type", amount_bucket(F.col("amount_usd")), month),
    )
    as_claims = rows.select("event_cluster", "source", "source_url", "source_weight", "is_official", "amount_usd", "source_tier")
    scores = corroboration.corroborate(as_claims, "event_cluster").select("event_cluster", "score")
    return rows.select("id", "event_cluster").join(scores, "event_cluster").select("id", F.col("score").alias("confidence"))


# -- valuation and cap table ------------------------------------------------------------------


def _multiple(round_type: Column) -> Column:
    key = F.coalesce(deals.series_round(F.nullif(round_type, F.lit("")), "series ", upper=False), F.lit("funding round"))
    out = None
    for name, value in ROUND_MULTIPLE.items():
        out = F.when(key == name, value) if out is None else out.when(key == name, value)
    return out.otherwise(DEFAULT_MULTIPLE)


def company_valuation(companies: DataFrame, rounds: DataFrame, events: DataFrame) -> DataFrame:
    """Best valuation per company: reported on the best round, implied by its amount, reported on
    an event, implied by all money raised; companies without any drop out."""
    pos = lambda c: F.when(F.col(c) > 0, F.col(c))
    score = F.coalesce("corroboration_score", F.lit(0.0))
    order = F.struct(
        pos("post_money_valuation_usd").isNotNull(), pos("valuation_usd").isNotNull(),
        "corroboration_score", "announced_date", (-F.col("id")).alias("back"),
    )
    reported = F.coalesce(pos("post_money_valuation_usd"), pos("valuation_usd"), pos("pre_money_valuation_usd"))
    implied = F.greatest((F.col("amount_usd") * _multiple(F.col("round_type"))).cast("bigint"), F.lit(LEAST_VALUATION))

    def record(value, kind, method, confidence, day, source):
        return F.struct(
            value.cast("bigint").alias("valuation_usd"), F.lit(kind).alias("valuation_kind"), method.alias("method"),
            rounded(confidence, 3).alias("confidence"), day.alias("as_of_date"), source.alias("source_round_id"),
        )

    day, rid, none = F.col("announced_date"), F.col("id"), F.lit(None).cast("bigint")
    method = F.when(F.coalesce("post_money_valuation_usd", F.lit(0)) != 0, "reported_post_money").otherwise("reported_round_valuation")
    from_round = F.when(
        reported.isNotNull(),
        record(reported, "reported", method, F.least(F.lit(0.85), 0.45 + score * 0.45), day, rid),
    ).when(
        F.col("amount_usd") > 0,
        record(implied, "estimated", F.lit("inferred_from_latest_round"), F.least(F.lit(0.55), 0.32 + score * 0.25), day, rid),
    )
    raised = F.when(F.col("amount_usd") > 0, F.col("amount_usd"))
    per_round = rounds.withColumn("__rec", from_round).groupBy("company_id").agg(
        F.max_by(F.struct("__rec"), order).alias("a"),
        F.sum(raised).alias("__total"), F.max(F.when(raised.isNotNull(), day)).alias("__last"),
    )
    total = record(
        F.greatest((F.col("__total") * RAISED_MULTIPLE).cast("bigint"), F.lit(LEAST_VALUATION)), "estimated",
        F.lit("inferred_from_total_raised"), F.lit(0.35), F.col("__last"), none,
    )
    per_event = events.filter("valuation_usd > 0").groupBy("company_id").agg(
        F.max_by(F.struct("valuation_usd", "confidence", "announced_date"), F.struct("announced_date", "confidence", "id")).alias("e")
    )
    from_event = record(
        F.col("e.valuation_usd"), "reported", F.lit("reported_intel_event"),
        F.least(F.lit(0.75), F.coalesce(F.nullif("e.confidence", F.lit(0.0)), F.lit(0.5))), F.col("e.announced_date"), none,
    )
    rows = companies.select("company_id").join(per_round, "company_id", "left").join(per_event, "company_id", "left")
    best = F.coalesce(
        F.col("a.__rec"), F.when(F.col("e").isNotNull(), from_event), F.when(F.col("__total") > 0, total)
    )
    return rows.withColumn("v", best).filter("v is not null").select("company_id", "v.*")


def cap_table(rounds: DataFrame, participants: DataFrame, firms: DataFrame) -> DataFrame:
    """Holding rows from rounds, their participants and the firms behind them."""
    rows = participants.join(
        rounds.select(F.col("id").alias("round_id"), "company_id", "announced_date"), "round_id"
    ).join(firms.select("investor_key", F.col("name").alias("holder_name")), "investor_key")
    rows = rows.filter("company_id is not null").withColumn("holder_name", F.trim("holder_name"))
    rows = rows.withColumn("holder_normalized", deals.holder_key(F.col("holder_name")))
    rows = rows.filter((F.length("holder_name") >= 2) & (F.length("holder_normalized") >= 2))
    share = F.when(F.col("is_lead"), "lead").otherwise(
        F.coalesce(F.nullif(F.trim("role"), F.lit("")), F.lit("investor"))
    )
    return rows.select(
        "company_id", F.substring("holder_name", 1, 200).alias("holder_name"), "holder_normalized",
        F.lit(None).cast("double").alias("ownership_pct"), F.substring(share, 1, 64).alias("share_class"),
        F.col("announced_date").alias("as_of_date"), F.lit("funding_round").alias("source"),
        F.concat_ws(":", F.lit("funding_round"), F.col("round_id").cast("string"), F.lit("investor"), "investor_key").alias("source_url"),
        F.coalesce("corroboration_score", F.lit(0.5)).alias("confidence"),
    )

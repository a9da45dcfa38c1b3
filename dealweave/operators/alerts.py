"""Alert rules, payloads and the send ledger."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import count_contained, with_once
from .keyed import insert_ignore
from .lookup import events_with_company

# Default rules, direct labels and the amount a funding alert needs.
KEYWORD_RULES = {
    "funding": ["raised", "funding", "series", "seed", "investment"],
    "acquisition": ["acquired", "acquisition", "buys", "purchased", "merger"],
    "launch": ["launch", "announced", "released", "introducing", "unveiled"],
    "hiring_spree": ["hires", "hiring", "expanding team", "headcount"],
}
DIRECT_LABELS = {
    "funding": "funding", "funding_round": "funding", "acquisition": "acquisition", "product_launch": "launch",
    "partnership": "partnership", "hiring": "hiring_spree", "research": None,
}
LEAST_AMOUNT, DEFAULT_CONFIDENCE, RULE_CONFIDENCE = 1_000_000, 0.7, 0.5


def event_types(raw: Column) -> Column:
    """Event types of a rule from a JSON object, a JSON list or comma-separated text."""
    obj = F.from_json(F.when(raw.startswith("{"), raw), "types array<string>, event_types array<string>")
    listed = F.from_json(F.when(raw.startswith("["), raw), "array<string>")
    plain = F.filter(F.transform(F.split(raw, ","), lambda t: F.trim(t)), lambda t: t != "")
    none = F.array().cast("array<string>")
    return (
        F.when(F.coalesce(raw, F.lit("")) == "", none)
        .when(raw.startswith("{"), F.coalesce(obj["types"], obj["event_types"], none))
        .when(raw.startswith("["), F.coalesce(listed, plain)).otherwise(plain)
    )


def default_label(event_type: Column, text: Column) -> Column:
    """Label of events no stored rule takes: by type, else two keywords of one rule."""
    low = F.lower(F.coalesce(event_type, F.lit("")))
    out = None
    for name, label in DIRECT_LABELS.items():
        out = F.when(low == name, F.lit(label)) if out is None else out.when(low == name, F.lit(label))
    for name, words in KEYWORD_RULES.items():
        out = out.when(count_contained(F.lower(text), words) >= 2, name)
    return out


def match_rules(events: DataFrame, rules: list[dict], companies: DataFrame | None = None) -> DataFrame:
    """First stored rule that takes an event, else the default label; small funding drops out.

    Rules are a short configured list, so each compiles to one condition and events are read
    once without a join. ``rules``: name, company_id, event_types, min_confidence in order.
    """
    low = F.lower(F.coalesce("event_type", F.lit("")))
    confidence = F.coalesce(F.nullif("confidence", F.lit(0.0)), F.lit(DEFAULT_CONFIDENCE))
    amount = F.coalesce("amount_usd", F.lit(0))
    out = None
    for rule in rules:
        hit = confidence >= (rule.get("min_confidence") or RULE_CONFIDENCE)
        if rule.get("company_id") is not None:
            hit = hit & F.coalesce(F.col("company_id") == rule["company_id"], F.lit(False))
        kinds = [k.lower() for k in rule.get("event_types") or []]
        if kinds:
            hit = hit & reduce(lambda a, b: a | b, [low.contains(k) | F.lit(k).contains(low) for k in kinds])
        if "funding" in rule["name"].lower():
            hit = hit & ~((amount != 0) & (amount < LEAST_AMOUNT))
        out = F.when(hit, rule["name"]) if out is None else out.when(hit, rule["name"])
    text = F.concat_ws(" ", "event_type")
    fallback = default_label(F.col("event_type"), text)
    label = fallback if out is None else out.otherwise(fallback)
    rows = with_once(events, alert_type=label).filter("alert_type is not null")
    return rows.filter((F.col("alert_type") != "funding") | (amount >= LEAST_AMOUNT))


def alert_payload(alerts: DataFrame, companies: DataFrame) -> DataFrame:
    """Title and description text of each alert."""
    rows = events_with_company(alerts, companies)
    money = F.when(F.coalesce("amount_usd", F.lit(0)) != 0, F.format_string("Amount: $%.1fM\n", F.col("amount_usd") / 1e6)).otherwise("")
    return rows.select(
        "id", "alert_type",
        F.concat(F.lit("🚨 "), F.replace(F.upper("alert_type"), F.lit("_"), F.lit(" ")), F.lit(" Alert")).alias("title"),
        F.concat(
            F.lit("**"), "company", F.lit("**\nEvent: "), "event_type", F.lit("\n"), money, F.lit("Source: "), "source", F.lit("\n"),
        ).alias("description"),
    )


def ledger_rows(ledger: DataFrame, alerts: DataFrame, channel: str, sent_at) -> DataFrame:
    """Ledger after reserving the alerts: one row per event and channel."""
    new = alerts.select(F.col("id").alias("event_id"), F.lit(channel).alias("channel"), F.lit(sent_at).alias("sent_at"))
    return insert_ignore(ledger, new, ["event_id", "channel"], ["sent_at"])



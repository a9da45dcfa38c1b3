"""Round type, investors, valuation and deal terms in deal prose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .money import amount_usd, number
from .text import alias_key, bind, capture, contains_any, filled, slug, squeeze, strip

# Event types treated as funding.
FUNDING_TYPES = [
    "Funding Round", "Rumored Round", "Strategic Investment", "Mega Round", "Debt Financing",
    "Partnership Deal", "Traditional VC",
]

# Round patterns on lower-cased text, in order ({} takes the series letter).
ROUND_RULES = [
    (r"(?:series|round)\s*([a-f])\+?", "Series {}"),
    (r"(?:seed|pre[- ]?seed)\s*(?:round)?", "Seed"),
    (r"(?:angel|pre[- ]?seed)", "Pre-Seed"),
    (r"(?:growth|late[- ]?stage)\s*(?:round)?", "Growth"),
    (r"(?:ipo|initial\s+public\s+offering)", "IPO"),
    (r"(?:private\s+placement)", "Private Placement"),
]
ROUND_CONFIDENCE, FALLBACK_CONFIDENCE = 0.9, 0.6

# Words that mark a rumour, and words that mark money talk.
RUMOR_WORDS = ["rumor", "rumoured", "rumored", "reportedly", "sources say"]
MONEY_WORDS = ["million", "billion", "raised", "funding", "$", "series a", "seed round"]

# Investor patterns.
_NAME = r"([A-Z][A-Za-z0-9&\s]+?)"
CO_LED = (
    r"(?i)co[- ]?led\s+by\s+" + _NAME + r"\s+and\s+" + _NAME
    + r"(?:,|;|\.|\s+with\s+|\s+participation|\s+alongside|$)"
)
STRATEGIC = (
    r"(?i)strategic\s+(?:investment|round|funding)\s+from\s+" + _NAME
    + r"(?:\.|,|;|\s+valued|\s+at\s+|$)"
)
LEAD_PHRASES = ["led by", "co-led by", "backed by"]
LEAD_TAIL = r"\s+" + _NAME + r"(?:,|;|\.\s|and\s|with\s|participation|$)"
ROSTER_PHRASES = [
    "including", "participation from", "joined by", "along with", "with participation from",
    "existing investors",
]
ROSTER_TAIL = r"\s+([A-Z][A-Za-z0-9&\s,]+?)(?:\.\s|and\s|with\s|participation|$)"
PARTICIPATING = r"(?i)with\s+" + _NAME + r"\s+participating"
PARTICIPATION = r"(?i)participation from\s+([A-Z][A-Za-z0-9&\s,]+)"
LED_AGAIN = (
    r"(?i)(?:series\s+[a-f0-9+]+\s+|seed\s+|round\s+)?led\s+by\s+" + _NAME
    + r"(?:,|;|\.\s|with\s|participation|$)"
)
RAISED_FROM = (
    r"(?i)(?:raised|raises|secured|securing|closed|announced)\s+.+?\s+from\s+(.+?)"
    r"(?:\.|$|\s+valued|\s+at\s+\$)"
)

# Firm suffixes dropped from an investor name, and tier fragments.
FIRM_SUFFIX = r"(?i)\s+(Ventures|Capital|Partners|VC|LLC|Inc\.?|LP)\.?$"
TIER_1 = [
    "a16z", "andreessen horowitz", "sequoia", "benchmark", "greylock", "accel", "kleiner perkins",
    "bessemer", "lightspeed", "index ventures", "general catalyst", "thrive capital",
    "founders fund", "y combinator",
]
TIER_2 = [
    "insight partners", "tiger global", "khosla", "menlo ventures", "nea", "battery ventures",
    "redpoint",
]

# Valuation patterns with their unit, in order.
VALUATION_RULES = [
    (r"(?i)valuation\s*(?:of|at)?\s*\$?\s*([\d,.]+)\s*(billion|b)", 1e9),
    (r"(?i)valued\s*(?:at|around)?\s*\$?\s*([\d,.]+)\s*(billion|b)", 1e9),
    (r"(?i)valuation\s*(?:of|at)?\s*\$?\s*([\d,.]+)\s*(million|m)", 1e6),
    (r"(?i)valued\s*(?:at|around)?\s*\$?\s*([\d,.]+)\s*(million|m)", 1e6),
]
PRE_MONEY = r"(?i)pre[- ]?money\s+(?:valuation\s+)?(?:of\s+)?\$?([\d,.]+)\s*(million|billion|m|b)\b"
PRE_MONEY_AFTER = r"(?i)\$?([\d,.]+)\s*(million|billion|m|b)\s+pre[- ]?money"
POST_MONEY = r"(?i)post[- ]?money\s+(?:valuation\s+)?(?:of\s+)?\$?([\d,.]+)\s*(million|billion|m|b)\b"
DEBT_WORDS = r"\b(debt|credit facility|venture debt|term loan)\b"


def round_type(text: Column) -> Column:
    """Struct (name, confidence) by the first matching rule; null name when nothing matches."""
    low = F.lower(text)

    def result(name, confidence):
        return F.struct(name.alias("name"), F.lit(confidence).alias("confidence"))

    out = None
    for pattern, name in ROUND_RULES:
        value = F.lit(name)
        if "{}" in name:
            value = F.concat(F.lit("Series "), F.upper(F.regexp_extract(low, pattern, 1)))
        hit = low.rlike(pattern)
        value = result(value, ROUND_CONFIDENCE)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    out = out.when(
        contains_any(low, ["funding", "raised"]), result(F.lit("Funding Round"), FALLBACK_CONFIDENCE)
    )
    return out.otherwise(result(F.lit(None).cast("string"), 0.0))


def _fits(name: Column) -> Column:
    return F.coalesce(F.length(name).between(3, 59), F.lit(False))


def _names(text: Column, separator: str = ",") -> Column:
    parts = F.transform(F.split(text, separator), strip)
    parts = F.filter(parts, lambda n: F.length(n) > 2)
    return F.coalesce(parts, F.array().cast("array<string>"))


def investors(text: Column) -> Column:
    """Struct (lead, co) where co holds sorted distinct names.

    All pattern hits are taken once into one struct; the rules then read its fields.
    """
    empty = F.array().cast("array<string>")

    def name(pattern, group=1):
        return strip(F.regexp_extract(text, pattern, group))

    single = strip(capture(text, PARTICIPATING))
    rosters = [_names(capture(text, "(?i)" + k + ROSTER_TAIL)) for k in ROSTER_PHRASES]
    backers = F.transform(F.split(F.regexp_extract(text, RAISED_FROM, 1), r",|\sand\s"), strip)
    found = F.struct(
        name(CO_LED, 1).alias("a"), name(CO_LED, 2).alias("b"), name(STRATEGIC).alias("partner"),
        *[name("(?i)" + k + LEAD_TAIL).alias(f"p{i}") for i, k in enumerate(LEAD_PHRASES)],
        name(LED_AGAIN).alias("again"), F.filter(backers, _fits).alias("backers"),
        F.concat(
            *rosters, F.when(single.isNotNull(), F.array(single)).otherwise(empty),
            _names(capture(text, PARTICIPATION)),
        ).alias("roster"),
    )
    return bind(found, _investor_rules)


def _investor_rules(p: Column) -> Column:
    empty = F.array().cast("array<string>")
    co_only = ~_fits(p["p0"]) & _fits(p["p1"])
    lead = F.when(_fits(p["p0"]), p["p0"]).when(~co_only & _fits(p["p2"]), p["p2"])
    lead = F.coalesce(lead, F.when(_fits(p["again"]), p["again"]))
    co = F.when(co_only, F.concat(F.array(p["p1"]), p["roster"])).otherwise(p["roster"])
    from_list = lead.isNull() & (F.size(co) == 0) & (F.size(p["backers"]) > 0)
    lead = F.when(from_list, F.get(p["backers"], 0)).otherwise(lead)
    co = F.when(from_list, F.slice(p["backers"], F.lit(2), F.greatest(F.size(p["backers"]) - 1, F.lit(0)))).otherwise(co)
    tidy = F.array_sort(F.array_distinct(co))
    return (
        F.when(_fits(p["a"]) & _fits(p["b"]), F.struct(p["a"].alias("lead"), F.array(p["b"]).alias("co")))
        .when(_fits(p["partner"]), F.struct(p["partner"].alias("lead"), empty.alias("co")))
        .otherwise(F.struct(lead.alias("lead"), tidy.alias("co")))
    )


def valuation_usd(text: Column) -> Column:
    tries = [
        (number(capture(text, pattern)) * F.lit(unit)).try_cast("bigint")
        for pattern, unit in VALUATION_RULES
    ]
    return F.coalesce(*tries)


def _money_phrase(text: Column, pattern: str) -> Column:
    phrase = F.concat_ws(" ", capture(text, pattern, 1), capture(text, pattern, 2))
    return bind(filled(phrase), amount_usd)


def deal_terms(text: Column) -> Column:
    """Struct (instrument, pre_money, post_money)."""
    low = F.lower(text)
    instrument = (
        F.when(low.rlike(r"\bsafe\b"), "safe")
        .when(low.contains("convertible"), "convertible_note")
        .when(low.rlike(DEBT_WORDS), "debt")
        .otherwise("equity")
    )
    pre = F.coalesce(_money_phrase(text, PRE_MONEY), _money_phrase(text, PRE_MONEY_AFTER))
    return F.struct(
        instrument.alias("instrument"),
        pre.alias("pre_money"),
        _money_phrase(text, POST_MONEY).alias("post_money"),
    )


def is_rumor(event_type: Column, text: Column) -> Column:
    return (event_type == "Rumored Round") | contains_any(F.lower(text), RUMOR_WORDS)


def series_round(name: Column, prefix: str = "Series ", upper: bool = True) -> Column:
    """``Series X`` when the name holds a series letter, else the trimmed name."""
    letter = F.regexp_extract(name, r"(?i)series\s*([a-f])", 1)
    letter = F.upper(letter) if upper else F.lower(letter)
    plain = F.trim(name) if upper else F.lower(F.trim(name))
    return F.when(letter != "", F.concat(F.lit(prefix), letter)).otherwise(plain)


def investor_name(name: Column) -> Column:
    """Squeezed name with one trailing firm suffix removed."""
    return F.trim(F.regexp_replace(squeeze(name), FIRM_SUFFIX, ""))


def investor_key(name: Column) -> Column:
    key = slug(investor_name(name))
    return F.when(key == "", "unknown").otherwise(key)


def investor_tier(name: Column) -> Column:
    low = F.lower(name)
    return F.when(contains_any(low, TIER_1), 1).when(contains_any(low, TIER_2), 2).otherwise(3)


def holder_key(name: Column) -> Column:
    return alias_key(investor_name(name))


def amounts_agree(low: Column, high: Column, count: Column, tolerance: float) -> Column:
    """Positive amounts lie within ``tolerance`` of the largest; fewer than two always agree."""
    spread = (high - low) / F.when(high > 0, high)
    return (count < 2) | F.coalesce(spread <= tolerance, F.lit(True))

"""Company-name hints in headlines and payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bind, contains_any, count_contained, squeeze

# Growth and deal language counted as attention.
HYPE_WORDS = [
    "raised", "raises", "funding", "series a", "series b", "series c", "seed", "pre-seed",
    "valuation", "led by", "million", "billion", "closes", "closed", "secured", "investors",
    "acquired", "acquisition", "launch", "launched", "introducing", "debuts", "startup", "hiring",
    "ipo", "round",
]

# A name of capitalised-looking words in front of one of the verbs.
_NAME_4 = r"([A-Z][A-Za-z0-9&.\-]{1,48}(?:\s+[A-Z][A-Za-z0-9&.\-]{1,32}){0,4})"
_NAME_3 = r"([A-Z][A-Za-z0-9&.\-]{1,48}(?:\s+[A-Z][A-Za-z0-9&.\-]{1,32}){0,3})"
_VERBS = [
    r"\s+(?:raises|raised|lands|secured|closes|closed|bags|gets|snags|hits)\b",
    r"\s+(?:launches|launched|debuts|introduces|unveils|announces)\b",
    r"\s+(?:acquires|acquired|buys|bought)\b",
]
HEADLINE_PATTERNS = [r"(?i)\b" + name + verbs for name, verbs in zip((_NAME_4, _NAME_3, _NAME_3), _VERBS, strict=True)]

# Words that are never a company name.
STOP_NAMES = [
    "the", "a", "an", "show hn", "ask hn", "breaking", "exclusive", "update", "how", "why", "what",
    "sec", "fda", "eu", "us", "uk",
]


def hype_hits(text: Column) -> Column:
    return count_contained(F.lower(F.coalesce(text, F.lit(""))), HYPE_WORDS)


def has_hype(text: Column) -> Column:
    return contains_any(F.lower(F.coalesce(text, F.lit(""))), HYPE_WORDS)


def entity_name(name: Column) -> Column:
    """Squeezed name without surrounding punctuation."""
    return F.regexp_replace(squeeze(name), r"""^[.,;:"'()\[\]]+|[.,;:"'()\[\]]+$""", "")


def plausible_name(name: Column) -> Column:
    def plausible(n: Column) -> Column:
        shouted = (n == F.upper(n)) & (n != F.lower(n)) & (F.length(n) > 12)
        return F.length(n).between(2, 80) & ~F.lower(n).isin(STOP_NAMES) & ~shouted & n.rlike("[A-Za-z]")

    return bind(entity_name(name), plausible)


def _in_front(text: Column, pattern: str, verbs: str) -> Column:
    """All names of a pattern; names are looked for only in texts that hold one of its verbs.

    No part of a name is followed by what its own repeats can match, so these never give back (possessive): same matches,
    without trying every shorter name.
    """
    for repeat in (",48}", ",32}", r"\s+[A-Z]"):
        pattern = pattern.replace(repeat, r"\s++[A-Z]" if repeat.startswith("\\") else repeat + "+")
    none = F.array().cast("array<string>")
    return F.when(~text.rlike("(?i)" + verbs), none).otherwise(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))


def headline_entities(text: Column) -> Column:
    """Sorted distinct plausible names found in front of deal verbs."""
    found = F.concat(*[_in_front(text, p, v) for p, v in zip(HEADLINE_PATTERNS, _VERBS, strict=True)])
    names = F.transform(found, entity_name)
    return F.array_sort(F.array_distinct(F.filter(names, plausible_name)))

"""Dollar amounts in free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import capture

# Amount patterns in the order they are tried, with their unit.
BILLION = r"(?i)\$?([\d,.]+)\s*(billion|b)\b"
MILLION = r"(?i)\$?([\d,.]+)\s*(million|m)\b"
THOUSAND = r"\$\s*([\d,.]+)\s*([Kk])\b"
PLAIN = r"\$([\d,]+)\b"
PLAIN_MINIMUM = 100_000


def number(text: Column) -> Column:
    """Digits with thousands separators as a double; null when malformed."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


def scaled(text: Column, unit: int) -> Column:
    """Number times unit, cut to a whole dollar amount."""
    return (number(text) * F.lit(float(unit))).try_cast("bigint")


def amount_usd(text: Column) -> Column:
    """First amount in the text: billions, then millions, then $..K, then a bare large $ amount."""
    plain = F.replace(capture(text, PLAIN), F.lit(","), F.lit("")).try_cast("bigint")
    return F.coalesce(
        scaled(capture(text, BILLION), 1_000_000_000),
        scaled(capture(text, MILLION), 1_000_000),
        scaled(capture(text, THOUSAND), 1_000),
        F.when(plain >= PLAIN_MINIMUM, plain),
    )


def amount_label(amount: Column) -> Column:
    """Short form for briefs: $1.2B, $3M, $4K."""
    value = amount.cast("double")
    return (
        F.when(amount.isNull() | (amount == 0), "Undisclosed")
        .when(amount >= 1_000_000_000, F.format_string("$%.1fB", value / 1e9))
        .when(amount >= 1_000_000, F.format_string("$%.0fM", value / 1e6))
        .when(amount >= 1_000, F.format_string("$%.0fK", value / 1e3))
        .otherwise(F.format_string("$%d", amount))
    )

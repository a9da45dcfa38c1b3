"""Search strings derived from recent events, signals, handles and products."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from . import keyed
from .ranking import handle_activity
from .signals import as_list, field, parse_payloads

# Search fragment per event type (first contained key wins) and the default.
FRAGMENTS = {
    "funding": '(raised OR funding OR "Series A" OR seed)',
    "product_launch": "(launch OR launched OR announces OR unveiled)",
    "acquisition": "(acquires OR acquisition OR acquired)",
    "hiring": "(hiring OR hires OR joined OR appoints)",
    "partnership": "(partnership OR partners OR integrates)",
}
DEFAULT_FRAGMENT = "(funding OR launch OR raised OR hiring)"
LONGEST, SHORTEST = 220, 8


def fragment(event_type: Column) -> Column:
    low = F.replace(F.lower(F.trim(F.coalesce(event_type, F.lit("")))), F.lit(" "), F.lit("_"))
    out = None
    for key, text in FRAGMENTS.items():
        out = F.when(low.contains(key), text) if out is None else out.when(low.contains(key), text)
    return out.otherwise(DEFAULT_FRAGMENT)


def tidy_query(q: Column) -> Column:
    text = strip(F.regexp_replace(F.coalesce(q, F.lit("")), r"\s+", " "))
    cut = F.concat(F.rtrim(F.substring(text, 1, LONGEST - 3)), F.lit("..."))
    return F.when(F.length(text) > LONGEST, cut).otherwise(text)


def dedupe_queries(rows: DataFrame, order: list[str]) -> DataFrame:
    """First spelling of every query, case aside; short ones drop out."""
    out = rows.withColumn("query", tidy_query(F.col("query"))).filter(F.length("query") >= SHORTEST)
    out = out.withColumn("__key", F.lower("query"))
    return keyed.keep_first(out, ["__key"], order).drop("__key")


def merge_sections(sections: list[DataFrame]) -> DataFrame:
    """Query lists (position, query) in section order, deduplicated across all of them."""
    tagged = [df.select(F.lit(i).alias("section"), "position", "query") for i, df in enumerate(sections)]
    return dedupe_queries(reduce(DataFrame.unionByName, tagged), ["section", "position"])


def derive_queries(
    events: DataFrame, signals: DataFrame, companies: DataFrame, products: DataFrame, since, since_text: str,
    event_rows: int = 40, signal_rows: int = 60, company_rows: int = 8, product_rows: int = 15, most: int = 10,
) -> DataFrame:
    """(section, position, query); the limits are the report sizes."""
    tail = F.lit(f" since:{since_text}")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    names = companies.select("company_id", "name")
    recent = events.filter((F.col("created_at") >= since) & F.col("company_id").isNotNull())
    recent = recent.orderBy(F.desc("confidence"), F.desc("created_at"), "id").limit(event_rows).join(names, "company_id")
    a = recent.select(
        F.struct(-F.col("confidence"), -F.unix_micros(F.col("created_at").cast("timestamp")), F.col("id")).alias("o"),
        F.concat(quoted(F.col("name")), F.lit(" "), fragment(F.col("event_type")), F.lit(" min_faves:3"), tail).alias("query"),
    )
    fresh = signals.filter(F.col("detected_at") >= since).orderBy(F.desc("detected_at"), F.desc("id")).limit(signal_rows)
    rows = parse_payloads(fresh).filter("coalesce(payload.title, payload.text, '') <> ''")
    listed = F.slice(as_list(field("companies_detected")), 1, 2)
    b = rows.select("id", "detected_at", F.posexplode(listed).alias("i", "c")).filter(F.length(F.trim("c")) >= 2)
    b = b.select(
        F.struct(-F.unix_micros(F.col("detected_at").cast("timestamp")), -F.col("id"), F.col("i")).alias("o"),
        F.concat(quoted(F.trim("c")), F.lit(" " + DEFAULT_FRAGMENT + " min_faves:3"), tail).alias("query"),
    )
    busy = handle_activity(companies, events, since).limit(company_rows)
    handle = F.regexp_replace(F.trim("x_handle"), "^@+", "")
    c = busy.select(
        F.struct(-F.col("recent_events"), F.col("name")).alias("o"),
        F.concat(F.lit("(@"), handle, F.lit(' OR "'), "name", F.lit('") ' + DEFAULT_FRAGMENT + " min_faves:2"), tail).alias("query"),
    )
    d = products.filter(F.length(F.trim("name")) >= 3).orderBy(F.desc("id")).limit(product_rows)
    d = d.select("id", F.trim("name").alias("product"), "company_id").join(names, "company_id").select(
        F.struct(-F.col("id")).alias("o"),
        F.concat(quoted(F.col("name")), F.lit(" "), quoted(F.col("product")), F.lit(" (launch OR announces) min_faves:2"), tail).alias("query"),
    )
    parts = [p.select(F.lit(i).alias("section"), F.to_json("o").alias("position"), "query") for i, p in enumerate((a, b, c, d))]
    return dedupe_queries(reduce(DataFrame.unionByName, parts), ["section", "position"]).orderBy("section", "position").limit(most)

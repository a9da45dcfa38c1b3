"""Joins between signals, events, companies and ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.deals import FUNDING_TYPES


def events_with_company(events: DataFrame, companies: DataFrame) -> DataFrame:
    """Every event with its company name, 'Unknown' when there is none.

    Events without a company never match, so they are kept out of the join's hash key.
    """
    names = companies.select(F.col("company_id").alias("__cid"), F.col("name").alias("__name"))
    joined = events.join(names, F.col("company_id") == F.col("__cid"), "left")
    return joined.withColumn("company", F.coalesce("__name", F.lit("Unknown"))).drop("__cid", "__name")


def events_with_signal(events: DataFrame, signals: DataFrame, *columns: str | Column) -> DataFrame:
    """Every event with the named columns of its signal.

    Both sides are shuffled whatever the files' size: texts take many times that size in memory, so a plan made
    from it would send them all through the driver.
    """
    side = signals.select(F.col("id").alias("raw_signal_id"), *columns)
    return events.join(side.hint("merge"), "raw_signal_id", "left")


def orphan_signals(signals: DataFrame, events: DataFrame, processed_only: bool = False):
    """Signals no event refers to."""
    base = signals.filter("processed") if processed_only else signals
    return base.join(events, base["id"] == events["raw_signal_id"], "left_anti")


def requeue_orphans(signals: DataFrame, events: DataFrame) -> DataFrame:
    """Signals with ``processed`` reset where no event refers to them."""
    seen = events.filter("raw_signal_id is not null").select(
        F.col("raw_signal_id").alias("id"), F.lit(True).alias("__seen")
    ).distinct()
    out = signals.join(seen, "id", "left")
    return out.withColumn("processed", F.col("processed") & F.col("__seen").isNotNull()).drop("__seen")


def unprocessed_signals(signals: DataFrame, events: DataFrame) -> DataFrame:
    """Signals not processed yet, or processed without leaving an event."""
    seen = events.select(F.col("raw_signal_id").alias("id"), F.lit(True).alias("__seen")).distinct()
    out = signals.join(seen, "id", "left")
    return out.filter(~F.col("processed") | F.col("__seen").isNull()).drop("__seen")


def recent_signals(signals: DataFrame, companies: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Signals of the last days that have a company, with its name."""
    cutoff = F.lit(as_of) - F.expr(f"interval {days} days")
    names = companies.select("company_id", F.col("name").alias("company_name"))
    return signals.filter(F.col("detected_at") >= cutoff).join(names, "company_id")


def sync_company(events: DataFrame, signals: DataFrame) -> DataFrame:
    """Events with a missing company filled from their signal."""
    side = signals.select(F.col("id").alias("raw_signal_id"), F.col("company_id").alias("__from"))
    out = events.join(side, "raw_signal_id", "left")
    return out.withColumn("company_id", F.coalesce("company_id", "__from")).drop("__from")


def unalerted_events(events: DataFrame, ledger: DataFrame, channel: str, since=None) -> DataFrame:
    """Events without a ledger row on the channel."""
    sent = ledger.filter(F.col("channel") == channel).select(F.col("event_id").alias("id"))
    base = events if since is None else events.filter(F.col("created_at") >= since)
    return base.join(sent, "id", "left_anti")


def unclaimed_funding_events(events: DataFrame, claims: DataFrame) -> DataFrame:
    """Funding-type events with a company that no claim refers to."""
    used = claims.filter("intelligence_event_id is not null").select(
        F.col("intelligence_event_id").alias("id")
    )
    base = events.filter(F.col("event_type").isin(FUNDING_TYPES) & F.col("company_id").isNotNull())
    return base.join(used, "id", "left_anti")


def latest_per_key(df: DataFrame, key: str, when: str, tie: list[str], columns: list[str]):
    """Newest row per key, combined on the map side."""
    best = F.max_by(F.struct(*columns), F.struct(when, *tie)).alias("__row")
    return df.groupBy(key).agg(best).select(key, "__row.*")


def duplicates_within(events: DataFrame, days: int = 7) -> DataFrame:
    """Events that repeat company, type and URL of an earlier one within the window.

    Time is cut into slices as long as the window. Everything but the first event of a slice
    repeats that first one; the first one repeats the last event of the slice before when it is
    near enough. Two aggregates per slice decide, so no key is ever gathered in one task.
    """
    keys = ["company_id", "event_type", "source_url", "__slice"]
    base = events.filter(
        F.col("company_id").isNotNull() & (F.coalesce("source_url", F.lit("")) != "")
    )
    seconds = days * 86_400
    base = base.withColumn("__at", F.unix_timestamp(F.col("created_at").cast("timestamp")))
    base = base.withColumn("__slice", F.floor(F.col("__at") / seconds))
    ends = base.groupBy(*keys).agg(
        F.min(F.struct("__at", "id")).alias("__first"), F.max("__at").alias("__last")
    )
    before = ends.select(*keys[:3], (F.col("__slice") + 1).alias("__slice"), F.col("__last").alias("__before"))
    ends = ends.join(before, keys, "left").drop("__last")
    out = base.join(ends, keys)
    near = F.coalesce(F.col("__at") - F.col("__before") <= seconds, F.lit(False))
    return out.withColumn("is_duplicate", (F.col("id") != F.col("__first.id")) | near).drop(
        "__at", "__slice", "__first", "__before"
    )


def article_forms(column: str):
    """The URL itself and what stands before each of its ``#`` marks."""
    url = F.col(column)
    return F.transform(
        F.sequence(F.lit(1), F.size(F.split(url, "#"))),
        lambda n: F.array_join(F.slice(F.split(url, "#"), F.lit(1), n), "#"),
    )


def link_event_by_url(signals: DataFrame, events: DataFrame) -> DataFrame:
    """For every signal URL the event on that article: unlinked first, then the newest id."""
    usable = events.filter("source_url is not null")
    index = usable.select(F.explode(article_forms("source_url")).alias("url"), "id", "raw_signal_id")
    order = F.struct(F.col("raw_signal_id").isNull(), F.col("id"))
    pick = F.max_by(F.struct(F.col("id").alias("event_id"), "raw_signal_id"), order).alias("e")
    index = index.groupBy("url").agg(pick)
    hits = signals.filter("url is not null and url not like 'raw_signal:%'").join(index, "url")
    free = F.col("e.raw_signal_id").isNull()
    own = F.col("e.raw_signal_id") == F.col("id")
    return hits.select(
        "id", "url", F.col("e.event_id").alias("event_id"), (free | F.coalesce(own, F.lit(False))).alias("linked")
    )

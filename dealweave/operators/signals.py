"""Raw signal payloads: parsing, text, keys, outbound links and mention fan-out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify, entities
from ..functions.money import amount_usd
from ..functions.text import bind, contains_any, filled, first_filled, strip, url_key, with_once
from . import resolve
from .lookup import article_forms

# Payload keys read anywhere; lists stay text here because a bare string may stand in for a list.
PAYLOAD_KEYS = [
    "title", "description", "summary", "text", "content", "body", "headline", "name", "url", "link",
    "company_id", "company", "channel_company", "channel", "mentioned_companies",
    "companies_detected", "companies", "provisional_entities", "entity_name", "commercial_name",
    "kind", "category", "story_type", "id", "urls", "outbound_urls", "linked_urls",
    "thread_comments", "entity_type", "headquarters", "jurisdiction", "year_of_inc",
    "total_offering_amount", "total_amount_sold", "cik", "related_persons", "batch", "status",
    "industry", "one_liner", "long_description", "team_size", "website", "lei",
    "home_member_state", "regulator", "services", "authorisation_date", "author", "high_signal",
    "url_fanout_done",
]
PAYLOAD_SCHEMA = ", ".join(f"`{k}` string" for k in PAYLOAD_KEYS)

# Payload keys that make up the signal text, and those of the fallback text.
TEXT_KEYS = ["title", "description", "summary", "text", "content", "body", "headline", "name"]
FALLBACK_KEYS = ["url", "link", "id", "kind", "category"]
BLOB_KEYS = ["title", "headline", "description", "summary", "content"]

# Social hosts never followed, and words that make a link deal-relevant.
SOCIAL_HOSTS = ["x.com", "twitter.com", "mobile.twitter.com", "t.co", "pic.twitter.com"]
DEAL_HINTS = [
    "raised", "raises", "funding", "series a", "series b", "series c", "seed round", "pre-seed",
    "valuation", "led by", "million", "billion", "acquired", "acquisition", "closes", "round",
]
LINK_PATTERN = r"""https?://[^\s\])"'<>]+"""


def parse_payloads(df: DataFrame, column: str = "data_json", strict: bool = True) -> DataFrame:
    """Add ``payload`` (struct of text fields) and ``strict`` (whether the text was valid JSON).

    Payloads written as Python literals are read in a second, lenient attempt; anything that is
    no object gives a payload of nulls. Both are worked out once a row: the array of one is no column that the optimizer
    copies into each place that names a field of it. Where ``strict`` is not asked for, only texts with a word of such a
    literal are tested for it: of all others both attempts read the same.
    """
    text = F.coalesce(F.col(column), F.lit(""))
    is_object = F.ltrim(text).startswith("{")
    literal = text
    for word, plain in (("None", "null"), ("True", "true"), ("False", "false")):
        literal = F.regexp_replace(literal, rf"(?<=[:\[,]\s?){word}(?=\s?[,\]\}}])", plain)
    options = {"mode": "PERMISSIVE", "allowBackslashEscapingAnyCharacter": "true"}

    def read(strict: Column) -> Column:
        json = F.when(strict, text).when(is_object, literal)
        return F.struct(strict.alias("strict"), F.from_json(json, PAYLOAD_SCHEMA, options).alias("payload"))

    valid = is_object & F.try_parse_json(text).isNotNull()
    df = df.drop("strict", "payload")
    if not strict:
        json = F.when(is_object, F.when(contains_any(text, ["None", "True", "False"]) & ~valid, literal).otherwise(text))
        return with_once(df, payload=F.from_json(json, PAYLOAD_SCHEMA, options))
    df = df.select("*", F.explode(F.array(bind(valid, read))).alias("__parsed"))
    return df.withColumn("strict", F.col("__parsed.strict")).withColumn("payload", F.col("__parsed.payload")).drop("__parsed")


def as_list(text: Column) -> Column:
    """JSON list text as an array; a bare string counts as a list of one; empty when missing."""
    parsed = F.from_json(F.when(text.startswith("["), text), "array<string>")
    single = F.when(filled(text).isNotNull(), F.array(text))
    return F.coalesce(parsed, single, F.array().cast("array<string>"))


def field(name: str) -> Column:
    return F.col(f"payload.{name}")


def payload_text() -> Column:
    """Filled text fields joined by blanks."""
    return strip(F.concat_ws(" ", *[filled(field(k)) for k in TEXT_KEYS]))


def payload_url() -> Column:
    return strip(F.coalesce(first_filled(field("url"), field("link")), F.lit("")))


def payload_blob(*keys: str) -> Column:
    """Fields joined by blanks, a missing one as the empty text."""
    return F.concat_ws(" ", *[F.coalesce(field(k), F.lit("")) for k in keys])


def with_url(text: Column, url: Column) -> Column:
    missing = (url != "") & ~text.contains(url)
    return F.when(missing, strip(F.concat(text, F.lit(" "), url))).otherwise(text)


def signal_text(df: DataFrame) -> DataFrame:
    """Add ``text`` (what the classifier reads) and ``description`` (its first 500 characters)."""
    if "payload" not in df.columns:
        df = parse_payloads(df, strict=False)
    hint = F.coalesce(
        first_filled(*[field(k) for k in FALLBACK_KEYS]),
        F.concat(F.lit("signal-"), F.col("id").cast("string")),
    )
    fallback = F.concat_ws(" ", F.col("source"), F.col("signal_type"), hint)
    df = df.withColumn("__text", payload_text()).withColumn("base_url", payload_url())
    base = F.when(F.col("__text") == "", fallback).otherwise(F.col("__text"))
    df = df.withColumn("text", with_url(base, F.col("base_url"))).drop("__text")
    return df.withColumn("description", F.substring("text", 1, 500))


def source_url_key(base: Column, signal_id: Column, company_id: Column) -> Column:
    """Event URL: the article plus a suffix, so signals sharing an article stay apart."""
    sid = signal_id.cast("string")
    return (
        F.when(F.coalesce(base, F.lit("")) == "", F.concat(F.lit("raw_signal:"), sid))
        .when(
            F.coalesce(company_id, F.lit(0)) != 0,
            F.concat(base, F.lit("#c"), company_id.cast("string"), F.lit("-rs"), sid),
        )
        .otherwise(F.concat(base, F.lit("#rs"), sid))
    )


def payload_hints(df: DataFrame, *keep: str) -> DataFrame:
    """The columns the resolution cascade reads, from parsed payloads, and those to keep."""
    number = field("company_id").try_cast("bigint")
    return df.select(
        "id",
        number.alias("company_ref"),
        F.coalesce(F.when(number.isNull(), filled(field("company_id"))), filled(field("company"))).alias("company_hint"),
        payload_url().alias("url"),
        first_filled(field("channel_company"), field("channel")).alias("channel"),
        F.concat(
            as_list(field("mentioned_companies")), as_list(field("companies_detected")), as_list(field("companies"))
        ).alias("listed"),
        field("title").alias("title"),
        field("headline").alias("headline"),
        payload_blob(*BLOB_KEYS).alias("blob"),
        *keep,
    )


def process_signals(signals: DataFrame, events: DataFrame, companies: DataFrame):
    """One event row per signal that has none yet.

    Every unprocessed signal is parsed, linked to a company, classified and priced. Where an
    event without a signal already stands on the same article, the signal is attached to it
    (``attached_event_id``) and no event is made. A URL that is taken falls back to the
    signal's own key.
    """
    todo = signals.join(
        events.filter("raw_signal_id is not null").select(F.col("raw_signal_id").alias("id")), "id", "left_anti"
    )
    parsed = signal_text(parse_payloads(todo, strict=False))
    missing = parsed.filter("company_id is null")
    found = resolve.resolve_company(payload_hints(missing), companies)
    found = found.select("id", F.col("company_id").alias("__found"))
    rows = parsed.join(found, "id", "left").withColumn("company_id", F.coalesce("company_id", "__found"))
    rows = classify.classify(rows, "text", "source")
    rows = rows.withColumn("event_type", classify.label_title(F.col("label")))
    blank = strip(F.col("text")) == ""
    rows = rows.withColumn("event_type", F.when(blank, classify.UNLABELED_TITLE).otherwise(F.col("event_type")))
    rows = rows.withColumn("confidence", F.when(blank, 0.0).otherwise(F.col("confidence")))
    rows = rows.withColumn("amount_usd", amount_usd(F.col("text")))
    rows = rows.withColumn("url_key", source_url_key(F.col("base_url"), F.col("id"), F.col("company_id")))
    rows = attach_unlinked(rows, events)
    taken = events.select(F.col("source_url").alias("url_key"), F.lit(True).alias("__taken")).distinct()
    rows = rows.join(taken, "url_key", "left")
    own = F.concat(F.lit("raw_signal:"), F.col("id").cast("string"))
    return rows.select(
        F.col("id").alias("raw_signal_id"), "company_id", "event_type", "amount_usd", "source",
        F.when(F.col("__taken"), own).otherwise(F.col("url_key")).alias("source_url"),
        "confidence", "description", F.col("detected_at").alias("announced_at"), "attached_event_id",
    )


def attach_unlinked(rows: DataFrame, events: DataFrame, salt: int = 32) -> DataFrame:
    """Pair the k-th newest signal of an article with its k-th newest unlinked event.

    Only articles with unlinked events take part. Signals are ranked in slices first and cut to
    the number of events on the article, so a popular article reaches the final ranking with a
    few rows per slice.
    """
    from pyspark.sql import Window

    free = events.filter("raw_signal_id is null and source_url is not null")
    free = free.select(
        F.explode(article_forms("source_url")).alias("base_url"), F.col("id").alias("attached_event_id")
    )
    free = free.filter("base_url not like 'raw_signal:%'")
    room = free.groupBy("base_url").agg(F.count("*").alias("__room"))
    ranked = free.withColumn(
        "__k", F.row_number().over(Window.partitionBy("base_url").orderBy(F.desc("attached_event_id")))
    )
    order = [F.desc("detected_at"), F.asc("id")]
    some = rows.filter("base_url <> ''").select("id", "base_url", "detected_at").join(room, "base_url")
    some = some.withColumn("__slice", F.pmod(F.xxhash64("id"), F.lit(salt)))
    some = some.withColumn("__k", F.row_number().over(Window.partitionBy("base_url", "__slice").orderBy(*order)))
    some = some.filter(F.col("__k") <= F.col("__room"))
    some = some.withColumn("__k", F.row_number().over(Window.partitionBy("base_url").orderBy(*order)))
    pairs = some.join(ranked, ["base_url", "__k"]).select("id", "attached_event_id")
    pairs = pairs.groupBy("id").agg(F.max("attached_event_id").alias("attached_event_id"))
    return rows.join(pairs, "id", "left")


# -- outbound links ---------------------------------------------------------------------------


def skip_link(url: Column) -> Column:
    """No host, or a social host."""
    host = F.regexp_replace(F.coalesce(authority_host_raw(url), F.lit("")), r"^www\.", "")
    social = host.rlike(r"^(?:.*\.)?(?:" + "|".join(h.replace(".", r"\.") for h in SOCIAL_HOSTS) + ")$")
    return (host == "") | social


def authority_host_raw(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def outbound_urls(df: DataFrame) -> Column:
    """Distinct non-social links: listed ones, the primary one, then those in the text."""
    listed = F.concat(*[
        F.coalesce(F.from_json(F.when(field(k).startswith("["), field(k)), "array<string>"), F.array().cast("array<string>"))
        for k in ("urls", "outbound_urls", "linked_urls")
    ])
    primary = F.when(
        F.coalesce(field("kind"), F.lit("")) != "x_social",
        F.array(F.coalesce(first_filled(field("url"), field("link")), F.lit(""))),
    ).otherwise(F.array().cast("array<string>"))
    blob = payload_blob("text", "title", "summary", "content", "thread_comments")
    inline = F.regexp_extract_all(blob, F.lit(LINK_PATTERN), F.lit(0))
    tidy = F.transform(F.concat(listed, primary, inline), lambda u: F.regexp_replace(strip(u), "[.,;)]+$", ""))
    return F.array_distinct(F.filter(tidy, lambda u: (u != "") & ~skip_link(u)))


def deal_worded() -> Column:
    """Deal language in the payload, or a funding tag."""
    text = F.lower(payload_blob("text", "title", "summary", "content", "thread_comments", "story_type"))
    tagged = (F.coalesce(field("category"), F.lit("")) == "funding") | (
        F.coalesce(field("story_type"), F.lit("")) == "funding"
    )
    return text.rlike("|".join(DEAL_HINTS)) | tagged


def deal_relevant(url: Column, worded: Column) -> Column:
    """Deal language, or any host but the aggregator's own."""
    host = F.coalesce(authority_host_raw(url), F.lit(""))
    return worded | ((host != "") & ~host.contains("ycombinator.com"))


def url_fanout(signals: DataFrame) -> DataFrame:
    """One article-shaped child signal per relevant outbound link of social and thread signals."""
    rows = parse_payloads(signals.filter(F.col("source").isin("x", "hackernews")), strict=False)
    rows = rows.filter(F.coalesce(field("url_fanout_done"), F.lit("false")) != "true")
    rows = rows.select(
        F.col("id").alias("parent_raw_signal_id"), "company_id", F.col("source").alias("discovered_via"),
        F.coalesce(first_filled(field("title"), field("text")), F.lit("")).alias("title"),
        F.coalesce(first_filled(field("text"), field("summary")), F.lit("")).alias("summary"),
        F.coalesce(filled(field("category")), F.lit("funding")).alias("category"),
        deal_worded().alias("__worded"), F.explode_outer(outbound_urls(rows)).alias("url"),
    )
    rows = rows.filter(F.col("url").isNotNull() & deal_relevant(F.col("url"), F.col("__worded")))
    return rows.select(
        F.lit("article").alias("source"),
        F.concat_ws(":", F.lit("fanout"), F.col("parent_raw_signal_id").cast("string"), url_key(F.col("url"))).alias("signal_type"),
        "parent_raw_signal_id", "company_id", "url", F.coalesce(filled(F.col("title")), F.col("url")).alias("title"),
        "summary", "category", "discovered_via",
    )


# -- feed entries and mentions ----------------------------------------------------------------

# Deal words for feed entries and the feed categories they count in.
FEED_DEAL_WORDS = [
    "raised", "raises", "funding", "series a", "series b", "series c", "seed round", "pre-seed",
    "valuation", "led by", "million round", "billion", "closes", "secured", "investors", "acquired",
    "acquisition",
]
DEAL_CATEGORIES = ["vc", "general_startup"]


def high_signal(text: Column, category: Column) -> Column:
    deal = category.isin(DEAL_CATEGORIES) & contains_any(F.lower(text), FEED_DEAL_WORDS)
    return deal | entities.has_hype(text)


def fan_by_mention(entries: DataFrame, companies: DataFrame) -> DataFrame:
    """One signal per mentioned company with its own key; without mentions one if high-signal.

    Entries: link, title, mentions (array), high_signal, published.
    """
    rows = entries.filter(F.coalesce("link", F.lit("")) != "")
    rows = rows.withColumn("mention", F.explode_outer("mentions"))
    rows = rows.filter(F.col("mention").isNotNull() | F.col("high_signal"))
    ids = resolve.by_name_slug_handle(rows.select(F.col("mention").alias("name")).filter("name is not null"), companies)
    rows = rows.join(ids.withColumnRenamed("name", "mention"), "mention", "left")
    base = url_key(F.col("link"))
    scoped = F.concat_ws(
        ":", base, F.coalesce("company_id", F.lit(0)).cast("string"), F.substring("mention", 1, 40)
    )
    return rows.withColumn("signal_type", F.when(F.col("mention").isNull(), base).otherwise(scoped))


def ingest_summary(entries: DataFrame) -> DataFrame:
    linked = F.size("mentions") > 0
    return entries.agg(
        F.count("*").alias("entries"),
        F.count_if(linked).alias("linked"),
        F.count_if(~linked).alias("unlinked"),
        F.coalesce(
            F.sum(F.when(linked, F.size("mentions")).when(F.col("high_signal"), 1).otherwise(0)), F.lit(0)
        ).cast("bigint").alias("stored"),
    )



"""Social posts: landing shapes and the post log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.entities import HYPE_WORDS
from ..functions.text import contains_any, first_filled, strip_tags, url_key
from .keyed import insert_ignore


def merge_posts(log: DataFrame, posts: DataFrame, companies: DataFrame) -> DataFrame:
    """New posts of known companies join the log; a missing metric counts as zero."""
    known = companies.select("company_id", F.col("name").alias("company"))
    fresh = posts.join(known, "company").withColumn("likes", F.coalesce("likes", F.lit(0)))
    return insert_ignore(log, fresh.select(*log.columns), ["post_id"], ["company_id"])


# Categories in the order they are tried.
CATEGORIES = [
    ("funding", ["raised", "funding", "series a", "series b", "seed round", "pre-seed"]),
    ("product_launch", ["launch", "launched", "introducing", "announcing", "shipped"]),
    ("hiring", ["hiring", "we're hiring", "join our team", "open roles"]),
    ("acquisition", ["acquired", "acquisition", "acquires"]),
]
STORY_TYPES = [
    ("launch", ["launch", "launched", "introducing"]), ("funding", ["funding", "raised", "series", "seed"]),
    ("acquisition", ["acquired", "acquisition", "bought"]), ("open_source", ["open source"]),
]
STARTUP_WORDS = [
    "launch", "show hn", "startup", "funding", "raised", "series a", "series b", "seed", "acquired", "open source",
    "github", "api", "saas", "developer tools", "led by", "million", "valuation", "round", "hiring", "platform",
    "marketplace", "fintech", "health",
]
SHORTEST_COMMENT, BUSY_THREAD = 40, 3


def social_category(text):
    low = F.lower(F.coalesce(text, F.lit("")))
    out = None
    for name, words in CATEGORIES:
        hit = contains_any(low, words)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("social_momentum")


def story_type(title):
    low = F.lower(F.coalesce(title, F.lit("")))
    out = F.when(low.startswith("show hn"), "show_hn").when(low.startswith("ask hn"), "ask_hn")
    for name, words in STORY_TYPES:
        out = out.when(contains_any(low, words), name)
    return out.otherwise("discussion")


def startup_relevant(title, text):
    low = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), strip_tags(text)))
    return contains_any(low, [*STARTUP_WORDS, *HYPE_WORDS])


def thread_comments(stories: DataFrame, comments: DataFrame, first: int | None = None, longest: int | None = None) -> DataFrame:
    """(id, comments): the ``first`` replies of busy stories (None: all) that are long enough, whole or cut to ``longest``.

    ``stories``: id, kids (ordered array), descendants. ``comments``: id, type, text.
    """
    wanted = stories.filter(F.coalesce("descendants", F.lit(0)) >= BUSY_THREAD)
    own = F.col("kids") if first is None else F.slice("kids", 1, first)
    kids = wanted.select(F.col("id").alias("story"), F.posexplode(own).alias("pos", "id"))
    body = comments.filter("type = 'comment'").select("id", strip_tags(F.col("text")).alias("body"))
    rows = kids.join(body.filter(F.length("body") > SHORTEST_COMMENT), "id")
    ordered = F.array_sort(F.collect_list(F.struct("pos", (F.col("body") if longest is None else F.substring("body", 1, longest)).alias("body"))))
    return rows.groupBy(F.col("story").alias("id")).agg(F.transform(ordered, lambda c: c["body"]).alias("comments"))


POST = (
    "post_id string, id string, text string, content string, url string, post_url string, urls array<string>, "
    "posted_at string, created_at string, likes bigint, favorite_count bigint, retweets bigint, retweet_count bigint, "
    "replies bigint, reply_count bigint, companies_detected array<string>, companies array<string>, is_founder_post boolean"
)
BATCH = f"query string, search string, company string, company_name string, results array<struct<{POST}>>, posts array<struct<{POST}>>"


def social_batches(lines: DataFrame) -> DataFrame:
    """Landed JSON documents or lines to one row per post with its query.

    A document is a batch, a list of batches, an object with ``batches``, or a bare post.
    """
    text = F.trim("value")
    doc = F.from_json(F.when(text.startswith("{"), text), f"batches array<struct<{BATCH}>>, {BATCH}, {POST}")
    listed = F.from_json(F.when(text.startswith("["), text), f"array<struct<{BATCH}>>")
    rows = lines.withColumn("d", doc).withColumn("l", listed)
    none = F.array().cast(f"array<struct<{BATCH}>>")
    fields = [f.split(" ")[0] for f in BATCH.replace(f"struct<{POST}>", "x").split(", ")]
    own = F.struct(*[F.col(f"d.{f}").alias(f) for f in fields])
    post = F.struct(*[F.col(f"d.{p.split(' ')[0]}").alias(p.split(" ")[0]) for p in POST.split(", ")])
    bare = F.struct(
        F.lit("inline_post").alias("query"), *[F.lit(None).cast("string").alias(f) for f in fields[1:4]],
        F.array(post).alias("results"), F.lit(None).cast(f"array<struct<{POST}>>").alias("posts"),
    )
    batches = (
        F.when(F.col("l").isNotNull(), F.col("l")).when(F.col("d.batches").isNotNull(), F.col("d.batches"))
        .when(F.col("d.results").isNotNull() | F.col("d.posts").isNotNull(), F.array(own))
        .when(F.col("d").isNotNull(), F.array(bare)).otherwise(none)
    )
    out = rows.select(F.explode(batches).alias("b"))
    posts = F.coalesce("b.results", "b.posts")
    out = out.select(
        first_filled(F.col("b.query"), F.col("b.search"), F.lit("grok_query")).alias("query"),
        first_filled(F.col("b.company"), F.col("b.company_name")).alias("company"), F.explode(posts).alias("p"),
    )
    some = lambda *cs: first_filled(*[F.col(f"p.{c}") for c in cs])
    number = lambda *cs: F.coalesce(*[F.col(f"p.{c}") for c in cs], F.lit(0))
    out = out.filter(some("post_id", "text", "url").isNotNull())
    return out.select(
        "query", "company", some("post_id", "id").alias("post_id"), F.coalesce(some("text", "content"), F.lit("")).alias("text"),
        some("posted_at", "created_at").alias("posted_at"), number("likes", "favorite_count").alias("likes"),
        number("retweets", "retweet_count").alias("retweets"), number("replies", "reply_count").alias("replies"),
        F.coalesce(some("url", "post_url"), F.lit("")).alias("url"),
        F.filter(F.coalesce("p.urls", F.array().cast("array<string>")), lambda u: u.startswith("http")).alias("urls"),
        F.coalesce("p.companies_detected", "p.companies", F.array().cast("array<string>")).alias("companies_detected"),
    )


def post_key(post_id, url, author, text):
    """Dedup key of a post: its id, else its link, else author and opening text."""
    return (
        F.when(F.coalesce(post_id, F.lit("")) != "", F.concat(F.lit("x_post:"), post_id))
        .when(F.coalesce(url, F.lit("")) != "", url_key(url))
        .otherwise(url_key(F.concat(F.lit("x:"), F.coalesce(author, F.lit("")), F.lit(":"), F.substring(text, 1, 120))))
    )

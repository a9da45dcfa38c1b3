"""Landed files to rows: staged signals, filings, directories, registers, feeds, threads, posts,
job boards and repository metrics.

Readers only open files with a declared schema; shaping works on DataFrames, so the same code
serves batch files, streams and tables that already hold the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import entities
from ..functions.text import filled, first_filled, strip_tags, url_key
from ..operators import keyed, resolve, social
from ..operators.signals import high_signal

STAGED_SCHEMA = "source string, url string, company_id bigint, detected_at string, dedup_key string, data string"

# Link shapes of public registers, kept rows per filing and feed, feed window.
FILING_LINK = "https://www.sec.gov/cgi-bin/browse-edgar?action=getcompany&CIK={}&type=D&dateb=&owner=exclude&count=40"
DIRECTORY_LINK = "https://www.ycombinator.com/companies/"
THREAD_LINK = "https://news.ycombinator.com/item?id="
FEED_DAYS = 30
FILING_FORMS = ["D", "D/A"]


# -- staged signals -----------------------------------------------------------------------------


def staged_lines(lines: DataFrame) -> DataFrame:
    """JSON lines (column ``value``) to staged signals; blank lines are skipped."""
    rows = lines.filter(F.trim("value") != "").select(F.from_json("value", STAGED_SCHEMA).alias("r")).select("r.*")
    rows = rows.filter("coalesce(url, '') <> '' or coalesce(dedup_key, '') <> ''")
    return rows.withColumn("signal_type", F.coalesce(filled(F.col("dedup_key")), url_key(F.col("url")))).withColumn(
        "detected_at", F.col("detected_at").try_cast("timestamp")
    ).withColumnRenamed("data", "data_json")


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    return staged_lines(spark.read.text(path))


# -- filings ------------------------------------------------------------------------------------


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).option("inferSchema", False).csv(path)


def form_d(issuers: DataFrame, offerings: DataFrame, persons: DataFrame, most_persons: int | None = None) -> DataFrame:
    """One row per primary issuer with its offering and first related persons.

    ``persons`` carries a ``line`` column with the file order. ``most_persons`` keeps the first of each filing.
    """
    acc = F.trim("ACCESSIONNUMBER")
    base = issuers.filter(F.upper("IS_PRIMARYISSUER_FLAG") == "YES").select(
        acc.alias("accession"), F.trim("ENTITYNAME").alias("entity_name"), F.trim("CIK").alias("cik"), F.trim("ENTITYTYPE").alias("entity_type"),
        F.concat_ws(", ", filled(F.trim("CITY")), filled(F.trim("STATEORCOUNTRY"))).alias("headquarters"),
        F.trim("JURISDICTIONOFINC").alias("jurisdiction"), F.trim("YEAROFINC_VALUE_ENTERED").alias("year_of_inc"),
    ).filter("coalesce(accession, '') <> '' and coalesce(entity_name, '') <> ''")
    offers = offerings.groupBy(acc.alias("accession")).agg(
        F.max_by(F.struct(F.trim("TOTALOFFERINGAMOUNT").alias("total_offering_amount"), F.trim("TOTALAMOUNTSOLD").alias("total_amount_sold")), "line").alias("o")
    ).filter("accession <> ''").select("accession", "o.*")
    first = persons.withColumn("accession", acc).filter("accession <> ''").withColumn("n", F.col("line"))
    if most_persons is not None:
        first = keyed.top_n(first, ["accession"], [F.asc("line")], most_persons)
    some = F.coalesce(filled(F.col("FIRSTNAME")), filled(F.col("LASTNAME"))).isNotNull()
    name = F.trim(F.concat(F.coalesce("FIRSTNAME", F.lit("")), F.lit(" "), F.coalesce("LASTNAME", F.lit(""))))
    people = first.filter(some).groupBy("accession").agg(
        F.array_sort(F.collect_list(F.struct("n", name.alias("name"), F.trim("RELATIONSHIP").alias("relationship")))).alias("p")
    )
    people = people.select("accession", F.transform("p", lambda x: F.struct(x["name"].alias("name"), x["relationship"].alias("relationship"))).alias("related_persons"))
    out = base.join(offers, "accession", "left").join(people, "accession", "left")
    head, tail = FILING_LINK.split("{}")
    return out.withColumn("url", F.concat(F.lit(head), F.coalesce("cik", F.lit("")), F.lit(tail))).withColumn(
        "dedup_key", F.concat(F.lit("form_d_bulk_"), "accession")
    )


SUBMISSIONS_SCHEMA = (
    "cik string, filings struct<recent: struct<form: array<string>, filingDate: array<string>, accessionNumber: array<string>>>"
)


def filings_columnar(submissions: DataFrame, cutoff: str) -> DataFrame:
    """Recent filings from parallel arrays: wanted forms since the cutoff with an accession number."""
    r = "filings.recent."
    zipped = F.arrays_zip(F.col(r + "form"), F.col(r + "filingDate"), F.col(r + "accessionNumber"))
    rows = submissions.select("cik", F.inline(zipped)).toDF("cik", "form", "filing_date", "accession")
    rows = rows.filter(F.col("form").isin(FILING_FORMS) & (F.col("filing_date") >= cutoff) & (F.coalesce("accession", F.lit("")) != ""))
    return rows.withColumn("dedup_key", F.concat_ws("_", F.lit("form_d"), "cik", "accession"))


# -- directories and registers --------------------------------------------------------------------


def resolved_by_site_then_name(rows: DataFrame, companies: DataFrame, name: str, website: str) -> DataFrame:
    """Adds company_id from the website's domain, else from the name."""
    links = rows.select("row_id", F.col(website).alias("url")).filter("url is not null").withColumnRenamed("row_id", "id")
    by_site = resolve.by_domain(links, companies).select(F.col("id").alias("row_id"), F.col("company_id").alias("__site"))
    by_name = resolve.resolve_names(rows.select(F.col(name).alias("name")), companies)
    by_name = by_name.select(F.col("name").alias(name), F.col("company_id").alias("__name"))
    out = rows.join(by_site, "row_id", "left").join(by_name, name, "left")
    return out.withColumn("company_id", F.coalesce("__site", "__name")).drop("__site", "__name")


def yc_directory(entries: DataFrame, companies: DataFrame) -> DataFrame:
    """Directory entries (row_id, name, slug, website, ...) to signal rows."""
    rows = entries.withColumn("name", F.trim("name")).filter("coalesce(name, '') <> ''")
    rows = rows.withColumn("website", filled(F.trim("website")))
    slug = F.substring(F.lower(F.replace(F.coalesce(filled(F.col("slug")), F.col("name")), F.lit(" "), F.lit("-"))), 1, 80)
    rows = rows.withColumn("slug", slug)
    rows = rows.withColumn("url", F.coalesce("website", F.concat(F.lit(DIRECTORY_LINK), "slug")))
    rows = rows.withColumn("dedup_key", F.concat(F.lit("yc_"), "slug"))
    return resolved_by_site_then_name(rows, companies, "name", "website")


def mica_register(entries: DataFrame, companies: DataFrame) -> DataFrame:
    """Register rows of known companies; the commercial name, else the legal name, names them."""
    rows = entries.withColumn("commercial_name", F.trim(first_filled(F.col("ae_commercial_name"), F.col("ae_lei_name"))))
    rows = rows.filter("coalesce(commercial_name, '') <> ''").withColumn("website", filled(F.trim("ae_website"))).withColumn("lei", F.trim("ae_lei"))
    fallback = F.replace(F.lower("commercial_name"), F.lit(" "), F.lit("_"))
    rows = rows.withColumn("dedup_key", F.concat(F.lit("mica_"), F.coalesce(filled(F.col("lei")), fallback)))
    return resolved_by_site_then_name(rows, companies, "commercial_name", "website").filter("company_id is not null")


# -- feeds and threads ----------------------------------------------------------------------------


def read_feed(spark: SparkSession, path: str, feed: str, category: str) -> DataFrame:
    """RSS items of landed feed files."""
    schema = "title string, link string, description string, pubDate string"
    items = spark.read.format("xml").option("rowTag", "item").schema(schema).load(path)
    published = F.try_to_timestamp(F.regexp_replace("pubDate", r"^\w+,\s*", ""), F.lit("d MMM yyyy HH:mm:ss Z"))
    return items.select(
        F.lit(feed).alias("feed"), F.lit(category).alias("category"), F.monotonically_increasing_id().alias("position"),
        "title", "link", F.col("description").alias("summary"), published.alias("published"),
    )


def feed_entries(items: DataFrame, companies: DataFrame, as_of, days: int | None = FEED_DAYS, per_feed: int | None = None) -> DataFrame:
    """Entries of the last ``days`` (None: all), with mentions and the high-signal flag; ``per_feed`` keeps a feed's first.

    Items: feed, category, position, title, link, summary, published.
    """
    rows = items if per_feed is None else keyed.top_n(items, ["feed"], [F.asc("position")], per_feed)
    rows = rows.withColumn("published", F.coalesce("published", F.lit(as_of)))
    if days is not None:
        rows = rows.filter(F.col("published") >= F.lit(as_of) - F.expr(f"interval {days} days"))
    body = F.concat_ws(" ", filled(F.col("title")), filled(F.col("summary")))
    rows = rows.withColumn("body", body).withColumn("id", F.xxhash64("feed", "position"))
    rows = rows.withColumn("high_signal", high_signal(F.col("body"), F.col("category")))
    named = resolve.mentions(rows.select("id", F.col("body").alias("text")), companies)
    named = named.groupBy("id").agg(F.array_sort(F.collect_set("mention")).alias("__m"))
    none = F.array().cast("array<string>")
    found = F.when(F.col("high_signal"), entities.headline_entities(F.col("body"))).otherwise(none)
    out = rows.join(named, "id", "left")
    return out.withColumn("mentions", F.array_distinct(F.concat(F.coalesce("__m", none), found))).withColumn("summary", F.col("body")).drop("__m", "body", "id")


def hn_stories(items: DataFrame) -> DataFrame:
    """Startup-relevant stories with their type, links and first comments.

    Items: id, type, title, text, url, kids, descendants.
    """
    stories = items.filter(F.coalesce("type", F.lit("story")) == "story")
    stories = stories.filter(social.startup_relevant(F.col("title"), F.col("text")))
    threads = social.thread_comments(stories.select("id", "kids", "descendants"), items)
    page = F.concat(F.lit(THREAD_LINK), F.col("id").cast("string"))
    rows = stories.join(threads, "id", "left")
    return rows.select(
        "id", "title", strip_tags(F.col("text")).alias("text"), F.coalesce(filled(F.col("url")), page).alias("url"),
        page.alias("discussion_url"), social.story_type(F.col("title")).alias("story_type"),
        F.coalesce("comments", F.array().cast("array<string>")).alias("comments"),
        entities.headline_entities(F.concat_ws(" ", "title", "text")).alias("provisional_entities"),
    )


# -- posts ------------------------------------------------------------------------------------------

SEARCH_SCHEMA = (
    "data:array<struct<id:string,text:string,created_at:string,author_id:string,public_metrics:struct<retweet_count:bigint,reply_count:bigint,"
    "like_count:bigint>,entities:struct<urls:array<struct<expanded_url:string,url:string>>>>>,includes:struct<users:array<struct<id:string,username:string>>>"
)


def search_posts(payloads: DataFrame) -> DataFrame:
    """Search payloads (column ``value``) to posts with author, metrics and links of text and entities."""
    rows = payloads.select(F.from_json("value", f"struct<{SEARCH_SCHEMA}>").alias("p")).select(F.explode("p.data").alias("t"), F.col("p.includes.users").alias("users"))
    user = F.get(F.filter("users", lambda u: u["id"] == F.col("t.author_id")), 0)["username"]
    return posts_of(rows.withColumn("author", user))


def posts_of(rows: DataFrame) -> DataFrame:
    """Posts of (t, author), a post as the search interface gives it and its author's name, if that is known."""
    rows = rows.withColumn("author", F.coalesce("author", F.lit("i")))
    inline = F.regexp_extract_all("t.text", F.lit(r"""https?://[^\s\])"'<>]+"""), F.lit(0))
    linked = F.filter(F.transform("t.entities.urls", lambda u: F.coalesce(u["expanded_url"], u["url"])), lambda u: u.startswith("http"))
    none = F.array().cast("array<string>")
    m = "t.public_metrics."
    return rows.select(
        F.col("t.id").alias("post_id"), F.col("t.text").alias("text"), F.col("t.created_at").alias("posted_at"), "author",
        F.coalesce(F.col(m + "like_count"), F.lit(0)).alias("likes"), F.coalesce(F.col(m + "retweet_count"), F.lit(0)).alias("retweets"),
        F.coalesce(F.col(m + "reply_count"), F.lit(0)).alias("replies"),
        F.concat(F.lit("https://x.com/"), "author", F.lit("/status/"), F.col("t.id")).alias("url"),
        F.array_distinct(F.concat(F.coalesce(inline, none), F.coalesce(linked, none))).alias("urls"),
    )


# -- job boards ---------------------------------------------------------------------------------------

BOARD_SCHEMAS = {
    "greenhouse": "jobs array<struct<id:string,title:string,absolute_url:string,updated_at:string,created_at:string,content:string,departments:array<struct<name:string>>,location:struct<name:string>>>",
    "lever": "array<struct<id:string,text:string,title:string,hostedUrl:string,applyUrl:string,createdAt:string,description:string,descriptionPlain:string,categories:struct<department:string,team:string,location:string,commitment:string>>>",
    "ashby": "jobs array<struct<id:string,title:string,department:string,team:string,location:string,jobUrl:string,applyUrl:string,publishedAt:string,updatedAt:string,description:string,descriptionPlain:string,employmentType:string>>",
}


def board_jobs(payloads: DataFrame) -> DataFrame:
    """Board payloads (board, slug, value) of all shapes as landed postings."""

    def jobs(board):
        parsed = F.from_json("value", BOARD_SCHEMAS[board])
        items = parsed if board == "lever" else parsed["jobs"]
        return payloads.filter(F.col("board") == board).select("slug", F.explode(items).alias("j"))

    g, lever, ashby = (board_shape(jobs(board), board) for board in ("greenhouse", "lever", "ashby"))
    return g.unionByName(lever).unionByName(ashby)


def board_shape(df: DataFrame, board: str) -> DataFrame:
    """Jobs (slug, j) of one board's shape as landed postings."""
    c, none = (lambda name: F.col(f"j.{name}")), F.lit(None).cast("string")
    day = lambda *names: filled(F.substring(first_filled(*map(c, names)), 1, 10))
    shape = {
        "greenhouse": lambda: (c("title"), F.get(c("departments"), 0)["name"], none, c("location.name"), c("absolute_url"), day("updated_at", "created_at"), c("content"), none),
        "lever": lambda: (
            first_filled(c("text"), c("title")), c("categories.department"), c("categories.team"), c("categories.location"), first_filled(c("hostedUrl"), c("applyUrl")), day("createdAt"),
            first_filled(c("descriptionPlain"), c("description")), c("categories.commitment")),
        "ashby": lambda: (
            c("title"), c("department"), c("team"), c("location"), first_filled(c("jobUrl"), c("applyUrl")), day("publishedAt", "updatedAt"),
            first_filled(c("descriptionPlain"), c("description")), c("employmentType")),
    }
    title, department, team, location, url, posted, text, commitment = shape[board]()
    return df.select(
        F.coalesce("j.id", F.lit("")).alias("external_id"), F.coalesce(title, F.lit("")).alias("title"), department.alias("department"),
        team.alias("team"), location.alias("location"), url.alias("source_url"), posted.alias("posted_at"), strip_tags(text).alias("description"),
        F.lit(board).alias("ats_platform"), F.lit(board).alias("source"), commitment.alias("commitment"), "slug",
    )


# -- repositories and catalogs ------------------------------------------------------------------------


def repo_metrics(repos: DataFrame, languages: DataFrame, contributors: DataFrame) -> DataFrame:
    """One row per organisation from its first non-fork repository.

    repos: org, position, name, fork, stars, language; languages: org, name, language, bytes;
    contributors: org, name, login, contributions.
    """
    top = keyed.keep_first(repos.filter("not coalesce(fork, false)"), ["org"], ["position"]).select("org", "name", "stars", "language")
    langs = languages.groupBy("org", "name").agg(F.max_by("language", F.struct("bytes", "language")).alias("__main"), F.sum("bytes").alias("__bytes"), F.max("bytes").alias("__top"))
    people = contributors.groupBy("org", "name").agg(F.count("*").alias("contributor_count"), F.count_if(F.col("contributions") > 0).alias("active_contributors"))
    out = top.join(langs, ["org", "name"], "left").join(people, ["org", "name"], "left")
    return out.select(
        "org", F.col("name").alias("repo"), "stars", F.coalesce("__main", "language").alias("primary_language"),
        F.round(F.col("__top") / F.nullif(F.col("__bytes"), F.lit(0)) * 100, 1).alias("primary_percent"),
        F.coalesce("contributor_count", F.lit(0)).alias("contributor_count"), F.coalesce("active_contributors", F.lit(0)).alias("active_contributors"),
    )


def feed_catalog_summary(feeds: DataFrame) -> DataFrame:
    """Feeds per category with enabled and disabled counts, and the total (null category)."""
    return feeds.rollup("category").agg(
        F.count("*").alias("total"), F.count_if("enabled").alias("enabled"), F.count_if(~F.col("enabled")).alias("disabled")
    )


def feeds_by_category(feeds: DataFrame, category: str, aliases: dict[str, str] | None = None) -> DataFrame:
    return feeds.filter(F.col("enabled") & (F.col("category") == (aliases or {}).get(category, category)))

"""Job claims, canonical postings, skills and hiring velocity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import rounded
from ..functions import jobs as J
from ..functions.text import authority_host_prefix, contains_any, filled, first_filled, strip
from ..functions.trust import job_trust

# Words that make a hiring event job-like, and the confidence of its claim.
HIRING_WORDS = ["engineer", "developer", "hiring", "open role", "job"]
EVENT_CONFIDENCE, BOARD_CONFIDENCE, SKILL_CONFIDENCE = 0.55, 0.85, 0.85

# Columns of a canonical posting taken from the best claim that has a value.
POSTING_FIELDS = [
    "title", "department", "team", "location", "remote_policy", "seniority_band", "employment_type",
    "salary_min_usd", "salary_max_usd", "salary_range", "ats_platform", "external_id", "posted_at",
]
JOB_POLICY_KEPT = {
    c: "keep" for c in (
        "company_id", "external_id", "salary_currency", "source", "ats_platform", "posted_at",
        "closes_at", "intelligence_event_id", "raw_signal_id",
    )
}


def hiring_events(events: DataFrame, extra: list[str] | None = None) -> DataFrame:
    words = HIRING_WORDS + (extra or [])
    return events.filter(
        F.col("company_id").isNotNull() & (F.col("event_type") == "Hiring")
        & contains_any(F.lower("description"), words)
    )


def parse_jobs(raw: DataFrame) -> DataFrame:
    """Landed postings to claim fields. Input: title, description, location, department, team, commitment."""
    title = J.job_title(F.col("title"))
    desc = F.coalesce("description", F.lit(""))
    rows = raw.withColumn("title", title).withColumn("__desc", desc)
    rows = rows.withColumn("__text", F.concat_ws(" ", "title", "__desc"))
    rows = rows.withColumn("__pay", J.pay_range(F.col("__text"))).withColumn("skills", J.skills(F.col("__text")))
    return (
        rows.withColumn("__dep", first_filled(F.col("department"), F.col("team")))
        .withColumn("team", first_filled(F.col("team"), F.col("department")))
        .withColumn("department", F.col("__dep"))
        .withColumn("seniority_band", J.seniority(F.col("title")))
        .withColumn("employment_type", J.employment_type(F.col("title"), F.col("commitment")))
        .withColumn("remote_policy", J.remote_policy(F.col("location"), F.col("__desc")))
        .withColumn("salary_min_usd", F.col("__pay.low"))
        .withColumn("salary_max_usd", F.col("__pay.high"))
        .withColumn("salary_range", F.col("__pay.raw"))
        .withColumn("description_snippet", filled(F.substring("__desc", 1, 500)))
        .drop("__desc", "__text", "__pay", "__dep")
    )


def job_claims(raw: DataFrame, companies: DataFrame) -> DataFrame:
    """Parsed postings with source trust and a URL of their own where none was given."""
    rows = parse_jobs(raw)
    ats = F.coalesce(filled(F.col("ats_platform")), filled(F.col("source")), F.lit("unknown"))
    own = F.concat_ws(
        ":", F.lit("job"), F.col("company_id").cast("string"), ats, F.coalesce("external_id", F.lit("")),
        "title",
    )
    rows = rows.withColumn("source_url", F.coalesce(filled(strip(F.col("source_url"))), own))
    rows = rows.drop("website").join(companies.select("company_id", "website"), "company_id")
    trust = job_trust(F.col("source"), F.col("source_url"), F.col("website"), F.col("ats_platform"))
    rows = rows.withColumn("__t", trust)
    confidence = F.col("extraction_confidence") if "extraction_confidence" in raw.columns else F.lit(BOARD_CONFIDENCE)
    return rows.select(
        *[c for c in rows.columns if c not in ("__t", "website", "source", "extraction_confidence")],
        F.coalesce(filled(F.col("source")), F.col("ats_platform")).alias("source"),
        F.col("__t.tier").alias("source_tier"), F.col("__t.weight").alias("source_weight"),
        F.col("__t.official").alias("is_official"), confidence.alias("extraction_confidence"),
    )


def event_job_rows(events: DataFrame) -> DataFrame:
    """Hiring events shaped as landed postings."""
    none = F.lit(None).cast("string")
    return hiring_events(events).select(
        "id", "company_id", F.col("description").alias("title"), "description",
        none.alias("location"), none.alias("department"), none.alias("team"), none.alias("commitment"),
        F.coalesce(filled(F.col("source_url")), F.concat(F.lit("intel-event:"), F.col("id").cast("string"))).alias("source_url"),
        F.coalesce(filled(F.col("source")), F.lit("intelligence_event")).alias("source"),
        F.lit("press_mention").alias("ats_platform"), none.alias("external_id"),
        F.col("announced_date").alias("posted_at"), F.lit(EVENT_CONFIDENCE).alias("extraction_confidence"),
    )


def with_cluster(claims: DataFrame) -> DataFrame:
    return claims.withColumn(
        "cluster_key",
        J.job_cluster(F.col("company_id"), F.col("title"), F.col("location"), F.col("ats_platform"), F.col("external_id")),
    )


def job_postings(claims: DataFrame) -> DataFrame:
    """Canonical postings: per field the best claim that has it, and a corroboration score."""
    rows = with_cluster(claims)
    rank = F.struct(
        F.coalesce("source_weight", F.lit(0.0)), F.coalesce("extraction_confidence", F.lit(0.0)), (-F.col("id")).alias("back")
    )
    has = lambda c: F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    fields = [F.max_by(c, F.when(has(c), rank)).alias(c) for c in POSTING_FIELDS]
    heaviest = F.struct(F.coalesce("source_weight", F.lit(0.0)), (-F.col("id")).alias("back"))
    domain = F.coalesce(filled(authority_host_prefix(F.col("source_url"))), F.lower("source"))
    out = rows.withColumn("__domain", domain).groupBy("company_id", "cluster_key").agg(
        *fields,
        F.max_by(F.struct("source", "source_url", F.col("source_tier").alias("source_tier_best")), heaviest).alias("s"),
        F.count("*").alias("report_count"), F.count_if("is_official").alias("official_report_count"),
        F.count_distinct("__domain").alias("__domains"), F.max(F.coalesce("source_weight", F.lit(0.0))).alias("__w"),
    )
    score = rounded(
        F.least("__domains", F.lit(4)) / 4 * 0.30 + F.least("report_count", F.lit(5)) / 5 * 0.20
        + F.when(F.col("official_report_count") > 0, 0.25).otherwise(0.0) + F.col("__w") * 0.20 + 0.05, 3,
    )
    return out.select(
        "company_id", "cluster_key", *POSTING_FIELDS, "s.*", "report_count", "official_report_count",
        F.least(F.lit(1.0), score).alias("corroboration_score"), F.lit(True).alias("is_active"),
    )


def posting_skills(claims: DataFrame) -> DataFrame:
    """Distinct skill per posting with its first category and the number of claims naming it."""
    rows = with_cluster(claims).select("cluster_key", "id", F.inline("skills"))
    return rows.groupBy("cluster_key", "skill").agg(
        F.min_by("category", "id").alias("category"), F.count("*").alias("claims")
    ).withColumn("confidence", F.lit(SKILL_CONFIDENCE))


def deactivate_stale(postings: DataFrame, seen: DataFrame) -> DataFrame:
    """Board postings of companies seen this run whose URL was not seen become inactive."""
    urls = seen.select("company_id", "source_url").distinct().withColumn("__seen", F.lit(True))
    firms = seen.select("company_id").distinct().withColumn("__firm", F.lit(True))
    out = postings.join(urls, ["company_id", "source_url"], "left").join(firms, "company_id", "left")
    stale = (
        F.col("__firm").isNotNull() & F.col("__seen").isNull() & F.col("source_url").isNotNull()
        & F.col("ats_platform").isNotNull()
    )
    return out.withColumn("is_active", F.col("is_active") & ~stale).select(*postings.columns)


def hiring_velocity(postings: DataFrame, today) -> DataFrame:
    """Per company with active openings: openings, new ones of the last 30 days, breadth."""
    active = F.col("is_active")
    out = postings.groupBy("company_id").agg(
        F.count_if(active).alias("active_openings"),
        F.count_if(F.col("posted_at") >= F.date_sub(F.lit(today).cast("date"), 30).cast("string")).alias("new_postings_30d"),
        F.count_distinct(F.when(active, F.col("department"))).alias("departments_hiring"),
        F.count_distinct(F.when(active, F.col("location"))).alias("locations_hiring"),
        F.count_distinct(F.when(active, F.col("seniority_band"))).alias("seniority_levels"),
    )
    return out.filter("active_openings > 0")


#: Boards whose postings carry the board's own address.
BOARD_HOSTS = ("greenhouse", "lever", "ashby")


def company_boards(postings: DataFrame, as_of: str) -> DataFrame:
    """(company_id, ats_platform, board_slug, board_url, last_fetched_at, last_job_count): the boards that postings were read from."""
    url = r"^(https?://[^/]+/([^/?#]+))"
    rows = postings.filter(F.col("source").isin(*BOARD_HOSTS)).select(
        "company_id", F.col("source").alias("ats_platform"), F.regexp_extract("source_url", url, 1).alias("board_url"), F.regexp_extract("source_url", url, 2).alias("board_slug"))
    out = rows.filter("board_slug <> ''").groupBy("company_id", "ats_platform").agg(
        F.max_by("board_slug", "board_url").alias("board_slug"), F.max("board_url").alias("board_url"), F.count(F.lit(1)).alias("last_job_count"))
    return out.select("company_id", "ats_platform", "board_slug", "board_url", F.lit(as_of).alias("last_fetched_at"), "last_job_count")


def board_slugs(companies: DataFrame) -> DataFrame:
    """Ordered distinct board slugs from organisation and name."""
    low = F.lower(F.trim("name"))
    dash = F.regexp_replace(F.regexp_replace(low, "[^a-z0-9]+", "-"), "^-+|-+$", "")
    tries = F.array(
        F.lower(F.trim("github_org")), F.replace(low, F.lit(" "), F.lit("-")), F.replace(low, F.lit(" "), F.lit("")),
        dash, F.regexp_replace(low, "[^a-z0-9]+", ""),
    )
    usable = F.array_distinct(F.filter(tries, lambda s: s.isNotNull() & (s != "")))
    return companies.select("company_id", F.posexplode(usable).alias("position", "slug"))

"""Company-data claims and their rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import exact_avg, rounded
from ..functions.text import authority_host

# What an existing claim keeps when the same source URL reports again.
PROFILE_POLICY = {
    c: "overwrite" for c in (
        "field_value", "source_tier", "source_weight", "is_official", "extraction_confidence",
        "headline", "snippet",
    )
}
TEAM_POLICY = {
    "name": "overwrite", "name_normalized": "overwrite", "role": "coalesce", "is_founder": "overwrite",
    "joined_date": "coalesce", "linkedin_url": "coalesce", "source_tier": "overwrite",
    "source_weight": "overwrite", "extraction_confidence": "overwrite", "headline": "overwrite",
    "snippet": "overwrite",
}
PRODUCT_POLICY = {
    "description": "coalesce", "category": "coalesce", "status": "overwrite",
    "product_url": "coalesce", "source_tier": "overwrite", "source_weight": "overwrite",
    "extraction_confidence": "overwrite",
}
LICENSE_POLICY = {
    "status": "overwrite", "license_number": "coalesce", "source_tier": "overwrite",
    "source_weight": "overwrite",
}


# Score parts of a merged company fact.
BASE_SCORE, DOMAIN_SCORE, WEIGHT_SCORE, OFFICIAL_SCORE, REPORT_SCORE = 0.25, 0.12, 0.35, 0.08, 0.03
PROFILE_FIELDS = [
    "founded_year", "headquarters", "team_size", "team_size_source", "business_model", "tech_stack",
    "description_long", "traction", "moat", "industry", "website_url", "entity_type", "legal_name",
]


def _score_parts():
    return [
        F.count("*").alias("report_count"),
        F.count_distinct(authority_host(F.col("source_url"))).alias("unique_domains"),
        exact_avg(F.coalesce(F.nullif("source_weight", F.lit(0.0)), F.lit(0.5))).alias("__w"),
        F.coalesce(F.bool_or("is_official"), F.lit(False)).alias("__official"),
    ]


def _score():
    return rounded(
        F.least(
            F.lit(1.0),
            F.lit(BASE_SCORE) + F.least("unique_domains", F.lit(5)) * DOMAIN_SCORE + F.col("__w") * WEIGHT_SCORE
            + F.when(F.col("__official"), OFFICIAL_SCORE).otherwise(0.0) + F.least("report_count", F.lit(6)) * REPORT_SCORE,
        ),
        3,
    ).alias("corroboration_score")


def simple_corroboration(claims: DataFrame, keys: list[str]) -> DataFrame:
    """Score, reports and domains of every group of claims."""
    return claims.groupBy(*keys).agg(*_score_parts()).select(*keys, _score(), "report_count", "unique_domains")


def _heaviest(*columns):
    order = F.struct("source_weight", (-F.col("id")).alias("back"))
    return F.max_by(F.struct(*columns), order).alias("b")


def _person_key():
    return F.coalesce(F.nullif("name_normalized", F.lit("")), F.lower("name"))


def profile_rollup(claims: DataFrame) -> DataFrame:
    """Per company and field the heaviest claim; one column per known field.

    Fields are reduced first, so the pivot handles at most one row per company and field.
    """
    order = F.struct("source_weight", F.coalesce("extraction_confidence", F.lit(0.0)), (-F.col("id")).alias("back"))
    best = claims.groupBy("company_id", "field_key").agg(
        F.max_by("field_value", order).alias("value"), F.max_by("source_url", order).alias("source_url"),
        F.max_by("source_tier", order).alias("source_tier"), F.count("*").alias("report_count"),
    )
    value = lambda k: F.max(F.when(F.col("field_key") == k, F.col("value")))
    number = lambda k: F.trim(value(k)).try_cast("bigint").alias(k)
    out = best.groupBy("company_id").agg(
        number("founded_year"), number("team_size"),
        F.coalesce(F.nullif(value("team_size_source"), F.lit("")), F.lit("aggregated")).alias("team_size_source"),
        *[value(k).alias(k) for k in PROFILE_FIELDS if k not in ("founded_year", "team_size", "team_size_source")],
        F.map_from_entries(F.collect_list(F.struct(
            "field_key", F.struct("value", "source_url", "source_tier", "report_count")
        ))).alias("fields_provenance"),
    )
    return out


def with_profiles(companies: DataFrame, profiles: DataFrame) -> DataFrame:
    """Companies with the industry and website of their rolled-up profile, where it has any, and its entity type and legal name as notes.

    A company whose notes name the entity type already keeps them.
    """
    note = F.concat(F.lit("entity_type="), F.nullif("entity_type", F.lit("")))
    notes = F.when(note.isNotNull(), F.concat_ws(" ", note, F.concat(F.lit("legal_name="), F.nullif("legal_name", F.lit("")))))
    own = profiles.select("company_id", F.struct(
        F.nullif("industry", F.lit("")).alias("industry"), F.nullif("website_url", F.lit("")).alias("website"), note.alias("note"), notes.alias("notes")).alias("__own"))
    had = companies if "notes" in companies.columns else companies.withColumn("notes", F.lit(None).cast("string"))
    rows = had.join(own, "company_id", "left")
    told = F.col("__own.note").isNull() | F.coalesce(F.contains("notes", F.col("__own.note")), F.lit(False))
    rows = rows.withColumn("notes", F.when(told, F.col("notes")).otherwise(F.trim(F.concat_ws(" ", "notes", "__own.notes"))))
    for name in ("industry", "website"):
        rows = rows.withColumn(name, F.coalesce(F.col(f"__own.{name}"), name))
    return rows.select(*had.columns)


def profile_listing(profiles: DataFrame, companies: DataFrame, most: int | None = None) -> DataFrame:
    """Companies with a rolled-up profile, the highest score first; all of them unless a limit is given."""
    own = profiles.select("company_id", "founded_year", "headquarters", "team_size", "business_model")
    out = companies.select("company_id", "name", "industry", "github_stars", "score").join(own, "company_id")
    out = out.orderBy(F.desc_nulls_last("score"), "company_id")
    return out if most is None else out.limit(most)


def team_rollup(claims: DataFrame) -> DataFrame:
    """Per company and person: most voted role (first on ties), founder flag, heaviest attributes."""
    rows = claims.withColumn("__key", _person_key())
    keys = ["company_id", "__key"]
    votes = rows.filter("coalesce(role, '') <> ''").groupBy(*keys, "role").agg(
        F.count("*").alias("n"), F.min("id").alias("first")
    )
    voted = votes.groupBy(*keys).agg(F.max_by("role", F.struct("n", (-F.col("first")).alias("back"))).alias("__role"))
    people = rows.groupBy(*keys).agg(
        _heaviest("name", "name_normalized", "role", "joined_date", "linkedin_url", "source", "source_url"),
        F.coalesce(F.bool_or("is_founder"), F.lit(False)).alias("is_founder"), *_score_parts(),
    )
    out = people.join(voted, keys, "left")
    return out.select(
        "company_id", F.col("__key").alias("name_normalized"), "b.name", F.coalesce("__role", "b.role").alias("role"),
        "is_founder", "b.joined_date", "b.linkedin_url", "b.source", "b.source_url", _score(), "report_count",
    )


def product_rollup(claims: DataFrame) -> DataFrame:
    rows = claims.withColumn("__key", _person_key()).groupBy("company_id", "__key").agg(
        _heaviest("name", "description", "category", "launch_date", "status", "source", "product_url"), *_score_parts()
    )
    return rows.select(
        "company_id", F.col("__key").alias("name_normalized"), "b.name", "b.description", "b.category", "b.launch_date",
        F.coalesce(F.nullif("b.status", F.lit("")), F.lit("active")).alias("status"), "b.source",
        F.col("b.product_url").alias("url"), _score(), "report_count",
    )


def license_rollup(claims: DataFrame) -> DataFrame:
    keys = ["company_id", "jurisdiction", "license_type"]
    rows = claims.groupBy(*keys).agg(
        _heaviest("status", "regulator", "license_number", "effective_date"), *_score_parts()
    )
    return rows.select(*keys, "b.*", _score(), "report_count")

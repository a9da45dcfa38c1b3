"""Corroboration score of a group of claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import exact_avg, rounded
from ..functions.deals import amounts_agree, series_round
from ..functions.text import filled, publisher_domain, squeeze

# Component weights, penalties, bonuses, caps.
WEIGHT = {
    "domains": 0.24, "quality": 0.14, "official": 0.10, "tiers": 0.06, "trusted": 0.08,
    "extraction": 0.08, "lead": 0.06, "round": 0.04, "days": 0.06, "weeks": 0.04, "amount": 0.10,
}
PENALTY = {"amount": 0.12, "rumor": 0.10, "extraction": 0.06}
BONUS = {"valuation": 0.04, "regulatory": 0.03, "roster": 0.04, "github": 0.02, "co_investor": 0.02}
BONUS_CAP = 0.12
SINGLE_CAP, OFFICIAL_CAP, STRONG, BUILDING, TRUSTED = 0.38, 0.55, 0.75, 0.45, 0.72
AMOUNT_TOLERANCE, VALUATION_TOLERANCE = 0.15, 0.12

#: Claim columns the score reads; a missing one counts as null.
CLAIM_COLUMNS = {
    "source": "string", "source_url": "string", "source_tier": "string", "source_weight": "double",
    "is_official": "boolean", "is_rumor": "boolean", "amount_usd": "bigint",
    "extraction_confidence": "double", "lead_investor": "string", "round_type": "string",
    "co_investors": "string", "announced_date": "string", "extracted_at": "string",
    "valuation_usd": "bigint", "post_money_valuation_usd": "bigint", "pre_money_valuation_usd": "bigint",
}


def confidence_tier(score: Column) -> Column:
    return F.when(score >= STRONG, "strong").when(score >= BUILDING, "building").otherwise("early_signal")


def person_key(name: Column) -> Column:
    return filled(F.lower(squeeze(name)))


def co_list(text: Column) -> Column:
    """Co-investor names; text that is no JSON list counts as one name."""
    parsed = F.from_json(F.when(text.startswith("["), text), "array<string>")
    return F.coalesce(parsed, F.when(filled(text).isNotNull(), F.array(text)), F.array().cast("array<string>"))


def _agreement(low: Column, high: Column, count: Column) -> Column:
    return F.when(count < 2, 0.5).when(low == high, 1.0).otherwise(0.0)


def _part(value: Column, weight: float) -> Column:
    return rounded(value * F.lit(weight), 3)


def prepared(claims: DataFrame) -> DataFrame:
    for name, kind in CLAIM_COLUMNS.items():
        if name not in claims.columns:
            claims = claims.withColumn(name, F.lit(None).cast(kind))
    day = F.substring(F.coalesce(filled(F.col("announced_date")), F.col("extracted_at").cast("string")), 1, 10)
    host = publisher_domain(F.col("source_url"))
    return (
        claims.withColumn("__host", host)
        .withColumn("__domain", F.coalesce("__host", filled(F.lower(F.trim("source")))))
        .withColumn("__weight", F.coalesce("source_weight", F.lit(0.0)))
        .withColumn("__day", F.when(F.length(day) == 10, day))
        .withColumn("__lead", person_key(F.col("lead_investor")))
        .withColumn("__round", filled(series_round(F.col("round_type"), "series ", upper=False)))
        .withColumn("__co", F.filter(F.transform(co_list(F.col("co_investors")), person_key), lambda n: n.isNotNull()))
    )


def _most_named(rows: DataFrame, key: str, lists: dict[str, Column]) -> DataFrame:
    """Per group, for each of some lists of names: in how many lists the name stands that most of them hold, as a column of the list's name.

    A name is shared by all when as many lists hold it as there are non-empty ones, which needs counts only, not the lists of a
    group in one place. All kinds of lists are counted in one pass.
    """

    def named(kind: str, names: Column) -> Column:
        return F.transform(F.array_distinct(names), lambda n: F.struct(F.lit(kind).alias("__kind"), n.alias("__n")))

    pairs = [named(kind, names) for kind, names in lists.items()]
    per = rows.select(key, F.explode(F.concat(*pairs)).alias("__p")).groupBy(key, "__p.__kind", "__p.__n").agg(F.count("*").alias("__k"))
    return per.groupBy(key).agg(*[F.max(F.when(F.col("__kind") == kind, F.col("__k"))).alias(kind) for kind in lists])


def corroborate(claims: DataFrame, key: str, github: DataFrame | None = None) -> DataFrame:
    """One row per group ``key``: score and the counts it rests on.

    ``github`` holds the group keys with repository activity. Groups are reduced by partial
    aggregates; only calendar days and tier names, both bounded, are collected as sets.
    """
    c = prepared(claims)
    amount = F.when(F.col("amount_usd") > 0, F.col("amount_usd"))
    values = F.filter(
        F.array("valuation_usd", "post_money_valuation_usd", "pre_money_valuation_usd"), lambda v: v > 0
    )
    names = {"__roster_top": F.concat(F.array_compact(F.array("__lead")), "__co"), "__co_top": F.col("__co")}
    g = c.withColumn("__values", values).groupBy(key).agg(
        F.count("*").alias("claim_count"),
        *[F.count_if(F.size(of) > 0).alias(f"{top}_lists") for top, of in names.items()],
        F.collect_set("source_tier").alias("__tiers"),
        F.coalesce(F.bool_or("is_official"), F.lit(False)).alias("official_present"),
        F.coalesce(F.bool_or("is_rumor"), F.lit(False)).alias("rumor_present"),
        F.count(amount).alias("__amounts"), F.min(amount).alias("__low"), F.max(amount).alias("__high"),
        exact_avg(F.col("extraction_confidence")).alias("__ext"),
        F.count("__lead").alias("__leads"), F.min("__lead").alias("__lead_a"), F.max("__lead").alias("__lead_z"),
        F.count("__round").alias("__rounds"), F.min("__round").alias("__round_a"), F.max("__round").alias("__round_z"),
        F.collect_set("__day").alias("__days"),
        F.sum(F.size("__values")).alias("__vals"),
        F.min(F.array_min("__values")).alias("__val_low"), F.max(F.array_max("__values")).alias("__val_high"),
        F.coalesce(
            F.bool_or((F.col("source_tier") == "regulatory") | F.coalesce(F.col("__host").contains("sec.gov"), F.lit(False))),
            F.lit(False),
        ).alias("__regulatory"),
    )
    domains = c.filter("__domain is not null").groupBy(key, "__domain").agg(F.max("__weight").alias("w"))
    domains = domains.groupBy(key).agg(
        F.count("*").alias("unique_domains"), exact_avg(F.col("w")).alias("__mean"), F.count_if(F.col("w") >= TRUSTED).alias("__trusted")
    )
    g = g.join(domains, key, "left").join(_most_named(c, key, names), key, "left")
    for shared, top in (("__roster", "__roster_top"), ("__shared_co", "__co_top")):
        g = g.withColumn(shared, (F.col(f"{top}_lists") >= 2) & (F.col(top) == F.col(f"{top}_lists")))
    if github is not None:
        g = g.join(github.select(key).distinct().withColumn("__github", F.lit(True)), key, "left")
    else:
        g = g.withColumn("__github", F.lit(None).cast("boolean"))
    return _score(g, key)


def _score(g: DataFrame, key: str) -> DataFrame:
    weeks = F.array_distinct(
        F.filter(
            F.transform(
                "__days",
                lambda d: F.when(
                    d.try_cast("date").isNotNull(),
                    F.concat_ws("-", F.extract(F.lit("YEAROFWEEK"), d.try_cast("date")), F.weekofyear(d.try_cast("date"))),
                ),
            ),
            lambda w: w.isNotNull(),
        )
    )
    nd = F.col("unique_domains")
    g = (
        g.withColumn("unique_domains", F.coalesce("unique_domains", F.lit(0)))
        .withColumn("__mean", F.coalesce("__mean", F.lit(0.0)))
        .withColumn("__trusted", F.coalesce("__trusted", F.lit(0)))
        .withColumn("unique_tiers", F.size(F.filter("__tiers", lambda t: t != "")))
        .withColumn("temporal_days", F.size("__days"))
        .withColumn("temporal_weeks", F.size(weeks))
        .withColumn("amount_agreement", amounts_agree(F.col("__low"), F.col("__high"), F.col("__amounts"), AMOUNT_TOLERANCE))
    )
    nt = F.col("unique_tiers")
    tier = F.when(nt >= 2, F.least(nt, F.lit(4)) / 4).when((nd >= 3) & (F.col("__mean") >= 0.7), 0.75).otherwise(
        F.least(nt, F.lit(4)) / 4
    )
    ext = F.coalesce("__ext", F.lit(0.55))
    step = lambda n, most: F.least(F.greatest(n - 1, F.lit(0)), F.lit(most)) / most
    yes = lambda flag: F.when(flag, 1.0).otherwise(0.0)
    parts = [
        _part(F.sqrt(F.least(nd, F.lit(6)) / 6), WEIGHT["domains"]),
        _part(F.col("__mean"), WEIGHT["quality"]),
        _part(yes(F.col("official_present")), WEIGHT["official"]),
        _part(tier, WEIGHT["tiers"]),
        _part(F.least("__trusted", F.lit(3)) / 3, WEIGHT["trusted"]),
        _part(F.least(ext, F.lit(1.0)), WEIGHT["extraction"]),
        _part(_agreement(F.col("__lead_a"), F.col("__lead_z"), F.col("__leads")), WEIGHT["lead"]),
        _part(_agreement(F.col("__round_a"), F.col("__round_z"), F.col("__rounds")), WEIGHT["round"]),
        _part(step(F.col("temporal_days"), 3), WEIGHT["days"]),
        _part(step(F.col("temporal_weeks"), 2), WEIGHT["weeks"]),
        _part(yes(F.col("amount_agreement")), WEIGHT["amount"]),
    ]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    agree = amounts_agree(F.col("__val_low"), F.col("__val_high"), F.col("__vals"), VALUATION_TOLERANCE)
    bonus = F.least(
        F.lit(BONUS_CAP),
        yes((F.col("__vals") >= 2) & agree) * BONUS["valuation"]
        + yes(F.col("__regulatory")) * BONUS["regulatory"]
        + yes(F.col("__roster")) * BONUS["roster"]
        + yes(F.col("__shared_co")) * BONUS["co_investor"]
        + yes(F.col("__github")) * BONUS["github"],
    )
    fine = (
        yes(~F.col("amount_agreement") & (F.col("__amounts") >= 2)) * PENALTY["amount"]
        + yes(F.col("rumor_present")) * PENALTY["rumor"]
        + yes(F.col("__ext") < 0.45) * PENALTY["extraction"]
    )
    raw = F.greatest(F.lit(0.0), F.least(F.lit(1.0), rounded(total + bonus - fine, 3)))
    official = F.col("official_present")
    capped = F.least(raw, F.when(official, OFFICIAL_CAP).otherwise(SINGLE_CAP))
    capped = F.when(official & (nd == 1), F.greatest(capped, F.lit(OFFICIAL_CAP))).otherwise(capped)
    g = g.withColumn("score", F.when(nd < 2, capped).otherwise(raw))
    return g.select(
        key, "score", "claim_count", nd.alias("unique_domains"), F.col("unique_tiers"), "official_present",
        "rumor_present", "amount_agreement", rounded(F.col("__mean"), 3).alias("mean_domain_weight"),
        rounded(ext, 3).alias("mean_extraction_confidence"), "temporal_days", "temporal_weeks",
    )

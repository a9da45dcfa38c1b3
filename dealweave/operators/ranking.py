"""Attention counts, candidate discovery and company scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import rounded
from ..functions import entities
from ..functions.text import contains_any, first_filled, slug
from ..session import settled
from . import keyed, resolve
from .signals import as_list, field, parse_payloads, payload_blob


def ago(as_of, days: int):
    return F.lit(as_of) - F.expr(f"interval {days} days")


def period_counts(signals: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Signals of the current and of the preceding period, per company."""
    at = F.col("detected_at")
    recent, prior = at >= ago(as_of, days), (at >= ago(as_of, 2 * days)) & (at < ago(as_of, days))
    return signals.filter("company_id is not null").groupBy("company_id").agg(
        F.count_if(recent).alias("recent"), F.count_if(prior).alias("prior")
    )


# Score mixes and bars.
ATTENTION_MIX = {"volume": 0.45, "diversity": 0.25, "hype": 0.30}
RANK_MIX = {"volume": 0.30, "velocity": 0.30, "diversity": 0.15, "events": 0.15, "hype": 0.10}
LEAST_ATTENTION, LEAST_SIGNALS, PROMOTE_BAR, TRACKED_BAR = 0.08, 2, 0.65, 0.72
HYPE_SIGNALS = 40


def signal_names(signals: DataFrame, companies: DataFrame) -> DataFrame:
    """(id, source, detected_at, hype, name): every plausible name a signal brings up."""
    rows = parse_payloads(signals, strict=False)
    text = payload_blob("title", "summary", "text", "description", "entity_name")
    listed = F.concat(
        F.array(field("entity_name"), field("commercial_name"), field("name")),
        as_list(field("mentioned_companies")),
        F.when(F.size(as_list(field("companies_detected"))) > 0, as_list(field("companies_detected")))
        .otherwise(as_list(field("provisional_entities"))),
    )
    prose = F.concat_ws(
        " ", F.coalesce(field("title"), F.lit("")),
        F.coalesce(first_filled(field("summary"), field("text"), field("description")), F.lit("")),
    )
    rows = rows.withColumn("__listed", listed).withColumn("__prose", prose).withColumn("hype", entities.hype_hits(text))
    own = companies.select("company_id", F.col("name").alias("__own"))
    rows = rows.join(own, "company_id", "left")
    names = F.concat(F.transform(F.concat("__listed", F.array("__own")), entities.entity_name), entities.headline_entities(F.col("__prose")))
    names = F.array_distinct(F.filter(names, lambda n: n.isNotNull() & entities.plausible_name(n)))
    out = rows.select("id", "source", "detected_at", "hype", F.explode_outer(names).alias("name"))
    return out.filter("name is not null")


def untracked_names(signals: DataFrame, companies: DataFrame, as_of, days: int) -> DataFrame:
    """The rows of :func:`signal_names` of the last ``days`` whose name is no tracked company.

    Names are found once and written, since matching them reads the distinct ones several times.
    """
    rows = settled(signal_names(signals.filter(F.col("detected_at") >= ago(as_of, days)), companies), "names")
    tracked = resolve.fuzzy_match(rows.select("name"), companies).filter(F.col("score") >= TRACKED_BAR)
    return rows.join(tracked.select("name").distinct(), "name", "left_anti")


def candidate_metadata(signals: DataFrame, companies: DataFrame, as_of, days: int = 30, most: int = 50) -> DataFrame:
    """(name, signal_ids, sources): the newest ``most`` signals that bring up an untracked name, and all its sources, sorted.

    Ids are ranked with a limit per input partition, so a name in a third of all signals sends few of them.
    """
    rows = untracked_names(signals, companies, as_of, days)
    newest = keyed.top_n(rows.select("name", "id", "detected_at"), ["name"], [F.desc("detected_at"), F.desc("id")], most, rank="__n")
    ids = newest.groupBy("name").agg(F.transform(F.array_sort(F.collect_list(F.struct("__n", "id"))), lambda x: x["id"]).alias("signal_ids"))
    sources = rows.select("name", F.coalesce("source", F.lit("unknown")).alias("source")).distinct().groupBy("name").agg(F.array_sort(F.collect_list("source")).alias("sources"))
    return ids.join(sources, "name")


def mention_stats(signals: DataFrame, companies: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Signals, sources, hype and last sight per name that is no tracked company.

    Counts come from partial aggregates and have no limit; scores saturate on their own.
    """
    rows = untracked_names(signals, companies, as_of, days)
    stats = rows.groupBy("name").agg(
        F.count("*").alias("signals"),
        F.count_distinct(F.coalesce("source", F.lit("unknown"))).alias("sources"),
        F.array_join(F.array_sort(F.collect_set(F.coalesce("source", F.lit("unknown")))), ",").alias("source_list"),
        F.sum("hype").alias("hype_hits"), F.max("detected_at").alias("last_seen"),
    )
    return stats


def attention_score(stats: DataFrame) -> DataFrame:
    volume = F.least(F.col("signals") / 15.0, F.lit(1.0))
    diversity = F.least(F.col("sources") / 5.0, F.lit(1.0))
    hype = F.least(F.col("hype_hits") / 6.0, F.lit(1.0))
    mix = volume * ATTENTION_MIX["volume"] + diversity * ATTENTION_MIX["diversity"] + hype * ATTENTION_MIX["hype"]
    return stats.select(
        "*", rounded(F.least(mix, F.lit(1.0)), 4).alias("score"), rounded(volume, 4).alias("signal_volume"),
        rounded(diversity, 4).alias("source_diversity"), rounded(hype, 4).alias("hype_language"),
    )


def company_candidates(stats: DataFrame) -> DataFrame:
    """Names worth a candidate row: enough attention or at least two signals."""
    scored = attention_score(stats).filter((F.col("score") >= LEAST_ATTENTION) | (F.col("signals") >= LEAST_SIGNALS))
    sources = F.col("source_list")
    return scored.select(
        "name", F.format_string("Mentioned in %d signals (%s)", "signals", sources).alias("description"),
        F.coalesce(F.nullif(sources, F.lit("")), F.lit("signals")).alias("discovery_source"), "score",
        "signal_volume", "source_diversity", "hype_language", F.lit("pending").alias("status"),
        F.col("last_seen").alias("first_seen"),
    )


def promote_candidates(candidates: DataFrame, companies: DataFrame) -> DataFrame:
    """Pending candidates above the bar as new company rows; known names and slugs are left out."""
    ready = candidates.filter((F.col("status") == "pending") & (F.col("score") >= PROMOTE_BAR))
    ready = ready.withColumn("slug", slug(F.col("name"))).filter("slug <> ''")
    fresh = ready.join(companies.select("name"), "name", "left_anti").join(companies.select("slug"), "slug", "left_anti")
    best = keyed.keep_last(fresh.select("slug", "name", "description", "score"), ["slug"], ["score", "name"])
    return best.select("name", "slug", "description", F.lit("active").alias("status"))


def last_hype(signals: DataFrame, most: int = HYPE_SIGNALS) -> DataFrame:
    """Hype hits over the newest signals of a company; the group limit runs before parsing."""
    s = signals.filter("company_id is not null").select("company_id", "id", "detected_at", "data_json")
    newest = keyed.top_n(s, ["company_id"], [F.desc("detected_at"), F.desc("id")], most)
    rows = parse_payloads(newest)
    text = F.when(F.col("strict"), payload_blob("title", "summary", "text", "description"))
    return rows.groupBy("company_id").agg(F.sum(entities.hype_hits(text)).alias("hype_hits"))


def rank_companies(companies: DataFrame, signals: DataFrame, events: DataFrame, as_of) -> DataFrame:
    """Attention score of active companies from volume, velocity, breadth, events and hype."""
    since = ago(as_of, 30)
    counts = period_counts(signals, as_of, 30)
    breadth = signals.filter(F.col("company_id").isNotNull() & (F.col("detected_at") >= since))
    breadth = breadth.groupBy("company_id").agg(F.count_distinct("source").alias("sources"))
    recent = events.filter(F.col("company_id").isNotNull() & (F.col("created_at") >= since))
    recent = recent.groupBy("company_id").agg(F.count("*").alias("events"))
    rows = companies.filter("status = 'active' or status is null").select("company_id", "name")
    for part in (counts, breadth, recent, last_hype(signals)):
        rows = rows.join(part, "company_id", "left")
    rows = rows.fillna(0, ["recent", "prior", "sources", "events", "hype_hits"])
    one = F.lit(1.0)
    growth = (F.col("recent") - F.col("prior")) / F.greatest("prior", F.lit(1))
    velocity = F.when(F.col("prior") == 0, F.least(F.col("recent") / 20.0, one)).otherwise(
        F.least(F.greatest((growth + 1) / 2, F.lit(0.0)), one)
    )
    rows = (
        rows.withColumn("volume", F.least(F.col("recent") / 25.0, one)).withColumn("velocity", velocity)
        .withColumn("diversity", F.least(F.col("sources") / 6.0, one))
        .withColumn("events_score", F.least(F.col("events") / 8.0, one))
        .withColumn("hype", F.least(F.col("hype_hits") / 8.0, one))
    )
    mix = (
        F.col("volume") * RANK_MIX["volume"] + F.col("velocity") * RANK_MIX["velocity"] + F.col("diversity") * RANK_MIX["diversity"]
        + F.col("events_score") * RANK_MIX["events"] + F.col("hype") * RANK_MIX["hype"]
    )
    return rows.select("company_id", "name", rounded(F.least(mix, one), 4).alias("score"), "recent", "prior", "sources", "events", "hype_hits")


def with_scores(companies: DataFrame, ranking: DataFrame) -> DataFrame:
    """Companies with the score they were ranked by; those not ranked keep theirs."""
    own = ranking.select("company_id", F.col("score").alias("__score"))
    rows = companies.join(own, "company_id", "left").withColumn("score", F.coalesce("__score", "score"))
    return rows.select(*companies.columns)


def handle_activity(companies: DataFrame, events: DataFrame, since) -> DataFrame:
    """Recent events per company that has a handle, busiest first."""
    counts = events.filter(F.col("company_id").isNotNull() & (F.col("created_at") >= since))
    counts = counts.groupBy("company_id").agg(F.count("*").alias("recent_events"))
    rows = companies.filter("trim(coalesce(x_handle, '')) <> ''").select("company_id", "name", "x_handle")
    out = rows.join(counts, "company_id", "left").fillna(0, ["recent_events"])
    return out.orderBy(F.desc("recent_events"), "name")


# -- twelve-factor score ----------------------------------------------------------------------

# Factor weights, investor groups, series scores, market scores, pricing words.
FACTOR_WEIGHT = {
    "funding_round_quality": 0.08, "investor_tier": 0.07, "capital_raised_runway": 0.06, "capital_efficiency": 0.09,
    "product_traction": 0.12, "revenue_monetization": 0.05, "technical_depth": 0.13, "founder_team_quality": 0.14,
    "talent_hiring_velocity": 0.07, "market_timing_tam": 0.09, "competitive_moat": 0.08, "momentum_risk": 0.12,
}
INVESTOR_GROUPS = [
    (0.9, ["a16z", "sequoia", "benchmark", "accel", "founders fund", "andreessen horowitz", "sequoia capital"]),
    (0.7, ["lightspeed", "kleiner", "greylock", "index ventures", "bessemer", "first round", "yc", "y combinator"]),
    (0.6, ["tiger global", "coatue", "dragoneer", "baillie gifford", "fidelity"]),
]
SERIES_SCORE = {
    "series e": 1.0, "series d": 0.95, "series c": 0.9, "series b": 0.75, "series a": 0.6, "seed": 0.45,
    "pre-seed": 0.35, "series s": 0.4, "angel": 0.3,
}
MARKET_SCORE = {
    "ai": 0.95, "llm": 0.95, "generative ai": 0.95, "foundation model": 0.9, "ai agents": 0.85, "ai infrastructure": 0.85,
    "ai productivity": 0.8, "developer tools": 0.75, "cybersecurity": 0.8, "fintech": 0.7, "healthcare": 0.65, "biotech": 0.7,
    "robotics": 0.75, "cloud": 0.8, "data": 0.7, "saas": 0.75,
}
PRICING_WORDS = ["pricing", "plan", "subscription", "saas", "enterprise", "pay", "premium", "pro tier"]
RELEASE_WORDS = ["launch", "released", "announced", "now available"]


def _ladder(text, scores: dict, default: float):
    out = None
    for word, value in scores.items():
        hit = text.contains(word)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(default)


def factor_inputs(companies, rounds, github, signals, events, snapshots, tech, team, details, jobs, competitors, as_of):
    """One row per active company with everything the factors read; each table is reduced to its
    company key first, then joined once."""
    at = F.col("detected_at")
    own = lambda df: df.filter("company_id is not null").groupBy("company_id")
    led = [F.coalesce(F.bool_or(contains_any(F.lower("lead_investor"), words)), F.lit(False)).alias(f"tier{i}") for i, (_, words) in enumerate(INVESTOR_GROUPS)]
    parts = [
        own(rounds).agg(
            F.max_by("round_type", F.struct("announced_date", (-F.col("id")).alias("b"))).alias("last_type"), *led,
            F.sum("amount_usd").alias("raised"), F.max("announced_date").alias("last_round"),
        ),
        github.select("company_id", "star_growth_30d", "contributor_count", "commits_last_30d"),
        own(signals).agg(
            F.count("*").alias("signals"), F.count_if(at >= ago(as_of, 30)).alias("signals_30d"),
            F.count_if(at >= ago(as_of, 7)).alias("signals_7d"),
        ),
        own(events).agg(F.count("*").alias("events"), F.count_if(F.col("created_at") >= ago(as_of, 7)).alias("events_7d")),
        own(snapshots).agg(F.count("*").alias("snapshots")),
        own(tech).agg(F.count_distinct("technology").alias("tech")),
        own(team).agg(
            F.count_if(F.col("corroboration_score") >= 0.35).alias("team"),
            *[
                F.coalesce(F.bool_or((F.col("corroboration_score") >= 0.35) & contains_any(F.lower("role"), words)), F.lit(False)).alias(n)
                for n, words in (("founder", ["founder", "ceo", "cto"]), ("exec", ["vp", "head", "director"]))
            ],
            F.count_if(F.col("joined_date") >= F.date_sub(F.lit(as_of).cast("date"), 90).cast("string")).alias("hires"),
        ),
        own(details).agg(F.max("team_size").alias("team_size")),
        own(jobs).agg(F.count_if("is_active").alias("openings")),
        own(competitors).agg(F.count("*").alias("competitors")),
        revenue_hits(signals),
    ]
    rows = companies.filter("status = 'active'").select("company_id", "name", "industry")
    for part in parts:
        rows = rows.join(part, "company_id", "left")
    return rows.withColumn("as_of", F.lit(as_of))


def revenue_hits(signals: DataFrame, most: int | None = None) -> DataFrame:
    """Pricing and release words over the payloads of a company, or its ``most`` first."""
    s = signals.filter("company_id is not null").select("company_id", "id", "data_json")
    rows = parse_payloads(s if most is None else keyed.top_n(s, ["company_id"], [F.asc("id")], most))
    text = F.when(F.col("strict"), F.lower(payload_blob("title", "description", "text")))
    price, release = contains_any(text, PRICING_WORDS), contains_any(text, RELEASE_WORDS)
    return rows.groupBy("company_id").agg(
        F.coalesce(F.bool_or(price), F.lit(False)).alias("pricing"),
        (F.count_if(price) + F.count_if(release)).alias("revenue_signals"),
    )


def factor_score(inputs: DataFrame) -> DataFrame:
    """The twelve factors and their weighted sum."""
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    cap = lambda v, most=1.0: F.least(v, F.lit(most))
    months = F.floor(F.date_diff(F.col("as_of").cast("date"), F.substring("last_round", 1, 10).try_cast("date"))) / 30
    recency = F.when(F.col("last_round").isNull(), 0.0).otherwise(F.coalesce(F.greatest(F.lit(0.0), 1.0 - months / 24), F.lit(0.5)))
    founder = (
        F.when(yes("founder") & yes("exec") & (n("team") >= 3), 0.9).when(yes("founder") & (n("team") >= 2), 0.7)
        .when(yes("founder"), 0.5).when(n("team") >= 2, 0.4).otherwise(0.2)
    )
    founder = F.when((n("team_size") != 0) & (n("team_size") > n("team")), cap(founder + 0.1)).otherwise(founder)
    moat = (
        F.when(n("tech") > 10, 0.5 + cap(n("tech") / 50, 0.3)).when(n("tech") > 3, 0.3 + cap(n("tech") / 20, 0.2)).otherwise(0.2)
    )
    moat = F.when(n("competitors") > 0, cap(moat + 0.1)).otherwise(moat)
    moat = F.when(n("star_growth_30d") > 1000, cap(moat + 0.1)).otherwise(moat)
    investor = F.lit(0.3)
    for i in range(len(INVESTOR_GROUPS) - 1, -1, -1):
        investor = F.when(yes(f"tier{i}"), INVESTOR_GROUPS[i][0]).otherwise(investor)
    factors = {
        "funding_round_quality": _ladder(F.lower(F.coalesce("last_type", F.lit(""))), SERIES_SCORE, 0.25),
        "investor_tier": investor,
        "capital_raised_runway": F.when(n("raised") > 0, cap(n("raised") / 500_000_000) * 0.6 + recency * 0.4).otherwise(0.2),
        "capital_efficiency": F.when(
            (n("star_growth_30d") > 0) & (n("contributor_count") > 0),
            cap(n("star_growth_30d") / F.greatest(n("contributor_count"), F.lit(1)) / 500),
        ).otherwise(0.2),
        "product_traction": cap(n("signals") / 50) * 0.5 + cap(n("events") / 10) * 0.3 + cap(n("snapshots") / 5) * 0.2,
        "revenue_monetization": F.when(yes("pricing"), 0.6 + cap(n("revenue_signals") / 10, 0.4)).when(
            n("revenue_signals") > 0, 0.3 + cap(n("revenue_signals") / 5, 0.3)).otherwise(0.15),
        "technical_depth": cap(n("commits_last_30d") / 200) * 0.6 + cap(n("tech") / 20) * 0.4,
        "founder_team_quality": founder,
        "talent_hiring_velocity": cap(n("openings") / 15) * 0.6 + cap(n("hires") / 5) * 0.4,
        "market_timing_tam": cap(_ladder(F.lower(F.coalesce("industry", F.lit(""))), MARKET_SCORE, 0.3) + cap(n("signals_30d") / 50, 0.2)),
        "competitive_moat": moat,
        "momentum_risk": cap(n("signals_7d") / 20) * 0.6 + cap(n("events_7d") / 5) * 0.4,
    }
    total = None
    for name, value in factors.items():
        part = value * FACTOR_WEIGHT[name]
        total = part if total is None else total + part
    return inputs.select(
        "company_id", "name", rounded(total, 4).alias("score"), *[rounded(v, 4).alias(k) for k, v in factors.items()]
    )

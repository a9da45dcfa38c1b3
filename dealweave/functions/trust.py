"""Source tier, weight and official flag of a claim."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bind, publisher_domain

# Weight of each source tier.
TIER_WEIGHT = {
    "company_official": 1.0, "regulatory": 0.95, "press_wire": 0.88, "tier1_media": 0.78,
    "industry_db": 0.72, "rss": 0.62, "social": 0.48, "unknown": 0.50,
}

# Publisher domains per tier (the second press list has its own weight).
PRESS_WIRES = ["prnewswire.com", "businesswire.com", "globenewswire.com"]
LEADING_MEDIA = [
    "techcrunch.com", "bloomberg.com", "reuters.com", "wsj.com", "ft.com", "theinformation.com",
    "venturebeat.com", "forbes.com", "cnbc.com", "axios.com", "tech.eu", "eu-startups.com",
    "geekwire.com", "betakit.com", "arcticstartup.com", "techfundingnews.com",
    "businessinsider.com", "fastcompany.com", "sifted.eu",
]
STARTUP_PRESS = [
    "finovate.com", "pehub.com", "privateequitywire.co.uk", "finsmes.com", "siliconangle.com",
    "inc.com", "entrepreneur.com", "pulse2.com", "startupdaily.net", "angellist.com",
    "producthunt.com",
]
STARTUP_PRESS_WEIGHT = 0.72
DEAL_DATABASES = ["crunchbase.com", "pitchbook.com", "dealroom.co", "cbinsights.com"]

# Sources whose tier does not depend on the link.
DIRECT_SOURCES = {
    "github_api": ("company_official", 0.8, False),
    "sec_edgar_api": ("regulatory", 0.95, True),
    "sec_edgar": ("regulatory", 0.95, True),
    "esma_mica": ("regulatory", 0.95, True),
    "ycombinator": ("industry_db", 0.75, False),
    "producthunt": ("rss", 0.7, False),
}
SOCIAL_SOURCES = ["x", "twitter"]
PLAIN_WEB_SOURCES = ["rss", "article", "website", "company_site", "blog", "hackernews"]
REGULATOR_SOURCES = ["sec", "edgar", "sec_edgar", "esma_mica"]
RUMOR_WEIGHT_CAP = 0.45

# Job boards that speak for the company.
JOB_BOARDS = [
    "greenhouse", "lever", "ashby", "workable", "recruitee", "breezy", "company_careers",
]
JOB_BOARD_WEIGHT = 0.92


def _tier(name: str, weight: float | None = None, official: bool = False) -> Column:
    return F.struct(
        F.lit(name).alias("tier"),
        F.lit(TIER_WEIGHT[name] if weight is None else weight).alias("weight"),
        F.lit(official).alias("official"),
    )


def under_domain(host: Column, domains: list[str]) -> Column:
    """Host equals or is a subdomain of one of the domains.

    Fixed short lists compile to one IN test per label depth instead of a test per domain.
    """
    hit = host.isin(domains)
    for labels in sorted({d.count(".") + 1 for d in domains}):
        hit = hit | F.substring_index(host, ".", -labels).isin(domains)
    return F.coalesce(hit, F.lit(False))


def own_domain(host: Column, website: Column) -> Column:
    home = publisher_domain(website)
    return F.coalesce((host == home) | host.endswith(F.concat(F.lit("."), home)), F.lit(False))


def source_trust(
    source: Column, url: Column, website: Column | None = None, rumor: Column | None = None
) -> Column:
    """Struct (tier, weight, official) by the first rule that applies."""
    host = publisher_domain(url)
    facts = F.struct(
        F.lower(F.trim(F.coalesce(source, F.lit("")))).alias("name"), F.lower(F.coalesce(source, F.lit(""))).alias("raw"),
        host.alias("host"), (F.lit(False) if website is None else own_domain(host, website)).alias("own"),
        (F.lit(False) if rumor is None else F.coalesce(rumor, F.lit(False))).alias("rumor"),
    )
    return bind(facts, _trust_rules)


def _trust_rules(p: Column) -> Column:
    name, host = p["name"], p["host"]
    out = F.when(
        p["rumor"] & p["raw"].isin(SOCIAL_SOURCES),
        _tier("social", min(TIER_WEIGHT["social"], RUMOR_WEIGHT_CAP)),
    ).when(p["rumor"], _tier("unknown", min(TIER_WEIGHT["unknown"], RUMOR_WEIGHT_CAP)))
    for key, (tier, weight, official) in DIRECT_SOURCES.items():
        out = out.when(name == key, _tier(tier, weight, official))
    regulator = name.isin(REGULATOR_SOURCES) | F.coalesce(
        host.contains("sec.gov") | host.contains("esma.europa.eu"), F.lit(False)
    )
    return (
        out.when(p["own"], _tier("company_official", official=True))
        .when(regulator, _tier("regulatory", official=True))
        .when(under_domain(host, PRESS_WIRES), _tier("press_wire"))
        .when(under_domain(host, LEADING_MEDIA), _tier("tier1_media"))
        .when(under_domain(host, STARTUP_PRESS), _tier("tier1_media", STARTUP_PRESS_WEIGHT))
        .when(under_domain(host, DEAL_DATABASES), _tier("industry_db"))
        .when(name.isin(SOCIAL_SOURCES), _tier("social"))
        .when(name.isin(PLAIN_WEB_SOURCES), _tier("rss"))
        .otherwise(_tier("unknown"))
    )


def job_trust(source: Column, url: Column, website: Column, board: Column) -> Column:
    """Job-board postings speak for the company; anything else goes by ``source_trust``."""
    host = publisher_domain(url)
    on_board = F.coalesce(board.isin(JOB_BOARDS), F.lit(False))
    return (
        F.when(on_board & own_domain(host, website), _tier("company_official", 1.0, True))
        .when(on_board, _tier("company_official", JOB_BOARD_WEIGHT, False))
        .otherwise(source_trust(source, url, website))
    )

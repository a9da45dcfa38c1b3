"""Company-data claims read from events and raw payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_any, filled, first_filled, strip
from ..functions.trust import source_trust
from .lookup import events_with_signal
from .signals import field, parse_payloads

# Roles, name stop words and patterns.
ROLES = (
    r"CEO|CTO|CFO|COO|CPO|CMO|Chief\s+\w+\s+Officer|President|Founder|Co-?Founder|General\s+Partner|"
    r"Managing\s+Director|Chair(?:man|woman|person)?|Board\s+member"
)
_PERSON = r"([A-Z][\w\-']+(?:\s+[A-Z][\w\-']+){0,2})"
# (pattern, name group, role group); the founder pattern carries its role implicitly.
LEADERSHIP = [
    (rf"(?i){_PERSON}\s+(?:named|appointed|joins|joined|named as)\s+(?:as\s+)?({ROLES})", 1, 2),
    (rf"(?i)({ROLES})\s+{_PERSON}", 2, 1),
    (rf"(?i){_PERSON}\s+is\s+(?:the\s+)?({ROLES})", 1, 2),
]
FOUNDER = rf"(?i){_PERSON},?\s+(?:co-?)?founder"
STOP_WORDS = [
    "the", "and", "new", "series", "round", "million", "billion", "january", "february", "march",
    "april", "may", "june", "july", "august", "september", "october", "november", "december",
    "artificial", "intelligence", "venture", "capital",
]
TEAM_EVENTS = ["hire", "hiring", "executive", "leadership", "team", "appointment"]
PRODUCT_EVENTS = ["product", "launch", "feature"]
LICENSE_EVENTS = ["regulatory", "license", "compliance", "fintech"]
PRODUCT = r"""(?i)(?:launches?|unveils?|introduces?|releases?)\s+["']?([A-Z][\w\s\-]{2,48})["']?"""
LICENSE = (
    r"(?i)(?:(?:FCA|ECB|BaFin|FINMA|OCC|state\s+charter)\b.*?(?:authorized|licensed|approved|granted|registered))"
    r"|(?:banking\s+license|payment\s+institution\s+license|e-money\s+license)"
)

# Regulators and license wording in regulatory feeds.
REGULATORS = ["FCA", "ECB", "EBA", "SEC", "ESMA", "BaFin", "FINMA", "OCC", "CFTC"]
REGULATORY_HINTS = ["fca", "sec ", "ecb", "eba", "bank of england", "finra", "cftc", "esma"]
REGULATORY_TEXT = (
    r"(?i)(?:\b(?:FCA|ECB|EBA|BaFin|FINMA|OCC|CFTC|SEC|ESMA)\b.*?"
    r"\b(?:authorized|authorised|licensed|approved|granted|registered|cleared)\b)"
    r"|\b(?:banking\s+license|payment\s+institution|e-money\s+institution|broker-dealer|money\s+transmitter)\b"
    r"|\b(?:MiCA|crypto-asset\s+service\s+provider|CASP)\b"
)


def bad_person_name(name: Column) -> Column:
    """Empty, opening with a stop word, or made of stop words only."""
    parts = F.filter(F.split(F.replace(F.lower(name), F.lit("."), F.lit(" ")), r"\s+"), lambda p: p != "")
    return (F.size(parts) == 0) | F.coalesce(F.get(parts, 0).isin(STOP_WORDS), F.lit(False))


def event_texts(events: DataFrame, signals: DataFrame) -> DataFrame:
    """Events of companies with the text of event and payload together."""
    rows = parse_payloads(events_with_signal(events.filter("company_id is not null"), signals, "data_json"))
    keys = ["title", "summary", "description", "headline", "content"]
    parts = [F.when(F.col("strict"), filled(strip(field(k)))) for k in keys]
    rows = rows.withColumn("text", F.concat_ws(" ", filled(F.col("description")), *parts))
    rows = rows.filter(F.length("text") >= 20)
    return rows.withColumn("source", F.coalesce(filled(F.lower("source")), F.lit("press")))


def _event_key(kind: str) -> Column:
    base = F.coalesce(filled(F.col("source_url")), F.col("source"))
    return F.concat(base, F.lit(f"#company-data-{kind}-"), F.col("id").cast("string"))


def with_tier(claims: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    rows = claims
    site = None
    if companies is not None:
        rows = rows.join(companies.select("company_id", "website"), "company_id")
        site = F.col("website")
    rows = rows.withColumn("__t", source_trust(F.col("source"), F.col("source_url"), site))
    return rows.select(
        *claims.columns, F.col("__t.tier").alias("source_tier"), F.col("__t.weight").alias("source_weight"),
        F.col("__t.official").alias("is_official"),
    )


def _person(rank: int):
    """Match to person row; the pattern's rank and the place in its matches give the order."""

    def build(pair, place):
        return F.struct(
            strip(pair["name"]).alias("name"), filled(F.substring(strip(pair["role"]), 1, 120)).alias("role"),
            F.lit(False).alias("is_founder"), (F.lit(rank * 1000) + place).alias("ord"),
        )

    return build


def team_claims(texts: DataFrame) -> DataFrame:
    """People with leadership roles in event text, once per event and name, first pattern first."""
    wanted = contains_any(F.lower("event_type"), TEAM_EVENTS) | F.col("text").rlike("(?i)" + ROLES)
    rows = texts.filter(wanted)
    found = []
    for rank, (pattern, name, role) in enumerate(LEADERSHIP):
        pairs = F.arrays_zip(
            F.regexp_extract_all("text", F.lit(pattern), F.lit(name)).alias("name"),
            F.regexp_extract_all("text", F.lit(pattern), F.lit(role)).alias("role"),
        )
        found.append(F.transform(pairs, _person(rank)))
    founders = F.transform(F.regexp_extract_all("text", F.lit(FOUNDER), F.lit(1)), lambda n, i: F.struct(
        strip(n).alias("name"), F.lit("Founder").alias("role"), F.lit(True).alias("is_founder"), (F.lit(9000) + i).alias("ord")))
    people = rows.withColumn("p", F.explode(F.concat(*found, founders))).filter(F.length("p.name") >= 4)
    people = people.filter(F.col("p.is_founder") | ~bad_person_name(F.col("p.name")))
    key = F.lower("p.name")
    first = people.groupBy("id", key.alias("name_normalized")).agg(
        F.min_by(F.struct("p", "company_id", "source", "source_url", "announced_date", F.substring("text", 1, 200).alias("headline")), "p.ord").alias("m")
    ).select("id", "name_normalized", "m.*")
    tag = F.when(F.col("p.is_founder"), "-founder-").otherwise("-")
    return first.select(
        "id", "company_id", F.col("p.name").alias("name"), "name_normalized", F.col("p.role").alias("role"),
        F.col("p.is_founder").alias("is_founder"), F.col("announced_date").alias("joined_date"), "source",
        F.concat(_event_key("team"), tag, F.replace(F.url_encode("p.name"), F.lit("+"), F.lit("%20"))).alias("source_url"),
        "headline", F.lit(0.6).alias("extraction_confidence"),
    )


def product_claims(texts: DataFrame) -> DataFrame:
    """Product names after launch verbs in product events."""
    rows = texts.filter((F.col("source") == "producthunt") | contains_any(F.lower("event_type"), PRODUCT_EVENTS))
    names = F.array_distinct(F.transform(
        F.regexp_extract_all("text", F.lit(PRODUCT), F.lit(1)), lambda n: F.btrim(strip(n), F.lit("\"'"))))
    rows = rows.withColumn("name", F.explode(names)).filter(F.length("name").between(3, 60))
    return rows.select(
        "id", "company_id", "name", F.lower(F.regexp_replace("name", r"\s+", " ")).alias("name_normalized"),
        F.substring("text", 1, 500).alias("description"), F.lit("product").alias("category"), F.lit("active").alias("status"),
        F.lit(None).cast("string").alias("product_url"), F.col("announced_date").alias("launch_date"), "source",
        F.concat(_event_key("product"), F.lit("-"), F.replace(F.url_encode("name"), F.lit("+"), F.lit("%20"))).alias("source_url"),
        F.lit(0.6).alias("extraction_confidence"),
    )


def license_claims(texts: DataFrame) -> DataFrame:
    """Licences reported in regulatory events."""
    rows = texts.filter(contains_any(F.lower("event_type"), LICENSE_EVENTS) & F.col("text").rlike(LICENSE))
    up = F.upper("text")
    return rows.select(
        "id", "company_id", F.when(up.contains("FCA"), "UK").when(up.contains("ECB"), "EU").otherwise("US").alias("jurisdiction"),
        F.lit("financial_services").alias("license_type"), F.lit("reported").alias("status"),
        F.when(up.contains("FCA"), "FCA").alias("regulator"), F.lit(None).cast("string").alias("license_number"),
        F.col("announced_date").alias("effective_date"), "source", _event_key("license").alias("source_url"),
        F.substring("text", 1, 400).alias("snippet"), F.lit(0.7).alias("extraction_confidence"),
    )


def regulatory_candidates(signals: DataFrame) -> DataFrame:
    tagged = F.col("data_json").contains('"category": "regulatory"') | F.col("data_json").contains('"category":"regulatory"')
    return signals.filter((F.col("source") == "sec_edgar") | tagged)


def _base_url() -> Column:
    return F.coalesce(first_filled(field("url"), field("link")), F.lower("source"))


def regulatory_claims(signals: DataFrame) -> DataFrame:
    """Filing rows from regulator bulk data, licence mentions from regulatory feeds.

    Signals carry a resolved company_id.
    """
    rows = parse_payloads(regulatory_candidates(signals).filter("company_id is not null"))
    kind = F.lower(F.coalesce(field("kind"), F.lit("")))
    filing = (F.col("source") == "sec_edgar") & (kind == "form_d_bulk")
    feed = ~filing & (
        (F.lower(F.trim(F.coalesce(field("category"), F.lit("")))) == "regulatory")
        | contains_any(F.lower("source"), REGULATORY_HINTS)
    )
    text = strip(F.concat_ws(" ", filled(field("title")), filled(field("summary"))))
    rows = rows.withColumn("__filing", filing).withColumn("text", text)
    rows = rows.filter(F.col("__filing") | (feed & (F.length("text") >= 20) & F.col("text").rlike(REGULATORY_TEXT)))
    up = F.upper("text")
    entity = strip(F.coalesce(field("entity_type"), F.lit("")))
    jurisdiction = F.when(contains_any(up, ["FCA", "UK"]), "UK").when(
        contains_any(up, ["ECB", "EBA", "ESMA", "EU", "MICA"]), "EU").otherwise("US")
    regulator = None
    for token in REGULATORS:
        regulator = F.when(up.contains(token), token) if regulator is None else regulator.when(up.contains(token), token)
    kind_of = F.when(F.col("text").rlike(r"(?i)\bMiCA\b|CASP"), "MiCA CASP").when(
        F.col("text").rlike(r"(?i)payment\s+institution"), "payment_institution").otherwise("financial_services")
    form = F.when(entity != "", F.concat(F.lit("Form D ("), F.substring(entity, 1, 40), F.lit(")"))).otherwise("Form D exemption")
    state = filled(strip(field("jurisdiction")))
    terms = F.concat_ws(
        "; ", F.concat(F.lit("Offering "), F.coalesce(filled(field("total_offering_amount")), F.lit("?"))),
        F.concat(F.lit("sold "), F.coalesce(filled(field("total_amount_sold")), F.lit("?"))),
        F.concat(F.lit("inc. "), state),
    )
    sid = F.col("id").cast("string")
    is_filing = F.col("__filing")
    return rows.select(
        "id", "company_id", F.when(is_filing, "US").otherwise(jurisdiction).alias("jurisdiction"),
        F.when(is_filing, form).otherwise(kind_of).alias("license_type"),
        F.when(is_filing, "filed").otherwise("reported").alias("status"),
        F.when(is_filing, "SEC").otherwise(regulator).alias("regulator"),
        F.when(is_filing, filled(F.substring(field("cik"), 1, 32))).alias("license_number"),
        F.lit(None).cast("string").alias("effective_date"), F.substring("source", 1, 64).alias("source"),
        F.concat(_base_url(), F.lit("#rs-"), sid, F.when(is_filing, "-form-d-license").otherwise("-reg")).alias("source_url"),
        F.substring(F.when(is_filing, terms).otherwise(F.col("text")), 1, 500).alias("snippet"),
        F.when(is_filing, 0.88).otherwise(0.75).alias("extraction_confidence"),
    )


# -- bulk payloads ----------------------------------------------------------------------------

# Profile fields per bulk kind with their payload expression, and confidences.
FORM_D_FIELDS = {
    "legal_name": "entity_name", "entity_type": "entity_type", "headquarters": "headquarters",
    "jurisdiction": "jurisdiction", "founded_year": "year_of_inc", "funding_total_offered": "total_offering_amount",
    "funding_amount_sold": "total_amount_sold",
}
YC_FIELDS = {
    "yc_batch": "batch", "yc_status": "status", "industry": "industry", "team_size": "team_size", "website_url": "website",
}

#: The sources that the bulk claims below read; of any other they make nothing.
BULK_SOURCES = ["sec_edgar", "ycombinator", "crunchbase", "producthunt", "hackernews", "esma_mica"]


def bulk_rows(signals: DataFrame) -> DataFrame:
    """Signals with a company and of a bulk source, their payload, lower-case source and kind, and base URL."""
    rows = parse_payloads(signals.filter(F.col("company_id").isNotNull() & F.lower("source").isin(BULK_SOURCES)), strict=False)
    return (
        rows.withColumn("source", F.lower("source")).withColumn("kind", F.lower(F.coalesce(field("kind"), F.lit(""))))
        .withColumn("base_url", _base_url())
    )


def bulk_profile_claims(rows: DataFrame) -> DataFrame:
    sid = F.col("id").cast("string")
    form_d, yc = F.col("kind") == "form_d_bulk", F.col("kind") == "yc_directory"

    def pairs(fields, extra=()):
        items = [F.struct(F.lit(k).alias("k"), filled(field(v)).alias("v")) for k, v in fields.items()]
        return F.array(*items, *extra)

    about = F.struct(F.lit("description_long").alias("k"), first_filled(field("long_description"), field("one_liner")).alias("v"))
    press = strip(F.coalesce(first_filled(field("description"), field("title")), F.lit("")))
    entries = (
        F.when((F.col("source") == "sec_edgar") & form_d, pairs(FORM_D_FIELDS))
        .when((F.col("source") == "ycombinator") & yc, pairs(YC_FIELDS, [about]))
        .when((F.col("source") == "crunchbase") & (F.length(press) >= 20), F.array(F.struct(F.lit("description_long").alias("k"), press.alias("v"))))
    )
    out = rows.select("id", "company_id", "source", "base_url", F.inline(entries)).filter("v is not null")
    suffix = F.when(F.col("source") == "crunchbase", F.lit("")).otherwise(F.concat(F.lit("-"), "k"))
    limit = F.when(F.col("source") == "sec_edgar", 2000).otherwise(4000)
    confidence = F.when(F.col("source") == "sec_edgar", 0.9).when(F.col("source") == "ycombinator", 0.76).otherwise(0.68)
    return out.select(
        "id", "company_id", F.col("k").alias("field_key"), F.substring(F.col("v"), F.lit(1), limit).alias("field_value"), "source",
        F.concat("base_url", F.lit("#rs-"), sid, suffix).alias("source_url"), confidence.alias("extraction_confidence"),
    )


def bulk_team_claims(rows: DataFrame) -> DataFrame:
    """Related persons of filings."""
    people = F.from_json(field("related_persons"), "array<struct<name:string,relationship:string>>")
    out = rows.filter("source = 'sec_edgar' and kind = 'form_d_bulk'")
    out = out.select("id", "company_id", "source", "base_url", F.posexplode(people).alias("i", "p"))
    out = out.withColumn("name", F.substring(strip(F.coalesce("p.name", F.lit(""))), 1, 120)).filter(F.length("name") >= 3)
    role = F.substring(F.coalesce(filled(F.col("p.relationship")), F.lit("Related person")), 1, 120)
    return out.select(
        "id", "company_id", "name", F.lower(F.regexp_replace("name", r"\s+", " ")).alias("name_normalized"), role.alias("role"),
        contains_any(F.lower(role), ["founder", "executive"]).alias("is_founder"), F.lit(None).cast("string").alias("joined_date"),
        "source", F.concat("base_url", F.lit("#rs-"), F.col("id").cast("string"), F.lit("-person-"), F.col("i").cast("string")).alias("source_url"),
        F.lit(0.85).alias("extraction_confidence"),
    )


def bulk_product_claims(rows: DataFrame) -> DataFrame:
    """Products from launch listings, the start-up directory and Show HN posts."""
    title = strip(F.coalesce(field("title"), F.lit("")))
    liner = strip(F.coalesce(field("one_liner"), F.lit("")))
    show = strip(F.replace(F.replace(title, F.lit("Show HN:"), F.lit("")), F.lit("Show HN"), F.lit("")))
    base, none = F.col("base_url"), F.lit(None).cast("string")

    def product(name, description, category, url, confidence, suffix):
        return F.struct(
            strip(F.substring(name, 1, 80)).alias("name"), F.substring(description, 1, 500).alias("description"),
            F.lit(category).alias("category"), url.alias("product_url"), F.lit(confidence).alias("extraction_confidence"), F.lit(suffix).alias("suffix"),
        )

    entry = (
        F.when((F.col("source") == "producthunt") & (F.length(title) >= 3), product(
            title, F.coalesce(field("description"), F.lit("")), "product_hunt", F.when(base.startswith("http"), base), 0.72, ""))
        .when((F.col("source") == "ycombinator") & (F.col("kind") == "yc_directory") & (F.length(liner) >= 4), product(
            F.coalesce(filled(field("name")), F.lit("Product")), liner, "yc", field("website"), 0.74, "-product"))
        .when((F.col("source") == "hackernews") & (F.col("kind") == "hn_algolia_show") & (F.length(title) >= 5), product(
            F.coalesce(filled(show), F.lit("Show HN launch")), show, "show_hn", field("url"), 0.7, ""))
    )
    out = rows.withColumn("e", entry).filter("e is not null")
    return out.select(
        "id", "company_id", "e.name", F.lower(F.regexp_replace("e.name", r"\s+", " ")).alias("name_normalized"), "e.description",
        "e.category", F.lit("active").alias("status"), "e.product_url", none.alias("launch_date"), "source",
        F.concat(base, F.lit("#rs-"), F.col("id").cast("string"), "e.suffix").alias("source_url"), "e.extraction_confidence",
    )


def bulk_license_claims(rows: DataFrame) -> DataFrame:
    """Crypto-asset register entries."""
    out = rows.filter("source = 'esma_mica' and kind = 'mica_casp'")
    get = lambda k, default, size: F.substring(F.coalesce(filled(field(k)), F.lit(default)), 1, size)
    return out.select(
        "id", "company_id", get("home_member_state", "EU", 16).alias("jurisdiction"), F.lit("MiCA CASP").alias("license_type"),
        F.lit("authorized").alias("status"), get("regulator", "ESMA MiCA", 200).alias("regulator"),
        filled(strip(field("lei"))).alias("license_number"), filled(F.substring(field("authorisation_date"), 1, 32)).alias("effective_date"),
        "source", F.concat("base_url", F.lit("#rs-"), F.col("id").cast("string")).alias("source_url"),
        get("services", "Crypto-Asset Service Provider", 500).alias("snippet"), F.lit(0.92).alias("extraction_confidence"),
    )


def profile_api_claims(profiles: DataFrame, fields: list[str], source: str, confidence: float = 0.7) -> DataFrame:
    """Wide profile rows to one claim per filled field."""
    pairs = F.array(*[F.struct(F.lit(k).alias("field_key"), F.col(k).cast("string").alias("field_value")) for k in fields])
    out = profiles.select("company_id", "source_url", F.inline(pairs)).filter("coalesce(field_value, '') <> ''")
    return out.withColumn("source", F.lit(source)).withColumn("extraction_confidence", F.lit(confidence))



"""Row-level extractors over signal text, and the SQL that reads the same fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify, deals, entities, money, text, trust
from ..operators import signals
from .registry import NOW_SQL, query

# -- SQL pieces ---------------------------------------------------------------------------------


def lit(value) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def rx(col: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({col}, {lit(pattern)}, {group}), '')"


def amount_sql(col: str) -> str:
    def scaled(pattern, unit):
        return f"cast(trunc(try_cast(replace({rx(col, pattern)}, ',', '') as double) * {unit}) as bigint)"

    plain = f"try_cast(replace({rx(col, money.PLAIN)}, ',', '') as bigint)"
    return (
        f"coalesce({scaled(money.BILLION, 1e9)}, {scaled(money.MILLION, 1e6)}, {scaled(money.THOUSAND, 1e3)},"
        f" case when {plain} >= 100000 then {plain} end)"
    )


def family_sql(col: str) -> str:
    name = f"lower(trim({col}))"
    out = "case"
    for fragment, family in classify.SOURCE_FRAGMENTS:
        out += f" when contains({name}, {lit(fragment)}){' or ' + name + ' = ' + lit('hn') if fragment == 'hacker' else ''} then {lit(family)}"
    return out + f" when {name} like 'http%' or contains({name}, 'feed') or contains({name}, 'rss') or {name} = '' then 'rss' else {name} end"


def reliability_sql(col: str) -> str:
    whens = " ".join(f"when {lit(k)} then {v}" for k, v in classify.RELIABILITY.items())
    return f"cast(case {family_sql(col)} {whens} else 0.55 end as double)"


def classify_ctes(source: str) -> dict[str, str]:
    """Named parts ending in ``classified`` over a relation with id, text, source."""
    def hits(keywords):
        tests = []
        for k in keywords:
            pattern = classify.keyword_pattern(k)
            tests.append(f"contains(low, {lit(k)})" if pattern is None else f"regexp_matches(low, {lit(pattern)})")
        return " + ".join(f"cast({x} as int)" for x in tests)

    scores = ", ".join(
        f"case when {n}_n > 0 then least(0.55e0 + 0.22e0 * {n}_n, 1e0) * rel * {spec['weight']}e0 end as {n}"
        for n, spec in classify.LABELS.items()
    )
    names = list(classify.LABELS)
    winner = " ".join(f"when {n} = best then {lit(n)}" for n in names)
    floors = " ".join(f"when {lit(n)} then {s['floor']}e0" for n, s in classify.LABELS.items())
    titles = " ".join(f"when {lit(n)} then {lit(s['title'])}" for n, s in classify.LABELS.items())
    return {
        "cl_hits": f"select *, {', '.join(f'{hits(s['keywords'])} as {n}_n' for n, s in classify.LABELS.items())} from "
                   f"(select *, lower(text) as low, {reliability_sql('source')} as rel from ({source}) z) y",
        "cl_score": f"select *, {scores} from cl_hits",
        "cl_best": f"select *, greatest({', '.join(names)}) as best, list_reverse_sort(list_filter([{', '.join(names)}], lambda v: v is not null)) as ranked,"
                   f" {amount_sql('text')} as amount_usd from cl_score",
        "cl_first": f"select *, case {winner} end as w0, case case {winner} end {floors} end as f0, greatest(0.28e0, 0.35e0 * rel) as general from cl_best",
        "cl_close": "select *, coalesce(best - ranked[2] < 0.06 and best < f0, false) as close from cl_first",
        "cl_pick": "select *, case when close then 'general' else w0 end as w1, case when close then general else best end as s1 from cl_close",
        "cl_fund": "select *, coalesce(amount_usd, 0) <> 0 and funding >= s1 * 0.65e0 as turn from cl_pick",
        "cl_last": "select *, case when turn then 'funding' else w1 end as w2, case when turn then funding else s1 end as s2 from cl_fund",
        "classified": f"select *, case when best is null or s2 < case w2 {floors} else 0.28e0 end then 'general' else w2 end as label,"
                      f" case when best is null then general when s2 < case w2 {floors} else 0.28e0 end then greatest(0.28e0, s2) else s2 end as confidence,"
                      f" case label {titles} else 'General News' end as event_type from cl_last",
    }


TITLE_TEXT = "select id, source, title || ' ' || summary as text from v_signals"


def titled(t):
    return t("v_signals").select("id", "source", F.concat_ws(" ", "title", "summary").alias("text"))


# -- queries ------------------------------------------------------------------------------------


@query("classify_events", "select id, label, event_type, round(confidence, 6) as confidence from classified",
       **classify_ctes(TITLE_TEXT))
def _(t):
    out = classify.classify(titled(t), "text", "source")
    return out.select(
        "id", "label", classify.label_title(F.col("label")).alias("event_type"), F.round("confidence", 6).alias("confidence")
    )


@query("top_company_events", """
select company_id, event_type, count(*) as events, cast(coalesce(sum(amount_usd), 0) as bigint) as amount_usd
from (select c.*, s.company_id from classified c join v_signals s on s.id = c.id) x where company_id is not null group by company_id, event_type""",
       **classify_ctes(TITLE_TEXT))
def _(t):
    s = t("v_signals").filter("company_id is not null")
    s = s.select("company_id", "source", F.concat_ws(" ", "title", "summary").alias("text"))
    out = classify.classify(s.withColumn("amount_usd", money.amount_usd(F.col("text"))), "text", "source")
    return out.groupBy("company_id", classify.label_title(F.col("label")).alias("event_type")).agg(
        F.count("*").alias("events"), F.coalesce(F.sum("amount_usd"), F.lit(0)).alias("amount_usd")
    )


@query("source_reliability", f"select distinct source, {family_sql('source')} as family, {reliability_sql('source')} as reliability from v_signals")
def _(t):
    s = t("v_signals").select("source").distinct()
    c = F.col("source")
    return s.select("source", classify.source_family(c).alias("family"), classify.reliability(c).alias("reliability"))


@query("parse_amount_usd", f"select id, {amount_sql('text')} as amount_usd from ({TITLE_TEXT}) x")
def _(t):
    return titled(t).select("id", money.amount_usd(F.col("text")).alias("amount_usd"))


ROUND_SQL = (
    "case " + " ".join(
        f"when regexp_matches(lower(text), {lit(p)}) then "
        + (f"'Series ' || upper(regexp_extract(lower(text), {lit(p)}, 1))" if "{}" in n else lit(n))
        for p, n in deals.ROUND_RULES
    ) + " when contains(lower(text), 'funding') or contains(lower(text), 'raised') then 'Funding Round' end"
)


@query("round_type", f"select id, {ROUND_SQL} as round_type from ({TITLE_TEXT}) x")
def _(t):
    return titled(t).select("id", deals.round_type(F.col("text"))["name"].alias("round_type"))


def fits(expr: str) -> str:
    return f"length({expr}) between 3 and 59"


def names_sql(expr: str) -> str:
    return f"coalesce(list_filter([trim(n) for n in string_split({expr}, ',')], lambda n: length(n) > 2), [])"


INVESTORS = {
    "inv_raw": "select id, text, "
    + ", ".join(
        f"trim(regexp_extract(text, {lit(p)}, {g})) as {n}"
        for n, p, g in [
            ("a", deals.CO_LED, 1), ("b", deals.CO_LED, 2), ("strategic", deals.STRATEGIC, 1),
            ("l1", "(?i)" + deals.LEAD_PHRASES[0] + deals.LEAD_TAIL, 1), ("l2", "(?i)" + deals.LEAD_PHRASES[1] + deals.LEAD_TAIL, 1),
            ("l3", "(?i)" + deals.LEAD_PHRASES[2] + deals.LEAD_TAIL, 1), ("again", deals.LED_AGAIN, 1),
        ]
    )
    + ", list_filter([trim(n) for n in regexp_split_to_array(regexp_extract(text, " + lit(deals.RAISED_FROM) + ", 1), ',|\\sand\\s')], lambda n: " + fits("n") + ") as backers, "
    + "list_concat(" + ", ".join(names_sql(rx("text", "(?i)" + k + deals.ROSTER_TAIL)) for k in deals.ROSTER_PHRASES)
    + f", case when {rx('text', deals.PARTICIPATING)} is null then [] else [trim({rx('text', deals.PARTICIPATING)})] end, {names_sql(rx('text', deals.PARTICIPATION))}) as roster"
    + " from (select id, text from inv_text) x",
    "inv_mid": f"select *, case when {fits('l1')} then l1 when {fits('l2')} then null when {fits('l3')} then l3 end as lead0,"
    f" case when not coalesce({fits('l1')}, false) and {fits('l2')} then list_concat([l2], roster) else roster end as co0 from inv_raw",
    "inv_lead": f"select *, coalesce(lead0, case when {fits('again')} then again end) as lead1 from inv_mid",
    "inv_end": f"select id, case when {fits('a')} and {fits('b')} then a when {fits('strategic')} then strategic"
    " when lead1 is null and len(co0) = 0 and len(backers) > 0 then backers[1] else lead1 end as lead_investor,"
    f" case when {fits('a')} and {fits('b')} then [b] when {fits('strategic')} then []"
    " when lead1 is null and len(co0) = 0 and len(backers) > 0 then list_sort(list_distinct(backers[2:]))"
    " else list_sort(list_distinct(co0)) end as co from inv_lead",
}


@query("investors", "select id, lead_investor, array_to_string(co, '|') as co_investors from inv_end", inv_text=TITLE_TEXT, **INVESTORS)
def _(t):
    out = titled(t).withColumn("w", deals.investors(F.col("text")))
    return out.select("id", F.col("w.lead").alias("lead_investor"), F.array_join("w.co", "|").alias("co_investors"))


VALUATION_SQL = "coalesce(" + ", ".join(
    f"cast(trunc(try_cast(replace({rx('text', p)}, ',', '') as double) * {u}) as bigint)" for p, u in deals.VALUATION_RULES
) + ")"


def phrase_sql(pattern: str) -> str:
    return amount_sql(f"({rx('text', pattern, 1)} || ' ' || {rx('text', pattern, 2)})")


INSTRUMENT_SQL = (
    "case when regexp_matches(lower(text), '\\bsafe\\b') then 'safe' when contains(lower(text), 'convertible') then 'convertible_note'"
    f" when regexp_matches(lower(text), {lit(deals.DEBT_WORDS)}) then 'debt' else 'equity' end"
)


@query("valuation", f"select id, {VALUATION_SQL} as valuation_usd from ({TITLE_TEXT}) x")
def _(t):
    return titled(t).select("id", deals.valuation_usd(F.col("text")).alias("valuation_usd"))


@query("deal_fields", f"""
select id, {INSTRUMENT_SQL} as instrument_type, coalesce({phrase_sql(deals.PRE_MONEY)}, {phrase_sql(deals.PRE_MONEY_AFTER)}) as pre_money,
  {phrase_sql(deals.POST_MONEY)} as post_money from ({TITLE_TEXT}) x""")
def _(t):
    out = titled(t).withColumn("d", deals.deal_terms(F.col("text")))
    return out.select("id", F.col("d.instrument").alias("instrument_type"), F.col("d.pre_money").alias("pre_money"), F.col("d.post_money").alias("post_money"))


@query("rumor_flag", """
select id, event_type = 'Rumored Round' or regexp_matches(lower(description), 'rumor|rumoured|rumored|reportedly|sources say') as is_rumor from v_events""")
def _(t):
    return t("v_events").select("id", deals.is_rumor(F.col("event_type"), F.col("description")).alias("is_rumor"))


HOST = "nullif(regexp_replace(split_part(regexp_extract(lower(trim({0})), '^(?:[a-z][a-z0-9+.-]*://)?([^/?#]*)', 1), ':', 1), '^www\\.', ''), '')"


def under_sql(host: str, domains) -> str:
    alternatives = "|".join(d.replace(".", "\\.") for d in domains)
    return f"coalesce(regexp_matches({host}, {lit('^(?:.*\\.)?(?:' + alternatives + ')$')}), false)"


def trust_sql(source: str, host: str, own: str, rumor: str) -> str:
    """Struct-free: tier '|' weight '|' official as one text."""
    def t(name, weight=None, official=False):
        return lit(f"{name}|{trust.TIER_WEIGHT[name] if weight is None else weight}|{str(official).lower()}")

    src = f"lower(trim({source}))"
    direct = " ".join(f"when {src} = {lit(k)} then {t(*v)}" for k, v in trust.DIRECT_SOURCES.items())
    return (
        f"case when {rumor} and {src} in ('x', 'twitter') then {t('social', 0.45)} when {rumor} then {t('unknown', 0.45)} {direct}"
        f" when coalesce({own}, false) then {t('company_official', None, True)}"
        f" when {src} in ('sec', 'edgar') or coalesce(contains({host}, 'sec.gov') or contains({host}, 'esma.europa.eu'), false) then {t('regulatory', None, True)}"
        f" when {under_sql(host, trust.PRESS_WIRES)} then {t('press_wire')} when {under_sql(host, trust.LEADING_MEDIA)} then {t('tier1_media')}"
        f" when {under_sql(host, trust.STARTUP_PRESS)} then {t('tier1_media', 0.72)} when {under_sql(host, trust.DEAL_DATABASES)} then {t('industry_db')}"
        f" when {src} in ('x', 'twitter') then {t('social')} when {src} in ({', '.join(map(lit, trust.PLAIN_WEB_SOURCES))}) then {t('rss')} else {t('unknown')} end"
    )


CLAIM_HOST = "select k.*, " + HOST.format("k.source_url") + " as host, c.name as company_name, replace(c.name, ' ', '') || '.io' as home from v_claims k join v_companies c on c.company_id = k.company_id"
OWN = "(host = home or ends_with(host, '.' || home))"


@query("source_trust", f"""
select id, split_part(tr, '|', 1) as source_tier, cast(split_part(tr, '|', 2) as double) as source_weight, split_part(tr, '|', 3) = 'true' as is_official
from (select id, {trust_sql('source', 'host', OWN, 'is_rumor')} as tr from hosted) x""", hosted=CLAIM_HOST)
def _(t):
    rows = t("v_claims").select("id", "company_id", "source", "source_url", "is_rumor")
    rows = rows.join(t("v_companies").select("company_id", "website"), "company_id")
    rows = rows.withColumn("x", trust.source_trust(F.col("source"), F.col("source_url"), F.col("website"), F.col("is_rumor")))
    return rows.select("id", F.col("x.tier").alias("source_tier"), F.col("x.weight").alias("source_weight"), F.col("x.official").alias("is_official"))


@query("reclassify_claim_trust", f"""
select split_part(tr, '|', 1) as source_tier, count(*) as claims, count(*) filter (where split_part(tr, '|', 1) <> source_tier) as changed
from (select source_tier, {trust_sql('source', 'host', OWN, 'is_rumor')} as tr from hosted) x group by 1""", hosted=CLAIM_HOST)
def _(t):
    from ..operators.funding import with_trust

    c = t("v_claims").withColumn("old", F.col("source_tier"))
    return with_trust(c, t("v_companies")).groupBy("source_tier").agg(
        F.count("*").alias("claims"), F.count_if(F.col("old") != F.col("source_tier")).alias("changed")
    )


def tier_sql(col):
    return f"case when regexp_matches(lower({col}), {lit('|'.join(deals.TIER_1))}) then 1 when regexp_matches(lower({col}), {lit('|'.join(deals.TIER_2))}) then 2 else 3 end"


INVESTOR_NAMES = "select distinct investor1 as name from v_base union select distinct '  ' || upper(investor2) || ' ' from v_base union select distinct vendor1 || ' Inc.' from v_base"
CLEAN = "trim(regexp_replace(trim(regexp_replace({0}, '\\s+', ' ', 'g')), " + lit(deals.FIRM_SUFFIX) + ", ''))"
SLUG = "coalesce(nullif(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'unknown')"


@query("investor_normalize", f"select name, {CLEAN.format('name')} as clean, {SLUG.format(CLEAN.format('name'))} as slug, {tier_sql('name')} as tier from ({INVESTOR_NAMES}) x")
def _(t):
    b = t("v_base")
    names = b.select(F.col("investor1").alias("name")).union(b.select(F.concat(F.lit("  "), F.upper("investor2"), F.lit(" "))))
    names = names.union(b.select(F.concat("vendor1", F.lit(" Inc.")))).distinct()
    c = F.col("name")
    return names.select("name", deals.investor_name(c).alias("clean"), deals.investor_key(c).alias("slug"), deals.investor_tier(c).alias("tier"))


ENTITY_CLEAN = "regexp_replace(trim(regexp_replace(e, '\\s+', ' ', 'g')), '^[.,;:\"''()\\[\\]]+|[.,;:\"''()\\[\\]]+$', '', 'g')"
PLAUSIBLE = "length({0}) between 2 and 80 and lower({0}) not in (" + ", ".join(map(lit, entities.STOP_NAMES)) + ") and not ({0} = upper({0}) and {0} <> lower({0}) and length({0}) > 12) and regexp_matches({0}, '[A-Za-z]')"


def entities_sql(col: str) -> str:
    found = ", ".join(f"regexp_extract_all({col}, {lit(p)}, 1)" for p in entities.HEADLINE_PATTERNS)
    return f"list_sort(list_distinct(list_filter([{ENTITY_CLEAN} for e in list_concat({found})], lambda n: {PLAUSIBLE.format('n')})))"


@query("headline_entities", f"select id, array_to_string({entities_sql('text')}, '|') as names from ({TITLE_TEXT}) x")
def _(t):
    return titled(t).select("id", F.array_join(entities.headline_entities(F.col("text")), "|").alias("names"))


def hype_sql(col: str) -> str:
    return "(" + " + ".join(f"cast(contains(lower({col}), {lit(w)}) as int)" for w in entities.HYPE_WORDS) + ")"


@query("hype_hits", f"select doc_id as id, {hype_sql('text')} as hits from documents union all select id, {hype_sql('text')} from ({TITLE_TEXT}) x")
def _(t):
    docs = t("documents").select(F.col("doc_id").alias("id"), entities.hype_hits(F.col("text")).alias("hits"))
    return docs.unionByName(titled(t).select("id", entities.hype_hits(F.col("text")).alias("hits")))


@query("plausible_company_name", f"""
select name, {PLAUSIBLE.format('name')} as plausible from (select distinct company as name from v_base union select distinct upper(vendor1 || ' HOLDINGS') from v_base
  union select distinct split_part(company, ' ', 1) from v_base union select distinct case id % 3 when 0 then 'The' when 1 then 'Show HN' else '12' end from v_base) x""")
def _(t):
    b = t("v_base")
    k = F.col("id") % 3
    names = b.select(F.col("company").alias("name")).union(b.select(F.upper(F.concat("vendor1", F.lit(" HOLDINGS")))))
    names = names.union(b.select(F.substring_index("company", " ", 1)))
    names = names.union(b.select(F.when(k == 0, "The").when(k == 1, "Show HN").otherwise("12"))).distinct()
    return names.select("name", entities.plausible_name(F.col("name")).alias("plausible"))


@query("parse_payload", "select id, title, nullif(summary, '') as summary, url, kind, source <> 'company website' or status <> 'P' as strict from v_signals")
def _(t):
    p = signals.parse_payloads(t("v_signals").select("id", "data_json"))
    return p.select("id", "payload.title", F.nullif("payload.summary", F.lit("")).alias("summary"), "payload.url", "payload.kind", "strict")


SIGNAL_TEXT = """
select id, source, base || case when url is not null and not contains(base, url) then ' ' || url else '' end as text from (
  select id, source, url, concat_ws(' ', title, nullif(summary, ''),
    case source when 'hackernews' then 'Discussion of ' || company || ' at https://news.example.org/d/' || id || ' today.'
      when 'x' then title || ' ' || coalesce(handle, '@nobody') || ' https://t.co/' || id end,
    case when source = 'ycombinator' then company end) as base from v_signals) x"""


@query("signal_text", "select id, text, substr(text, 1, 500) as description from signal_text", signal_text=SIGNAL_TEXT)
def _(t):
    s = t("v_signals").select("id", "source", "signal_type", "data_json")
    return signals.signal_text(s).select("id", "text", "description")


@query("source_url_key", """
select id, case when url is null then 'raw_signal:' || id when company_id is not null then url || '#c' || company_id || '-rs' || id else url || '#rs' || id end as source_url from v_signals""")
def _(t):
    key = signals.source_url_key(F.col("url"), F.col("id"), F.col("company_id"))
    return t("v_signals").select("id", key.alias("source_url"))


# url -> scheme://host/path[?query], lower-case host, no fragment or trailing slash
CANON = """regexp_replace(regexp_extract(url, '^([^#?]*)', 1), '/+$', '') || regexp_extract(url, '(\\?[^#]*)', 1)"""


@query("dedup_key", f"select id, {CANON} as canonical, substr(sha256({CANON}), 1, 16) as dedup_key from v_signals where url is not null")
def _(t):
    s = t("v_signals").filter("url is not null")
    return s.select("id", text.canonical_url(F.col("url")).alias("canonical"), text.url_key(F.col("url")).alias("dedup_key"))


@query("url_fanout", """
select 'fanout:' || id || ':' || substr(sha256(regexp_replace(regexp_extract(link, '^([^#?]*)', 1), '/+$', '') || regexp_extract(link, '(\\?[^#]*)', 1)), 1, 16) as signal_type,
  id as parent_raw_signal_id, regexp_replace(link, '/+$', '') as url from (
  select id, unnest(list_distinct(case source
    when 'x' then ['https://news.example.org/x/' || id]
    else [url, 'https://news.example.org/d/' || id] end)) as link from v_signals where source in ('x', 'hackernews')) u
where link is not null and not regexp_matches(link, '^https?://(www\\.)?x\\.com/')""")
def _(t):
    out = signals.url_fanout(t("v_signals").select("id", "source", "company_id", "data_json"))
    return out.select("signal_type", "parent_raw_signal_id", F.regexp_replace("url", "/+$", "").alias("url"))


@query("skip_social_host", """
select id, url is null or regexp_matches(regexp_extract(url, '//([^/?#]*)', 1), '^(.*\\.)?(x\\.com|twitter\\.com|t\\.co)$') as skipped from v_signals""")
def _(t):
    return t("v_signals").select("id", signals.skip_link(F.coalesce("url", F.lit(""))).alias("skipped"))




@query("high_signal_filter", f"""
select id, (category in ('vc', 'general_startup') and regexp_matches(lower(text), {lit('|'.join(signals.FEED_DEAL_WORDS))})) or {hype_sql('text')} > 0 as high_signal
from (select id, category, title || ' ' || summary as text from v_signals) x""")
def _(t):
    s = t("v_signals").select("id", "category", F.concat_ws(" ", "title", "summary").alias("text"))
    return s.select("id", signals.high_signal(F.col("text"), F.col("category")).alias("high_signal"))


MENTION_KEY = "substr(sha256('https://news.example.org/' || custkey), 1, 16)"


@query("signal_fan_by_mention", f"""
select id, {MENTION_KEY} || ':' || company_id || ':' || company as signal_type, company_id from (select s.id, s.custkey, s.company, c.company_id from v_signals s join v_companies c on c.name = s.company where s.source <> 'x') a
union all select id, {MENTION_KEY} || ':0:' || vendor1 as signal_type, null as company_id from v_signals where source <> 'x' and template = 3
union all select id, {MENTION_KEY} as signal_type, null as company_id from v_signals where source = 'x' and {hype_sql('title')} > 0""")
def _(t):
    names = F.when(F.col("source") == "x", F.array().cast("array<string>")).when(
        F.col("template") == 3, F.array("company", "vendor1")).otherwise(F.array("company"))
    e = t("v_signals").select(
        "id", F.concat(F.lit("https://news.example.org/"), "custkey", F.lit("#x")).alias("link"), "title", names.alias("mentions"),
        entities.has_hype(F.col("title")).alias("high_signal"),
    )
    return signals.fan_by_mention(e, t("v_companies")).select("id", "signal_type", "company_id")


@query("ingest_summary", f"""
select count(*) as entries, count(*) filter (where source <> 'x') as linked, count(*) filter (where source = 'x') as unlinked,
  count(*) filter (where source <> 'x' or {hype_sql('title')} > 0) as stored from v_signals""")
def _(t):
    names = F.when(F.col("source") == "x", F.array().cast("array<string>")).otherwise(F.array("company"))
    e = t("v_signals").select(names.alias("mentions"), entities.has_hype(F.col("title")).alias("high_signal"))
    return signals.ingest_summary(e)


@query("merge_name_lists", """
select id, company || '|' || vendor1 || case when vendor2 <> vendor1 then '|' || vendor2 else '' end as names from v_signals""")
def _(t):
    lists = F.array_distinct(F.concat(F.array("company", "vendor1"), F.array("vendor2", "company")))
    return t("v_signals").select("id", F.array_join(lists, "|").alias("names"))


@query("format_amount", """
select id, case when coalesce(amount_usd, 0) = 0 then 'Undisclosed' when amount_usd >= 1000000000 then printf('$%.1fB', amount_usd / 1e9)
  when amount_usd >= 1000000 then printf('$%.0fM', amount_usd / 1e6) when amount_usd >= 1000 then printf('$%.0fK', amount_usd / 1e3)
  else printf('$%d', amount_usd) end as label from (select id, coalesce(valuation_usd, amount_usd) as amount_usd from v_events) x""")
def _(t):
    v = F.coalesce("valuation_usd", "amount_usd")
    return t("v_events").select("id", money.amount_label(v).alias("label"))

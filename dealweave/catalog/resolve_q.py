"""Company resolution queries; the SQL compares everything with everything, the engine does not."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import resolve
from .registry import query

ALIASES = """
select alias, max_by(company_id, company_id) as company_id, max_by(name, company_id) as name, min(company_id * 10 + pos) as first_seen from (
  select company_id, name, 0 as pos, lower(name) as alias from v_companies
  union all select company_id, name, 1, slug from v_companies
  union all select company_id, name, 2, lower(replace(x_handle, '@', '')) from v_companies where x_handle is not null
  union all select company_id, name, 3, split_part(lower(name), ' ', 1) from v_companies where length(split_part(name, ' ', 1)) > 3
  union all select company_id, name, 4, split_part(lower(name), ' ', 2) from v_companies where length(split_part(name, ' ', 2)) > 3) a
group by alias"""
DOMAINS = """
select domain, company_id, name, score from (select *, row_number() over (partition by domain order by company_id, kind) rn from (
  select replace(name, ' ', '') || '.io' as domain, company_id, name, cast(0.95 as double) as score, 0 as kind from v_companies
  union all select slug || s.suffix, company_id, name, cast(0.75 as double), 1 from v_companies
    cross join (select unnest(['.com', '.io', '.ai']) as suffix) s) d) r where rn = 1"""
HOSTS = """
select id, regexp_replace(lower(regexp_extract(url, '^(?:https?://)?([^/?#:]*)', 1)), '^www\\.', '') as host
from v_signals where url is not null"""
BY_DOMAIN = """
select h.id, coalesce(x.company_id, y.company_id) as company_id, coalesce(x.name, y.name) as name, coalesce(x.score, y.score) as score
from hosts h left join domains x on x.domain = h.host
left join domains y on y.domain = regexp_extract(h.host, '([^.]+\\.[^.]+)$', 1) where x.domain is not null or y.domain is not null"""
REPOS = """
select s.id, c.company_id, c.name, cast(0.92 as double) as score from v_signals s join v_companies c
  on lower(c.github_org) = lower(regexp_extract(s.url, '(?i)github\\.com/([^/]+)', 1)) where c.github_org is not null"""


def brute_fuzzy(names: str) -> str:
    """Every name against every company; ``names`` yields a column ``name``."""
    return f"""
select n.name, coalesce(a.company_id, f.company_id) as company_id, coalesce(a.name, f.company) as company,
  case when a.alias is not null then cast(1 as double) else f.score end as score
from (select distinct name from ({names}) x where length(name) >= 2) n left join aliases a on a.alias = lower(trim(n.name))
left join (select name, max_by(company_id, rank_key) as company_id, max_by(company, rank_key) as company, max(sim) as score from (
  select q.name, c.company_id, c.name as company, greatest(
    case when regexp_matches(lower(trim(q.name)), '\\b' || regexp_escape(lower(c.name)) || '\\b')
      or regexp_matches(lower(c.name), '\\b' || regexp_escape(lower(trim(q.name))) || '\\b')
      then cast(length(c.name) as double) / greatest(length(trim(q.name)), length(c.name)) else 0 end,
    case when 1 - cast(levenshtein(lower(trim(q.name)), lower(c.name)) as double) / greatest(length(trim(q.name)), length(c.name)) > 0.75
      then 1 - cast(levenshtein(lower(trim(q.name)), lower(c.name)) as double) / greatest(length(trim(q.name)), length(c.name)) else 0 end) as sim,
    sim * 1000000 - c.company_id as rank_key
  from (select distinct name from ({names}) y where length(name) >= 2) q cross join v_companies c) p where sim > 0.6 group by name) f
  on f.name = n.name where a.alias is not null or f.name is not null"""


# Names as they come in: exact, misspelt, embedded, partial and foreign ones.
NAMES = """
select distinct case id % 6 when 0 then company when 1 then replace(company, 'e', 'a') when 2 then company || ' Inc'
  when 3 then upper(substr(company, 1, 3)) || substr(company, 4) || 's' when 4 then substr(company, 2) else vendor1 end as name from v_signals"""


def names_of(t):
    c = F.col("company")
    return t("v_signals").select(
        F.when(F.col("id") % 6 == 0, c)
        .when(F.col("id") % 6 == 1, F.replace(c, F.lit("e"), F.lit("a")))
        .when(F.col("id") % 6 == 2, F.concat(c, F.lit(" Inc")))
        .when(F.col("id") % 6 == 3, F.concat(F.upper(F.substring(c, 1, 3)), F.expr("substring(company, 4)"), F.lit("s")))
        .when(F.col("id") % 6 == 4, F.expr("substring(company, 2)"))
        .otherwise(F.col("vendor1")).alias("name")
    ).distinct()


@query("resolve_by_domain", "select id, company_id, name, score from by_domain",
       hosts=HOSTS, domains=DOMAINS, by_domain=BY_DOMAIN)
def _(t):
    return resolve.by_domain(t("v_signals").select("id", "url"), t("v_companies"))


@query("resolve_by_repo_org", REPOS)
def _(t):
    return resolve.by_repo(t("v_signals").select("id", "url"), t("v_companies"))


@query("resolve_by_alias", """
select n.name, a.company_id from (select distinct name from names) n join aliases a on a.alias = lower(trim(n.name))""",
       aliases=ALIASES, names=NAMES)
def _(t):
    from ..functions.text import strip

    index = resolve.alias_index(t("v_companies")).select("alias", "company_id")
    names = names_of(t).withColumn("alias", F.lower(strip(F.col("name"))))
    return names.join(index, "alias").select("name", "company_id")


@query("fuzzy_match_company", "select name, company_id, company, round(score, 6) as score from fuzzy",
       aliases=ALIASES, fuzzy=brute_fuzzy(NAMES))
def _(t):
    return resolve.fuzzy_match(names_of(t), t("v_companies")).withColumn("score", F.round("score", 6))


TEXTS = "select id, title || ' ' || summary || ' ' || vendor2 as text from v_signals"


@query("resolve_by_name_in_text", """
select id, company_id, name, cast(0.88 as double) as score from (select x.id, c.company_id, c.name,
  row_number() over (partition by x.id order by length(c.name) desc, c.company_id) rn
  from texts x join v_companies c on length(c.name) >= 4 and regexp_matches(lower(x.text), '\\b' || lower(c.name) || '\\b')) t where rn = 1""",
       texts=TEXTS)
def _(t):
    texts = t("v_signals").select("id", F.concat_ws(" ", "title", "summary", "vendor2").alias("text"))
    return resolve.by_name_in_text(texts, t("v_companies"))


@query("resolve_by_title_alias", """
select id, company_id, name, cast(0.9 as double) as score from (select s.id, a.company_id, a.name,
  row_number() over (partition by s.id order by length(a.alias) desc, a.first_seen) rn
  from v_signals s join aliases a on length(a.alias) >= 4 and contains(lower(s.title), a.alias)) t where rn = 1""",
       aliases=ALIASES)
def _(t):
    return resolve.by_title_alias(t("v_signals").select("id", "title"), t("v_companies"))


@query("resolve_by_handle", """
select s.id, c.company_id, c.name from v_signals s join v_companies c on c.x_handle = s.handle""")
def _(t):
    posts = t("v_signals").select(
        "id", F.concat(F.lit("seen by "), F.coalesce("handle", F.lit("nobody")), F.lit(" today")).alias("text"),
        F.lit("@desk").alias("author"),
    )
    return resolve.by_handle(posts, t("v_companies"))


@query("mentions_to_companies", """
select distinct id, mention from (select id, mention, m, lower(text) as t, instr(lower(text), m) as p from texts
  join (select distinct mention, lower(mention) as m from (select name as mention from v_companies
    union all select replace(slug, '-', ' ') from v_companies
    union all select replace(x_handle, '@', '') from v_companies where x_handle is not null) n where length(mention) >= 3) k
  on contains(lower(text), m)) h
where not regexp_matches(case when p > 1 then substr(t, p - 1, 1) else '' end, '[\\p{L}\\p{N}]')
  and not regexp_matches(substr(t, p + length(m), 1), '[\\p{L}\\p{N}]')""",
       texts="select id, title || 's or ' || company || ', ' || coalesce(handle, '') as text from v_signals")
def _(t):
    text = F.concat(
        F.col("title"), F.lit("s or "), F.col("company"), F.lit(", "), F.coalesce("handle", F.lit(""))
    )
    return resolve.mentions(t("v_signals").select("id", text.alias("text")), t("v_companies"))


@query("resolve_by_name_slug_handle", """
select name, coalesce(a, b, s, h) as company_id from (select n.name,
  (select min(company_id) from v_companies c where c.name = n.name) a,
  (select min(company_id) from v_companies c where lower(c.name) = lower(n.name)) b,
  (select min(company_id) from v_companies c where c.slug = replace(lower(n.name), ' ', '-')) s,
  (select min(company_id) from v_companies c where c.x_handle = n.name) h
  from (select distinct case id % 4 when 0 then company when 1 then upper(company) when 2 then replace(company, ' ', '-')
    else coalesce(handle, vendor1) end as name from v_signals) n) t where coalesce(a, b, s, h) is not null""")
def _(t):
    k = F.col("id") % 4
    names = t("v_signals").select(
        F.when(k == 0, F.col("company")).when(k == 1, F.upper("company"))
        .when(k == 2, F.replace("company", F.lit(" "), F.lit("-"))).otherwise(F.coalesce("handle", "vendor1")).alias("name")
    )
    return resolve.by_name_slug_handle(names, t("v_companies"))


@query("resolve_entity", """
select name, coalesce(r.company_id, f.company_id) as company_id,
  round(case when r.company_id is not null then r.confidence else least(0.99, greatest(0.5, f.score)) end, 6) as confidence,
  case when r.company_id is not null then 'alias' else 'fuzzy' end as method
from (select distinct name from names) n left join recorded r on r.alias_normalized = trim(regexp_replace(lower(n.name), '[^a-z0-9]+', ' ', 'g'))
left join fuzzy f using (name) where r.company_id is not null or f.company_id is not null""",
       aliases=ALIASES, names=NAMES, fuzzy=brute_fuzzy(NAMES),
       recorded="select company_id, name || ' inc' as alias_normalized, cast(0.97 as double) as confidence from v_companies")
def _(t):
    recorded = t("v_companies").select(
        "company_id", F.concat("name", F.lit(" inc")).alias("alias_normalized"), F.lit(0.97).alias("confidence")
    )
    out = resolve.resolve_names(names_of(t), t("v_companies"), recorded)
    return out.select("name", "company_id", F.round("confidence", 6).alias("confidence"), "method")


@query("registry_name_match", """
select name, registrant_id, title, how from (select q.name, r.registrant_id, r.title,
  case when lower(r.title) = lower(trim(q.name)) then 'exact' else 'prefix' end as how,
  row_number() over (partition by q.name order by case when lower(r.title) = lower(trim(q.name)) then 0 else 1 end, r.registrant_id) rn
  from (select distinct name from names) q join registry r on lower(r.title) = lower(trim(q.name))
    or starts_with(lower(r.title), lower(trim(q.name))) or starts_with(lower(trim(q.name)), split_part(lower(r.title), ',', 1))) t where rn = 1""",
       names=NAMES, registry="select company_id as registrant_id, name || case when company_id % 2 = 0 then ', Inc.' else '' end as title from v_companies")
def _(t):
    registry = t("v_companies").select(
        F.col("company_id").alias("registrant_id"),
        F.concat("name", F.when(F.col("company_id") % 2 == 0, ", Inc.").otherwise("")).alias("title"),
    )
    return resolve.registry_match(names_of(t), registry).select("name", "registrant_id", "title", "how")


CASCADE = """
select id, company_id, name, round(score, 6) as score, method from (select *, row_number() over (partition by id order by rank, ord) rn from (
  select r.*, 'repo' as method, 2 as rank, 0 as ord from repos r
  union all select b.*, 'domain', 3, 0 from by_domain b
  union all select s.id, f.company_id, f.company as name, f.score, 'listed', 5, 0 from v_signals s join fuzzy f on f.name = s.company
    where s.source in ('Startup Feed', 'x')
  union all select id, company_id, name, cast(0.9 as double), 'title_alias', 6, 0 from (select s.id, a.company_id, a.name,
      row_number() over (partition by s.id order by length(a.alias) desc, a.first_seen) rn
      from v_signals s join aliases a on length(a.alias) >= 4 and contains(lower(s.title), a.alias)) t where rn = 1
  union all select id, company_id, name, cast(0.88 as double), 'name_in_text', 7, 0 from (select s.id, c.company_id, c.name,
      row_number() over (partition by s.id order by length(c.name) desc, c.company_id) rn
      from v_signals s join v_companies c on regexp_matches(lower(s.title || ' ' || s.summary), '\\b' || lower(c.name) || '\\b')) t where rn = 1
  union all select s.id, f.company_id, f.company, f.score, 'fuzzy_title', 8, 0 from v_signals s join fuzzy f on f.name = s.title
    where f.score >= 0.72) u) v where rn = 1"""


CASCADE_PARTS = {
    "aliases": ALIASES, "domains": DOMAINS, "hosts": HOSTS, "by_domain": BY_DOMAIN, "repos": REPOS,
    "fuzzy": brute_fuzzy("select company as name from v_signals union all select title from v_signals"),
}


@query("resolve_company", CASCADE, **CASCADE_PARTS)
def _(t):
    from ..operators.signals import payload_hints, parse_payloads

    hints = payload_hints(parse_payloads(t("v_signals").select("id", "data_json")))
    out = resolve.resolve_company(hints, t("v_companies"))
    return out.withColumn("score", F.round("score", 6))


@query("company_identifiers", """
select id_type, id_value, min(company_id) as company_id from (
  select 'domain' as id_type, replace(name, ' ', '') || '.io' as id_value, company_id from v_companies
  union all select 'alias', slug, company_id from v_companies
  union all select 'alias', lower(replace(x_handle, '@', '')), company_id from v_companies where x_handle is not null
  union all select 'github', lower(github_org), company_id from v_companies where github_org is not null) t group by id_type, id_value""")
def _(t):
    from ..operators.repair import company_identifiers

    return company_identifiers(t("v_companies"))

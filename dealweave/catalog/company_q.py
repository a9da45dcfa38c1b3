"""Jobs and company-data queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import jobs as J
from ..functions import trust
from ..functions.numbers import EXACT_AVG_SQL
from ..operators import claims, company, jobs
from .extract_q import HOST, lit, rx, trust_sql
from .registry import query

# -- jobs ---------------------------------------------------------------------------------------


def words_sql(col: str, words) -> str:
    return "(" + " or ".join(f"contains({col}, {lit(w)})" for w in words) + ")"


def dollars(expr: str) -> str:
    value = f"try_cast(replace({expr}, ',', '') as bigint)"
    return f"case when {value} < 1000 then {value} * 1000 else {value} end"


SENIORITY_SQL = "case " + " ".join(f"when {words_sql('lower(title)', w)} then {lit(b)}" for b, w in J.SENIORITY) + " else 'mid' end"
PARSED = f"""select *, {SENIORITY_SQL} as seniority_band,
  case when regexp_matches(lower(title || ' ' || coalesce(commitment, '')), 'intern|co-op') then 'internship'
    when regexp_matches(lower(title || ' ' || coalesce(commitment, '')), 'contract|consultant|freelance') then 'contract'
    when regexp_matches(lower(title || ' ' || coalesce(commitment, '')), 'part-time|part time') then 'part_time' else 'full_time' end as employment_type,
  case when contains(place, 'remote') and regexp_matches(place, 'hybrid|onsite|on-site') then 'hybrid' when contains(place, 'remote') then 'remote'
    when regexp_matches(place, 'hybrid|flexible') then 'hybrid' when regexp_matches(place, 'onsite|on-site|in-office|in office') then 'onsite' else 'unknown' end as remote_policy,
  case when {dollars(rx('txt', J.PAY_RULES[0], 1))} is not null and {dollars(rx('txt', J.PAY_RULES[0], 2))} is not null then {dollars(rx('txt', J.PAY_RULES[0], 1))}
    when {dollars(rx('txt', J.PAY_RULES[1], 1))} is not null then {dollars(rx('txt', J.PAY_RULES[1], 1))}
    when {dollars(rx('txt', J.PAY_RULES[2], 1))} is not null then {dollars(rx('txt', J.PAY_RULES[2], 1))} else {dollars(rx('txt', J.PAY_SINGLE, 1))} end as salary_min_usd,
  case when {dollars(rx('txt', J.PAY_RULES[0], 1))} is not null and {dollars(rx('txt', J.PAY_RULES[0], 2))} is not null then {dollars(rx('txt', J.PAY_RULES[0], 2))}
    when {dollars(rx('txt', J.PAY_RULES[1], 1))} is not null then {dollars(rx('txt', J.PAY_RULES[1], 2))}
    when {dollars(rx('txt', J.PAY_RULES[2], 1))} is not null then {dollars(rx('txt', J.PAY_RULES[2], 1))} else {dollars(rx('txt', J.PAY_SINGLE, 1))} end as salary_max_usd
from (select id, company_id, website, trim(regexp_replace(title, '\\s+', ' ', 'g')) as title, description, location, coalesce(department, team) as department, coalesce(team, department) as team,
    commitment, source, ats_platform, external_id, posted_at, source_url,
    trim(regexp_replace(title, '\\s+', ' ', 'g')) || ' ' || description as txt, lower(coalesce(location, '') || ' ' || description) as place from v_jobs) j"""
JOB_COLS = ["id", "title", "department", "seniority_band", "employment_type", "remote_policy", "salary_min_usd", "salary_max_usd"]


@query("job_parse", f"select {', '.join(JOB_COLS)} from parsed", parsed=PARSED)
def _(t):
    return jobs.parse_jobs(t("v_jobs")).select(*JOB_COLS)


BOARDS = ", ".join(map(lit, trust.JOB_BOARDS))
CLAIMED = f"""select *, split_part(tr, '|', 1) as source_tier, cast(split_part(tr, '|', 2) as double) as source_weight, split_part(tr, '|', 3) = 'true' as is_official, 0.85 as extraction_confidence
from (select p.*, case when ats_platform in ({BOARDS}) then case when coalesce(ends_with(host, home), false) then 'company_official|1.0|true' else 'company_official|0.92|false' end
    else {trust_sql('source', 'host', 'ends_with(host, home)', 'false')} end as tr
  from (select p.* exclude (source_url), url as source_url, {HOST.format('url')} as host, replace(c.name, ' ', '') || '.io' as home from (select *, coalesce(nullif(source_url, ''),
      'job:' || company_id || ':' || coalesce(ats_platform, source) || ':' || coalesce(external_id, '') || ':' || title) as url from parsed) p
    join v_companies c on c.company_id = p.company_id) p) q"""


@query("job_source_trust", "select id, source_tier, source_weight, is_official from claimed", parsed=PARSED, claimed=CLAIMED)
def _(t):
    return jobs.job_claims(t("v_jobs"), t("v_companies")).select("id", "source_tier", "source_weight", "is_official")


@query("job_claims", "select id, company_id, title, source_url, source_tier, salary_min_usd from claimed", parsed=PARSED, claimed=CLAIMED)
def _(t):
    return jobs.job_claims(t("v_jobs"), t("v_companies")).select("id", "company_id", "title", "source_url", "source_tier", "salary_min_usd")


JKEY = "select *, case when external_id is not null and ats_platform is not null then company_id || ':' || ats_platform || ':' || external_id else company_id || ':' || substr(trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')), 1, 120) || ':' || substr(lower(coalesce(location, 'unknown')), 1, 40) end as cluster_key from claimed"


@query("job_cluster_key", "select id, cluster_key from jkeyed", parsed=PARSED, claimed=CLAIMED, jkeyed=JKEY)
def _(t):
    return jobs.with_cluster(jobs.job_claims(t("v_jobs"), t("v_companies"))).select("id", "cluster_key")


def best(col):
    return f"max_by({col}, source_weight * 1000000000 - id) filter (where {col} is not null and cast({col} as string) <> '') as {col}"


POSTINGS = f"""select company_id, cluster_key, {', '.join(best(c) for c in ('title', 'department', 'location', 'salary_min_usd', 'posted_at', 'ats_platform'))},
  max_by(source_url, source_weight * 1000000000 - id) as source_url, count(*) as report_count, count(*) filter (where is_official) as official_report_count,
  least(1e0, round(least(count(distinct coalesce(nullif(regexp_replace(lower(regexp_extract(source_url, '^[^/]*://([^/]*)', 1)), '^www\\.', ''), ''), lower(source))), 4) / 4e0 * 0.3e0
    + least(count(*), 5) / 5e0 * 0.2e0 + case when bool_or(is_official) then 0.25e0 else 0e0 end + max(source_weight) * 0.2e0 + 0.05e0, 3)) as corroboration_score
from jkeyed group by company_id, cluster_key"""
POSTING_COLS = ["company_id", "cluster_key", "title", "department", "location", "salary_min_usd", "posted_at", "ats_platform", "source_url", "report_count", "official_report_count", "corroboration_score"]


@query("job_postings", f"select {', '.join(POSTING_COLS)} from postings", parsed=PARSED, claimed=CLAIMED, jkeyed=JKEY, postings=POSTINGS)
def _(t):
    return jobs.job_postings(jobs.job_claims(t("v_jobs"), t("v_companies"))).select(*POSTING_COLS)


@query("job_corroboration", "select cluster_key, corroboration_score from postings", parsed=PARSED, claimed=CLAIMED, jkeyed=JKEY, postings=POSTINGS)
def _(t):
    return jobs.job_postings(jobs.job_claims(t("v_jobs"), t("v_companies"))).select("cluster_key", "corroboration_score")


SKILL_ROWS = " union all ".join(f"select {lit(s)} as skill, {lit(c)} as category" for s, c in J.SKILLS.items())


@query("job_skills", "select cluster_key, skill, category, count(*) as claims from jkeyed join skills s on contains(lower(txt), s.skill) group by cluster_key, skill, category",
       parsed=PARSED, claimed=CLAIMED, jkeyed=JKEY, skills=SKILL_ROWS)
def _(t):
    return jobs.posting_skills(jobs.job_claims(t("v_jobs"), t("v_companies"))).drop("confidence")


@query("deactivate_stale_jobs", """
select p.cluster_key, not (p.ats_platform is not null and p.company_id in (select company_id from seen) and p.source_url not in (select source_url from seen s where s.company_id = p.company_id)) as is_active from postings p""",
       parsed=PARSED, claimed=CLAIMED, jkeyed=JKEY, postings=POSTINGS, seen="select company_id, source_url from postings where department = 'Engineering'")
def _(t):
    p = jobs.job_postings(jobs.job_claims(t("v_jobs"), t("v_companies")))
    return jobs.deactivate_stale(p, p.filter("department = 'Engineering'")).select("cluster_key", "is_active")


@query("job_velocity", """
select company_id, count(*) filter (where act) as active_openings, count(*) filter (where posted_at >= '2001-06-02') as new_postings_30d,
  count(distinct department) filter (where act) as departments_hiring, count(distinct location) filter (where act) as locations_hiring
from (select *, coalesce(location, '') <> 'Berlin' as act from postings) x group by company_id having count(*) filter (where act) > 0""",
       parsed=PARSED, claimed=CLAIMED, jkeyed=JKEY, postings=POSTINGS)
def _(t):
    p = jobs.job_postings(jobs.job_claims(t("v_jobs"), t("v_companies")))
    p = p.withColumn("is_active", F.coalesce("location", F.lit("")) != "Berlin")
    return jobs.hiring_velocity(p, "2001-07-02").drop("seniority_levels")


@query("merge_job_claims", """
select coalesce(o.source_url, n.source_url) as source_url, coalesce(n.title, o.title) as title, coalesce(o.posted_at, n.posted_at) as posted_at
from (select source_url, min(title) as title, min(posted_at) as posted_at from v_jobs where source_url <> '' and department is not null group by source_url) o
full join (select source_url, upper(max(title)) as title, max(posted_at) as posted_at from v_jobs where source_url <> '' group by source_url) n on o.source_url = n.source_url""")
def _(t):
    from ..operators.keyed import merge_upsert

    j = t("v_jobs").filter("source_url <> ''")
    old = j.filter("department is not null").groupBy("source_url").agg(F.min("title").alias("title"), F.min("posted_at").alias("posted_at"))
    new = j.groupBy("source_url").agg(F.upper(F.max("title")).alias("title"), F.max("posted_at").alias("posted_at"))
    return merge_upsert(old, new, ["source_url"], jobs.JOB_POLICY_KEPT)


@query("board_slug_variants", """
select company_id, slug, row_number() over (partition by company_id order by pos) - 1 as position from (
  select company_id, slug, min(pos) as pos from (select company_id, 0 as pos, github_org as slug from v_companies where github_org is not null
    union all select company_id, 1, replace(name, ' ', '-') from v_companies union all select company_id, 2, replace(name, ' ', '') from v_companies) a group by company_id, slug) b""")
def _(t):
    return jobs.board_slugs(t("v_companies")).select("company_id", "slug", F.col("position").cast("bigint").alias("position"))


# -- company data -------------------------------------------------------------------------------

AUTH = "nullif(replace(lower(regexp_extract(source_url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)), 'www.', ''), '')"
SIMPLE = f"""round(least(1e0, 0.25e0 + least(count(distinct {AUTH}), 5) * 0.12e0 + {EXACT_AVG_SQL.format("source_weight")} * 0.35e0 + case when bool_or(is_official) then 0.08e0 else 0e0 end + least(count(*), 6) * 0.03e0), 3)"""
HEAVY = "source_weight * 1000000000 - id"


@query("simple_corroboration", f"select company_id, jurisdiction, {SIMPLE} as corroboration_score, count(*) as report_count, count(distinct {AUTH}) as unique_domains from v_licenses group by company_id, jurisdiction")
def _(t):
    return company.simple_corroboration(t("v_licenses"), ["company_id", "jurisdiction"])


@query("unique_domains", f"select company_id, count(distinct {AUTH}) as unique_domains from v_team group by company_id")
def _(t):
    return company.simple_corroboration(t("v_team"), ["company_id"]).select("company_id", "unique_domains")


@query("profile_rollup", """
select company_id, max(case when field_key = 'headquarters' then v end) as headquarters, max(case when field_key = 'team_size' then try_cast(v as bigint) end) as team_size,
  max(case when field_key = 'founded_year' then try_cast(v as bigint) end) as founded_year, max(case when field_key = 'business_model' then v end) as business_model,
  max(case when field_key = 'industry' then v end) as industry, cast(sum(n) as bigint) as reports
from (select company_id, field_key, arg_max(field_value, (source_weight, extraction_confidence, -id)) as v, count(*) as n from v_profile group by company_id, field_key) x group by company_id""")
def _(t):
    out = company.profile_rollup(t("v_profile"))
    reports = F.aggregate(F.map_values("fields_provenance"), F.lit(0).cast("bigint"), lambda a, x: a + x["report_count"])
    return out.select("company_id", "headquarters", "team_size", "founded_year", "business_model", "industry", reports.alias("reports"))


@query("team_rollup", f"""
select t.company_id, t.name_normalized, max_by(name, {HEAVY}) as name, any_value(v.role) as role, bool_or(is_founder) as is_founder, max_by(source_url, {HEAVY}) as source_url,
  {SIMPLE} as corroboration_score, count(*) as report_count
from v_team t left join (select * from (select company_id, name_normalized, role, row_number() over (partition by company_id, name_normalized order by count(*) desc, min(id)) rn
  from v_team where role is not null group by company_id, name_normalized, role) q where rn = 1) v on v.company_id = t.company_id and v.name_normalized = t.name_normalized
group by t.company_id, t.name_normalized""")
def _(t):
    return company.team_rollup(t("v_team")).select(
        "company_id", "name_normalized", "name", "role", "is_founder", "source_url", "corroboration_score", "report_count")


@query("product_rollup", f"""
select company_id, name_normalized, arg_max_null(description, {HEAVY}) as description, max_by(status, {HEAVY}) as status, {SIMPLE} as corroboration_score, count(*) as report_count
from v_products group by company_id, name_normalized""")
def _(t):
    return company.product_rollup(t("v_products")).select("company_id", "name_normalized", "description", "status", "corroboration_score", "report_count")


@query("license_rollup", f"""
select company_id, jurisdiction, license_type, max_by(status, {HEAVY}) as status, arg_max_null(license_number, {HEAVY}) as license_number, {SIMPLE} as corroboration_score, count(*) as report_count
from v_licenses group by company_id, jurisdiction, license_type""")
def _(t):
    return company.license_rollup(t("v_licenses")).drop("regulator", "effective_date")


@query("bad_person_name_filter", """
select name, split_part(lower(name), ' ', 1) in ('the', 'and', 'new', 'series', 'round', 'million', 'venture', 'capital') as bad
from (select distinct case id % 4 when 0 then 'Series ' || vendor1 when 1 then 'Ann Lee ' || (id % 50) when 2 then 'The ' || company else investor1 end as name from v_base) x""")
def _(t):
    k = F.col("id") % 4
    names = t("v_base").select(
        F.when(k == 0, F.concat(F.lit("Series "), "vendor1")).when(k == 1, F.concat(F.lit("Ann Lee "), (F.col("id") % 50).cast("string")))
        .when(k == 2, F.concat(F.lit("The "), "company")).otherwise(F.col("investor1")).alias("name")).distinct()
    return names.select("name", claims.bad_person_name(F.col("name")).alias("bad"))


TEAM_TEXTS = """select e.id, e.company_id, concat_ws(' ', nullif(e.description, ''), case when s.source = 'company website' and s.status = 'P' then null else s.title end,
  case when s.source = 'company website' and s.status = 'P' then null else nullif(s.summary, '') end) as text from v_events e join v_signals s on s.id = e.raw_signal_id where e.company_id is not null"""
TEAM_NAMES = " union all ".join(
    f"select id, company_id, trim(unnest(regexp_extract_all(text, {lit(p)}, {n}))) as name, trim(unnest(regexp_extract_all(text, {lit(p)}, {r}))) as role from team_texts where length(text) >= 20"
    for p, n, r in claims.LEADERSHIP)


@query("team_claims", "select distinct id, company_id, name, role from team_names where length(name) >= 4 and split_part(lower(name), ' ', 1) not in ("
       + ", ".join(map(lit, claims.STOP_WORDS)) + ")", team_texts=TEAM_TEXTS, team_names=TEAM_NAMES)
def _(t):
    return claims.team_claims(claims.event_texts(t("v_events"), t("v_signals"))).select("id", "company_id", "name", "role")


PRODUCT_NAMES = r"""select distinct id, company_id, trim(trim(unnest(regexp_extract_all(text, '(?i)(?:launches?|unveils?|introduces?|releases?)\s+["'']?([A-Z][\w\s\-]{2,48})["'']?', 1))), '"''') as name
  from (select t.*, e.event_type, lower(e.source) as source from team_texts t join v_events e on e.id = t.id) p
  where length(text) >= 20 and (source = 'producthunt' or regexp_matches(lower(event_type), 'product|launch|feature'))"""


@query("product_claims", r"select id, company_id, name, lower(regexp_replace(name, '\s+', ' ', 'g')) as name_normalized from product_names where length(name) between 3 and 60",
       team_texts=TEAM_TEXTS, product_names=PRODUCT_NAMES)
def _(t):
    out = claims.with_tier(claims.product_claims(claims.event_texts(t("v_events"), t("v_signals"))), t("v_companies"))
    return out.select("id", "company_id", "name", "name_normalized")


@query("license_claims", """
select e.id, e.company_id, 'UK' as jurisdiction, 'FCA' as regulator from v_events e join v_signals s on s.id = e.raw_signal_id
where e.company_id is not null and e.event_type = 'Regulatory Update' and regexp_matches(e.description || ' ' || s.title, 'FCA\\b.*?(authorized|licensed|approved|granted|registered)|payment\\s+institution\\s+license')""")
def _(t):
    return claims.license_claims(claims.event_texts(t("v_events"), t("v_signals"))).select("id", "company_id", "jurisdiction", "regulator")


LEGACY = "not (source = 'company website' and status = 'P')"


@query("bulk_source_claims", f"""
select id, company_id, field_key, field_value from (
  select id, company_id, unnest(['legal_name', 'entity_type', 'headquarters', 'jurisdiction', 'founded_year', 'funding_total_offered', 'funding_amount_sold']) as field_key,
    unnest([company || ' Inc', 'Corporation', 'Austin, TX', 'DE', cast(2000 + id % 20 as string), cast(price as string), case when id % 2 = 0 then '' else cast(price - 1 as string) end]) as field_value
  from v_signals where source = 'sec_edgar' and company_id is not null
  union all select id, company_id, unnest(['yc_batch', 'yc_status', 'industry', 'team_size', 'website_url', 'description_long']),
    unnest(['W' || (10 + id % 15), 'Active', 'B2B', cast(id % 90 as string), 'https://www.' || tight || '.io', 'Tools by ' || company]) from v_signals where source = 'ycombinator' and company_id is not null
  union all select id, company_id, 'description_long', title from v_signals where source = 'crunchbase' and company_id is not null and length(title) >= 20) x where field_value <> ''""")
def _(t):
    return claims.bulk_profile_claims(claims.bulk_rows(t("v_signals"))).select("id", "company_id", "field_key", "field_value")


@query("bulk_team_claims", """
select id, company_id, unnest(['Ann Lee ' || (id % 7), 'Cy Ray ' || (id % 3)]) as name, unnest(['Executive Officer', 'Director']) as role, unnest([true, false]) as is_founder
from v_signals where source = 'sec_edgar' and company_id is not null""")
def _(t):
    return claims.bulk_team_claims(claims.bulk_rows(t("v_signals"))).select("id", "company_id", "name", "role", "is_founder")


@query("bulk_product_claims", """
select id, company_id, case when source = 'ycombinator' then company else rtrim(substr(title, 1, 80)) end as name, case source when 'producthunt' then 'product_hunt' when 'ycombinator' then 'yc' else 'show_hn' end as category
from v_signals where company_id is not null and (source in ('producthunt', 'ycombinator') or (source = 'hackernews' and id % 2 = 1))""")
def _(t):
    return claims.bulk_product_claims(claims.bulk_rows(t("v_signals"))).select("id", "company_id", "name", "category")


@query("bulk_license_claims", """
select id, company_id, case id % 3 when 0 then 'DE' when 1 then 'FR' else 'NL' end as jurisdiction, 'LEI' || custkey as license_number, substr(cast(detected_at as string), 1, 10) as effective_date
from v_signals where source = 'esma_mica' and company_id is not null""")
def _(t):
    return claims.bulk_license_claims(claims.bulk_rows(t("v_signals"))).select("id", "company_id", "jurisdiction", "license_number", "effective_date")


@query("regulatory_claims", """
select id, company_id, case when source = 'sec_edgar' then 'US' else 'UK' end as jurisdiction, case when source = 'sec_edgar' then 'Form D (Corporation)' else 'payment_institution' end as license_type,
  case when source = 'sec_edgar' then 'SEC' else 'FCA' end as regulator,
  case when source = 'sec_edgar' then 'Offering ' || price || '; sold ' || case when id % 2 = 0 then '?' else cast(price - 1 as string) end || '; inc. DE'
    else title || case when summary = '' then '' else ' ' || summary end end as snippet
from v_signals where company_id is not null and (source = 'sec_edgar' or (category = 'regulatory' and (source <> 'company website' or status <> 'P')))""")
def _(t):
    return claims.regulatory_claims(t("v_signals")).select("id", "company_id", "jurisdiction", "license_type", "regulator", "snippet")


@query("profile_api_claims", """
select company_id, 'industry' as field_key, industry as field_value from v_companies union all select company_id, 'github_org', github_org from v_companies where github_org is not null
union all select company_id, 'description', description from v_companies""")
def _(t):
    wide = t("v_companies").withColumn("source_url", F.col("website"))
    out = claims.profile_api_claims(wide, ["industry", "github_org", "description"], "github_api")
    return out.select("company_id", "field_key", "field_value")



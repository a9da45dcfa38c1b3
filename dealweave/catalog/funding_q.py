"""Clusters, rounds, corroboration, participants, valuations and the cap table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import deals
from ..functions.numbers import EXACT_AVG_SQL
from ..operators import corroboration, funding
from .extract_q import CLEAN, HOST, INVESTORS, INSTRUMENT_SQL, SLUG, amount_sql, phrase_sql, tier_sql, trust_sql
from .registry import query

SERIES = "case when regexp_matches({0}, '(?i)series\\s*([a-f])') then 'Series ' || upper(regexp_extract({0}, '(?i)series\\s*([a-f])', 1)) else trim({0}) end"
BUCKET = "case when {0} > 0 then cast(cast(floor(log10({0}) * 10) as int) as string) else 'undisclosed' end"
KEY = "{0} || ':' || " + SERIES.format("round_type") + " || ':' || " + BUCKET.format("amount_usd") + " || ':' || coalesce(substr(announced_date, 1, 7), 'unknown')"

# Claims in order, their clusters in order of the first claim, and the greedy second pass.
CLUSTERS = {
    "keyed": f"""select *, {KEY.format('company_id')} as cluster_key,
  row_number() over (partition by company_id order by announced_date desc nulls last, source_weight desc, id) as claim_pos from v_claims""",
    "clusters": """select company_id, cluster_key, min(claim_pos) as cluster_pos, min_by(round_type, claim_pos) as first_type,
  coalesce(min(amount_usd) filter (where amount_usd > 0), 0) as low, coalesce(max(amount_usd) filter (where amount_usd > 0), 0) as high,
  count(amount_usd) filter (where amount_usd > 0) as n from keyed group by company_id, cluster_key""",
    "ordered": "select *, row_number() over (partition by company_id, first_type order by cluster_pos) as step from clusters",
    "greedy": """select company_id, first_type, step, cluster_key, cluster_key as merged_key,
    [{'key': cluster_key, 'low': low, 'high': high, 'n': n}] as buckets from ordered where step = 1
  union all
  select o.company_id, o.first_type, o.step, o.cluster_key, case when o.hit is null then o.cluster_key else o.buckets[o.hit].key end,
    case when o.hit is null then list_append(o.buckets, {'key': o.cluster_key, 'low': o.low, 'high': o.high, 'n': o.n})
      else list_transform(o.buckets, lambda b, i: case when i = o.hit then {'key': b.key,
        'low': case when b.low = 0 then o.low when o.low = 0 then b.low else least(b.low, o.low) end, 'high': greatest(b.high, o.high), 'n': b.n + o.n} else b end) end
  from (select c.*, g.buckets, list_position(list_transform(g.buckets, lambda b: b.n + c.n < 2 or
      cast(greatest(b.high, c.high) - case when b.low = 0 then c.low when c.low = 0 then b.low else least(b.low, c.low) end as double) / greatest(b.high, c.high) <= 0.18), true) as hit
    from ordered c join greedy g on g.company_id = c.company_id and g.first_type = c.first_type and c.step = g.step + 1) o""",
    "merged": """select k.*, g.merged_key, c.cluster_pos from keyed k join greedy g on g.cluster_key = k.cluster_key
  join clusters c on c.cluster_key = k.cluster_key""",
}

# Corroboration of ``claims_in(group_key, ...)`` in one statement.
CORROBORATION = {
    "co_rows": "select *, coalesce(" + HOST.format("source_url") + ", nullif(lower(trim(source)), '')) as domain, " + HOST.format("source_url") + " as host,"
    " nullif(lower(trim(regexp_replace(lead_investor, '\\s+', ' ', 'g'))), '') as lead_key,"
    " lower(" + SERIES.format("round_type") + ") as round_key,"
    " list_filter([lower(co1), lower(co2)], lambda n: n is not null) as co,"
    " substr(coalesce(announced_date, cast(extracted_at as string)), 1, 10) as day,"
    " case when amount_usd > 0 then amount_usd end as amt,"
    " list_filter([valuation_usd, post_money_valuation_usd, pre_money_valuation_usd], lambda v: v > 0) as vals from claims_in",
    "co_dom": "select group_key, count(*) as nd, " + EXACT_AVG_SQL.format("w") + " as mean_w, count(*) filter (where w >= 0.72) as trusted from (select group_key, domain, max(coalesce(source_weight, 0)) as w from co_rows where domain is not null group by all) d group by group_key",
    "co_roster": """select t.group_key, max(k) = any_value(lists) and any_value(lists) >= 2 as shared from
  (select group_key, n, count(*) as k from (select group_key, unnest(list_distinct(list_concat(case when lead_key is null then [] else [lead_key] end, co))) as n from co_rows) x group by all) t
  join (select group_key, count(*) filter (where lead_key is not null or len(co) > 0) as lists from co_rows group by group_key) l on l.group_key = t.group_key group by t.group_key""",
    "co_shared": """select t.group_key, max(k) = any_value(lists) and any_value(lists) >= 2 as shared from
  (select group_key, n, count(*) as k from (select group_key, unnest(list_distinct(co)) as n from co_rows) x group by all) t
  join (select group_key, count(*) filter (where len(co) > 0) as lists from co_rows group by group_key) l on l.group_key = t.group_key group by t.group_key""",
    "co_agg": """select group_key, count(*) as claim_count, count(distinct source_tier) as nt, coalesce(bool_or(is_official), false) as official,
  coalesce(bool_or(is_rumor), false) as rumor, count(amt) as na, min(amt) as lo, max(amt) as hi, """ + EXACT_AVG_SQL.format("extraction_confidence") + """ as ext,
  count(lead_key) as nl, count(distinct lead_key) as dl, count(round_key) as nr, count(distinct round_key) as dr,
  count(distinct day) as days, count(distinct (isoyear(cast(day as date)), weekofyear(cast(day as date)))) as weeks,
  sum(len(vals)) as nv, min(list_min(vals)) as vlo, max(list_max(vals)) as vhi,
  coalesce(bool_or(source_tier = 'regulatory' or coalesce(contains(host, 'sec.gov'), false)), false) as reg, coalesce(bool_or(github), false) as gh
from co_rows group by group_key""",
    "co_parts": """select a.*, coalesce(nd, 0) as nd, coalesce(mean_w, 0) as mean_w, coalesce(trusted, 0) as trusted, coalesce(r.shared, false) as roster, coalesce(s.shared, false) as cos,
  na < 2 or (hi - lo) / cast(hi as double) <= 0.15 as agree from co_agg a left join co_dom d using (group_key) left join co_roster r using (group_key) left join co_shared s using (group_key)""",
    "co_sum": """select *, round(sqrt(least(nd, 6) / 6e0) * 0.24e0, 3) + round(mean_w * 0.14e0, 3) + case when official then 0.1e0 else 0e0 end
  + round(case when nt >= 2 then least(nt, 4) / 4e0 when nd >= 3 and mean_w >= 0.7 then 0.75e0 else least(nt, 4) / 4e0 end * 0.06e0, 3)
  + round(least(trusted, 3) / 3e0 * 0.08e0, 3) + round(least(coalesce(ext, 0.55e0), 1e0) * 0.08e0, 3)
  + round(case when nl < 2 then 0.5e0 when dl = 1 then 1e0 else 0e0 end * 0.06e0, 3) + round(case when nr < 2 then 0.5e0 when dr = 1 then 1e0 else 0e0 end * 0.04e0, 3)
  + round(least(greatest(days - 1, 0), 3) / 3e0 * 0.06e0, 3) + round(least(greatest(weeks - 1, 0), 2) / 2e0 * 0.04e0, 3)
  + case when agree then 0.1e0 else 0e0 end
  + least(0.12e0, case when nv >= 2 and (vhi - vlo) / cast(vhi as double) <= 0.12 then 0.04e0 else 0e0 end + case when reg then 0.03e0 else 0e0 end
    + case when roster then 0.04e0 else 0e0 end + case when cos then 0.02e0 else 0e0 end + case when gh then 0.02e0 else 0e0 end)
  - case when not agree and na >= 2 then 0.12e0 else 0e0 end - case when rumor then 0.1e0 else 0e0 end - case when ext < 0.45 then 0.06e0 else 0e0 end as raw from co_parts""",
    "scored": """select group_key, case when nd >= 2 then s when official and nd = 1 then greatest(least(s, 0.55e0), 0.55e0) when official then least(s, 0.55e0) else least(s, 0.38e0) end as score,
  claim_count, nd as unique_domains, nt as unique_tiers, official as official_present, rumor as rumor_present, agree as amount_agreement, days as temporal_days, weeks as temporal_weeks
  from (select *, greatest(0e0, least(1e0, round(raw, 3))) as s from co_sum) z""",
}
GITHUB = "select distinct company_id from v_metrics where greatest(star_growth_30d, commits_last_30d, contributor_count) > 0"


def latest_github(t):
    from ..operators.lookup import latest_per_key

    cols = ["star_growth_30d", "commits_last_30d", "contributor_count"]
    return latest_per_key(t("v_metrics"), "company_id", "extracted_at", ["id", *cols], cols)


@query("claim_cluster_key", "select id, cluster_key from keyed", keyed=CLUSTERS["keyed"])
def _(t):
    key = funding.cluster_key(F.col("company_id"), F.col("round_type"), F.col("amount_usd"), F.col("announced_date"))
    return t("v_claims").select("id", key.alias("cluster_key"))


@query("cluster_merge", "select id, cluster_key, merged_key from merged", **CLUSTERS)
def _(t):
    cols = ["id", "company_id", "round_type", "amount_usd", "announced_date", "source_weight"]
    return funding.merge_clusters(t("v_claims").select(*cols)).select("id", "cluster_key", "merged_key")


@query("corroboration_score", """
select group_key as company_id, score, claim_count, unique_domains, unique_tiers, official_present, rumor_present, amount_agreement,
  temporal_days, temporal_weeks from scored""",
       claims_in=f"select *, company_id as group_key, company_id in ({GITHUB}) as github from v_claims", **CORROBORATION)
def _(t):
    out = corroboration.corroborate(t("v_claims"), "company_id", latest_github(t).filter(
        "greatest(star_growth_30d, commits_last_30d, contributor_count) > 0"))
    return out.drop("mean_domain_weight", "mean_extraction_confidence")


@query("corroboration_by_month", "select group_key as month_key, score, claim_count, unique_domains from scored",
       claims_in="select *, company_id || ':' || coalesce(substr(announced_date, 1, 7), '') as group_key, false as github from v_claims", **CORROBORATION)
def _(t):
    c = t("v_claims")
    month = F.concat_ws(":", F.col("company_id").cast("string"), F.coalesce(F.substring("announced_date", 1, 7), F.lit("")))
    out = corroboration.corroborate(c.withColumn("month_key", month), "month_key")
    return out.select("month_key", "score", "claim_count", "unique_domains")


@query("confidence_tier", """
select id, case when c >= 0.75 then 'strong' when c >= 0.45 then 'building' else 'early_signal' end as tier from (select id, extraction_confidence as c from v_claims) x""")
def _(t):
    return t("v_claims").select("id", corroboration.confidence_tier(F.col("extraction_confidence")).alias("tier"))


ROUNDS = {
    **CLUSTERS,
    "github_active": """select company_id from (select *, row_number() over (partition by company_id
  order by extracted_at desc, id desc, star_growth_30d desc, commits_last_30d desc, contributor_count desc) rn from v_metrics) t
  where rn = 1 and greatest(star_growth_30d, commits_last_30d, contributor_count) > 0""",
    "claims_in": "select *, merged_key as group_key, company_id in (select company_id from github_active) as github from merged",
    **CORROBORATION,
    "ranked": """select *, row_number() over (partition by merged_key order by source_weight desc, coalesce(extraction_confidence, 0) desc, cluster_pos, claim_pos) as r1,
  row_number() over (partition by merged_key order by source_weight desc, cluster_pos, claim_pos) as r2 from merged""",
    "round_rows": f"""select m.merged_key, m.company_id, m.round_type, m.amount_usd, m.valuation_usd, m.lead_investor, m.co_investors, m.announced_date,
  m.instrument_type, m.pre_money_valuation_usd, m.post_money_valuation_usd, coalesce(m.currency, 'USD') as currency, b.source, b.source_url, b.source_tier as source_tier_best,
  x.report_count, x.official_report_count, s.score as corroboration_score, s.unique_domains, {KEY.format('m.company_id').replace('round_type', 'm.round_type').replace('amount_usd', 'm.amount_usd').replace('announced_date', 'm.announced_date')} as cluster_key, x.pos
  from ranked m join ranked b on b.merged_key = m.merged_key and b.r2 = 1
  join (select merged_key, count(*) as report_count, count(*) filter (where is_official) as official_report_count, min(cluster_pos) as pos from merged group by merged_key) x on x.merged_key = m.merged_key
  join scored s on s.group_key = m.merged_key where m.r1 = 1""",
    "rounds": "select * from (select *, row_number() over (partition by cluster_key order by pos desc) rn from round_rows) q where rn = 1",
}
ROUND_COLS = (
    "cluster_key, company_id, round_type, amount_usd, valuation_usd, lead_investor, co_investors, announced_date, instrument_type, "
    "pre_money_valuation_usd, post_money_valuation_usd, currency, source, source_url, source_tier_best, report_count, official_report_count, "
    "corroboration_score, unique_domains"
)


def rounds_of(t):
    clustered = funding.merge_clusters(t("v_claims"))
    return clustered, funding.funding_rounds(clustered, latest_github(t))


@query("funding_rounds", f"select {ROUND_COLS} from rounds", **ROUNDS)
def _(t):
    return rounds_of(t)[1].select(*[c.strip() for c in ROUND_COLS.split(",")])


_FIELDS = funding.ROUND_FIELDS
PROVENANCE = f"""
select merged_key, field, v.value, v.source_tier, coalesce(u.reports, 0) as reports, u.urls as reporting_sources from (
  {" union all ".join(f"select merged_key, '{f}' as field, cast({f} as string) as value, source_tier from ranked where r1 = 1" for f in _FIELDS)}) v
left join (select merged_key, field, count(*) as reports, array_to_string(list(source_url order by cluster_pos, claim_pos)[1:10], ' ') as urls from (
  {" union all ".join(f"select merged_key, '{f}' as field, source_url, cluster_pos, claim_pos from merged where coalesce(cast({f} as string), '') <> ''" for f in _FIELDS)}) w
  group by merged_key, field) u using (merged_key, field) where v.value is not null"""
CLUSTERED = {k: v for k, v in ROUNDS.items() if k in (*CLUSTERS, "ranked")}


@query("field_provenance", PROVENANCE, **CLUSTERED)
def _(t):
    out = funding.field_provenance(funding.merge_clusters(t("v_claims")))
    return out.withColumn("reporting_sources", F.array_join("reporting_sources", " "))


@query("investor_provenance", """
select merged_key, investor, array_to_string(list_sort(list(distinct role)), ' ') as roles, count(distinct source_url) as reports,
  array_to_string(list_sort(list(distinct tier_first)), ' ') as source_tiers, array_to_string(list_distinct_in_order[1:10], ' ') as reporting_sources
from (select *, list(source_url order by cluster_pos, claim_pos) filter (where k = 1) over (partition by merged_key, investor) as list_distinct_in_order from (
  select *, first_value(source_tier) over w as tier_first, row_number() over w as k from (
    select merged_key, trim(lead_investor) as investor, 'lead' as role, source_url, source_tier, cluster_pos, claim_pos from merged where trim(lead_investor) <> ''
    union all select merged_key, trim(co1), 'participant', source_url, source_tier, cluster_pos, claim_pos from merged where co1 is not null
    union all select merged_key, trim(co2), 'participant', source_url, source_tier, cluster_pos, claim_pos from merged where co2 is not null) n
  window w as (partition by merged_key, investor, source_url order by cluster_pos, claim_pos)) r) q
group by merged_key, investor, list_distinct_in_order""", **CLUSTERED)
def _(t):
    out = funding.investor_provenance(funding.merge_clusters(t("v_claims")))
    return out.select("merged_key", "investor", "reports", *[F.array_join(c, " ").alias(c) for c in ("roles", "source_tiers", "reporting_sources")])


PEOPLE = """select id as claim_id, 0 as position, lead_investor as name, 'lead' as role, true as is_lead from v_claims where lead_investor is not null
union all select id, position, name, 'participant', false from (select id, lead_investor, 1 as position, co1 as name from v_claims union all select id, lead_investor, 2, co2 from v_claims) c
where name is not null and (lead_investor is null or lower(""" + CLEAN.format("name") + ") <> lower(" + CLEAN.format("lead_investor") + "))"
PARTS = f"select *, {CLEAN.format('name')} as clean, {SLUG.format(CLEAN.format('name'))} as investor_key from people"


@query("claim_participants", "select claim_id, name, role, is_lead, investor_key from parts", people=PEOPLE, parts=PARTS)
def _(t):
    return funding.claim_participants(t("v_claims")).select("claim_id", "name", "role", "is_lead", "investor_key")


FIRMS = f"select investor_key, min_by(clean, claim_id * 10 + position) as name, min({tier_sql('clean')}) as tier from parts group by investor_key"


@query("investor_tier", "select investor_key, name, tier from firms", people=PEOPLE, parts=PARTS, firms=FIRMS)
def _(t):
    return funding.investor_firms(funding.claim_participants(t("v_claims")))


@query("claim_participants_join", """
select p.claim_id, p.investor_key, c.source_url, c.source_tier, c.is_official, c.source_weight from parts p join v_claims c on c.id = p.claim_id""",
       people=PEOPLE, parts=PARTS)
def _(t):
    out = funding.participants_with_claims(funding.claim_participants(t("v_claims")), t("v_claims"))
    return out.select("claim_id", "investor_key", "source_url", "source_tier", "is_official", "source_weight")


RPS = f"""select k.cluster_key as round_id, p.investor_key, bool_or(p.is_lead) as is_lead, count(distinct p.claim_id) as report_count,
  count(distinct {HOST.format('k.source_url')}) as source_domain_count, bool_or(k.is_official) as has_official_source
  from parts p join keyed k on k.id = p.claim_id group by 1, 2"""
RP_SCORE = """least(1e0, round(0.25e0 * least(source_domain_count, 4) / 4 + 0.2e0 * least(report_count, 5) / 5 + case when has_official_source then 0.25e0 else 0e0 end + 0.15e0, 3))"""


def links_of(t):
    """Claims linked to rounds by their first-pass cluster, which SQL can state briefly."""
    c = t("v_claims")
    key = funding.cluster_key(F.col("company_id"), F.col("round_type"), F.col("amount_usd"), F.col("announced_date"))
    return c.select(F.col("id").alias("claim_id"), key.alias("round_id"))


@query("round_participants", f"""
select round_id, investor_key, case when is_lead then 'lead' else 'participant' end as role, is_lead, report_count, source_domain_count,
  has_official_source, {RP_SCORE} as corroboration_score from rps""", people=PEOPLE, parts=PARTS, keyed=CLUSTERS["keyed"], rps=RPS)
def _(t):
    return funding.round_participants(funding.claim_participants(t("v_claims")), t("v_claims"), links_of(t))


@query("participant_attributions", """
select k.cluster_key as round_id, p.investor_key, p.claim_id, min_by(p.role, p.position) as role, any_value(k.source_url) as source_url,
  any_value(k.source_tier) as source_tier, any_value(k.is_official) as is_official from parts p join keyed k on k.id = p.claim_id group by 1, 2, 3""",
       people=PEOPLE, parts=PARTS, keyed=CLUSTERS["keyed"])
def _(t):
    return funding.participant_attributions(funding.claim_participants(t("v_claims")), t("v_claims"), links_of(t))


CAP_ROUNDS = "select id, company_id, announced_date from v_claims"


@query("cap_table_holdings", f"""
select c.company_id, f.name as holder_name, trim(regexp_replace(lower(f.name), '[^a-z0-9]+', ' ', 'g')) as holder_normalized, case when r.is_lead then 'lead' else r.role end as share_class,
  c.announced_date as as_of_date, 'funding_round:' || c.id || ':investor:' || r.investor_key as source_url, r.corroboration_score as confidence
from (select claim_id as id, investor_key, is_lead, role, cast(0.5 as double) as corroboration_score from parts) r join v_claims c on c.id = r.id join firms f using (investor_key)""",
       people=PEOPLE, parts=PARTS, firms=FIRMS)
def _(t):
    people = funding.claim_participants(t("v_claims"))
    held = people.select(F.col("claim_id").alias("round_id"), "investor_key", "is_lead", "role", F.lit(0.5).alias("corroboration_score"))
    out = funding.cap_table(t("v_claims"), held, funding.investor_firms(people))
    return out.drop("ownership_pct", "source")


VAL_ROUNDS = "select id, company_id, round_type, case when template = 7 or source = 'x' then null else amount_usd end as amount_usd, case when source = 'TechCrunch' then valuation_usd end as valuation_usd, case when source = 'hackernews' then post_money_valuation_usd end as post_money_valuation_usd, cast(null as bigint) as pre_money_valuation_usd, announced_date, extraction_confidence as corroboration_score from (select c.*, s.template from v_claims c join v_signals s on s.id = c.id) j"


@query("company_valuation", """
select company_id, valuation_usd, valuation_kind, method, round(confidence, 3) as confidence, as_of_date, source_round_id from (
  select c.company_id, coalesce(reported, implied, e.valuation_usd, case when total > 0 then greatest(cast(trunc(total * 1.6e0) as bigint), 3000000) end) as valuation_usd,
    case when reported is not null then 'reported' when implied is not null then 'estimated' when e.valuation_usd is not null then 'reported' when total > 0 then 'estimated' end as valuation_kind,
    case when reported is not null then case when coalesce(post_money_valuation_usd, 0) <> 0 then 'reported_post_money' else 'reported_round_valuation' end
      when implied is not null then 'inferred_from_latest_round' when e.valuation_usd is not null then 'reported_intel_event' when total > 0 then 'inferred_from_total_raised' end as method,
    case when reported is not null then least(0.85e0, 0.45e0 + coalesce(r.corroboration_score, 0) * 0.45e0) when implied is not null then least(0.55e0, 0.32e0 + coalesce(r.corroboration_score, 0) * 0.25e0)
      when e.valuation_usd is not null then least(0.75e0, e.confidence) else 0.35e0 end as confidence,
    case when coalesce(reported, implied) is not null then r.announced_date when e.valuation_usd is not null then e.announced_date else last_day end as as_of_date,
    case when coalesce(reported, implied) is not null then r.id end as source_round_id
  from v_companies c
  left join (select *, coalesce(case when post_money_valuation_usd > 0 then post_money_valuation_usd end, case when valuation_usd > 0 then valuation_usd end) as reported,
      case when amount_usd > 0 then greatest(cast(trunc(amount_usd * case lower(""" + SERIES.format("round_type") + """) when 'pre-seed' then 10e0 when 'seed' then 6e0 when 'series a' then 5e0 when 'series b' then 3.5e0
        when 'series c' then 2.8e0 when 'growth' then 2e0 else 5e0 end) as bigint), 3000000) end as implied
    from (select *, row_number() over (partition by company_id order by case when post_money_valuation_usd > 0 then 0 else 1 end, case when valuation_usd > 0 then 0 else 1 end,
      corroboration_score desc nulls last, announced_date desc nulls last, id) rn from val_rounds) z where rn = 1) r on r.company_id = c.company_id
  left join (select company_id, sum(amount_usd) as total, max(announced_date) as last_day from val_rounds where amount_usd > 0 group by company_id) m on m.company_id = c.company_id
  left join (select * from (select *, row_number() over (partition by company_id order by announced_date desc, confidence desc, id desc) rn from v_events where valuation_usd > 0 and company_id is not null) y where rn = 1) e on e.company_id = c.company_id) q
where valuation_usd is not null""", val_rounds=VAL_ROUNDS)
def _(t):
    c = t("v_claims").join(t("v_signals").select("id", "template"), "id")
    rounds = c.select(
        "id", "company_id", "round_type", F.expr("case when template = 7 or source = 'x' then null else amount_usd end").alias("amount_usd"),
        F.expr("case when source = 'TechCrunch' then valuation_usd end").alias("valuation_usd"),
        F.expr("case when source = 'hackernews' then post_money_valuation_usd end").alias("post_money_valuation_usd"),
        F.lit(None).cast("bigint").alias("pre_money_valuation_usd"), "announced_date", F.col("extraction_confidence").alias("corroboration_score"),
    )
    return funding.company_valuation(t("v_companies"), rounds, t("v_events"))


@query("merge_replace_or_delete", """
select company_id, cast(sum(amount_usd) as bigint) as valuation_usd from v_claims where company_id in (select company_id from v_companies where status = 'active') group by company_id having sum(amount_usd) is not null""")
def _(t):
    from ..operators.keyed import replace_or_drop

    fresh = t("v_claims").groupBy("company_id").agg(F.sum("amount_usd").alias("valuation_usd")).filter("valuation_usd is not null")
    return replace_or_drop(fresh, t("v_companies").filter("status = 'active'"), "company_id")


@query("company_funding_history", """
select company_id, id, round_type, amount_usd, announced_date from (select *, row_number() over (partition by company_id order by announced_date desc nulls last, id desc) rn from v_claims) x where rn <= 5""")
def _(t):
    from ..operators.brief import funding_history

    return funding_history(t("v_claims"), 5).select("company_id", "id", "round_type", "amount_usd", "announced_date")


@query("sync_event_confidence", """
select e.id, coalesce(b.s, e.confidence) as confidence from v_events e left join (select k.intelligence_event_id as id, max(r.s) as s from keyed k
  join (select cluster_key, cast(count(*) as double) / 100 as s from keyed group by cluster_key) r using (cluster_key)
  where intelligence_event_id is not null group by 1) b on b.id = e.id""", keyed=CLUSTERS["keyed"])
def _(t):
    links = links_of(t)
    rounds = links.groupBy(F.col("round_id").alias("merged_key")).agg((F.count("*").cast("double") / 100).alias("corroboration_score"))
    return funding.sync_event_confidence(t("v_events"), t("v_claims"), links, rounds).select("id", "confidence")


EVENT_CLUSTERS = "select *, company_id || ':' || event_type || ':' || " + BUCKET.format("amount_usd") + """ || ':' || substr(announced_date, 1, 7) as group_key,
  split_part(tr, '|', 1) as source_tier, cast(split_part(tr, '|', 2) as double) as source_weight, split_part(tr, '|', 3) = 'true' as is_official from (
  select e.*, """ + trust_sql("e.source", "host", "(host = home or ends_with(host, '.' || home))", "false") + """ as tr from (
    select e.id, e.company_id, e.event_type, e.amount_usd, e.announced_date, e.source, e.source_url, """ + HOST.format("e.source_url") + """ as host, replace(c.name, ' ', '') || '.io' as home
    from v_events e join v_companies c on c.company_id = e.company_id where e.event_type in (""" + ", ".join(f"'{n}'" for n in deals.FUNDING_TYPES) + """)
    and e.id not in (select intelligence_event_id from v_claims where intelligence_event_id is not null)) e) x"""


@query("event_cluster_confidence", "select c.id, s.score as confidence from event_rows c join scored s on s.group_key = c.group_key",
       event_rows=EVENT_CLUSTERS, claims_in="""select group_key, source, source_url, source_tier, source_weight, is_official, amount_usd, false as is_rumor, cast(null as double) as extraction_confidence,
  cast(null as string) as lead_investor, cast(null as string) as round_type, cast(null as string) as co1, cast(null as string) as co2, cast(null as string) as announced_date,
  cast(null as timestamp) as extracted_at, cast(null as bigint) as valuation_usd, cast(null as bigint) as post_money_valuation_usd, cast(null as bigint) as pre_money_valuation_usd, false as github from event_rows""",
       **CORROBORATION)
def _(t):
    return funding.event_cluster_confidence(t("v_events"), t("v_claims"), t("v_companies"))


@query("backfill_participants", """
select c.id, coalesce(i.lead_investor, c.lead_investor) as lead_investor from v_claims c join inv_end i on i.id = c.id""",
       inv_text="select id, trim(coalesce(headline, '') || ' ' || coalesce(snippet, '')) as text from v_claims", **INVESTORS)
def _(t):
    return funding.backfill_participants(t("v_claims")).select("id", "lead_investor")


@query("backfill_deal_fields", f"""
select id, {INSTRUMENT_SQL} as instrument_type, coalesce({phrase_sql(deals.PRE_MONEY)}, {phrase_sql(deals.PRE_MONEY_AFTER)}, pre_money_valuation_usd) as pre_money_valuation_usd,
  coalesce({phrase_sql(deals.POST_MONEY)}, post_money_valuation_usd) as post_money_valuation_usd
from (select *, trim(coalesce(headline, '') || ' ' || coalesce(snippet, '')) as text from v_claims) x""")
def _(t):
    return funding.backfill_terms(t("v_claims")).select("id", "instrument_type", "pre_money_valuation_usd", "post_money_valuation_usd")


FROM_EVENTS = "select e.id, e.company_id, e.source_url, e.announced_date, e.event_type, e.amount_usd as event_amount, e.valuation_usd as event_val, s.source, e.description || ' ' || case when s.source = 'company website' and s.status = 'P' then s.data_json else s.title || ' ' || s.summary end as text from v_events e join v_signals s on s.id = e.raw_signal_id where e.company_id is not null and e.event_type in (" + ", ".join(f"'{n}'" for n in deals.FUNDING_TYPES) + ")"


@query("funding_claims", f"""
select f.id as intelligence_event_id, f.company_id, coalesce(nullif(f.event_amount, 0), {amount_sql('f.text')}) as amount_usd, i.lead_investor, nullif(array_to_string(i.co, '|'), '') as co_investors
from inv_text f join inv_end i on i.id = f.id
where coalesce(nullif(f.event_amount, 0), {amount_sql('f.text')}, 0) <> 0 or i.lead_investor is not null or regexp_matches(f.text, '(?i)valuation\\s*(?:of|at)?\\s*\\$?\\s*[\\d,.]+\\s*(billion|b|million|m)')""",
       inv_text=FROM_EVENTS, **INVESTORS)
def _(t):
    out = funding.event_claims(t("v_events"), t("v_signals"))
    co = F.array_join(F.from_json("co_investors", "array<string>"), "|")
    return out.select("intelligence_event_id", "company_id", "amount_usd", "lead_investor", co.alias("co_investors"))


@query("union_claim_sources")
def _(t):
    parts = [funding.event_claims(t("v_events"), t("v_signals")), funding.signal_claims(t("v_signals"))]
    return funding.union_claims(parts, t("v_companies")).select(
        "source_url", "company_id", "round_type", "amount_usd", "lead_investor", "source_tier", "source_weight", "is_official"
    )

"""Dedup, merge and keep-n queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import keyed, lookup
from .registry import NOW_SQL, query

SIGNAL = "id, source, signal_type, title"


@query("dedup_keep_first", f"""
select {SIGNAL} from (select *, row_number() over (partition by source, signal_type order by detected_at, id) rn
  from v_signals) t where rn = 1""")
def _(t):
    s = t("v_signals").select("id", "source", "signal_type", "title", "detected_at")
    return keyed.keep_first(s, ["source", "signal_type"], ["detected_at", "id"]).drop("detected_at")


@query("dedup_keep_last", f"""
select {SIGNAL} from v_signals where id in (select max(id) from v_signals group by source, signal_type)""")
def _(t):
    s = t("v_signals").select("id", "source", "signal_type", "title")
    return keyed.keep_last(s, ["source", "signal_type"], ["id"])


@query("dedup_events_by_signal", """
select id, raw_signal_id, event_type from v_events
where id in (select max(id) from v_events group by raw_signal_id)""")
def _(t):
    e = t("v_events").select("id", "raw_signal_id", "event_type")
    return keyed.keep_last(e, ["raw_signal_id"], ["id"])


@query("duplicate_groups", """
select count(*) as duplicate_groups, cast(coalesce(sum(n - 1), 0) as bigint) as rows_to_delete
from (select count(*) n from v_signals group by source, signal_type having count(*) > 1) t""")
def _(t):
    return keyed.duplicate_groups(t("v_signals"), ["source", "signal_type"])


@query("last_n_per_key", """
select company_id, id from (select company_id, id, row_number() over (partition by company_id
  order by detected_at desc, id desc) rn from v_signals where company_id is not null) t where rn <= 40""")
def _(t):
    s = t("v_signals").filter("company_id is not null").select("company_id", "id", "detected_at")
    order = [F.desc("detected_at"), F.desc("id")]
    return keyed.top_n(s, ["company_id"], order, 40).drop("detected_at")


@query("first_n_per_key", """
select source, id, rn as position from (select source, id, row_number() over (partition by source
  order by detected_at, id) rn from v_signals) t where rn <= 25""")
def _(t):
    s = t("v_signals").select("source", "id", "detected_at")
    out = keyed.top_n(s, ["source"], [F.asc("detected_at"), F.asc("id")], 25, rank="position")
    return out.drop("detected_at").withColumn("position", F.col("position").cast("bigint"))


@query("best_claim", """
select company_id, id, source_url, source_tier from (select *, row_number() over (partition by company_id
  order by source_weight desc, coalesce(extraction_confidence, 0) desc, id) rn from v_claims) t where rn = 1""")
def _(t):
    c = t("v_claims").select("company_id", "id", "source_url", "source_tier", "source_weight", "extraction_confidence")
    c = c.withColumn("__conf", F.coalesce("extraction_confidence", F.lit(0.0))).withColumn("__back", -F.col("id"))
    out = keyed.keep_last(c, ["company_id"], ["source_weight", "__conf", "__back"])
    return out.select("company_id", "id", "source_url", "source_tier")


@query("latest_metrics_join", """
select c.company_id, c.name, m.star_growth_30d, m.commits_last_30d, m.contributor_count
from v_companies c left join (select * from (select *, row_number() over (partition by company_id
  order by extracted_at desc, id desc, star_growth_30d desc, commits_last_30d desc, contributor_count desc) rn from v_metrics) t
  where rn = 1) m on m.company_id = c.company_id""")
def _(t):
    cols = ["star_growth_30d", "commits_last_30d", "contributor_count"]
    latest = lookup.latest_per_key(t("v_metrics"), "company_id", "extracted_at", ["id", *cols], cols)
    return t("v_companies").select("company_id", "name").join(latest, "company_id", "left")


@query("dup_within_window", """
select id, coalesce(date_diff('second', lag(created_at) over w, created_at) <= 604800, false) as is_duplicate
from v_events where company_id is not null and source_url <> ''
window w as (partition by company_id, event_type, source_url order by created_at, id)""")
def _(t):
    e = t("v_events").select("id", "company_id", "event_type", "source_url", "created_at")
    return lookup.duplicates_within(e).select("id", "is_duplicate")


@query("period_growth", f"""
select company_id, count(*) filter (where detected_at >= {NOW_SQL} - interval 30 day) as recent,
  count(*) filter (where detected_at >= {NOW_SQL} - interval 60 day and detected_at < {NOW_SQL} - interval 30 day) as prior
from v_signals where company_id is not null group by company_id""")
def _(t):
    from ..operators import ranking

    return ranking.period_counts(t("v_signals"), t.now(), 30)


@query("merge_insert_ignore", """
select id, source, signal_type from (select *, row_number() over (partition by source, signal_type order by detected_at, id) rn
  from v_signals where processed) a where rn = 1
union all
select id, source, signal_type from (select *, row_number() over (partition by source, signal_type order by detected_at, id) rn
  from v_signals s where not processed and not exists (select 1 from v_signals p where p.processed
    and p.source = s.source and p.signal_type = s.signal_type)) b where rn = 1""")
def _(t):
    s = t("v_signals").select("id", "source", "signal_type", "detected_at", "processed")
    keys, order = ["source", "signal_type"], ["detected_at", "id"]
    log = keyed.keep_first(s.filter("processed"), keys, order)
    return keyed.insert_ignore(log, s.filter("not processed"), keys, order).select("id", *keys)


@query("merge_claims_overwrite", """
select coalesce(o.source_url, n.source_url) as source_url, coalesce(n.amount_usd, case when n.source_url is null then o.amount_usd end) as amount_usd,
  case when n.source_url is null then o.lead_investor else n.lead_investor end as lead_investor,
  case when o.source_url is null then n.round_type else o.round_type end as round_type,
  case when o.source_url is null then n.announced_date else o.announced_date end as announced_date
from (select * from v_claims where is_official or source_tier = 'press_wire') o
full join (select source_url, amount_usd + 1 as amount_usd, upper(lead_investor) as lead_investor, 'x' as round_type,
  'later' as announced_date from v_claims where source_tier in ('press_wire', 'unknown')) n on n.source_url = o.source_url""")
def _(t):
    cols = ["source_url", "amount_usd", "lead_investor", "round_type", "announced_date"]
    c = t("v_claims")
    old = c.filter("is_official or source_tier = 'press_wire'").select(*cols)
    new = c.filter("source_tier in ('press_wire', 'unknown')").select(
        "source_url", (F.col("amount_usd") + 1).alias("amount_usd"), F.upper("lead_investor").alias("lead_investor"),
        F.lit("x").alias("round_type"), F.lit("later").alias("announced_date"),
    )
    policy = {"round_type": "keep", "announced_date": "keep"}
    return keyed.merge_upsert(old, new, ["source_url"], policy)


DETAILS = """select company_id, max(case when field_key = 'headquarters' then field_value end) as headquarters,
  max(case when field_key = 'team_size' then field_value end) as team_size from v_profile where {} group by company_id"""


@query("merge_coalesce", f"""
select coalesce(o.company_id, n.company_id) as company_id, coalesce(n.headquarters, o.headquarters) as headquarters,
  coalesce(n.team_size, o.team_size) as team_size
from ({DETAILS.format("source_weight >= 0.9")}) o full join ({DETAILS.format("field_key = 'team_size'")}) n using (company_id)""")
def _(t):
    def details(df):
        value = lambda k: F.max(F.when(F.col("field_key") == k, F.col("field_value"))).alias(k)
        return df.groupBy("company_id").agg(value("headquarters"), value("team_size"))

    p = t("v_profile")
    old, new = details(p.filter("source_weight >= 0.9")), details(p.filter("field_key = 'team_size'"))
    return keyed.merge_upsert(old, new, ["company_id"], {}, default="coalesce")


@query("merge_max", """
select coalesce(o.name, n.name) as name, greatest(o.score, n.score) as score, coalesce(o.discovery_source, n.discovery_source) as discovery_source
from (select vendor1 as name, cast(max(price) as double) as score, max(source) as discovery_source from v_signals where processed group by vendor1) o
full join (select vendor2 as name, cast(max(price) as double) as score, min(source) as discovery_source from v_signals where not processed group by vendor2) n
using (name)""")
def _(t):
    s = t("v_signals")
    score = F.max("price").cast("double").alias("score")
    old = s.filter("processed").groupBy(F.col("vendor1").alias("name")).agg(score, F.max("source").alias("discovery_source"))
    new = s.filter("not processed").groupBy(F.col("vendor2").alias("name")).agg(score, F.min("source").alias("discovery_source"))
    return keyed.merge_upsert(old, new, ["name"], {"score": "max", "discovery_source": "fill"})


TEAM = "select company_id, name_normalized, max(role) as role, bool_or(is_founder) as is_founder from v_team where {} group by all"


@query("merge_or_flags", f"""
select coalesce(o.company_id, n.company_id) as company_id, coalesce(o.name_normalized, n.name_normalized) as name_normalized,
  coalesce(n.role, o.role) as role, coalesce(n.is_founder, false) or coalesce(o.is_founder, false) as is_founder
from ({TEAM.format("is_official")}) o full join ({TEAM.format("not is_official")}) n
  on o.company_id = n.company_id and o.name_normalized = n.name_normalized""")
def _(t):
    def people(df):
        return df.groupBy("company_id", "name_normalized").agg(
            F.max("role").alias("role"), F.bool_or("is_founder").alias("is_founder")
        )

    m = t("v_team")
    policy = {"role": "coalesce", "is_founder": "or"}
    keys = ["company_id", "name_normalized"]
    return keyed.merge_upsert(people(m.filter("is_official")), people(m.filter("not is_official")), keys, policy)


@query("apply_structured_enrichment", """
select c.id, coalesce(p.lead_investor, c.lead_investor) as lead_investor, coalesce(p.amount_usd, c.amount_usd) as amount_usd,
  case when p.id is null then c.extraction_confidence else greatest(coalesce(c.extraction_confidence, 0), 0.85) end as extraction_confidence
from v_claims c left join (select id, case when is_rumor is not null and source_tier = 'tier1_media' then 'Patched' end as lead_investor,
  coalesce(amount_usd, 1) as amount_usd from v_claims where source_tier in ('tier1_media', 'regulatory')) p on p.id = c.id""")
def _(t):
    c = t("v_claims").select("id", "source_url", "source_tier", "lead_investor", "amount_usd", "extraction_confidence")
    media = F.col("source_tier") == "tier1_media"
    patches = c.filter("source_tier in ('tier1_media', 'regulatory')").select(
        F.when(media, F.col("id")).alias("claim_id"),
        F.when(~media, F.col("source_url")).alias("source_url"),
        F.when(media, "Patched").alias("lead_investor"),
        F.coalesce("amount_usd", F.lit(1)).cast("bigint").alias("amount_usd"),
    )
    out = keyed.patch_claims(c, patches)
    return out.select("id", "lead_investor", "amount_usd", "extraction_confidence")


@query("merge_claims_company", """
select coalesce(o.source_url, n.source_url) as source_url, coalesce(o.name, n.name) as name, coalesce(n.description, o.description) as description,
  case when n.source_url is null then o.status else n.status end as status
from (select * from v_products where source_tier = 'rss') o
full join (select source_url, 'renamed' as name, case when status = 'beta' then 'Later text' end as description, 'retired' as status
  from v_products where category = 'yc' or is_official) n on n.source_url = o.source_url""")
def _(t):
    from ..operators.company import PRODUCT_POLICY

    p = t("v_products").select("source_url", "name", "description", "status", "source_tier", "category", "is_official")
    cols = ["source_url", "name", "description", "status"]
    new = p.filter("category = 'yc' or is_official").select(
        "source_url", F.lit("renamed").alias("name"), F.when(F.col("status") == "beta", "Later text").alias("description"),
        F.lit("retired").alias("status"),
    )
    return keyed.merge_upsert(p.filter("source_tier = 'rss'").select(*cols), new, ["source_url"], PRODUCT_POLICY, "keep")


@query("merge_social_posts", """
select s.id as post_id, c.company_id, title as text, 0 as likes from v_signals s join v_companies c on c.name = s.company
where s.source = 'x' and s.status <> 'F'
union all select id as post_id, true_company_id as company_id, title as text, 7 as likes from v_signals where source = 'x' and status = 'F'""")
def _(t):
    from ..operators.social import merge_posts

    s = t("v_signals").filter("source = 'x'")
    kept = s.filter("status = 'F'").select(
        F.col("id").alias("post_id"), F.col("true_company_id").alias("company_id"), F.col("title").alias("text"), F.lit(7).alias("likes")
    )
    new = s.select(F.col("id").alias("post_id"), "company", F.col("title").alias("text"), F.lit(None).cast("int").alias("likes"))
    return merge_posts(kept, new, t("v_companies"))


@query("prune_unclustered", """
select id, company_id from v_claims where announced_date is not null""")
def _(t):
    from ..operators.funding import prune_unclustered

    rounds = t("v_claims").withColumn("cluster_key", F.col("announced_date"))
    return prune_unclustered(rounds).select("id", "company_id")

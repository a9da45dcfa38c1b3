"""Filters, predicates and joins between signals, events, companies and ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.deals import FUNDING_TYPES
from ..operators import lookup
from .registry import NOW_SQL, query

FUNDING_IN = ", ".join(f"'{n}'" for n in FUNDING_TYPES)


@query("events_with_company", """
select e.id, coalesce(c.name, 'Unknown') as company, e.event_type from v_events e left join v_companies c on c.company_id = e.company_id""")
def _(t):
    out = lookup.events_with_company(t("v_events").select("id", "company_id", "event_type"), t("v_companies"))
    return out.select("id", "company", "event_type")


@query("events_with_signal", """
select e.id, e.raw_signal_id, s.title, s.url from v_events e left join v_signals s on s.id = e.raw_signal_id""")
def _(t):
    e = t("v_events").select("id", "raw_signal_id")
    return lookup.events_with_signal(e, t("v_signals"), "title", "url").select("id", "raw_signal_id", "title", "url")


@query("orphan_signals", """
select id, processed from v_signals s where not exists (select 1 from v_events e where e.raw_signal_id = s.id)""")
def _(t):
    return lookup.orphan_signals(t("v_signals").select("id", "processed"), t("v_events").select("raw_signal_id"))


@query("orphan_processed_signals", """
select id from v_signals s where processed and not exists (select 1 from v_events e where e.raw_signal_id = s.id)""")
def _(t):
    s = t("v_signals").select("id", "processed")
    return lookup.orphan_signals(s, t("v_events").select("raw_signal_id"), processed_only=True).select("id")


@query("requeue_orphans", """
select id, processed and exists (select 1 from v_events e where e.raw_signal_id = s.id) as processed from v_signals s""")
def _(t):
    return lookup.requeue_orphans(t("v_signals").select("id", "processed"), t("v_events"))


@query("unprocessed_signals", """
select id from v_signals s where not processed or not exists (select 1 from v_events e where e.raw_signal_id = s.id)""")
def _(t):
    return lookup.unprocessed_signals(t("v_signals").select("id", "processed"), t("v_events")).select("id")


@query("recent_signals", f"""
select s.id, c.name as company_name, s.source, s.detected_at from v_signals s join v_companies c on c.company_id = s.company_id
where s.detected_at >= {NOW_SQL} - interval 7 day""")
def _(t):
    s = t("v_signals").select("id", "company_id", "source", "detected_at")
    out = lookup.recent_signals(s, t("v_companies"), t.now()).orderBy(F.desc("detected_at"), "id")
    return out.select("id", "company_name", "source", "detected_at")


@query("funding_candidate_signals", """
select id from v_signals where lower(data_json) like '%raised%' or lower(data_json) like '%funding%'
  or lower(data_json) like '%million%' or lower(data_json) like '%billion%'
order by detected_at desc, id desc limit 300""")
def _(t):
    from ..operators.funding import funding_candidates

    return funding_candidates(t("v_signals"), limit=300).select("id")


@query("sync_company_from_signal", """
select e.id, coalesce(e.company_id, s.company_id) as company_id from v_events e left join v_signals s on s.id = e.raw_signal_id""")
def _(t):
    e = t("v_events").select("id", "raw_signal_id", "company_id")
    return lookup.sync_company(e, t("v_signals")).select("id", "company_id")


@query("unalerted_events", f"""
select id from v_events where created_at >= {NOW_SQL} - interval 365 day
  and id not in (select id from v_events where event_type = 'Hiring')""")
def _(t):
    e = t("v_events").select("id", "event_type", "created_at")
    ledger = e.filter("event_type = 'Hiring'").select(F.col("id").alias("event_id"), F.lit("chat").alias("channel"))
    since = F.lit(t.now()) - F.expr("interval 365 days")
    return lookup.unalerted_events(e, ledger, "chat", since).select("id")


@query("unclaimed_funding_events", f"""
select id from v_events where company_id is not null and event_type in ({FUNDING_IN})
  and id not in (select intelligence_event_id from v_claims where intelligence_event_id is not null)""")
def _(t):
    e = t("v_events").select("id", "company_id", "event_type")
    return lookup.unclaimed_funding_events(e, t("v_claims")).select("id")


@query("link_event_by_url", """
select id, url, event_id, linked from (select s.id, s.url, e.id as event_id,
    e.raw_signal_id is null or e.raw_signal_id = s.id as linked,
    row_number() over (partition by s.id order by case when e.raw_signal_id is null then 0 else 1 end, e.id desc) rn
  from v_signals s join (select id, case when template = 7 then null else raw_signal_id end as raw_signal_id, source_url from v_events) e
    on e.source_url = s.url or (e.source_url like s.url || '#%')) t where rn = 1""")
def _(t):
    e = t("v_events").select(
        "id", F.when(F.col("template") != 7, F.col("raw_signal_id")).alias("raw_signal_id"), "source_url"
    )
    return lookup.link_event_by_url(t("v_signals").select("id", "url"), e)


@query("search_entities", """
select * from (select 'company' as kind, company_id as id, name as label from v_companies
  where name ilike '%ring%' or description ilike '%ring%' order by company_id limit 10) a
union all select * from (select 'event' as kind, e.id, e.event_type as label from v_events e left join v_companies c
  on c.company_id = e.company_id where e.event_type ilike '%ring%' or c.name ilike '%ring%'
  order by e.created_at desc, e.id desc limit 10) b""")
def _(t):
    from ..operators.brief import search_entities

    return search_entities(t("v_companies"), t("v_events"), "ring")


@query("hiring_event_candidates", """
select id from v_events where company_id is not null and event_type = 'Hiring' and (lower(description) like '%engineer%'
  or lower(description) like '%developer%' or lower(description) like '%hiring%' or lower(description) like '%open role%'
  or lower(description) like '%job%' or lower(description) like '%talent%')""")
def _(t):
    from ..operators.jobs import hiring_events

    return hiring_events(t("v_events"), extra=["talent"]).select("id")


@query("regulatory_candidates", """
select id from v_signals where source = 'sec_edgar' or (category = 'regulatory' and (source <> 'company website' or status <> 'P'))""")
def _(t):
    from ..operators.claims import regulatory_candidates

    return regulatory_candidates(t("v_signals")).select("id")

"""Discovery, ranking, quality, brief, alert, search and query-building queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify
from ..operators import alerts, brief, quality, queries, ranking, repair, search
from .extract_q import amount_sql, classify_ctes, entities_sql, hype_sql
from .registry import NOW_SQL, query
from .resolve_q import ALIASES, CASCADE, CASCADE_PARTS, brute_fuzzy

AGO = lambda days: f"{NOW_SQL} - interval {days} day"

PAYLOAD_TEXT = """case source when 'hackernews' then 'Discussion of ' || company || ' at https://news.example.org/d/' || id || ' today.'
  when 'x' then title || ' ' || coalesce(handle, '@nobody') || ' https://t.co/' || id else '' end"""
MENTIONS = f"""
select id, source, detected_at, hype, unnest(names) as name from (select id, source, detected_at, {hype_sql('blob')} as hype,
    list_distinct(list_concat([company || ' Inc'], {entities_sql('prose')})) as names from (
  select *, title || ' ' || summary || ' ' || {PAYLOAD_TEXT} as blob, title || ' ' || coalesce(nullif(summary, ''), {PAYLOAD_TEXT}, '') as prose from v_signals where detected_at >= {AGO(365)}) s where source = 'sec_edgar'
  union all select id, source, detected_at, {hype_sql('blob')} as hype, list_distinct(list_concat(case when company_id is not null or source in ('Startup Feed', 'x', 'ycombinator', 'esma_mica') then [company] else [] end, {entities_sql('prose')})) as names from (
  select *, title || ' ' || summary || ' ' || {PAYLOAD_TEXT} as blob, title || ' ' || coalesce(nullif(summary, ''), {PAYLOAD_TEXT}, '') as prose from v_signals where detected_at >= {AGO(365)}) s where source <> 'sec_edgar') m"""
STATS = f"""select name, count(*) as signals, count(distinct source) as sources, cast(sum(hype) as bigint) as hype_hits, max(detected_at) as last_seen,
  array_to_string(list_sort(list(distinct source)), ',') as source_list from mentioned where name not in (select name from fuzzy where score >= 0.72) group by name"""
STAT_PARTS = {"aliases": ALIASES, "mentioned": MENTIONS, "fuzzy": brute_fuzzy("select name from mentioned"), "stats": STATS}
SCORED = """select *, round(least(least(signals / 15e0, 1e0) * 0.45e0 + least(sources / 5e0, 1e0) * 0.25e0 + least(hype_hits / 6e0, 1e0) * 0.3e0, 1e0), 4) as score from stats"""


def year_stats(t):
    return ranking.mention_stats(t("v_signals"), t("v_companies"), t.now(), 365)


@query("mention_stats", "select name, signals, sources, hype_hits, last_seen, source_list from stats", **STAT_PARTS)
def _(t):
    return year_stats(t)


@query("candidate_metadata", """
select name, array_to_string(list(id order by detected_at desc, id desc)[1:50], ' ') as signal_ids, array_to_string(list_sort(list(distinct source)), ',') as sources
from mentioned where name not in (select name from fuzzy where score >= 0.72) group by name""", **{k: v for k, v in STAT_PARTS.items() if k != "stats"})
def _(t):
    out = ranking.candidate_metadata(t("v_signals"), t("v_companies"), t.now(), 365)
    return out.select("name", F.array_join(F.col("signal_ids").cast("array<string>"), " ").alias("signal_ids"), F.array_join("sources", ",").alias("sources"))


@query("attention_score", "select name, score from scored_stats", **STAT_PARTS, scored_stats=SCORED)
def _(t):
    return ranking.attention_score(year_stats(t)).select("name", "score")


@query("company_candidates", """
select name, score, 'Mentioned in ' || signals || ' signals (' || source_list || ')' as description from scored_stats where score >= 0.08 or signals >= 2""",
       **STAT_PARTS, scored_stats=SCORED)
def _(t):
    return ranking.company_candidates(year_stats(t)).select("name", "score", "description")


@query("promote_candidates", """
select name, lower(name) as slug, 'active' as status from (select vendor1 as name, cast(count(*) as double) / (select count(*) from v_base) * 60 as score from v_base group by vendor1
  union all select company, 1e0 from v_base group by company) c where score >= 0.65 and name not in (select name from v_companies)""")
def _(t):
    b = t("v_base")
    total = b.count()
    score = (F.count("*").cast("double") / total * 60).alias("score")
    c = b.groupBy(F.col("vendor1").alias("name")).agg(score).unionByName(b.groupBy(F.col("company").alias("name")).agg(F.lit(1.0).alias("score")))
    c = c.withColumn("status", F.lit("pending")).withColumn("description", F.lit("seen"))
    return ranking.promote_candidates(c, t("v_companies")).select("name", "slug", "status")


@query("rank_companies", f"""
select company_id, name, round(least(least(recent / 25e0, 1e0) * 0.3e0 + case when prior = 0 then least(recent / 20e0, 1e0) else least(greatest((cast(recent - prior as double) / prior + 1) / 2, 0e0), 1e0) end * 0.3e0
  + least(sources / 6e0, 1e0) * 0.15e0 + least(events / 8e0, 1e0) * 0.15e0 + least(hype_hits / 8e0, 1e0) * 0.1e0, 1e0), 4) as score, recent, prior, sources, events, hype_hits
from (select c.company_id, c.name, coalesce(recent, 0) as recent, coalesce(prior, 0) as prior, coalesce(sources, 0) as sources, coalesce(events, 0) as events, coalesce(hype_hits, 0) as hype_hits
  from (select * from v_companies where status = 'active') c
  left join (select company_id, count(*) filter (where detected_at >= {AGO(30)}) as recent, count(*) filter (where detected_at >= {AGO(60)} and detected_at < {AGO(30)}) as prior,
    count(distinct source) filter (where detected_at >= {AGO(30)}) as sources from v_signals group by company_id) s on s.company_id = c.company_id
  left join (select company_id, count(*) as events from v_events where created_at >= {AGO(30)} group by company_id) e on e.company_id = c.company_id
  left join (select company_id, cast(sum(case when source = 'company website' and status = 'P' then 0 else {hype_sql("title || ' ' || summary || ' ' || " + PAYLOAD_TEXT)} end) as bigint) as hype_hits from (
    select *, row_number() over (partition by company_id order by detected_at desc, id desc) rn from v_signals) z where rn <= 40 group by company_id) h on h.company_id = c.company_id) q""")
def _(t):
    return ranking.rank_companies(t("v_companies"), t("v_signals"), t("v_events"), t.now())


@query("handle_activity", f"""
select c.company_id, c.name, c.x_handle, count(e.id) as recent_events from v_companies c left join v_events e on e.company_id = c.company_id and e.created_at >= {AGO(90)}
where c.x_handle is not null group by 1, 2, 3""")
def _(t):
    since = F.lit(t.now()) - F.expr("interval 90 days")
    return ranking.handle_activity(t("v_companies"), t("v_events"), since)


@query("vc_factor_score")
def _(t):
    from ..operators.company import profile_rollup, team_rollup
    from ..operators.funding import merge_clusters
    from .funding_q import latest_github

    c = t("v_companies")
    rounds = merge_clusters(t("v_claims").select("id", "company_id", "round_type", "amount_usd", "announced_date", "source_weight", "lead_investor"))
    tech = t("v_metrics").select("company_id", F.col("primary_language").alias("technology"))
    jobs = t("v_jobs").select("company_id", F.lit(True).alias("is_active"))
    rivals = t("v_signals").filter("template = 3").select("company_id")
    inputs = ranking.factor_inputs(
        c, rounds, latest_github(t), t("v_signals"), t("v_events"), t("v_profile"), tech, team_rollup(t("v_team")),
        profile_rollup(t("v_profile")), jobs, rivals, t.now())
    return ranking.factor_score(inputs)


# -- repairs ------------------------------------------------------------------------------------

BODIES = "select id, source, title, summary, concat_ws(' ', title, nullif(summary, ''), nullif(" + PAYLOAD_TEXT + ", ''), case when source = 'ycombinator' then company end) as text, url from v_signals"
WITH_TEXT = "select e.*, s.text as stext, s.url from v_events e join signal_bodies s on s.id = e.raw_signal_id"


@query("repair_amounts", f"""
select id, case when event_type like '%Funding%' and coalesce(amount_usd, 0) = 0 then coalesce(nullif({amount_sql("(description || ' ' || stext)")}, 0), amount_usd) else amount_usd end as amount_usd from joined""",
       signal_bodies=BODIES, joined=WITH_TEXT)
def _(t):
    return repair.backfill_amounts(t("v_events"), t("v_signals")).select("id", "amount_usd")


MONEY = "regexp_matches(lower(description || ' ' || stext), 'million|billion|raised|funding|\\$|series a|seed round')"


@query("repair_misfunded", f"""
select id, case when bad then 'General News' else event_type end as event_type, case when bad then least(confidence, 0.4e0) else confidence end as confidence
from (select *, event_type like '%Funding%' and coalesce(amount_usd, 0) = 0 and not {MONEY} as bad from joined) x""", signal_bodies=BODIES, joined=WITH_TEXT)
def _(t):
    return repair.reclassify_misfunded(t("v_events"), t("v_signals")).select("id", "event_type", "confidence")


MERGED = """select id, source, event_type as old_type, confidence as old_conf, base || case when url is not null and not contains(base, url) then ' ' || url else '' end as text
from (select *, case when description = '' or contains(stext, description) then stext else description || ' ' || stext end as base from joined) x"""


@query("repair_general", """
select id, case when old_type = 'General News' and event_type <> 'General News' and confidence >= 0.35 then event_type else old_type end as event_type,
  round(case when old_type = 'General News' and event_type <> 'General News' and confidence >= 0.35 then confidence else old_conf end, 6) as confidence from classified""",
       signal_bodies=BODIES, joined=WITH_TEXT, merged_text=MERGED, **classify_ctes("select * from merged_text"))
def _(t):
    out = repair.reclassify_general(t("v_events"), t("v_signals"))
    return out.select("id", "event_type", F.round("confidence", 6).alias("confidence"))


@query("repair_minimal", """
select id, case when old_type = 'General News' and length(trim(text)) < 60 then 'Unlabeled Signal' else old_type end as event_type from merged_text""",
       signal_bodies=BODIES, joined=WITH_TEXT, merged_text=MERGED)
def _(t):
    return repair.relabel_minimal(t("v_events"), t("v_signals"), 60).select("id", "event_type")


# Orphan events, resolved through their signals; the actionable ones hold a company's name in their text.
RELINKED = """select e.id, c.company_id, lower(concat_ws(' ', e.description, s.title, s.summary)) as low from v_events e join cascade c on c.id = e.raw_signal_id
  join v_signals s on s.id = e.raw_signal_id where e.company_id is null"""
RELINK_PARTS = CASCADE_PARTS | {"cascade": CASCADE, "relinked": RELINKED}


@query("relink_orphans", "select id, company_id from relinked", **RELINK_PARTS)
def _(t):
    return repair.relink_orphans(t("v_events"), t("v_signals"), t("v_companies"))


@query("relink_actionable", """
select id, company_id from relinked where exists (select 1 from v_companies n where length(n.name) >= 4 and contains(low, lower(n.name)))""", **RELINK_PARTS)
def _(t):
    return repair.relink_orphans(t("v_events"), t("v_signals"), t("v_companies"), actionable=True)


# -- quality ------------------------------------------------------------------------------------


METRICS = """
select (select count(*) from v_signals s where not exists (select 1 from v_events e where e.raw_signal_id = s.id)) as orphans, (select count(*) from v_signals where not processed) as unprocessed,
  round(100e0 * count(*) filter (where company_id is null) / count(*), 1) as null_company_pct, round(100e0 * count(*) filter (where event_type = 'General News') / count(*), 1) as general_news_pct,
  (select count(*) from (select 1 from v_events group by raw_signal_id having count(*) > 1) d) as dup_raw_signal_id,
  round(100e0 * count(*) filter (where event_type like '%Funding%' and coalesce(amount_usd, 0) = 0 and m) / count(*) filter (where event_type like '%Funding%' and m), 1) as pct_funding_no_amount
from (select *, regexp_matches(lower(description), 'million|billion|raised|\\$|series ') as m from v_events) e"""


@query("quality_metrics", METRICS)
def _(t):
    return quality.quality_metrics(t("v_signals"), t("v_events"), t("v_companies")).drop("actionable_null_pct")


# How many orphan events name a company, and how many of these the cascade can link.
ACTIONABLE = """select count(*) as actionable, count(*) filter (where id in (select id from cascade)) as missed from (
  select e.raw_signal_id as id from v_events e join v_signals s on s.id = e.raw_signal_id where e.company_id is null and exists (
    select 1 from v_companies n where length(n.name) >= 4 and contains(lower(concat_ws(' ', e.description, s.title, s.summary, s.url)), lower(n.name)))) x"""
FAILED = ", ".join(
    f"case when {n} > {most} then '{n}=' || {n} end"
    for n, most in (("orphans", 0), ("unprocessed", 0), ("null_company_pct", 40), ("actionable_null_pct", 5), ("general_news_pct", 65), ("dup_raw_signal_id", 0), ("pct_funding_no_amount", 25)))


@query("quality_gate", f"select failed, failed = '' as passed from (select concat_ws(', ', {FAILED}) as failed from (select m.*, round(100e0 * a.missed / a.actionable, 1) as actionable_null_pct from metrics m, actionable a) x) y",
       **CASCADE_PARTS, cascade=CASCADE, metrics=METRICS, actionable=ACTIONABLE)
def _(t):
    gate = quality.quality_gate(quality.quality_metrics(t("v_signals"), t("v_events"), t("v_companies")))
    return gate.select(F.array_join("failed", ", ").alias("failed"), "passed")


@query("classifier_eval", """
select expected as label, count(*) as rows, cast(sum(hit) as bigint) as correct, round(cast(sum(hit) as double) / count(*), 4) as accuracy
from (select e.event_type as expected, cast(c.event_type = e.event_type as int) as hit from v_event_rows e join classified c on c.id = e.raw_signal_id) x group by rollup (expected)""",
       **classify_ctes("select id, source, title || ' ' || summary as text from v_signals"))
def _(t):
    s = t("v_signals").select("id", "source", F.concat_ws(" ", "title", "summary").alias("text"))
    out = classify.classify(s, "text", "source").select("id", classify.label_title(F.col("label")).alias("got"))
    rows = t("v_event_rows").select(F.col("raw_signal_id").alias("id"), "event_type").join(out, "id")
    return quality.classifier_eval(rows, "got", "event_type").drop("passed")


# -- brief --------------------------------------------------------------------------------------


@query("brief_top_events", f"""
select e.id, coalesce(c.name, 'Unknown') as company, e.event_type, e.amount_usd, e.confidence from v_events e left join v_companies c on c.company_id = e.company_id
where e.created_at >= {AGO(30)} order by e.confidence desc, coalesce(e.amount_usd, 0) desc, e.id limit 15""")
def _(t):
    out = brief.top_events(t("v_events"), t("v_companies"), F.lit(t.now()) - F.expr("interval 30 days"))
    return out.select("id", "company", "event_type", "amount_usd", "confidence")


@query("top_companies", "select company_id, name, score, industry from v_companies where score is not null order by score desc, company_id limit 10")
def _(t):
    return brief.top_companies(t("v_companies")).select("company_id", "name", "score", "industry")


@query("company_listing", "select company_id, name, score, github_stars from v_companies order by score desc nulls last, github_stars desc nulls last, company_id limit 25")
def _(t):
    return brief.list_companies(t("v_companies"), 25).select("company_id", "name", "score", "github_stars")


@query("recent_events", """
select e.id, coalesce(c.name, 'Unknown') as company, e.event_type from v_events e left join v_companies c on c.company_id = e.company_id order by e.created_at desc, e.id desc limit 20""")
def _(t):
    return brief.recent_events(t("v_events"), t("v_companies")).select("id", "company", "event_type")


@query("brief_signal_counts", f"select source, count(*) as signals from v_signals where detected_at >= {AGO(30)} group by source")
def _(t):
    return brief.source_counts(t("v_signals"), F.lit(t.now()) - F.expr("interval 30 days"))


@query("status_counts", f"""
select 'signals' as table_name, count(*) as rows, count(*) filter (where detected_at >= {AGO(1)}) as recent from v_signals
union all select 'events', count(*), count(*) filter (where created_at >= {AGO(1)}) from v_events union all select 'companies', count(*), null from v_companies""")
def _(t):
    since = F.lit(t.now()) - F.expr("interval 1 day")
    return brief.status_counts({"signals": (t("v_signals"), "detected_at"), "events": (t("v_events"), "created_at"), "companies": (t("v_companies"), None)}, since)


@query("sink_events_export", """
select cast(e.id as string) as id, coalesce(c.name, 'Unknown') as company, coalesce(cast(e.amount_usd as string), '') as amount_usd from v_events e left join v_companies c on c.company_id = e.company_id""")
def _(t):
    return brief.export_rows(brief.events_export(t("v_events").select("id", "company_id", "amount_usd", "created_at"), t("v_companies"))).select("id", "company", "amount_usd")


# -- alerts -------------------------------------------------------------------------------------

RULES = [
    {"name": "Big funding", "event_types": ["Funding"], "min_confidence": 0.6},
    {"name": "Any hiring", "event_types": ["hiring"], "min_confidence": 0.5},
    {"name": "Deals", "event_types": ["Acquisition", "Partnership"], "min_confidence": 0.8},
]
ALERTED = """select * from (select *, case when confidence >= 0.6 and contains(lower(event_type), 'funding') and not (coalesce(amount_usd, 0) <> 0 and amount_usd < 1000000) then 'Big funding'
  when confidence >= 0.5 and contains(lower(event_type), 'hiring') then 'Any hiring' when confidence >= 0.8 and event_type in ('Acquisition', 'Partnership') then 'Deals'
  when event_type = 'Acquisition' then 'acquisition' when event_type = 'Partnership' then 'partnership' when event_type = 'Hiring' then 'hiring_spree' end as alert_type from v_events) a where alert_type is not null"""


@query("match_alert_rules", "select id, alert_type from alerted", alerted=ALERTED)
def _(t):
    return alerts.match_rules(t("v_events"), RULES).select("id", "alert_type")


@query("alert_payload", """
select a.id, '🚨 ' || replace(upper(alert_type), '_', ' ') || ' Alert' as title, '**' || coalesce(c.name, 'Unknown') || '**' || chr(10) || 'Event: ' || event_type || chr(10)
  || case when coalesce(amount_usd, 0) <> 0 then 'Amount: ' || printf('$%.1fM', amount_usd / 1e6) || chr(10) else '' end || 'Source: ' || source || chr(10) as description
from alerted a left join v_companies c on c.company_id = a.company_id""", alerted=ALERTED)
def _(t):
    return alerts.alert_payload(alerts.match_rules(t("v_events"), RULES), t("v_companies")).drop("alert_type")


@query("sink_alert_ledger", "select id as event_id, 'chat' as channel from v_events where event_type in ('Hiring', 'Partnership') or id in (select id from alerted)", alerted=ALERTED)
def _(t):
    e = t("v_events")
    old = e.filter("event_type in ('Hiring', 'Partnership')").select(F.col("id").alias("event_id"), F.lit("chat").alias("channel"), F.lit(0).alias("sent_at"))
    return alerts.ledger_rows(old, alerts.match_rules(e, RULES), "chat", 1).select("event_id", "channel")


# -- search -------------------------------------------------------------------------------------

DOT = "list_dot_product(cast(e.embedding as double[]), cast(q.embedding as double[]))"
COSINE = f"coalesce({DOT} / nullif(sqrt(list_dot_product(cast(e.embedding as double[]), cast(e.embedding as double[]))) * sqrt(list_dot_product(cast(q.embedding as double[]), cast(q.embedding as double[]))), 0), 0)"


def topk_sql(boost: str, k: int, where: str = "true") -> str:
    return f"""select e.vec_id as id, round(least(1e0, {COSINE} + {boost}), 6) as score from embeddings e, (select embedding from embeddings where vec_id = 0) q where {where}
order by least(1e0, {COSINE} + {boost}) desc, e.vec_id limit {k}"""


def vectors(t):
    e = t("embeddings")
    query_vector = e.filter("vec_id = 0").select("embedding").first()[0]
    rows = e.select(
        F.col("vec_id").alias("id"), "embedding", "label", (F.col("label") / 10.0).cast("double").alias("company_score"),
        (F.col("label").cast("bigint") * 200_000_000).alias("amount_usd"), (F.col("label") / 20.0).cast("double").alias("confidence"))
    return rows, query_vector


COMPANY_BOOST, FUNDING_BOOST, EVENT_BOOST = "label / 10e0 * 0.05e0", "least(0.1e0, label * 200000000 / 1e10)", "case when label = 0 then 0.5e0 else label / 20e0 end * 0.05e0"


def ranked(t, boost, k):
    rows, q = vectors(t)
    return search.top_k(rows, q, boost, k).select("id", F.round("score", 6).alias("score"))


@query("semantic_topk_companies", topk_sql(COMPANY_BOOST, 10))
def _(t):
    return ranked(t, search.company_boost(), 10)


@query("semantic_topk_funding", topk_sql(FUNDING_BOOST, 10))
def _(t):
    return ranked(t, search.funding_boost(), 10)


@query("semantic_topk_events", topk_sql(EVENT_BOOST, 10))
def _(t):
    return ranked(t, search.event_boost(), 10)


@query("unified_search", f"""
select * from (select 'company' as kind, * from ({topk_sql(COMPANY_BOOST, 5)}) a union all select 'funding', * from ({topk_sql(FUNDING_BOOST, 5)}) b
  union all select 'event', * from ({topk_sql(EVENT_BOOST, 10)}) c) u order by score desc, kind, id limit 15""")
def _(t):
    parts = [("company", search.company_boost(), 5), ("funding", search.funding_boost(), 5), ("event", search.event_boost(), 10)]
    return search.unified([ranked(t, b, k).withColumn("kind", F.lit(n)) for n, b, k in parts])


@query("embedding_text", """
select e.id, coalesce(c.name, 'Unknown') || ' ' || e.event_type || case when coalesce(e.amount_usd, 0) <> 0 then ' $' || format('{:,}', e.amount_usd) else '' end || ' from ' || e.source as text
from v_events e left join v_companies c on c.company_id = e.company_id""")
def _(t):
    rows = t("v_events").join(t("v_companies").select("company_id", "name"), "company_id", "left")
    return rows.select("id", search.event_text().alias("text"))


# -- query building -----------------------------------------------------------------------------


@query("dedupe_queries", """
select query from (select *, row_number() over (partition by lower(query) order by id) rn from (select id, case when length(query) > 220 then rtrim(substr(query, 1, 217)) || '...' else query end as query
  from (select id, trim(regexp_replace(case when id % 2 = 0 then title else upper(title) end || '  deal', '\\s+', ' ', 'g')) as query from v_signals) a) b where length(query) >= 8) c where rn = 1""")
def _(t):
    q = F.concat(F.when(F.col("id") % 2 == 0, F.col("title")).otherwise(F.upper("title")), F.lit("  deal"))
    return queries.dedupe_queries(t("v_signals").select("id", q.alias("query")), ["id"]).select("query")


@query("merge_query_sections", """
select section, query from (select *, row_number() over (partition by lower(query) order by section, position) rn from (
  select 0 as section, company_id as position, name || ' funding' as query from v_companies union all select 1, id, upper(company) || ' funding' from v_base union all select 2, id, vendor1 || ' launch' from v_base) a) b where rn = 1""")
def _(t):
    b = t("v_base")
    return queries.merge_sections([
        t("v_companies").select(F.col("company_id").alias("position"), F.concat("name", F.lit(" funding")).alias("query")),
        b.select(F.col("id").alias("position"), F.concat(F.upper("company"), F.lit(" funding")).alias("query")),
        b.select(F.col("id").alias("position"), F.concat("vendor1", F.lit(" launch")).alias("query")),
    ]).select("section", "query")


@query("derive_queries")
def _(t):
    now = t.now()
    since = F.lit(now) - F.expr("interval 30 days")
    return queries.derive_queries(t("v_events"), t("v_signals"), t("v_companies"), t("v_products"), since, str(now)[:10])

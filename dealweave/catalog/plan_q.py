"""Composite jobs and streams as registered queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import brief, company, repair, search, signals
from ..plans import rollups
from ..session import shared_folder
from ..streaming import streams
from . import company_q  # noqa: F401 - its SQL is used here
from .extract_q import SIGNAL_TEXT, classify_ctes
from .funding_q import latest_github, rounds_of
from .rank_q import ALERTED, RULES
from .registry import NOW_SQL, ORACLES, query
from .source_q import SNAP, snapshots


def scratch(t) -> str:
    return f"{shared_folder(t.spark)}/dealweave-streams/{uuid.uuid4().hex}"


def run_of(t) -> str:
    return uuid.uuid4().hex


@query("job_process_signals", """
select c.id as raw_signal_id, event_type, round(confidence, 6) as confidence from classified c where not exists (select 1 from v_events e where e.raw_signal_id = c.id)""",
       signal_text=SIGNAL_TEXT, **classify_ctes("select * from signal_text"))
def _(t):
    out = signals.process_signals(t("v_signals"), t("v_events"), t("v_companies"))
    return out.select("raw_signal_id", "event_type", F.round("confidence", 6).alias("confidence"))


@query("job_signal_repair", "select raw_signal_id, max(id) as id from v_events group by raw_signal_id")
def _(t):
    return repair.repair(t("v_events"), t("v_signals"), t("v_companies")).select("raw_signal_id", "id")


@query("job_funding_rollup")
def _(t):
    out = rollups.funding_rollup(t("v_events"), t("v_signals"), t("v_companies"), latest_github(t), run_of(t))
    return out["rounds"].select("company_id", "round_type", "amount_usd", "report_count", "corroboration_score", "cluster_key")


@query("job_company_data_rollup")
def _(t):
    out = rollups.company_data_rollup(t("v_events"), t("v_signals"), t("v_companies"), run_of(t))
    return rollups.company_facts(out)


@query("job_regulatory_rollup", """
select company_id, case when source = 'sec_edgar' then 'US' else 'UK' end as jurisdiction, count(*) as report_count from v_signals
where company_id is not null and (source = 'sec_edgar' or (category = 'regulatory' and (source <> 'company website' or status <> 'P'))) group by 1, 2""")
def _(t):
    out = rollups.regulatory_rollup(t("v_signals"))
    return out.groupBy("company_id", "jurisdiction").agg(F.sum("report_count").alias("report_count"))


@query("job_jobs_rollup")
def _(t):
    out = rollups.jobs_rollup(t("v_jobs"), t("v_events"), t("v_companies"), "2001-07-02", run_of(t))
    return out["velocity"]


@query("job_discover_promote_rank")
def _(t):
    out = rollups.discover_and_rank(t("v_signals"), t("v_events"), t("v_companies"), t.now(), 365, run_of(t))
    return out["ranking"].select("company_id", "name", "score")


@query("job_brief", f"""
select 'signals' as part, source as name, cast(count(*) as double) as value from v_signals where detected_at >= {NOW_SQL} - interval 30 day group by source
union all select * from (select 'company', name, score from v_companies order by score desc, company_id limit 10) c""")
def _(t):
    out = rollups.daily_brief(t("v_events"), t("v_signals"), t("v_companies"), t.now())
    counts = out["signal_counts"].select(F.lit("signals").alias("part"), F.col("source").alias("name"), F.col("signals").cast("double").alias("value"))
    return counts.unionByName(out["top_companies"].select(F.lit("company").alias("part"), "name", F.col("score").alias("value")))


@query("sink_brief", "select company_id, name, industry from v_companies where score is not null order by score desc, company_id limit 10")
def _(t):
    folder = scratch(t)
    brief.write_export(brief.top_companies(t("v_companies")), folder)
    return t.spark.read.json(f"{folder}/json").select("company_id", "name", "industry")


ASKED = "Robotics maker series A funding round"
_VECTOR = search.query_vector(ASKED)


def _embedded(kind: str, most: int, boost: str, rows: str) -> str:
    """SQL of the best rows of (id, text, ...) by cosine to the query, with a boost."""
    q = ", ".join(f"{v:.1f}::double" for v in _VECTOR)
    norm = repr(sum(v * v for v in _VECTOR) ** 0.5)
    return f"""(select '{kind}' as kind, id, score from (
  select id, least(1.0::double, case when nn > 0 then dot / (sqrt(nn) * {norm}::double) else 0 end + {boost}) as score from (
    select id, any_value(amount_usd) as amount_usd, any_value(company_score) as company_score, any_value(confidence) as confidence, sum(n * n)::double as nn, sum(n * [{q}][part + 1])::double as dot from (
      select id, part, any_value(amount_usd) as amount_usd, any_value(company_score) as company_score, any_value(confidence) as confidence, count(*) as n from (
        select *, ('0x' || substr(md5(unnest(regexp_extract_all(lower(text), '[a-z0-9]+'))), 1, 4))::int % {len(_VECTOR)} as part from ({rows}) x) y group by id, part) z group by id) s) v
  order by score desc, id limit {most})"""


def _or_blank(value: str, text: str) -> str:
    return f"case when coalesce({value}::varchar, '') <> '' then {text} end"


def _usd(column: str) -> str:
    return f"'$' || format('{{:,}}', {column})"


EMBEDDED = " union all ".join([
    "select * from " + _embedded("company", 5, "coalesce(company_score, 0) * 0.05", f"""select c.company_id::varchar as id, null::bigint as amount_usd, c.score as company_score, null::double as confidence,
      concat_ws(' ', c.name, {_or_blank("c.description", "c.description")}, {_or_blank("p.business_model", "'Business model: ' || p.business_model")},
        {_or_blank("p.headquarters", "'HQ: ' || p.headquarters")}, {_or_blank("p.team_size", "'Team: ' || p.team_size || ' people'")}) as text
      from v_companies c left join ({ORACLES["profile_rollup"]}) p on p.company_id = c.company_id"""),
    "select * from " + _embedded("funding", 5, "least(0.1::double, coalesce(amount_usd, 0) / 1e10)", f"""select r.cluster_key as id, r.amount_usd, null::double as company_score, null::double as confidence,
      concat_ws(' ', c.name, r.round_type, case when coalesce(r.amount_usd, 0) <> 0 then {_usd("r.amount_usd")} end, case when coalesce(r.valuation_usd, 0) <> 0 then 'at ' || {_usd("r.valuation_usd")} || ' valuation' end,
        {_or_blank("r.lead_investor", "'led by ' || r.lead_investor")}) as text from ({ORACLES["funding_rounds"]}) r left join v_companies c on c.company_id = r.company_id"""),
    "select * from " + _embedded("event", 10, "coalesce(nullif(confidence, 0), 0.5) * 0.05", f"""select e.id::varchar as id, null::bigint as amount_usd, null::double as company_score, e.confidence,
      concat_ws(' ', coalesce(c.name, 'Unknown'), e.event_type, case when coalesce(e.amount_usd, 0) <> 0 then {_usd("e.amount_usd")} end, 'from ' || e.source) as text
      from v_events e left join v_companies c on c.company_id = e.company_id"""),
])


@query("job_embed_and_search", f"select kind, id, round(score, 6) as score from ({EMBEDDED}) f order by f.score desc, kind, id limit 15")
def _(t):
    out = rollups.embed_and_search(t("v_companies"), company.profile_rollup(t("v_profile")), rounds_of(t)[1], t("v_events"), ASKED, run_of(t))
    return out["found"].select("kind", "id", F.round("score", 6).alias("score"))


@query("job_daily")
def _(t):
    run = run_of(t)
    out = rollups.daily(t("v_signals"), t("v_events").drop("status", "priority", "template", "signal_company_id"), t("v_companies"), latest_github(t), t("v_jobs"), t.now(), run, snapshots(t))
    return rollups.day_report(out, run)


# -- streams --------------------------------------------------------------------------------------


BATCHES = 3


def landed(t, df, order: str, key: str):
    """``df`` as a file stream that comes in several batches, in the order of ``order`` for each ``key``.

    Each slice of the order is a batch of as many files as the session has cores, so that all of them work on a batch.
    """
    folder, files = f"{scratch(t)}/landed", max(2, t.spark.sparkContext.defaultParallelism)
    cuts = df.approxQuantile(order, [i / BATCHES for i in range(1, BATCHES)], 0.01)
    bounds = [None, *cuts, None]
    for lo, hi in zip(bounds, bounds[1:]):
        part = df if lo is None else df.filter(F.col(order) >= lo)
        part = part if hi is None else part.filter(F.col(order) < hi)
        part.repartition(files, key).write.mode("append").parquet(folder)
    return t.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(folder)


@query("stream_ingest_dedup", "select distinct source, signal_type from v_signals")
def _(t):
    folder = scratch(t)
    rows = t("v_signals").select("id", "source", "signal_type", "detected_at")
    streams.run_to_files(streams.unseen(landed(t, rows, "id", "id"), ["source", "signal_type"], ["detected_at", "id"]), f"{folder}/log", f"{folder}/cp")
    return t.spark.read.parquet(f"{folder}/log").select("source", "signal_type")


@query("stream_classify", "select id, event_type, round(confidence, 6) as confidence from classified",
       **classify_ctes("select id, source, title as text from v_signals"))
def _(t):
    folder = scratch(t)
    s = landed(t, t("v_signals").select("id", "source", F.col("title").alias("text"), "url"), "id", "id")
    streams.run_batches(streams.classified_stream(s, t("v_companies")), streams.write_batches(f"{folder}/out"), f"{folder}/cp")
    return t.spark.read.parquet(f"{folder}/out").select("id", "event_type", F.round("confidence", 6).alias("confidence"))


@query("stream_alerts", "select id as event_id, alert_type from alerted", alerted=ALERTED)
def _(t):
    # every event comes twice, in different batches: the second time it must not be sent again
    folder, events = scratch(t), t("v_events").select("id", "company_id", "event_type", "confidence", "amount_usd")
    twice = events.withColumn("turn", F.col("id")).unionByName(events.withColumn("turn", -F.col("id")))
    streams.run_to_files(streams.unsent_alerts(landed(t, twice, "turn", "id").drop("turn"), RULES, "chat"), f"{folder}/ledger", f"{folder}/cp")
    return t.spark.read.parquet(f"{folder}/ledger").select("event_id", "alert_type")


@query("stream_signal_velocity", """
select company_id, start, count(*) as events from (select company_id, unnest(generate_series(date_trunc('day', detected_at) - interval 29 day, date_trunc('day', detected_at), interval 1 day)) as start
  from v_signals where company_id is not null) x group by company_id, start""")
def _(t):
    folder = scratch(t)
    rows = t("v_signals").filter("company_id is not null").select("id", "company_id", "detected_at")
    streams.run_batches(landed(t, rows, "id", "id"), streams.daily_count_step(f"{folder}/days", "company_id", "detected_at"), f"{folder}/cp")
    out = streams.velocity(t.spark.read.parquet(f"{folder}/days"), "company_id")
    return out.select("company_id", F.col("start").cast("timestamp_ntz").alias("start"), "events")


@query("stream_page_changes", """
select page_id, host, hash <> ph as content_changed, title <> pt as title_changed from (select *, lag(hash) over w as ph, lag(title) over w as pt from snaps window w as (partition by host order by page_id)) x
where ph is not null and (hash <> ph or title <> pt)""", snaps=SNAP)
def _(t):
    folder = scratch(t)
    snap = snapshots(t).select("page_id", "host", "hash", "title", "meta_description")
    streams.run_to_files(streams.page_changes(landed(t, snap, "page_id", "host"), "host", "page_id"), f"{folder}/changes", f"{folder}/cp")
    return t.spark.read.parquet(f"{folder}/changes").select("page_id", "host", "content_changed", "title_changed")

"""Queries over tables that are written as versions: merges in a row, replacement, aliases learned batch by batch, and a stream
that resolves against the newest companies."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import resolve
from ..session import shared_folder
from ..sources.snapshots import SnapshotTable
from ..streaming import streams
from .extract_q import classify_ctes
from .registry import query
from .resolve_q import ALIASES, BY_DOMAIN, DOMAINS, HOSTS, NAMES, brute_fuzzy, names_of


def _folder(t) -> str:
    return f"{shared_folder(t.spark)}/dealweave-stored/{uuid.uuid4().hex}"


@query("snapshot_merge", """
select * from (
  select 1 as version, id, amount_usd, lead_investor, round_type from first_version
  union all select 2, id, amount_usd, lead_investor, round_type from second_version
  union all select 3, coalesce(o.id, n.id), greatest(o.amount_usd, n.amount_usd), coalesce(o.lead_investor, n.lead_investor), coalesce(n.round_type, o.round_type)
    from second_version o full join (select id, amount_usd - 5 as amount_usd, 'Later' as lead_investor, case when id % 2 = 0 then 'Bridge' end as round_type
      from v_claims where id % 3 = 0) n on n.id = o.id) v""",
       first_version="select id, amount_usd, lead_investor, round_type from v_claims where is_official or source_tier = 'press_wire'",
       second_version="""
select coalesce(o.id, n.id) as id, case when n.id is null then o.amount_usd else n.amount_usd end as amount_usd,
  case when n.id is null then o.lead_investor else n.lead_investor end as lead_investor, case when o.id is null then n.round_type else o.round_type end as round_type
from first_version o full join (select id, amount_usd + 1 as amount_usd, upper(lead_investor) as lead_investor, 'x' as round_type
  from v_claims where source_tier in ('press_wire', 'unknown')) n on n.id = o.id""")
def _(t):
    claims = t("v_claims").select("id", "amount_usd", "lead_investor", "round_type", "is_official", "source_tier")
    rows = claims.drop("is_official", "source_tier")
    table = SnapshotTable(t.spark, _folder(t), ["id"], buckets=16)
    table.create(rows.filter(F.col("is_official") | (F.col("source_tier") == "press_wire")))
    first = rows.filter(F.col("source_tier").isin("press_wire", "unknown"))
    table.merge(first.select("id", (F.col("amount_usd") + 1).alias("amount_usd"), F.upper("lead_investor").alias("lead_investor"), F.lit("x").alias("round_type")), {"round_type": "keep"})
    later = rows.filter("id % 3 = 0").select(
        "id", (F.col("amount_usd") - 5).alias("amount_usd"), F.lit("Later").alias("lead_investor"), F.when(F.col("id") % 2 == 0, "Bridge").alias("round_type"),
    )
    table.merge(later, {"amount_usd": "max", "lead_investor": "fill", "round_type": "coalesce"})
    one, two, three = (table.read(v).select(F.lit(v).alias("version"), "*") for v in (1, 2, 3))
    return one.unionByName(two).unionByName(three)


@query("snapshot_replace", """
select company_id, sum(amount_usd) as amount_usd, count(*) as claims from v_claims where source_tier <> 'unknown' and company_id in (select company_id from v_companies where status = 'active') group by company_id""")
def _(t):
    def sums(claims):
        return claims.groupBy("company_id").agg(F.sum("amount_usd").alias("amount_usd"), F.count("*").alias("claims"))

    claims = t("v_claims")
    table = SnapshotTable(t.spark, _folder(t), ["company_id"], buckets=16)
    table.create(sums(claims))
    table.replace(sums(claims.filter("source_tier <> 'unknown'")), t("v_companies").filter("status = 'active'"), "company_id")
    return table.read()


_BOARDS = """select company_id, source as ats_platform, max(regexp_extract(source_url, '^https?://[^/]+/([^/?#]+)', 1)) as board_slug, max(regexp_extract(source_url, '^(https?://[^/]+/[^/?#]+)', 1)) as board_url,
  '{}' as last_fetched_at, count(*) as last_job_count from v_jobs where source in ('greenhouse', 'lever') and {} group by company_id, source"""


@query("merge_job_boards", f"""
select n.* from ({_BOARDS.format("2001-06-01", "id % 3 = 0")}) n
union all select o.* from ({_BOARDS.format("2001-05-01", "id % 2 = 0")}) o anti join ({_BOARDS.format("2001-06-01", "id % 3 = 0")}) n on n.company_id = o.company_id and n.ats_platform = o.ats_platform""")
def _(t):
    from ..operators import jobs

    table = SnapshotTable(t.spark, _folder(t), ["company_id", "ats_platform"], buckets=16)
    table.create(jobs.company_boards(t("v_jobs").filter("id % 2 = 0"), "2001-05-01"))
    table.merge(jobs.company_boards(t("v_jobs").filter("id % 3 = 0"), "2001-06-01"))
    return table.read()


def _spelt(t):
    """Names as they come in, and the batch they come with."""
    return names_of(t).select("name", F.lit(1).alias("batch")).unionByName(names_of(t).select(F.upper("name").alias("name"), F.lit(2).alias("batch")))


@query("resolve_entity_batches", "select 1 as batch, * from one union all select 2, * from two",
       aliases=ALIASES, names=NAMES, fuzzy=brute_fuzzy(NAMES), upper_fuzzy=brute_fuzzy(f"select upper(name) as name from ({NAMES}) u"),
       one="""
select n.name, f.company_id, round(least(0.99, greatest(0.5, f.score)), 6) as confidence, 'fuzzy' as method from (select distinct name from names) n join fuzzy f using (name)""",
       learned="""
select alias, max_by(company_id, rank_key) as company_id, max_by(confidence, rank_key) as confidence from (
  select trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) as alias, company_id, confidence, confidence * 1000000 - company_id as rank_key from one where confidence >= 0.85) x group by alias""",
       two="""
select n.name, coalesce(l.company_id, f.company_id) as company_id, round(coalesce(l.confidence, least(0.99, greatest(0.5, f.score))), 6) as confidence,
  case when l.alias is not null then 'alias' else 'fuzzy' end as method from (select distinct upper(name) as name from names) n
  left join learned l on l.alias = trim(regexp_replace(lower(n.name), '[^a-z0-9]+', ' ', 'g'))
  left join upper_fuzzy f on f.name = n.name where l.alias is not null or f.name is not null""")
def _(t):
    spelt, companies = _spelt(t), t("v_companies")
    table = resolve.alias_table(t.spark, _folder(t))
    out = None
    for batch in (1, 2):
        got = resolve.resolve_and_learn(spelt.filter(F.col("batch") == batch), companies, table, f"{table.folder}-out/{batch}")
        got = got.select(F.lit(batch).alias("batch"), "name", "company_id", F.round("confidence", 6).alias("confidence"), "method")
        out = got if out is None else out.unionByName(got)
    return out


EARLY = "company_id % 2 = 0"


def _early(sql: str) -> str:
    return sql.replace("v_companies", "early_companies")


_TITLE_ALIAS = """select s.id, max_by(a.company_id, length(a.alias) * 1000000000 - a.first_seen) as company_id
  from v_signals s join {aliases} a on length(a.alias) >= 4 and contains(lower(s.title), a.alias) where {which} group by s.id"""


@query("stream_resolve", """
select c.id, c.event_type, coalesce(h.company_id, a.company_id) as company_id, case when h.id is not null then 'domain' when a.id is not null then 'alias' end as method
from classified c left join by_host h on h.id = c.id left join by_title a on a.id = c.id""",
       early_companies=f"select * from v_companies where {EARLY}", aliases=ALIASES, early_aliases=_early(ALIASES), hosts=HOSTS, domains=DOMAINS,
       early_domains=_early(DOMAINS), by_domain=BY_DOMAIN, early_by_domain=BY_DOMAIN.replace("domains", "early_domains"),
       by_title=f'{_TITLE_ALIAS.format(aliases="early_aliases", which="s.processed")} union all {_TITLE_ALIAS.format(aliases="aliases", which="not s.processed")}',
       by_host="""select b.id, b.company_id from early_by_domain b join v_signals s on s.id = b.id and s.processed
  union all select b.id, b.company_id from by_domain b join v_signals s on s.id = b.id and not s.processed""",
       **classify_ctes("select id, source, title as text from v_signals"))
def _(t):
    folder, companies = _folder(t), t("v_companies").select("company_id", "name", "slug", "website", "x_handle")
    table = SnapshotTable(t.spark, f"{folder}/companies", ["company_id"], buckets=16)
    table.create(companies.filter(EARLY))
    rows = t("v_signals").select("id", "source", F.col("title").alias("text"), "url", "processed")
    for part in ("processed", "not processed"):
        rows.filter(part).drop("processed").write.mode("append").parquet(f"{folder}/landed")
        landed = t.spark.readStream.schema(rows.drop("processed").schema).parquet(f"{folder}/landed")
        streams.run_batches(landed, streams.resolve_step(f"{folder}/out", table), f"{folder}/cp")
        if part == "processed":
            table.merge(companies)  # the other half is tracked from now on
    return t.spark.read.parquet(f"{folder}/out").select("id", "event_type", "company_id", "method")

"""Signal-shaped views over the generic test tables.

The given tables hold orders, parts and suppliers, not news. These views read them whole and
shape every row into a signal, event, claim or posting, so that each operator has an input that
grows with the tables. The text is plain SQL that both Spark and an ANSI engine accept, which
lets a result be checked side by side. Every view maps rows one to one or groups them; ``case``
on a key only picks a wording, it never drops rows to make a check cheaper.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .session import shared_folder

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

VIEWS = {
    "v_companies": """
select min(p_partkey) + 1 as company_id, p_name as name, replace(p_name, ' ', '-') as slug,
  'https://www.' || replace(p_name, ' ', '') || '.io/home' as website,
  case when count(*) % 4 <> 0 then '@' || replace(p_name, ' ', '_') end as x_handle,
  case when count(*) % 3 <> 0 then replace(p_name, ' ', '') || 'labs' end as github_org,
  case min(p_type) when 'ECONOMY' then 'Fintech payments' when 'LARGE' then 'AI infrastructure'
    when 'MEDIUM' then 'Robotics' when 'PROMO' then 'Consumer' else 'Cloud data' end as industry,
  case when max(p_size) % 7 = 0 then 'paused' else 'active' end as status,
  cast(sum(p_size) % 1000 as double) / 1000 as score,
  cast(sum(p_size) * 10 as bigint) as github_stars,
  'Maker of ' || p_name as description
from part group by p_name""",
    "v_base": """
select o.o_orderkey as id, o.o_custkey as custkey, o.o_orderstatus as status,
  o.o_orderpriority as priority, o.o_orderdate as detected_at,
  cast(floor(o.o_totalprice) as bigint) as price, o.o_orderkey % 12 as template,
  c.company_id as true_company_id, c.name as company, replace(c.name, ' ', '') as tight,
  c.x_handle as handle,
  replace(s1.s_name, 'Supplier#', 'Vendor') as vendor1,
  replace(s2.s_name, 'Supplier#', 'Vendor') as vendor2,
  case s1.s_nationkey % 6 when 0 then 'Sequoia Capital' when 1 then 'Tiger Global'
    else replace(s1.s_name, 'Supplier#', 'Vendor') || ' Capital' end as investor1,
  case s2.s_nationkey % 6 when 0 then 'Greylock' when 1 then 'Menlo Ventures'
    else replace(s2.s_name, 'Supplier#', 'Vendor') || ' Partners' end as investor2,
  case o.o_custkey % 10 when 0 then 'TechCrunch' when 1 then 'Startup Feed' when 2 then 'hackernews'
    when 3 then 'x' when 4 then 'company website' when 5 then 'sec_edgar' when 6 then 'ycombinator'
    when 7 then 'esma_mica' when 8 then 'producthunt' else 'crunchbase' end as source
from (select *, o_orderkey % (select count(*) from supplier) as k1,
        o_custkey % (select count(*) from supplier) as k2 from orders) o
join part p on p.p_partkey = o.o_custkey
join v_companies c on c.name = p.p_name
join supplier s1 on s1.s_suppkey = o.k1
join supplier s2 on s2.s_suppkey = o.k2""",
    "v_titles": """
select *,
  case template
    when 0 then company || ' raises $' || (custkey % 90 + 1) || ' million Series '
      || chr(cast(65 + id % 6 as int)) || ' led by ' || investor1 || ' with participation from ' || investor2
    when 1 then company || ' launches Nova Suite for developers, now available'
    when 2 then company || ' partners with ' || vendor1
    when 3 then company || ' acquires ' || vendor1 || ' for undisclosed sum'
    when 4 then 'Ada Stone appointed CEO as ' || company || ' hires new cto and head of talent'
    when 5 then company || ' published research paper with benchmark dataset'
    when 6 then company || ' secured $' || (custkey % 3 + 1) || 'B valuation, seed round closes'
    when 7 then company || ' quarterly outlook'
    when 8 then vendor1 || ' raises $' || (custkey % 900 + 100) || 'K seed round from ' || investor1 || ' and ' || investor2
    when 9 then 'Sources say ' || company || ' reportedly raised $' || (custkey % 40 + 10)
      || 'M growth round co-led by ' || investor1 || ' and ' || investor2
    when 10 then company || ' closes $' || (custkey % 30 + 1) || ' million convertible note, pre-money valuation of $'
      || (custkey % 70 + 10) || ' million, post-money valuation of $' || (custkey % 70 + 30) || ' million'
    else 'FCA authorised ' || company || ' as payment institution in UK' end as title,
  case id % 4 when 0 then '' when 1 then 'The team plans hiring and a new product launch.'
    when 2 then 'Startup funding update by ' || vendor2 || '.' else 'Pricing and enterprise plan announced.' end as summary,
  case id % 11
    when 0 then 'https://techcrunch.com/news/' || custkey || '/'
    when 1 then 'https://www.reuters.com/markets/' || custkey || '#top'
    when 2 then 'http://www.prnewswire.com/news/' || custkey || '?ref=feed'
    when 3 then 'https://blog.' || tight || '.io/post/' || custkey
    when 4 then 'https://www.sec.gov/Archives/' || custkey
    when 5 then 'https://news.example.org/' || custkey
    when 6 then 'https://www.crunchbase.com/round/' || custkey
    when 7 then 'https://finsmes.com/' || custkey || '/'
    when 8 then 'https://github.com/' || tight || 'labs/app' || custkey
    when 9 then 'https://x.com/i/status/' || custkey end as url,
  case source when 'TechCrunch' then 'news' when 'Startup Feed' then 'rss_blog'
    when 'hackernews' then case when id % 2 = 0 then 'hackernews' else 'hn_algolia_show' end
    when 'x' then 'x_social' when 'company website' then 'site' when 'sec_edgar' then 'form_d_bulk'
    when 'ycombinator' then 'yc_directory' when 'esma_mica' then 'mica_casp'
    when 'producthunt' then 'launch' else 'profile' end as kind,
  case when template = 11 then 'regulatory' when id % 3 = 0 then 'vc' when id % 3 = 1 then 'general_startup'
    else 'general' end as category
from v_base""",
    "v_signals": """
select *, case when priority = '5-LOW' then cast(null as bigint) else true_company_id end as company_id,
  'k' || custkey || '-' || (id % 7) as signal_type,
  status <> 'O' as processed,
  case when source = 'company website' and status = 'P' then replace(payload, '"', '''') else payload end as data_json
from (select *, '{"title": "' || title || '", "summary": "' || summary || '"'
    || case when url is null then '' else ', "url": "' || url || '"' end
    || ', "kind": "' || kind || '", "category": "' || category || '"'
    || case source
      when 'Startup Feed' then ', "mentioned_companies": ["' || company || '"]'
      when 'hackernews' then ', "text": "Discussion of ' || company || ' at https://news.example.org/d/' || id
        || ' today.", "story_type": "' || case when id % 3 = 0 then 'funding' else 'discussion' end || '"'
      when 'x' then ', "text": "' || title || ' ' || coalesce(handle, '@nobody') || ' https://t.co/' || id
        || '", "author": "@desk' || (id % 5) || '", "companies_detected": ["' || company || '"], "urls": ["https://news.example.org/x/'
        || id || '"]'
      when 'sec_edgar' then ', "entity_name": "' || company || ' Inc", "entity_type": "Corporation", "headquarters": "Austin, TX"'
        || ', "jurisdiction": "DE", "year_of_inc": "' || (2000 + id % 20) || '", "total_offering_amount": "' || price
        || '", "total_amount_sold": "' || case when id % 2 = 0 then '' else cast(price - 1 as string) end
        || '", "cik": "' || custkey || '", "related_persons": [{"name": "Ann Lee ' || (id % 7)
        || '", "relationship": "Executive Officer"}, {"name": "Bo", "relationship": "Director"}, {"name": "Cy Ray ' || (id % 3)
        || '", "relationship": "Director"}]'
      when 'ycombinator' then ', "name": "' || company || '", "batch": "W' || (10 + id % 15) || '", "status": "Active"'
        || ', "industry": "B2B", "one_liner": "Tools by ' || company || '", "team_size": ' || (id % 90)
        || ', "website": "https://www.' || tight || '.io"'
      when 'esma_mica' then ', "commercial_name": "' || company || '", "lei": "LEI' || custkey
        || '", "home_member_state": "' || case id % 3 when 0 then 'DE' when 1 then 'FR' else 'NL' end
        || '", "authorisation_date": "' || substr(cast(detected_at as string), 1, 10) || '"'
      else '' end || '}' as payload from v_titles) t""",
    "v_event_rows": """
select id * 2 as id, id as raw_signal_id, status, priority, template, company_id as signal_company_id,
  case when priority = '4-NOT SPECIFIED' then cast(null as bigint) else company_id end as company_id,
  case when id % 17 = 3 then 'General News' when template = 7 and id % 5 = 0 then 'Funding Round'
    when template in (0, 6, 8) then 'Funding Round' when template = 1 then 'Product Launch'
    when template = 2 then 'Partnership' when template = 3 then 'Acquisition' when template = 4 then 'Hiring'
    when template = 5 then 'Research Publication' when template = 7 then 'General News'
    when template = 9 then 'Rumored Round' when template = 10 then 'Debt Financing'
    else 'Regulatory Update' end as event_type,
  case when id % 5 = 0 then cast(null as bigint)
    when template = 0 then (custkey % 90 + 1) * 1000000 when template = 8 then (custkey % 900 + 100) * 1000
    when template = 9 then (custkey % 40 + 10) * 1000000 when template = 10 then (custkey % 30 + 1) * 1000000 end as amount_usd,
  case when template = 6 then (custkey % 3 + 1) * 1000000000 end as valuation_usd,
  source, case when url is null then 'raw_signal:' || id when id % 6 = 0 then url || '#rs' || id else url end as source_url,
  cast(id % 60 + 30 as double) / 100 as confidence,
  case when id % 23 = 7 then '' else title end as description,
  substr(cast(detected_at as string), 1, 10) as announced_date, detected_at as created_at
from v_signals""",
    "v_events": """
select * from v_event_rows where status = 'F' or (status = 'P' and priority <> '3-MEDIUM')
union all
select id + 1 as id, raw_signal_id, status, priority, template, signal_company_id, company_id, event_type, amount_usd,
  valuation_usd, source, source_url, confidence, description, announced_date, created_at
from v_event_rows where status = 'F' and priority = '1-URGENT'""",
    "v_claims": """
select id, true_company_id as company_id, case when status = 'F' then id * 2 end as intelligence_event_id, id as raw_signal_id,
  case id % 8 when 0 then 'Series A' when 1 then 'Series B' when 2 then 'series c extension' when 3 then 'Seed' when 4 then 'Growth'
    when 5 then 'Series A' when 6 then 'Pre-Seed' else 'Funding Round' end as round_type,
  case when id % 9 = 0 then cast(null as bigint) else (custkey % 5 + 1) * 2000000 + (id % 3) * 100000 end as amount_usd,
  case when id % 4 = 0 then (custkey % 5 + 1) * 10000000 + (id % 2) * 500000 end as valuation_usd,
  case when id % 10 = 0 then (custkey % 5 + 1) * 12000000 end as post_money_valuation_usd,
  case when id % 14 = 0 then (custkey % 5 + 1) * 9000000 end as pre_money_valuation_usd,
  case when id % 5 = 4 then cast(null as string) else investor1 end as lead_investor,
  case when id % 3 = 0 then investor2 end as co1,
  case when id % 6 = 0 then vendor1 end as co2,
  case when id % 6 = 0 then '["' || investor2 || '", "' || vendor1 || '"]'
    when id % 3 = 0 then '["' || investor2 || '"]' end as co_investors,
  case when id % 13 = 0 then cast(null as string) else substr(cast(detected_at as string), 1, 10) end as announced_date,
  detected_at as extracted_at, source,
  case when url is null then 'raw_signal:' || id else url || '?c=' || id end as source_url,
  case id % 11 when 0 then 'tier1_media' when 1 then 'tier1_media' when 2 then 'press_wire' when 3 then 'company_official'
    when 4 then 'regulatory' when 6 then 'industry_db' when 7 then 'tier1_media' else 'unknown' end as source_tier,
  cast(case id % 11 when 0 then 78 when 1 then 78 when 2 then 88 when 3 then 100 when 4 then 95 when 6 then 72 when 7 then 72
    else 50 end as double) / 100 as source_weight,
  id % 11 in (3, 4) as is_official, template = 9 and priority = '5-LOW' as is_rumor,
  case when id % 15 = 0 then cast(null as double) else cast(id % 6 * 11 + 41 as double) / 100 end as extraction_confidence,
  case when id % 7 = 0 then cast(null as string) when template = 10 then 'convertible_note' else 'equity' end as instrument_type,
  case when id % 2 = 0 then 'USD' end as currency, title as headline, summary as snippet
from v_signals""",
    "v_metrics": """
select l.l_orderkey * 10 + l.l_linenumber as id, c.company_id, l.l_shipdate as extracted_at,
  cast(l.l_quantity as bigint) * 40 as star_growth_30d, cast(floor(l.l_extendedprice) as bigint) % 300 as commits_last_30d,
  l.l_suppkey % 50 as contributor_count,
  case l.l_linenumber % 4 when 0 then 'Python' when 1 then 'Go' when 2 then 'Rust' else 'TypeScript' end as primary_language
from lineitem l join part p on p.p_partkey = l.l_partkey join v_companies c on c.name = p.p_name""",
    "v_team": """
select id, true_company_id as company_id, 'Member ' || chr(cast(65 + custkey % 9 as int)) as name,
  'member ' || chr(cast(97 + custkey % 9 as int)) as name_normalized,
  case id % 5 when 0 then 'CEO' when 1 then 'VP Sales' when 2 then 'Head of Product' when 3 then 'Founder' end as role,
  id % 5 = 3 as is_founder,
  case when id % 3 = 0 then substr(cast(detected_at as string), 1, 10) end as joined_date,
  case when id % 4 = 0 then 'https://linkedin.example/in/' || id end as linkedin_url,
  source, coalesce(url, 'raw_signal:' || id) || '#team-' || id as source_url,
  case when id % 11 in (3, 4) then 'company_official' else 'rss' end as source_tier,
  cast(case id % 11 when 2 then 883 when 3 then 1000 when 4 then 951 when 6 then 723 else 617 end - id % 13 as double) / 1000 as source_weight,
  id % 11 in (3, 4) as is_official, cast(id % 6 * 11 + 41 as double) / 100 as extraction_confidence
from v_signals""",
    "v_products": """
select id, company_id, 'Nova ' || replace(name, 'Member ', '') as name, 'nova ' || replace(name_normalized, 'member ', '') as name_normalized,
  case when id % 2 = 0 then 'Release ' || id end as description, case id % 3 when 0 then 'product' when 1 then 'yc' end as category,
  case when id % 5 = 0 then 'beta' else 'active' end as status, linkedin_url as product_url, joined_date as launch_date,
  source, source_url, source_tier, source_weight, is_official, extraction_confidence from v_team""",
    "v_licenses": """
select id, company_id, case id % 3 when 0 then 'UK' when 1 then 'EU' else 'US' end as jurisdiction,
  case id % 4 when 0 then 'MiCA CASP' when 1 then 'payment_institution' when 2 then 'financial_services' else 'Form D exemption' end as license_type,
  case when id % 5 = 0 then 'filed' else 'authorized' end as status,
  case id % 3 when 0 then 'FCA' when 1 then 'ESMA' end as regulator, case when id % 2 = 0 then 'N' || id end as license_number,
  joined_date as effective_date, source, source_url, source_tier, source_weight, is_official, extraction_confidence from v_team""",
    "v_profile": """
select id, company_id, case id % 8 when 0 then 'industry' when 1 then 'headquarters' when 2 then 'team_size' when 3 then 'founded_year'
    when 4 then 'business_model' when 5 then 'description_long' when 6 then 'website_url' else 'entity_type' end as field_key,
  case id % 8 when 0 then 'Sector ' || (id % 5) when 1 then 'City ' || (id % 9) when 2 then cast(id % 400 as string)
    when 3 then case when id % 3 = 0 then 'n/a' else cast(2000 + id % 20 as string) end
    when 4 then 'b2b' when 5 then 'About ' || name when 6 then 'https://site' || (id % 6) || '.example' else 'Corporation' end as field_value,
  source, source_url, source_tier, source_weight, is_official, extraction_confidence from v_team""",
    "v_jobs": """
select p_partkey as id, c.company_id, c.website, 
  case p_partkey % 7 when 0 then 'Senior ' when 1 then 'Junior ' when 2 then 'Staff ' when 3 then 'VP ' when 4 then 'Contract '
    when 5 then 'Intern ' else '' end
  || case p_type when 'ECONOMY' then 'Backend Engineer' when 'LARGE' then 'Data   Scientist' when 'MEDIUM' then 'Account Manager'
    when 'PROMO' then 'Designer' when 'SMALL' then 'Platform Engineer' else 'Recruiter' end as title,
  case p_size % 4 when 0 then 'Python, PostgreSQL, AWS. $' || (p_size + 100) || 'k-$' || (p_size + 140) || 'k. Remote US.'
    when 1 then 'Rust and Kubernetes. Pay $' || (p_size * 1000) || ' - $' || (p_size * 2000) || '. Hybrid remote.'
    when 2 then 'TypeScript, React, Kafka. $90k+ onsite.' else '' end as description,
  case p_size % 5 when 0 then 'Berlin' when 1 then 'Remote' when 2 then 'New York' when 3 then 'London' end as location,
  case p_size % 3 when 0 then 'Engineering' when 1 then 'Sales' end as department,
  case when p_size % 6 = 0 then 'Core' end as team, case when p_size % 8 = 0 then 'part-time' end as commitment,
  case p_partkey % 5 when 0 then 'https://boards.greenhouse.io/' || replace(c.name, ' ', '') || '/jobs/' || p_size
    when 1 then 'https://jobs.lever.co/' || replace(c.name, ' ', '') || '/' || p_partkey
    when 2 then 'https://careers.' || replace(c.name, ' ', '') || '.io/' || p_partkey when 3 then 'https://news.example.org/jobs/' || p_partkey
    else '' end as source_url,
  case p_partkey % 5 when 0 then 'greenhouse' when 1 then 'lever' when 2 then 'company_careers' when 3 then 'rss' else 'blog' end as source,
  case p_partkey % 5 when 0 then 'greenhouse' when 1 then 'lever' when 2 then 'company_careers' end as ats_platform,
  case when p_partkey % 5 < 2 then cast(p_size as string) end as external_id,
  cast(date '2001-06-01' + (p_size * 2 - 30) as string) as posted_at
from part join v_companies c on c.name = part.p_name""",
}


def needed(sql: str) -> list[str]:
    """Views a statement refers to, in definition order, dependencies included."""
    wanted, frontier = set(), [sql]
    while frontier:
        text = frontier.pop()
        for name in VIEWS:
            if name not in wanted and re.search(rf"\b{name}\b", text):
                wanted.add(name)
                frontier.append(VIEWS[name])
    return [name for name in VIEWS if name in wanted]


def with_views(sql: str, **extra: str) -> str:
    """The statement with the views (and extra named parts) it uses put in front."""
    parts = dict(extra)
    closure = sql + " ".join(parts.values())
    ctes = [f"{name} as ({VIEWS[name]})" for name in needed(closure)]
    ctes += [f"{name} as ({text})" for name, text in parts.items()]
    if not ctes:
        return sql
    # a part that reads itself makes the statement recursive
    loops = any(re.search(rf"\bjoin {name}\b", text) for name, text in parts.items())
    return f"with {'recursive ' if loops else ''}{', '.join(ctes)}\n{sql}"


#: Tables whose rows carry the work; the others are looked up.
FACTS = {"orders", "lineitem", "documents", "pages", "events", "conversations"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, as its files lie. A session for one machine can ask for scans of fact tables to be spread over its
    cores (``spark.dealweave.spread``), since the small test tables are single files that Spark cannot split."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    spread = int(spark.conf.get("spark.dealweave.spread", "0"))
    return df.repartition(spread) if spread > 1 and name in FACTS else df


#: Views that stand for landed tables. They are written once per session to the shared folder and
#: read back, so queries scan stored columns instead of carrying the wording above in their plans.
STORED = [
    "v_companies", "v_signals", "v_events", "v_claims", "v_metrics", "v_team", "v_products",
    "v_licenses", "v_profile", "v_jobs",
]

#: Columns that are only a step to another one; no reader of the written table names them.
STEPS = {"v_signals": ["payload"]}

_READ: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table or view as a DataFrame; only the tables it needs are opened."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key in _READ:
        return _READ[key]
    if name in TABLES:
        _READ[key] = read(spark, sf_dir, name)
        return _READ[key]
    inline, frontier = [], [name]
    while frontier:
        text = VIEWS[frontier.pop()]
        for other in [*TABLES, *VIEWS]:
            if not re.search(rf"\b{other}\b", text) or other in inline:
                continue
            if other in TABLES or other in STORED:
                table(spark, sf_dir, other).createOrReplaceTempView(other)
            else:
                inline.append(other)
                frontier.append(other)
    ctes = ", ".join(f"{v} as ({VIEWS[v]})" for v in VIEWS if v in inline)
    df = spark.sql(f"with {ctes} {VIEWS[name]}" if ctes else VIEWS[name])
    if name in STORED:
        folder = f"{shared_folder(spark)}/dealweave-views/{key[0]}/{sf_dir.strip('/').replace('/', '_')}/{name}"
        df.drop(*STEPS.get(name, [])).write.mode("overwrite").parquet(folder)
        df = spark.read.parquet(folder)
    _READ[key] = df
    return df

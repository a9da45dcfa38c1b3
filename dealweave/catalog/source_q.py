"""Landed shapes: text the given tables are written into, read back through the source code."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import series, social, web
from ..session import shared_folder
from ..sources import files, landed
from .registry import query


def _folder(t) -> str:
    return f"{shared_folder(t.spark)}/dealweave-landed/{uuid.uuid4().hex}"


def _arrays(t, rows, key: str) -> str:
    """A folder of files of one json array each, of about 1,000 rows."""
    folder, n = _folder(t), max(1, rows.count() // 1000)
    dealt = rows.groupBy(F.pmod(F.xxhash64(key), F.lit(n)).alias("part")).agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value"))
    dealt.repartition("part").write.partitionBy("part").text(folder)
    return folder


@query("scan_staged_signals", """
select source, url, company_id, case when id % 3 = 0 then 'k' || id else substr(sha256(regexp_replace(regexp_extract(url, '^([^#?]*)', 1), '/+$', '') || regexp_extract(url, '(\\?[^#]*)', 1)), 1, 16) end as signal_type, detected_at
from v_signals where url is not null or id % 3 = 0""")
def _(t):
    s = t("v_signals").select(
        "source", "url", "company_id", F.col("detected_at").cast("string").alias("detected_at"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("k"), F.col("id").cast("string"))).alias("dedup_key"),
        F.struct("title", "summary").alias("data"))
    lines = s.select(F.to_json(F.struct("*")).alias("value"))
    return landed.staged_lines(lines).select("source", "url", "company_id", "signal_type", F.col("detected_at").cast("timestamp_ntz").alias("detected_at"))


@query("scan_form_d", """
select 'A' || o.o_orderkey as accession, 'Issuer ' || o.o_custkey as entity_name, 'Austin, TX' as headquarters, cast(cast(floor(o.o_totalprice) as bigint) as string) as total_offering_amount,
  coalesce(p.n, 0) as persons from orders o
left join (select l_orderkey, count(*) as n from lineitem group by l_orderkey) p on p.l_orderkey = o.o_orderkey where o.o_orderstatus <> 'P'""")
def _(t):
    o = t("orders")
    acc = F.concat(F.lit("A"), F.col("o_orderkey").cast("string")).alias("ACCESSIONNUMBER")
    issuers = o.select(
        acc, F.when(F.col("o_orderstatus") != "P", "yes").otherwise("NO").alias("IS_PRIMARYISSUER_FLAG"), F.concat(F.lit("Issuer "), "o_custkey").alias("ENTITYNAME"),
        F.col("o_custkey").cast("string").alias("CIK"), F.lit("Corporation").alias("ENTITYTYPE"), F.lit("Austin ").alias("CITY"), F.lit("TX").alias("STATEORCOUNTRY"),
        F.lit("DE").alias("JURISDICTIONOFINC"), F.lit("2010").alias("YEAROFINC_VALUE_ENTERED"))
    offers = o.select(acc, F.floor("o_totalprice").cast("string").alias("TOTALOFFERINGAMOUNT"), F.lit("").alias("TOTALAMOUNTSOLD"), F.lit(1).alias("line"))
    people = t("lineitem").select(
        F.concat(F.lit("A"), F.col("l_orderkey").cast("string")).alias("ACCESSIONNUMBER"), F.concat(F.lit("P"), "l_suppkey").alias("FIRSTNAME"), F.lit("Q").alias("LASTNAME"),
        F.lit("Director").alias("RELATIONSHIP"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("line"))
    out = landed.form_d(issuers, offers, people)
    return out.select("accession", "entity_name", "headquarters", "total_offering_amount", F.coalesce(F.size("related_persons"), F.lit(0)).cast("bigint").alias("persons"))


@query("scan_filings_columnar", """
select cast(o_custkey as string) as cik, case o_orderstatus when 'F' then 'D' else 'D/A' end as form, substr(cast(o_orderdate as string), 1, 10) as filing_date, 'N' || o_orderkey as accession
from orders where o_orderstatus <> 'P' and o_orderdate >= timestamp '1998-01-01'""")
def _(t):
    form = F.when(F.col("o_orderstatus") == "F", "D").when(F.col("o_orderstatus") == "O", "D/A").otherwise("10-K").alias("form")
    row = F.struct(form.alias("form"), F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("date"), F.concat(F.lit("N"), F.col("o_orderkey").cast("string")).alias("acc"))
    own = t("orders").groupBy(F.col("o_custkey").cast("string").alias("cik")).agg(F.collect_list(row).alias("f"))
    side = lambda name, alias: F.transform("f", lambda x: x[name]).alias(alias)
    one = own.select("cik", F.struct(F.struct(side("form", "form"), side("date", "filingDate"), side("acc", "accessionNumber")).alias("recent")).alias("filings"))
    read = files.read_json(t.spark, _arrays(t, one, "cik"), landed.SUBMISSIONS_SCHEMA)
    return landed.filings_columnar(read.rows, "1998-01-01").drop("dedup_key")


@query("scan_yc_directory", """
select b.id as row_id, b.slug, coalesce(b.website, 'https://www.ycombinator.com/companies/' || b.slug) as url, coalesce(s.company_id, c.company_id) as company_id from (
  select id, vendor1 as vendor, company, replace(lower(company), ' ', '-') as slug, case when id % 2 = 0 then 'https://www.' || tight || '.io' end as website from v_base) b
left join v_companies s on b.website = 'https://www.' || replace(s.name, ' ', '') || '.io' left join v_companies c on c.name = b.company""")
def _(t):
    b = t("v_base").withColumnRenamed("company", "name")
    e = b.select(F.col("id").alias("row_id"), "name", F.lit("").alias("slug"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("https://www."), "tight", F.lit(".io"))).alias("website"))
    read = files.read_json(t.spark, _arrays(t, e, "row_id"), "row_id long, name string, slug string, website string")
    return landed.yc_directory(read.rows, t("v_companies")).select("row_id", "slug", "url", "company_id")


@query("scan_mica_register", """
select b.id as row_id, 'mica_L' || b.id as dedup_key, c.company_id from v_base b join v_companies c on c.name = b.company where b.id % 4 <> 3""")
def _(t):
    b = t("v_base")
    name = F.when(F.col("id") % 4 == 3, F.lit("Zqxjv Wkkpt Holdings")).otherwise(F.col("company"))
    e = b.select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 2 == 0, name).otherwise("").alias("ae_commercial_name"), name.alias("ae_lei_name"),
        F.lit("").alias("ae_website"), F.concat(F.lit("L"), F.col("id").cast("string")).alias("ae_lei"))
    folder = _folder(t)
    e.write.option("header", True).csv(folder)
    # lines that are no rows of the register, in files of their own
    torn = b.filter("id % 10 = 0").select(F.concat(F.lit("torn "), F.col("id").cast("string"), F.lit(",x")).alias("value"))
    torn.repartition(1).write.mode("append").text(folder)  # only the lines go to one task, not the join before them
    rows, unreadable, counts = files.quarantine(files.read_csv(t.spark, folder, "row_id long, ae_commercial_name string, ae_lei_name string, ae_website string, ae_lei string"), f"{folder}-read")
    if counts["rows"] + counts["unreadable"] != e.count() + max(0, torn.count() - 1):  # a file's first line is its header
        raise ValueError(f"lines of the register got lost: {counts}")
    return landed.mica_register(rows, t("v_companies")).select("row_id", "dedup_key", "company_id")


@query("scan_rss_items")
def _(t):
    s = t("v_signals").select(
        F.concat(F.lit("feed "), F.col("custkey").cast("string")).alias("feed"), "category", F.col("id").alias("position"), "title",
        F.col("url").alias("link"), "summary", F.col("detected_at").cast("timestamp").alias("published"))
    import datetime as dt

    out = landed.feed_entries(s, t("v_companies"), t.now().replace(tzinfo=dt.timezone.utc))
    return out.select("feed", "position", "title", "high_signal", F.array_join("mentions", "|").alias("mentions"))


@query("scan_hn_stories", """
select s.id, s.url, case when s.title like 'Show HN%' then 'show_hn' when contains(lower(s.title), 'launch') then 'launch' when regexp_matches(lower(s.title), 'funding|raised|series|seed') then 'funding'
  when regexp_matches(lower(s.title), 'acquired|acquisition|bought') then 'acquisition' else 'discussion' end as story_type, coalesce(k.n, 0) as comments
from (select id, template, coalesce(url, 'https://news.ycombinator.com/item?id=' || id) as url, case when template = 5 then 'Show HN: ' || title else title end as title from v_signals) s
left join (select l_orderkey, count(*) filter (where length(trim(l_returnflag || ' comment on the launch with enough words ' || l_partkey)) > 40) as n from
  (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) rn, count(*) over (partition by l_orderkey) as c from lineitem) l where c >= 3 group by l_orderkey) k on k.l_orderkey = s.id
where regexp_matches(lower(s.title), 'launch|show hn|startup|funding|raised|series a|series b|seed|acquired|open source|github|api|saas|developer tools|led by|million|valuation|round|hiring|platform|marketplace|fintech|health|raises|series c|pre-seed|billion|closes|closed|secured|investors|acquisition|introducing|debuts|ipo')""")
def _(t):
    from pyspark.sql import Window

    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    lines = t("lineitem").withColumn("rn", F.row_number().over(order))
    cid = F.col("l_orderkey") * 1000 + 900_000_000 + F.col("rn")
    comments = lines.select(
        cid.alias("id"), F.lit("comment").alias("type"), F.lit(None).cast("string").alias("title"),
        F.concat("l_returnflag", F.lit(" comment on the <i>launch</i> with enough words "), F.col("l_partkey").cast("string")).alias("text"),
        F.lit(None).cast("string").alias("url"), F.lit(None).cast("array<bigint>").alias("kids"), F.lit(0).cast("bigint").alias("descendants"))
    comments = comments.withColumn("text", F.replace("text", F.lit("<i>launch</i>"), F.lit("launch")))
    kids = lines.groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(cid)).alias("kids"), F.count("*").alias("descendants"))
    title = F.when(F.col("template") == 5, F.concat(F.lit("Show HN: "), "title")).otherwise(F.col("title"))
    stories = t("v_signals").select("id", F.lit("story").alias("type"), title.alias("title"), F.lit("").alias("text"), "url").join(kids, "id", "left")
    folder = _folder(t)
    stories.unionByName(comments).select(F.to_json(F.struct("*")).alias("value")).write.text(folder)
    out = files.thread_stories(files.payloads(t.spark, folder).rows)
    return out.select("id", "url", "story_type", F.size("comments").cast("bigint").alias("comments"))


@query("thread_comments", """
select l_orderkey as id, count(*) as comments from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) rn,
  count(*) over (partition by l_orderkey) as c from lineitem) l where c >= 3 group by l_orderkey""")
def _(t):
    from pyspark.sql import Window

    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    lines = t("lineitem").withColumn("rn", F.row_number().over(order)).withColumn("cid", F.col("l_orderkey") * 1000 + F.col("rn"))
    stories = lines.groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list("cid")).alias("kids"), F.count("*").alias("descendants"))
    body = F.concat(F.lit("<p>a reply that is long enough to be kept as context "), F.col("cid").cast("string"))
    comments = lines.select(F.col("cid").alias("id"), F.lit("comment").alias("type"), body.alias("text"))
    return social.thread_comments(stories, comments).select("id", F.size("comments").cast("bigint").alias("comments"))


STORY = "case when starts_with(low, 'show hn') then 'show_hn' when contains(low, 'launch') or contains(low, 'introducing') then 'launch' when regexp_matches(low, 'funding|raised|series|seed') then 'funding' when regexp_matches(low, 'acquired|acquisition|bought') then 'acquisition' when contains(low, 'open source') then 'open_source' else 'discussion' end"


@query("story_type", f"select id, {STORY} as story_type from (select id, lower(title) as low from v_signals) x")
def _(t):
    return t("v_signals").select("id", social.story_type(F.col("title")).alias("story_type"))


@query("social_category", """
select id, case when regexp_matches(low, 'raised|funding|series a|series b|seed round|pre-seed') then 'funding' when regexp_matches(low, 'launch|introducing|announcing|shipped') then 'product_launch'
  when regexp_matches(low, 'hiring|join our team|open roles') then 'hiring' when regexp_matches(low, 'acquired|acquisition|acquires') then 'acquisition' else 'social_momentum' end as category
from (select id, lower(title || ' ' || summary) as low from v_signals) x""")
def _(t):
    return t("v_signals").select("id", social.social_category(F.concat_ws(" ", "title", "summary")).alias("category"))


@query("startup_relevance_filter", """
select id from v_signals where regexp_matches(lower(title), 'launch|show hn|startup|funding|raised|series a|series b|seed|acquired|open source|github|api|saas|developer tools|led by|million|valuation|round|hiring|platform|marketplace|fintech|health|raises|series c|pre-seed|billion|closes|closed|secured|investors|acquisition|introducing|debuts|ipo')""")
def _(t):
    return t("v_signals").filter(social.startup_relevant(F.col("title"), F.lit(""))).select("id")


@query("scan_social_posts", """
select cast(id as string) as post_id, title || ' https://t.co/' || id as text, 'desk' || (id % 5) as author, id % 90 as likes, 'https://x.com/desk' || (id % 5) || '/status/' || id as url,
  'https://t.co/' || id || ' https://news.example.org/' || id as urls from v_signals""")
def _(t):
    s = t("v_signals")
    sid = F.col("id").cast("string")
    author = F.concat(F.lit("desk"), (F.col("id") % 5).cast("string"))
    tweet = F.struct(
        sid.alias("id"), F.concat("title", F.lit(" https://t.co/"), sid).alias("text"), F.lit("2024-01-01T00:00:00Z").alias("created_at"), F.lit("u1").alias("author_id"),
        F.struct((F.col("id") % 90).alias("like_count")).alias("public_metrics"),
        F.struct(F.array(F.struct(F.concat(F.lit("https://news.example.org/"), sid).alias("expanded_url"))).alias("urls")).alias("entities"))
    users = F.struct(F.array(F.struct(F.lit("u1").alias("id"), author.alias("username"))).alias("users"))
    folder = _folder(t)
    s.select(F.to_json(F.struct(F.array(tweet).alias("data"), users.alias("includes"))).alias("value")).write.text(folder)
    out = files.social_posts(files.payloads(t.spark, folder).rows)
    return out.select("post_id", "text", "author", "likes", "url", F.array_join("urls", " ").alias("urls"))


@query("social_batches", """
select case id % 4 when 0 then 'q' || company when 1 then 'grok_query' when 2 then 'inline_post' else 'q2' end as query, cast(id as string) as post_id, title as text, case when id % 4 = 0 then id % 7 else 0 end as likes from v_signals""")
def _(t):
    s = t("v_signals")
    sid = F.col("id").cast("string").alias("post_id")
    post = F.struct(sid, F.col("title").alias("text"))
    k = F.col("id") % 4
    value = (
        F.when(k == 0, F.to_json(F.struct(F.concat(F.lit("q"), "company").alias("query"), F.array(F.struct(sid, F.col("title").alias("text"), (F.col("id") % 7).alias("likes"))).alias("results"))))
        .when(k == 1, F.to_json(F.struct(F.array(post).alias("posts")))).when(k == 2, F.to_json(post))
        .otherwise(F.to_json(F.array(F.struct(F.lit("q2").alias("search"), F.array(post).alias("results"))))))
    return social.social_batches(s.select(value.alias("value"))).select("query", "post_id", "text", "likes")


BOARD_ROWS = "select p_partkey as id, p_name, p_size, p_brand, case p_partkey % 3 when 0 then 'greenhouse' when 1 then 'lever' else 'ashby' end as board from part"


@query("scan_job_boards", f"""
select board as ats_platform, cast(id as string) as external_id, 'Engineer ' || p_name as title, p_brand as department, 'https://b.example/' || id as source_url, '2001-05-' || (10 + p_size % 20) as posted_at from ({BOARD_ROWS}) x""")
def _(t):
    p = t("part").select(F.col("p_partkey").cast("string").alias("id"), F.concat(F.lit("Engineer "), "p_name").alias("title"), "p_brand", "p_name", F.concat(F.lit("https://b.example/"), F.col("p_partkey").cast("string")).alias("u"), F.concat(F.lit("2001-05-"), (10 + F.col("p_size") % 20).cast("string"), F.lit("T08:00:00")).alias("at"), (F.col("p_partkey") % 3).alias("k"))
    g = F.to_json(F.struct(F.array(F.struct("id", "title", F.col("u").alias("absolute_url"), F.col("at").alias("updated_at"), F.lit("<p>Go</p>").alias("content"), F.array(F.struct(F.col("p_brand").alias("name"))).alias("departments"))).alias("jobs")))
    lv = F.to_json(F.array(F.struct("id", F.col("title").alias("text"), F.col("u").alias("hostedUrl"), F.col("at").alias("createdAt"), F.struct(F.col("p_brand").alias("department")).alias("categories"))))
    a = F.to_json(F.struct(F.array(F.struct("id", "title", F.col("u").alias("jobUrl"), F.col("at").alias("publishedAt"), F.col("p_brand").alias("department"))).alias("jobs")))
    k = F.col("k")
    folder = _folder(t)
    p.select(F.when(k == 0, g).when(k == 1, lv).otherwise(a).alias("value")).write.text(folder)
    return files.job_shapes(files.payloads(t.spark, folder).rows).select("ats_platform", "external_id", "title", "department", "source_url", "posted_at")


@query("union_job_shapes", f"""
select board as ats_platform, cast(id as string) as external_id, 'Engineer ' || p_name as title from ({BOARD_ROWS}) x""")
def _(t):
    # postings of all boards, stories and posts lie in one folder; each payload goes by its shape
    folder = _folder(t)
    p = t("part").select(F.col("p_partkey").cast("string").alias("id"), F.concat(F.lit("Engineer "), "p_name").alias("title"), F.concat(F.lit("https://b.example/"), F.col("p_partkey").cast("string")).alias("u"), (F.col("p_partkey") % 3).alias("k"))
    k = F.col("k")
    g = F.to_json(F.struct(F.array(F.struct("id", "title", F.col("u").alias("absolute_url"))).alias("jobs")))
    lv = F.to_json(F.array(F.struct("id", F.col("title").alias("text"), F.col("u").alias("hostedUrl"))))
    a = F.to_json(F.struct(F.array(F.struct("id", "title", F.col("u").alias("jobUrl"))).alias("jobs")))
    p.select(F.when(k == 0, g).when(k == 1, lv).otherwise(a).alias("value")).write.text(folder)
    _hits(t).write.mode("append").text(folder)
    t("v_signals").select(F.concat(F.lit("{torn "), "title").alias("value")).write.mode("append").text(folder)
    return files.job_shapes(files.payloads(t.spark, folder).rows).select("ats_platform", "external_id", "title")


def _hits(t):
    """Search hits, one payload a line."""
    hit = F.struct(F.col("id").cast("string").alias("objectID"), F.concat(F.lit("Show HN: "), "title").alias("title"), "url", (F.col("id") % 50).alias("points"))
    return t("v_signals").select(F.to_json(F.struct(F.array(hit).alias("hits"))).alias("value"))


@query("scan_search_hits", """
select id, trim('Show HN: ' || title) as title, coalesce(url, 'https://news.ycombinator.com/item?id=' || id) as url, 'show_hn' as story_type, id % 50 as points from v_signals""")
def _(t):
    folder = _folder(t)
    _hits(t).write.text(folder)
    return files.thread_stories(files.payloads(t.spark, folder).rows).select("id", "title", "url", "story_type", "points")


@query("scan_repo_metrics", """
select r.org, r.repo, l.primary_language, l.primary_percent, c.n as contributor_count from (select p_name as org, 'r' || min(p_partkey) as repo from part where p_size > 3 group by p_name) r
left join (select repo, max_by(language, (bytes, language)) as primary_language, round(max(bytes) / cast(sum(bytes) as double) * 100, 1) as primary_percent from (
  select 'r' || l_partkey as repo, l_shipinstruct as language, cast(sum(l_quantity) as bigint) as bytes from (select l_partkey, l_returnflag || l_linestatus as l_shipinstruct, l_quantity from lineitem) z group by 1, 2) q group by repo) l using (repo)
left join (select 'r' || l_partkey as repo, count(*) as n from lineitem group by l_partkey) c using (repo)""")
def _(t):
    name = F.concat(F.lit("r"), F.col("p_partkey").cast("string"))
    repos = t("part").select(F.col("p_name").alias("org"), F.col("p_partkey").alias("position"), name.alias("name"), (F.col("p_size") <= 3).alias("fork"), F.col("p_size").alias("stars"), F.lit("Go").alias("language"))
    owned = t("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("org"))
    l = t("lineitem").join(owned, "l_partkey").withColumn("name", F.concat(F.lit("r"), F.col("l_partkey").cast("string")))  # noqa: E741
    langs = l.groupBy("org", "name", F.concat("l_returnflag", "l_linestatus").alias("language")).agg(F.sum("l_quantity").cast("bigint").alias("bytes"))
    people = l.select("org", "name", F.col("l_suppkey").cast("string").alias("login"), F.col("l_linenumber").alias("contributions"))
    out = landed.repo_metrics(repos, langs, people)
    return out.select("org", "repo", "primary_language", "primary_percent", "contributor_count")


@query("repo_growth", """
select a.company_id, a.day, a.commits, a.contributors, a.commits - b.commits as commits_growth, a.contributors - b.contributors as contributors_growth
from daily a asof left join daily b on b.company_id = a.company_id and a.due >= b.day""",
       daily="""select *, cast(day - interval 30 day as date) as due from (select company_id, cast(extracted_at as date) as day, cast(sum(commits_last_30d) as bigint) as commits,
  max(contributor_count) as contributors from v_metrics group by 1, 2) d""")
def _(t):
    daily = t("v_metrics").groupBy("company_id", F.col("extracted_at").cast("date").alias("day")).agg(
        F.sum("commits_last_30d").alias("commits"), F.max("contributor_count").alias("contributors"))
    return series.growth(daily, "company_id", "day", ["commits", "contributors"], 30)


@query("feed_catalog_summary", """
select category, count(*) as total, count(*) filter (where enabled) as enabled, count(*) filter (where not enabled) as disabled from (select source as category, n_chars > 500 as enabled from documents) d group by rollup (category)""")
def _(t):
    return landed.feed_catalog_summary(t("documents").select(F.col("source").alias("category"), (F.col("n_chars") > 500).alias("enabled")))


# -- pages --------------------------------------------------------------------------------------------

SNAP = """select page_id, url, regexp_replace(lower(regexp_extract(url, '//([^/?#:]*)', 1)), '^(www|m)\\.', '') as host, substr(trim(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)), 1, 200) as title,
  substr(trim(regexp_extract(html, '(?is)name="description".*?content="(.*?)"', 1)), 1, 500) as meta_description, substr(sha256(html), 1, 32) as hash, length(html) as size from pages"""


def snapshots(t):
    from ..functions.text import authority_host

    p = t("pages").withColumn("s", web.page_snapshot(F.col("html")))
    host = F.regexp_replace(F.regexp_replace(authority_host(F.col("url")), ":.*$", ""), r"^(www|m)\.", "")
    return p.select("page_id", "url", host.alias("host"), "s.*")


@query("scan_web_pages", "select page_id, title, meta_description, hash, size from snaps", snaps=SNAP)
def _(t):
    return snapshots(t).select("page_id", "title", "meta_description", "hash", F.col("size").cast("bigint").alias("size"))


@query("website_changes", """
select page_id, host, hash <> ph as content_changed, title <> pt as title_changed, pt as title_from from (select *, lag(hash) over w as ph, lag(title) over w as pt from snaps window w as (partition by host order by page_id)) x
where ph is not null and (hash <> ph or title <> pt)""", snaps=SNAP)
def _(t):
    return web.website_changes(snapshots(t), "host", "page_id").select("page_id", "host", "content_changed", "title_changed", "title_from")


PLAIN_PAGE = "trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'))"


@query("page_profile_fields", r"""
select page_id, try_cast(nullif(regexp_extract(txt, '(?i)(\d+)\+?\s*(?:employees?|team members?|people)', 1), '') as int) as team_size,
  try_cast(nullif(regexp_extract(txt, '(?i)founded\s+(?:in\s+)?(\d{4})', 1), '') as int) as founded_year,
  cast(len(regexp_extract_all(html, '(?i)<a[^>]*href=["''][^"'']*(?:job|career|position)')) as int) as hiring_count,
  case when contains(low, 'api') then 'API' when regexp_matches(low, 'enterprise|contact sales') then 'Enterprise SaaS'
    when regexp_matches(low, '/mo|monthly|per month|plan') then 'SaaS' when regexp_matches(low, 'open source|github') then 'Open Source' end as business_model
from (select *, lower(txt) as low from plain_pages) p""", plain_pages=f"select page_id, html, {PLAIN_PAGE} as txt from pages")
def _(t):
    return t("pages").withColumn("f", web.page_fields(F.col("html"))).select("page_id", "f.*")


@query("tech_detect", " union ".join(
    f"select page_id, '{c}' as category, '{n}' as technology from pages where regexp_matches(lower(html), '{p.lower()}')" for c, n, p in web.TECH_PATTERNS))
def _(t):
    return web.tech_detect(t("pages"), "page_id").drop("confidence")


@query("scan_listing_headlines", """
select title, page_id, href from (select *, row_number() over (partition by title order by page_id, pos) rn from (
  select page_id, unnest(generate_series(1, len(a))) as pos, unnest(a) as href, trim(regexp_replace(unnest(b), '<[^>]+>', ' ', 'g')) as title from (
    select page_id, regexp_extract_all(html, '(?is)<a\\s[^>]*href=["'']([^"'']*/[^"'']*)["''][^>]*>(.*?)</a>', 1) as a, regexp_extract_all(html, '(?is)<a\\s[^>]*href=["'']([^"'']*/[^"'']*)["''][^>]*>(.*?)</a>', 2) as b from pages) p) q
  where length(title) >= 15) r where rn = 1""")
def _(t):
    return web.listing_headlines(t("pages"), words=[], href="/").select("title", "page_id", "href")


LANGS = "select p.p_name as org, l.l_returnflag || l.l_linestatus as language, l.l_quantity from lineitem l join part p on p.p_partkey = l.l_partkey"


def language_rows(t):
    p = t("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("org"))
    return t("lineitem").join(p, "l_partkey").select("org", F.concat("l_returnflag", "l_linestatus").alias("language"), F.col("l_quantity").cast("bigint").alias("bytes"))


@query("tech_share", f"""
select org, lower(language) as technology, round(share, 6) as share, round(least(0.5e0 + share * 0.5e0, 0.95e0), 6) as confidence from (
  select org, language, cast(count(*) as double) / sum(count(*)) over (partition by org) as share from ({LANGS}) l group by org, language) x where share > 0.1""")
def _(t):
    return web.tech_share(language_rows(t), "org", "language")


@query("language_share", f"""
select org, language, round(cast(sum(l_quantity) as double) / sum(sum(l_quantity)) over (partition by org) * 100, 1) as percent from ({LANGS}) l group by org, language""")
def _(t):
    return web.language_share(language_rows(t), "org", "language", "bytes")


@query("org_language_mix", f"""
select org, language, bytes, rn as position from (select org, language, bytes, row_number() over (partition by org order by bytes desc, language) rn from (
  select org, language, cast(sum(l_quantity) as bigint) as bytes from ({LANGS}) l group by org, language) a) b where rn <= 8""")
def _(t):
    return web.language_mix(language_rows(t), "org", "language", "bytes").withColumn("position", F.col("position").cast("bigint"))


@query("append_snapshots", """
select page_id, hash from snaps where page_id % 2 = 0 union all select page_id, hash from snaps where page_id % 2 = 1""", snaps=SNAP)
def _(t):
    s = snapshots(t).select("page_id", "hash")
    return web.append_snapshots(s.filter("page_id % 2 = 0"), s, ["page_id"])

"""Which tracked company a signal is about.

Every strategy is an equi-join on something both sides can be cut into (host, alias, piece of text,
string segment), so no strategy compares all signals with all companies. Names are matched once
per distinct name; names and aliases within texts are found by word postings.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import alias_key, base_domain, capture, filled, link_host, strip
from ..session import shared_folder
from . import postings
from .postings import pieces as _pieces

# Confidence per strategy and acceptance bars.
WEBSITE_SCORE, SLUG_SCORE, REPO_SCORE = 0.95, 0.75, 0.92
TITLE_ALIAS_SCORE, NAME_IN_TEXT_SCORE = 0.9, 0.88
ACCEPT, EDIT_BAR, TITLE_BAR = 0.6, 0.75, 0.72
MIN_NAME, MIN_TITLE = 4, 8
SLUG_SUFFIXES = [".com", ".io", ".ai"]


# -- indexes over companies -------------------------------------------------------------------


def domain_index(companies: DataFrame) -> DataFrame:
    """(domain, company_id, name, score): own website first, then guessed slug domains."""
    site = companies.select(
        link_host(F.col("website")).alias("domain"), "company_id", "name",
        F.lit(WEBSITE_SCORE).alias("score"), F.lit(0).alias("kind"),
    )
    guessed = companies.filter(F.coalesce("slug", F.lit("")) != "").select(
        F.explode(F.array(*[F.concat("slug", F.lit(s)) for s in SLUG_SUFFIXES])).alias("domain"),
        "company_id", "name", F.lit(SLUG_SCORE).alias("score"), F.lit(1).alias("kind"),
    )
    rows = site.unionByName(guessed).filter("domain is not null")
    first = F.min_by(F.struct("company_id", "name", "score"), F.struct("company_id", "kind"))
    return rows.groupBy("domain").agg(first.alias("m")).select("domain", "m.*")


def repo_index(companies: DataFrame) -> DataFrame:
    """(org, company_id, name, score); the later company wins a shared organisation."""
    rows = companies.filter(F.coalesce("github_org", F.lit("")) != "")
    last = F.max_by(F.struct("company_id", "name"), "company_id").alias("m")
    out = rows.groupBy(F.lower("github_org").alias("org")).agg(last)
    return out.select("org", "m.*", F.lit(REPO_SCORE).alias("score"))


def alias_index(companies: DataFrame) -> DataFrame:
    """(alias, company_id, name, first_seen) from names, slugs, handles and longer name words."""
    low = F.lower("name")
    words = F.filter(F.split(F.regexp_replace(low, "[-_]", " "), r"\s+"), lambda w: F.length(w) > 3)
    parts = F.concat(
        F.array(low, F.lower("slug"), F.regexp_replace(F.lower("x_handle"), "^@+", "")), words
    )
    rows = companies.select("company_id", "name", F.posexplode(parts).alias("pos", "alias"))
    rows = rows.filter(F.coalesce("alias", F.lit("")) != "")
    return (
        rows.groupBy("alias")
        .agg(
            F.max_by(F.struct("company_id", "name"), "company_id").alias("m"),
            F.min(F.struct("company_id", "pos")).alias("first_seen"),
        )
        .select("alias", "m.*", "first_seen")
    )


# -- strings cut at word boundaries -----------------------------------------------------------


def _cut(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("__pieces", _pieces(F.col(text)))


def _runs(sizes: list[int] | None = None) -> Column:
    """All runs of consecutive pieces of a text column whose count is in ``sizes`` (default: any).

    The text must have been cut into the column ``__pieces`` by ``_cut`` first, so that the
    split runs once per row and not once per run.
    """
    pieces = F.col("__pieces")
    sizes = F.sequence(F.lit(1), F.size(pieces)) if sizes is None else F.array(*map(F.lit, sizes))
    per_size = F.transform(
        sizes,
        lambda n: F.when(
            F.size(pieces) >= n,
            F.transform(
                F.sequence(F.lit(1), F.size(pieces) - n + 1),
                lambda i: F.array_join(F.slice(pieces, i, n), ""),
            ),
        ),
    )
    return F.array_distinct(F.flatten(F.filter(per_size, lambda a: a.isNotNull())))


# -- fuzzy names ------------------------------------------------------------------------------


def _containment(names: DataFrame, companies: DataFrame) -> DataFrame:
    """Company name inside the name, or the name inside the company name, as whole words."""
    low = companies.select("company_id", "name", F.lower("name").alias("c"))
    # A company inside the name counts only above the acceptance bar, so short runs are left out.
    # Names too long (or short) for any company to make up enough of them are not cut at all.
    fit = F.sequence(F.length("c"), F.ceil(F.length("c") / ACCEPT).cast("int"))
    lengths = low.select(F.explode_outer(fit).alias("ln")).distinct()
    some = names.withColumn("ln", F.length("q")).join(lengths, "ln", "left_semi")
    spans = _cut(some, "q").select("q", F.explode_outer(_runs()).alias("c"))
    spans = spans.filter(
        (F.length("c") >= 2) & (F.length("c") / F.length("q") > ACCEPT)
        & _whole_words(F.col("c"), F.col("q"))
    )
    inside = spans.join(low, "c").select(
        "q", "company_id", "name", (F.length("c") / F.length("q")).alias("score")
    )
    runs = _cut(low, "c").select("company_id", "name", "c", F.explode(_runs()).alias("q"))
    runs = runs.filter((F.length("q") >= 2) & _whole_words(F.col("q"), F.col("c")))
    around = names.join(runs, "q").select(
        "q", "company_id", "name",
        (F.length("c") / F.greatest(F.length("q"), F.length("c"))).alias("score"),
    )
    return inside.unionByName(around)


def _whole_words(run: Column, text: Column) -> Column:
    """A run that opens or closes the text does so at a boundary only with a word character."""
    opens = text.startswith(run) & ~run.rlike(r"^\w")
    closes = text.endswith(run) & ~run.rlike(r"\w$")
    return ~(opens | closes)


def _edit_distance(names: DataFrame, companies: DataFrame) -> DataFrame:
    """Pairs whose edit similarity is above the bar, found by shared segments.

    With at most t edits between two strings, cutting one into t + 1 segments leaves at least one
    segment intact and at most t places away. The company is cut for every length the other name
    may have; the name offers its short substrings; the pair meets on (length, place, segment).
    """
    c = companies.select("company_id", "name", F.lower("name").alias("c"))
    c = c.withColumn("lc", F.length("c"))
    # similarity > 3/4 means edits <= floor((longer - 1) / 4), hence lengths within a third
    lens = F.sequence(F.greatest(F.lit(1), F.floor(F.col("lc") * 3 / 4).cast("int")), F.ceil(F.col("lc") * 4 / 3).cast("int"))
    cut = c.withColumn("ln", F.explode(lens))
    cut = cut.withColumn("t", F.floor((F.greatest("lc", "ln") - 1) / 4).cast("int"))
    cut = cut.filter((F.abs(F.col("lc") - F.col("ln")) <= F.col("t")) & (F.col("t") > 0))
    cut = cut.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("t"))))
    start = F.floor(F.col("i") * F.col("lc") / (F.col("t") + 1)).cast("int")
    stop = F.floor((F.col("i") + 1) * F.col("lc") / (F.col("t") + 1)).cast("int")
    cut = cut.withColumn("start", start).withColumn("width", stop - start)
    cut = cut.withColumn("seg", F.substring(F.col("c"), F.col("start") + 1, F.col("width")))
    places = F.sequence(F.greatest(F.lit(0), F.col("start") - F.col("t")), F.col("start") + F.col("t"))
    cut = cut.withColumn("place", F.explode_outer(places)).select(
        "company_id", "name", "c", "ln", "place", "seg"
    )

    q = names.withColumn("ln", F.length("q")).join(cut.select("ln").distinct(), "ln", "left_semi")
    q = q.withColumn("width", F.explode(F.array(F.lit(2), F.lit(3), F.lit(4)))).filter("ln >= width")
    q = q.withColumn("place", F.explode(F.sequence(F.lit(0), F.col("ln") - F.col("width"))))
    q = q.withColumn("seg", F.substring(F.col("q"), F.col("place") + 1, F.col("width"))).drop("width")
    pairs = q.join(cut, ["ln", "place", "seg"])
    longer = F.greatest(F.length("q"), F.length("c"))
    score = F.lit(1.0) - F.levenshtein("q", "c") / longer
    return pairs.select("q", "company_id", "name", score.alias("score")).filter(F.col("score") > EDIT_BAR)


def fuzzy_match(names: DataFrame, companies: DataFrame) -> DataFrame:
    """(name, company_id, company, score) for the distinct names that match a company.

    An alias gives 1.0; else the best of word containment and edit similarity, the earlier
    company on ties, accepted above the bar.
    """
    distinct = names.select("name").distinct()
    distinct = distinct.filter(F.length("name") >= 2).withColumn("q", F.lower(strip(F.col("name"))))
    aliases = alias_index(companies).select(
        F.col("alias").alias("q"), "company_id", F.col("name").alias("company")
    )
    by_alias = distinct.join(aliases, "q").select("name", "company_id", "company", F.lit(1.0).alias("score"))
    left = distinct.join(aliases.select("q"), "q", "left_anti")
    probes = left.select("q").distinct()
    pairs = _containment(probes, companies).unionByName(_edit_distance(probes, companies))
    order = F.struct(F.col("score"), -F.col("company_id"))
    best = pairs.groupBy("q").agg(F.max_by(F.struct("company_id", "name", "score"), order).alias("m"))
    best = best.select("q", F.col("m.company_id"), F.col("m.name").alias("company"), F.col("m.score"))
    close = left.join(best.filter(F.col("score") > ACCEPT), "q").select("name", "company_id", "company", "score")
    return by_alias.unionByName(close)


def resolve_names(names: DataFrame, companies: DataFrame, aliases: DataFrame | None = None):
    """Recorded aliases first, then fuzzy clamped to [0.5, 0.99]."""
    distinct = names.select("name").distinct()
    if aliases is None:
        recorded = distinct.limit(0).select(
            "name", F.lit(0).cast("bigint").alias("company_id"), F.lit("").alias("company"),
            F.lit(0.0).alias("confidence"), F.lit("alias").alias("method"),
        )
    else:
        keyed = distinct.withColumn("alias_normalized", alias_key(F.col("name")))
        keyed = keyed.filter(F.length("alias_normalized") >= 2)
        ids = companies.select("company_id", F.col("name").alias("company"))
        recorded = keyed.join(aliases.join(ids, "company_id"), "alias_normalized").select(
            "name", "company_id", "company", F.coalesce("confidence", F.lit(0.95)).alias("confidence"),
            F.lit("alias").alias("method"),
        )
    rest = distinct.join(recorded.select("name"), "name", "left_anti")
    matched = fuzzy_match(rest, companies).select(
        "name", "company_id", "company",
        F.least(F.lit(0.99), F.greatest(F.lit(0.5), "score")).alias("confidence"),
        F.lit("fuzzy").alias("method"),
    )
    return recorded.unionByName(matched)


#: Matches of this confidence are recorded as aliases.
LEARN = 0.85


def alias_table(spark, folder: str):
    """Recorded aliases as versions: (alias_normalized, company_id, confidence), one row an alias."""
    from ..sources.snapshots import SnapshotTable

    table = SnapshotTable(spark, folder, ["alias_normalized"])
    if table.newest() is None:
        table.create(spark.createDataFrame([], "alias_normalized string, company_id long, confidence double"))
    return table


def resolve_and_learn(names: DataFrame, companies: DataFrame, aliases, folder: str) -> DataFrame:
    """(name, company_id, company, confidence, method) of a batch of names; what it learns, the next batch reads first.

    Fuzzy matches of LEARN or more enter the alias table, in the spelling that aliases are compared in; of several matches of one such
    spelling the surest, then the earlier company. A recorded alias keeps its company. The batch's result is written to ``folder``
    first, so matches are found once and what is learned is what was returned.
    """
    resolve_names(names, companies, aliases.read()).write.mode("overwrite").parquet(folder)
    found = names.sparkSession.read.parquet(folder)
    sure = found.filter((F.col("method") == "fuzzy") & (F.col("confidence") >= LEARN)).withColumn("alias_normalized", alias_key(F.col("name")))
    best = F.max_by(F.struct("company_id", "confidence"), F.struct(F.col("confidence"), -F.col("company_id").cast("decimal(20,0)"))).alias("m")
    learned = sure.filter(F.length("alias_normalized") >= 2).groupBy("alias_normalized").agg(best).select("alias_normalized", "m.*")
    aliases.merge(learned, default="keep")
    return found


# -- one strategy each: (id, company_id, name, score) ------------------------------------------


def by_domain(links: DataFrame, companies: DataFrame) -> DataFrame:
    """Host of ``url`` in the domain index, else its last two labels."""
    index = domain_index(companies)
    hosts = links.select("id", link_host(F.col("url")).alias("host")).filter("host is not null")
    exact = index.select(F.col("domain").alias("host"), F.struct("company_id", "name", "score").alias("x"))
    base = index.select(F.col("domain").alias("base"), F.struct("company_id", "name", "score").alias("y"))
    out = hosts.join(exact, "host", "left").withColumn("base", base_domain(F.col("host")))
    out = out.join(base, "base", "left").withColumn("m", F.coalesce("x", "y"))
    return out.filter("m is not null").select("id", "m.*")


def by_repo(links: DataFrame, companies: DataFrame) -> DataFrame:
    org = F.lower(capture(F.col("url"), r"(?i)github\.com/([^/]+)"))
    rows = links.select("id", org.alias("org")).filter("org is not null")
    return rows.join(repo_index(companies), "org").select("id", "company_id", "name", "score")


def _earlier(company: str, pos: str | None = None) -> Column:
    """Ranks the smaller company id, then the earlier place, higher; of use for ids of all 64 bits."""
    place = F.col(pos) if pos else F.lit(0)
    return F.struct((-F.col(company).cast("decimal(20,0)")).alias("company"), (-place).cast("int").alias("pos"))


def _alias_ranks(companies: DataFrame) -> DataFrame:
    """(entry, company_id, name, rank) of aliases long enough to search for; the longer and then the earlier one ranks higher."""
    index = alias_index(companies).filter(F.length("alias") >= MIN_NAME)
    rank = F.struct(F.length("alias").alias("len"), _earlier("first_seen.company_id", "first_seen.pos").alias("back"))
    return index.select(F.col("alias").alias("entry"), "company_id", "name", rank.alias("rank"))


def _name_ranks(companies: DataFrame) -> DataFrame:
    """(entry, company_id, name, rank) of company names long enough to look for, the longer one ranking higher."""
    low = F.lower("name")
    rank = F.struct(F.length(low).alias("len"), _earlier("company_id").alias("back"))
    return companies.filter(F.length("name") >= MIN_NAME).select(low.alias("entry"), "company_id", "name", rank.alias("rank"))


def _best_entry(found: DataFrame, ranks: DataFrame, score: float) -> DataFrame:
    best = found.join(ranks, "entry").groupBy("id").agg(F.max_by(F.struct("company_id", "name"), "rank").alias("m"))
    return best.select("id", "m.*", F.lit(score).alias("score"))


def _phrases(ranks: DataFrame) -> DataFrame:
    return ranks.select("entry").distinct().withColumn("phrase", F.col("entry"))


def by_title_alias(titles: DataFrame, companies: DataFrame) -> DataFrame:
    """Longest alias contained anywhere in the title."""
    ranks = _alias_ranks(companies)
    found = postings.find(titles.select("id", F.lower("title").alias("text")), _phrases(ranks))
    return _best_entry(found, ranks, TITLE_ALIAS_SCORE)


def by_name_in_text(texts: DataFrame, companies: DataFrame):
    """Longest company name that stands in the text as whole words."""
    ranks = _name_ranks(companies)
    found = postings.find(texts.select("id", F.lower("text").alias("text")), _phrases(ranks), inside_words=False)
    return _best_entry(found.filter("whole"), ranks, NAME_IN_TEXT_SCORE)


def by_handle(posts: DataFrame, companies: DataFrame) -> DataFrame:
    """(id, company_id, name) for every handle mentioned in the text or signing the post."""
    named = F.transform(F.regexp_extract_all("text", F.lit("@([A-Za-z0-9_]{1,15})"), F.lit(1)), F.lower)
    author = F.when(
        F.coalesce("author", F.lit("")) != "",
        F.array(F.lower(F.regexp_replace("author", "^@+", ""))),
    ).otherwise(F.array().cast("array<string>"))
    handles = posts.select("id", F.explode(F.array_distinct(F.concat(named, author))).alias("handle"))
    keyed = companies.filter("x_handle is not null").select(
        "company_id", "name", F.lower(F.replace("x_handle", F.lit("@"), F.lit(""))).alias("handle")
    )
    return handles.join(keyed, "handle").select("id", "company_id", "name").distinct()


def mentions(texts: DataFrame, companies: DataFrame) -> DataFrame:
    """(id, mention): names, slug words and handles whose first occurrence stands alone."""
    names = companies.select(
        F.explode(
            F.array("name", F.replace("slug", F.lit("-"), F.lit(" ")), F.regexp_replace("x_handle", "^@+", ""))
        ).alias("mention")
    )
    names = names.filter("mention is not null").distinct().withColumn("entry", F.lower("mention")).filter(F.length("entry") >= 3)
    found = postings.find(texts.select("id", F.lower("text").alias("text")), _phrases(names))
    return found.filter("alone").join(names, "entry").select("id", "mention").distinct()


def by_name_slug_handle(names: DataFrame, companies: DataFrame, variations: dict | None = None):
    """Exact name, lower-case name, slug, handle, then known spellings; the first rule wins."""
    q = names.select("name").distinct()
    variations = variations or {}
    rules = companies.select(
        "company_id",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("rule"), F.col("name").alias("key")),
                F.struct(F.lit(1).alias("rule"), F.lower("name").alias("key")),
                F.struct(F.lit(2).alias("rule"), F.col("slug").alias("key")),
                F.struct(F.lit(3).alias("rule"), F.col("x_handle").alias("key")),
            )
        ).alias("r"),
    ).select("company_id", "r.*").filter("key is not null")
    low = F.lower("name")
    tries = F.array(
        F.struct(F.lit(0).alias("rule"), F.col("name").alias("key")),
        F.struct(F.lit(1).alias("rule"), low.alias("key")),
        F.struct(F.lit(2).alias("rule"), F.replace(low, F.lit(" "), F.lit("-")).alias("key")),
        F.struct(F.lit(3).alias("rule"), F.col("name").alias("key")),
    )
    probes = q.select("name", F.explode(tries).alias("p")).select("name", "p.*")
    hits = probes.join(rules, ["rule", "key"])
    for spelling, canonical in variations.items():
        extra = q.filter(low == spelling).select("name", F.lit(4).alias("rule"), F.lit(canonical).alias("key"))
        exact = rules.filter("rule = 0").select("company_id", "key")
        hits = hits.unionByName(extra.join(exact, "key").select("rule", "key", "name", "company_id"))
    return hits.groupBy("name").agg(
        F.min(F.struct("rule", "company_id")).alias("m")
    ).select("name", "m.company_id")


def registry_match(names: DataFrame, registry: DataFrame) -> DataFrame:
    """Registrant by lower-case title, else the first title that opens with the name, or whose part before the comma opens
    the name. Either side's openings of every length are matched by equality with the other side; empty names and parts
    open nothing."""
    q = names.select("name").distinct().withColumn("q", F.lower(F.trim("name"))).filter("q <> ''")
    r = registry.select("registrant_id", "title", F.lower("title").alias("t"))
    exact = q.join(r, F.col("q") == F.col("t")).groupBy("name", "q").agg(
        F.min("registrant_id").alias("registrant_id")
    )
    rest = q.join(exact.select("name"), "name", "left_anti")

    def openings(df: DataFrame, text: str, *keep: str) -> DataFrame:
        sized = df.filter(F.length(text) > 0).select(*keep, text, F.explode(F.sequence(F.lit(1), F.length(text))).alias("n"))
        return sized.select(*keep, F.substring(F.col(text), F.lit(1), F.col("n")).alias("key"))

    opens = openings(r, "t", "registrant_id").join(rest.select("name", F.col("q").alias("key")), "key").select("name", "registrant_id")
    heads = r.select("registrant_id", F.substring_index("t", ",", 1).alias("key"))
    opened = openings(rest, "q", "name").join(heads, "key").select("name", "registrant_id")
    prefix = opens.unionByName(opened).groupBy("name").agg(F.min("registrant_id").alias("registrant_id"))
    out = exact.select("name", "registrant_id", F.lit("exact").alias("how")).unionByName(
        prefix.select("name", "registrant_id", F.lit("prefix").alias("how"))
    )
    return out.join(registry.select("registrant_id", "title"), "registrant_id")


# -- the cascade ------------------------------------------------------------------------------

#: Strategies in the order they are tried.
METHODS = [
    "company_id", "company", "repo", "domain", "channel", "listed", "title_alias", "name_in_text",
    "fuzzy_title",
]


def resolve_company(payloads: DataFrame, companies: DataFrame) -> DataFrame:
    """(id, company_id, name, score, method) per payload by the first strategy that answers.

    Input columns: id (unique), company_ref, company_hint, url, channel, listed (array), title, headline,
    blob. The payloads are parsed into a written table once; strategies run in stages over its columns, each stage on
    the ids that the ones before left open, and write what they find.
    """
    folder = f"{shared_folder(payloads.sparkSession)}/dealweave-resolve/{uuid.uuid4().hex}"

    def settle(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    title = F.coalesce(filled(F.col("title")), filled(F.col("headline")), F.lit(""))
    rows = settle(payloads.select(
        "id", "company_ref", F.trim("company_hint").alias("hint"), "channel", "listed", F.lower("title").alias("t"), F.lower("blob").alias("b"),
        F.when(F.length(title) > MIN_TITLE, title).alias("headline"), link_host(F.col("url")).alias("host"),
        F.lower(capture(F.col("url"), r"(?i)github\.com/([^/]+)")).alias("org"),
    ), "rows")

    def found(hits: DataFrame, method: str) -> DataFrame:
        return hits.select("id", "company_id", "name", "score", F.lit(method).alias("method"))

    stages = [
        lambda todo: _by_key(todo, companies),
        lambda todo: found(by_title_alias(todo.select("id", F.col("t").alias("title")), companies), "title_alias"),
        lambda todo: found(by_name_in_text(todo.select("id", F.col("b").alias("text")), companies), "name_in_text"),
        lambda todo: found(_by_headline(todo, companies), "fuzzy_title"),
    ]
    todo, results = rows, []
    for i, stage in enumerate(stages):
        results.append(settle(stage(todo), f"found{i}"))
        todo = todo.join(results[-1].select("id"), "id", "left_anti")
    return reduce(DataFrame.unionByName, results)


def _by_headline(rows: DataFrame, companies: DataFrame) -> DataFrame:
    """(id, company_id, name, score): the title as a whole, as a company name."""
    titles = rows.filter("headline is not null").select("id", F.col("headline").alias("name"))
    hits = titles.join(fuzzy_match(titles, companies), "name").filter(F.col("score") >= TITLE_BAR)
    return hits.select("id", "company_id", F.col("company").alias("name"), "score")


def _by_key(rows: DataFrame, companies: DataFrame) -> DataFrame:
    """(id, company_id, name, score, method) by what a payload says outright: id, name, repository, host, channel, listed names."""
    rank = {name: i for i, name in enumerate(METHODS)}

    def probe(method: str, order, key):
        return F.struct(F.lit(rank[method]).alias("rank"), order.alias("ord"), key.cast("string").alias("key"))

    keys = rows.select("id", F.explode(F.array(
        probe("company_id", F.lit(0), F.col("company_ref")), probe("repo", F.lit(0), F.col("org")), probe("domain", F.lit(0), F.col("host")),
        probe("domain", F.lit(1), base_domain(F.col("host"))),
    )).alias("p")).select("id", "p.*").filter("key is not null and key <> ''")

    def indexed(df, method, key, score):
        return df.select(F.lit(rank[method]).alias("rank"), key.cast("string").alias("key"), "company_id", "name", score.alias("score"))

    index = reduce(DataFrame.unionByName, [
        indexed(companies, "company_id", F.col("company_id"), F.lit(1.0)), indexed(repo_index(companies), "repo", F.col("org"), F.col("score")),
        indexed(domain_index(companies), "domain", F.col("domain"), F.col("score")),
    ])
    direct = keys.join(index, ["rank", "key"]).select("id", "rank", "ord", "company_id", "name", "score")

    listed = F.transform(F.coalesce("listed", F.array().cast("array<string>")), lambda n, i: probe("listed", i, n))
    named = F.concat(F.array(probe("company", F.lit(0), F.col("hint")), probe("channel", F.lit(0), F.col("channel"))), listed)
    named = rows.select("id", F.explode(named).alias("p")).select("id", "p.rank", "p.ord", F.col("p.key").alias("name"))
    named = named.filter(F.coalesce("name", F.lit("")) != "")
    by_name = named.join(fuzzy_match(named, companies), "name").select("id", "rank", "ord", "company_id", F.col("company").alias("name"), "score")
    best = F.min_by(F.struct("company_id", "name", "score", "rank"), F.struct("rank", "ord", F.col("company_id")))
    out = direct.unionByName(by_name).groupBy("id").agg(best.alias("m")).select("id", "m.*")
    return out.select("id", "company_id", "name", "score", F.get(F.array(*[F.lit(n) for n in METHODS]), F.col("rank")).alias("method"))

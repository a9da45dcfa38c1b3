"""Composite jobs: operators in the order the daily run applies them.

A job is one lazy plan per output. Where a later step reads an earlier result several times the
result is settled first: written to the shared folder and read back, which also cuts the lineage
that a lost executor would otherwise have to recompute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import brief, claims, company, funding, jobs, keyed, quality, ranking, repair, search, signals, web
from ..session import shared_folder


def settle(df: DataFrame, run: str, name: str) -> DataFrame:
    """The rows as a written table of this run."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/dealweave-runs/{spark.sparkContext.applicationId}/{run}/{name}"
    df.write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def funding_rollup(events, raw_signals, companies, github, run: str = "funding") -> dict[str, DataFrame]:
    """Claims from events and signals to rounds, participants, event confidence and valuations."""
    rows = funding.union_claims(
        [funding.event_claims(events, raw_signals), funding.signal_claims(raw_signals)], companies
    )
    rows = funding.backfill_terms(funding.backfill_participants(rows))
    rows = settle(funding.with_trust(rows, companies), run, "claims")
    texts = ("deal_text", "headline", "snippet", "deal_terms_text")  # read for the last time above
    clustered = settle(funding.merge_clusters(rows.drop(*texts)), run, "clusters")
    rounds = settle(funding.funding_rounds(clustered, github), run, "rounds")
    people = funding.claim_participants(rows)
    links = funding.claim_links(clustered)
    firms = funding.investor_firms(people)
    members = settle(funding.round_participants(people, rows, links), run, "participants")
    numbered = rounds.withColumn("id", F.xxhash64("cluster_key"))
    held = members.join(
        numbered.select(F.col("merged_key").alias("round_id"), F.col("id").alias("__id")), "round_id"
    ).drop("round_id").withColumnRenamed("__id", "round_id")
    synced = funding.sync_event_confidence(events, rows, links, rounds)
    clusters = settle(funding.event_cluster_confidence(events, rows, companies), run, "event_clusters")
    return {
        "claims": rows, "rounds": numbered, "participants": members, "firms": firms,
        "attributions": funding.participant_attributions(people, rows, links),
        "events": with_confidence(synced, clusters), "event_clusters": clusters,
        "valuations": funding.company_valuation(companies, numbered, events),
        "cap_table": funding.cap_table(numbered, held, firms),
    }


def with_confidence(events: DataFrame, scores: DataFrame) -> DataFrame:
    """Events with the confidence that ``scores`` (id, confidence) has for them, if any."""
    own = scores.groupBy("id").agg(F.max("confidence").alias("__score"))
    return events.join(own, "id", "left").withColumn("confidence", F.coalesce("__score", "confidence")).select(*events.columns)


def company_data_rollup(events, raw_signals, companies, run: str = "company") -> dict[str, DataFrame]:
    """Claims on profiles, people, products and licences to one row per fact, and the companies as their profiles have them."""
    texts = settle(claims.event_texts(events, raw_signals).drop("data_json", "payload", "description"), run, "texts")
    bulk = settle(claims.bulk_rows(raw_signals).select("id", "company_id", "source", "kind", "base_url", "payload"), run, "bulk")

    def merged(parts, policy, keys=("source_url",)):
        """Later reports of the same URL update the first by the table's policy."""
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part, allowMissingColumns=True)
        rows = claims.with_tier(rows, companies)
        return keyed.fold(rows, list(keys), "id", policy)

    profile = merged([claims.bulk_profile_claims(bulk)], company.PROFILE_POLICY, ("source_url", "field_key"))
    team = merged([claims.team_claims(texts), claims.bulk_team_claims(bulk)], company.TEAM_POLICY)
    team = team.withColumn("linkedin_url", F.lit(None).cast("string"))
    product = merged([claims.product_claims(texts), claims.bulk_product_claims(bulk)], company.PRODUCT_POLICY)
    licence = merged([claims.license_claims(texts), claims.bulk_license_claims(bulk)], company.LICENSE_POLICY)
    details = settle(company.profile_rollup(profile), run, "details")
    return {
        "company_details": details, "team_members": company.team_rollup(team),
        "products": company.product_rollup(product), "regulatory_licenses": company.license_rollup(licence),
        "companies": company.with_profiles(companies, details),
    }


def company_facts(out: dict[str, DataFrame]) -> DataFrame:
    """What a company-data rollup found, a row a fact: (part, company_id, name, role, is_founder, corroboration_score, report_count).

    ``role`` is what is said of the name: a person's role, a product's status, a licence's jurisdiction and status, a profile
    field's value, a company's industry.
    """
    columns = ("company_id", "name", "role", "is_founder", "corroboration_score", "report_count")
    fields = out["company_details"].select("company_id", F.explode("fields_provenance").alias("name", "f"))
    licences = out["regulatory_licenses"].withColumnRenamed("license_type", "name")
    parts = {
        "team_members": out["team_members"], "products": out["products"].withColumn("role", F.col("status")),
        "regulatory_licenses": licences.withColumn("role", F.concat_ws(" ", "jurisdiction", "status")),
        "company_details": fields.select("company_id", "name", F.col("f.value").alias("role"), F.col("f.report_count").alias("report_count")),
        "companies": out["companies"].withColumn("role", F.col("industry")).drop("report_count"),
    }
    rows = None
    for part, df in parts.items():
        kinds = {"is_founder": "boolean", "corroboration_score": "double", "report_count": "bigint"}
        missing = {c: F.lit(None).cast(kinds[c]) for c in columns if c not in df.columns}
        some = df.withColumns(missing).select(F.lit(part).alias("part"), *columns)
        rows = some if rows is None else rows.unionByName(some)
    return rows


def regulatory_rollup(raw_signals: DataFrame) -> DataFrame:
    return company.license_rollup(claims.with_tier(claims.regulatory_claims(raw_signals)))


def jobs_rollup(board_rows, events, companies, today, run: str = "jobs", earlier: DataFrame | None = None) -> dict[str, DataFrame]:
    """Board postings and hiring events to postings, skills and velocity.

    ``earlier`` holds the claims of former runs; a board posting among them that its company's boards no longer list
    becomes inactive.
    """
    boards = jobs.job_claims(board_rows, companies)
    from_events = jobs.job_claims(jobs.event_job_rows(events), companies)
    rows = boards.unionByName(from_events, allowMissingColumns=True)
    if earlier is not None:
        rows = rows.unionByName(earlier, allowMissingColumns=True)
    rows = settle(keyed.keep_last(rows, ["source_url"], ["id"]), run, "claims")
    postings = settle(jobs.job_postings(rows), run, "postings")
    postings = jobs.deactivate_stale(postings, boards)
    return {"claims": rows, "postings": postings, "skills": jobs.posting_skills(rows), "velocity": jobs.hiring_velocity(postings, today)}


def embed_and_search(companies, profiles, rounds, events, query: str, run: str = "search") -> dict[str, DataFrame]:
    """Vectors of companies, rounds and events, written, and the best of all three for a query."""
    own = profiles.select("company_id", "business_model", "headquarters", "team_size")
    c = companies.select("company_id", "name", F.col("description").alias("description_long"), F.col("score").alias("company_score"), F.lit("").alias("tech_stack"))
    c = c.join(own, "company_id", "left").withColumn("id", F.col("company_id").cast("string"))
    names = companies.select("company_id", "name")
    r = rounds.select(F.col("cluster_key").alias("id"), "company_id", "round_type", "amount_usd", "valuation_usd", "lead_investor").join(names, "company_id", "left")
    e = events.select(F.col("id").cast("string").alias("id"), "company_id", "event_type", "amount_usd", "source", "confidence").join(names, "company_id", "left")
    parts = {
        "company": (search.term_counts(c, search.company_text()), search.company_boost(), 5),
        "funding": (search.term_counts(r, search.round_text()), search.funding_boost(), 5),
        "event": (search.term_counts(e, search.event_text()), search.event_boost(), 10),
    }
    vector = search.query_vector(query)
    out, best = {}, []
    for kind, (rows, boost, most) in parts.items():
        out[kind] = settle(rows.select("id", "embedding", boost.alias("boost")), run, f"{kind}-vectors")
        best.append(search.top_k(out[kind], vector, F.col("boost"), most).select(F.lit(kind).alias("kind"), "id", "score"))
    return out | {"found": search.unified(best)}


#: Ids made by hashing start here, above any that were numbered, and take as many values: two of a hundred million agree once in a thousand runs.
NEW_IDS = 1 << 62


def new_id(*of: str) -> Column:
    """A positive id above all numbered ones, the same in every run."""
    return F.lit(NEW_IDS) + F.pmod(F.xxhash64(*of), F.lit(NEW_IDS))


def discover_and_rank(raw_signals, events, companies, as_of, days: int = 30, run: str = "rank") -> dict[str, DataFrame]:
    """Candidates from mentions, promotion of the strong ones, and the ranking of all companies, which gives them their score."""
    stats = settle(ranking.mention_stats(raw_signals, companies, as_of, days), run, "mentions")
    candidates = ranking.company_candidates(stats)
    promoted = settle(ranking.promote_candidates(candidates, companies), run, "promoted")
    fresh = promoted.withColumn("company_id", new_id("slug"))
    everyone = companies.unionByName(fresh, allowMissingColumns=True)
    ranked = settle(ranking.rank_companies(everyone, raw_signals, events, as_of), run, "ranking")
    return {"candidates": candidates, "promoted": promoted, "companies": ranking.with_scores(everyone, ranked), "ranking": ranked}


def daily_brief(events, raw_signals, companies, as_of, days: int = 30) -> dict[str, DataFrame]:
    since = F.lit(as_of) - F.expr(f"interval {days} days")
    return {
        "events": brief.top_events(events, companies, since), "top_companies": brief.top_companies(companies),
        "signal_counts": brief.source_counts(raw_signals, since),
    }


def process(raw_signals, events, companies, run: str = "events") -> tuple[DataFrame, DataFrame]:
    """Signals and events after processing.

    Every signal gets the company it was resolved to and counts as processed; an event that stood on a signal's article
    gets the signal (and its company, if it had none); the other signals become events of their own.
    """
    made = settle(signals.process_signals(raw_signals, events, companies), run, "made")
    fresh = made.filter("attached_event_id is null").select(
        (-F.col("raw_signal_id")).alias("id"), "raw_signal_id", "company_id", "event_type", "amount_usd",
        F.lit(None).cast("bigint").alias("valuation_usd"), "source", "source_url", "confidence", "description",
        F.substring(F.col("announced_at").cast("string"), 1, 10).alias("announced_date"), F.col("announced_at").alias("created_at"),
    )
    linked = made.filter("attached_event_id is not null").groupBy(F.col("attached_event_id").alias("id")).agg(
        F.min(F.struct("raw_signal_id", "company_id")).alias("__made")
    )
    kept = events.select(*fresh.columns).join(linked, "id", "left")
    kept = kept.withColumn("raw_signal_id", F.coalesce("raw_signal_id", "__made.raw_signal_id")).withColumn("company_id", F.coalesce("company_id", "__made.company_id"))
    own = made.groupBy(F.col("raw_signal_id").alias("id")).agg(F.min("company_id").alias("__company"))
    after = raw_signals.join(own, "id", "left").withColumn("company_id", F.coalesce("company_id", "__company")).withColumn("processed", F.lit(True))
    return settle(after.select(*raw_signals.columns), run, "signals"), settle(kept.select(*fresh.columns).unionByName(fresh), run, "all")


def new_events(raw_signals, events, companies, run: str = "events") -> DataFrame:
    """All events after processing the signals that had none."""
    return process(raw_signals, events, companies, run)[1]


def with_children(raw_signals: DataFrame, as_of) -> DataFrame:
    """The signals and, as signals of their own, the links they fan out to; a child that is there already is not added."""
    children = signals.url_fanout(raw_signals)
    payload = F.to_json(F.struct("title", "summary", "url", "category", "discovered_via", "parent_raw_signal_id"))
    rows = children.select(
        new_id("signal_type").alias("id"), "source", "signal_type", "company_id", payload.alias("data_json"), F.lit(as_of).cast(raw_signals.schema["detected_at"].dataType).alias("detected_at"),
        F.lit(False).alias("processed"), "url", "title", "summary", "category",
    )
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in raw_signals.schema if f.name not in rows.columns]
    return keyed.insert_ignore(raw_signals, rows.select("*", *missing), ["source", "signal_type"], ["id"])


def daily(raw_signals, events, companies, github, board_rows, as_of, run: str = "daily", snapshots=None) -> dict[str, DataFrame]:
    """The whole day in order: page changes, links, events, repairs, gate, jobs, ranking, funding, company data, brief.

    Each part works on what the parts before it left. Outputs are named by part, such as ``funding.rounds``; ``signals`` and
    ``events`` are the tables at the end of the day, ``companies`` too, with the scores of the ranking and what their profiles say;
    the brief reads these. ``snapshots`` (host, page_id, hash, title, meta_description) may be left out.
    """
    everything = settle(with_children(raw_signals, as_of), run, "with_children")
    everything, made = process(everything, events, companies, f"{run}/events")
    repaired = settle(repair.repair(made, everything, companies), run, "repaired")
    gate = settle(quality.quality_gate(quality.quality_metrics(everything, repaired, companies)), run, "gate")
    parts = {"jobs": jobs_rollup(board_rows, repaired, companies, as_of, f"{run}/jobs")}
    parts["rank"] = discover_and_rank(everything, repaired, companies, as_of, run=f"{run}/rank")
    known = settle(parts["rank"]["companies"], run, "companies")
    parts["funding"] = funding_rollup(repaired, everything, known, github, f"{run}/funding")
    synced = settle(parts["funding"]["events"], run, "synced")
    parts["company"] = company_data_rollup(synced, everything, known, f"{run}/company")
    ended = settle(parts["company"].pop("companies"), run, "companies_after")
    parts["brief"] = daily_brief(synced, everything, ended, as_of)
    out = {f"{part}.{name}": df for part, group in parts.items() for name, df in group.items()}
    if snapshots is not None:
        out["changes"] = web.website_changes(snapshots, "host", "page_id")
    out |= {"rank.companies": known, "funding.events": synced, "signals": everything, "events": synced, "companies": ended, "gate": gate}
    return out | {"regulatory": regulatory_rollup(everything)}


#: Outputs of a day that its steps have written.
WRITTEN = (
    "signals", "events", "companies", "gate", "jobs.claims", "rank.promoted", "rank.ranking", "rank.companies", "funding.claims",
    "funding.participants", "funding.events", "funding.event_clusters", "company.company_details",
)


def day_report(out: dict[str, DataFrame], run: str = "daily") -> DataFrame:
    """A day as rows (part, company_id, cluster_key, report_count, corroboration_score), each of its outputs written.

    Every output gives a row with its number of rows. Rounds, the brief, the ranking and the gate are given row by row: ``cluster_key``
    names the row, ``report_count`` and ``corroboration_score`` are its count and score.
    """
    out = {name: df if name in WRITTEN else settle(df, run, f"out/{name}") for name, df in out.items()}
    kinds = {"company_id": "bigint", "cluster_key": "string", "report_count": "bigint", "corroboration_score": "double"}

    def rows(part: str, df: DataFrame, key: str, **columns: str) -> DataFrame:
        columns["cluster_key"] = key
        own = [(F.col(columns[c]) if c in columns else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()]
        return df.select(F.lit(part).alias("part"), *own)

    parts = [rows(f"rows.{name}", df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n")), "name", report_count="n") for name, df in out.items()]
    parts += [
        rows("funding.rounds", out["funding.rounds"], "cluster_key", company_id="company_id", report_count="report_count", corroboration_score="corroboration_score"),
        rows("brief.events", out["brief.events"], "id", company_id="company_id", report_count="amount_usd", corroboration_score="confidence"),
        rows("brief.top_companies", out["brief.top_companies"], "name", company_id="company_id", corroboration_score="score"),
        rows("brief.signal_counts", out["brief.signal_counts"], "source", report_count="signals"),
        rows("rank.ranking", out["rank.ranking"], "name", company_id="company_id", report_count="recent", corroboration_score="score"),
        rows("gate", out["gate"].withColumn("text", F.array_join("failed", ", ")).withColumn("n", F.size("failed")), "text", report_count="n"),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole

"""Audits of whole table sets, counted while the tables are written, and the listing of enriched profiles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import company, jobs, quality, web
from ..session import shared_folder
from . import company_q  # noqa: F401 - its SQL is counted here
from .funding_q import rounds_of
from .rank_q import ACTIONABLE
from .registry import ORACLES, query
from .resolve_q import CASCADE, CASCADE_PARTS
from .source_q import snapshots

#: Tables of the claims audit and of the coverage report, in their order.
CLAIM_TABLES = [
    "funding_round_claims", "funding_rounds", "team_member_claims", "team_members", "product_claims", "products", "license_claims", "regulatory_licenses",
    "company_profile_claims", "job_posting_claims", "job_postings",
]
COVERED = [
    "companies", "intelligence_events", "funding_rounds", "company_details", "github_metrics", "team_members", "products", "technology_stack", "website_snapshots",
    "job_postings", "competitor_relationships", "customer_signals", "ip_assets",
]
#: What each table is built from: a view, or the registered query whose SQL counts it.
COUNTED = {
    "funding_round_claims": "v_claims", "funding_rounds": ("funding_rounds",), "team_member_claims": "v_team", "team_members": ("team_rollup",), "product_claims": "v_products",
    "products": ("product_rollup",), "license_claims": "v_licenses", "regulatory_licenses": ("license_rollup",), "company_profile_claims": "v_profile",
    "job_posting_claims": "v_jobs", "job_postings": ("job_postings",), "companies": "v_companies", "intelligence_events": "v_events", "company_details": ("profile_rollup",),
    "github_metrics": "v_metrics", "technology_stack": ("tech_detect",), "website_snapshots": ("append_snapshots",),
}


def _tables(t):
    """How each audited table is made."""
    return {
        "funding_round_claims": lambda: t("v_claims"), "funding_rounds": lambda: rounds_of(t)[1], "team_member_claims": lambda: t("v_team"),
        "team_members": lambda: company.team_rollup(t("v_team")), "product_claims": lambda: t("v_products"), "products": lambda: company.product_rollup(t("v_products")),
        "license_claims": lambda: t("v_licenses"), "regulatory_licenses": lambda: company.license_rollup(t("v_licenses")), "company_profile_claims": lambda: t("v_profile"),
        "job_posting_claims": lambda: jobs.job_claims(t("v_jobs"), t("v_companies")), "job_postings": lambda: jobs.job_postings(jobs.job_claims(t("v_jobs"), t("v_companies"))),
        "companies": lambda: t("v_companies"), "intelligence_events": lambda: t("v_events"), "company_details": lambda: company.profile_rollup(t("v_profile")),
        "github_metrics": lambda: t("v_metrics"), "technology_stack": lambda: web.tech_detect(t("pages"), "page_id"), "website_snapshots": lambda: snapshots(t),
    }


def _written(t, names):
    """An audit of the named tables after each was written once."""
    folder, audit, tables = f"{shared_folder(t.spark)}/dealweave-audit/{uuid.uuid4().hex}", quality.TableAudit(names), _tables(t)
    for name in names:
        if name in tables:
            audit.write(name, tables[name](), f"{folder}/{name}")
    return audit


def _count(name: str) -> str:
    made = COUNTED.get(name)
    return f"(select count(*) from ({ORACLES[made[0]]}) x)" if isinstance(made, tuple) else f"(select count(*) from {made})" if made else "cast(null as bigint)"


@query("claims_audit", " union all ".join([
    *[f"select '{n}' as table_name, {_count(n)} as rows, '' as missing_columns, "
      + ("coalesce((select concat_ws(',', case when sum(case when company_id is null then 1 else 0 end) > 0 then 'company_id=' || sum(case when company_id is null then 1 else 0 end) end) from v_claims), '')"
         if n == "funding_round_claims" else "''") + " as null_columns, false as failed" for n in CLAIM_TABLES],
    "select 'actionable_missed_company_link', missed, '', '', missed > 0 from actionable"]), **CASCADE_PARTS, cascade=CASCADE, actionable=ACTIONABLE)
def _(t):
    audit = _written(t, CLAIM_TABLES)
    return audit.report(t.spark).unionByName(quality.missed_links(t("v_events"), t("v_signals"), t("v_companies")))


@query("enrichment_coverage", " union all ".join(f"select '{n}' as table_name, {_count(n)} as rows" for n in COVERED))
def _(t):
    return _written(t, COVERED).report(t.spark).select("table_name", "rows")


@query("profile_listing", f"""
select c.company_id, c.name, c.industry, c.github_stars, c.score, p.founded_year, p.headquarters, p.team_size, p.business_model
from ({ORACLES["profile_rollup"]}) p join v_companies c on c.company_id = p.company_id""")
def _(t):
    return company.profile_listing(company.profile_rollup(t("v_profile")), t("v_companies"))

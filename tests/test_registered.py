"""A sample of registered queries against their SQL at the smallest scale."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from dealweave.views import TABLES

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "top_company_events", "dedup_keep_first", "merge_insert_ignore", "resolve_by_name_in_text", "fuzzy_match_company", "cluster_merge",
    "corroboration_score", "funding_rounds", "job_postings", "rank_companies", "match_alert_rules", "stream_ingest_dedup", "scan_form_d",
]


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    return f"{float(v):.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(tuple(canon(v) for v in row) for row in cursor.fetchall())
    got = sorted(tuple(canon(r[c]) for c in columns) for r in df.collect())
    assert got == want


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())

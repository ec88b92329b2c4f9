"""Registered queries against their SQL answers at the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__
from checks import base

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES, ANSWERS = __spark_entry__.queries(), __spark_entry__.oracle_sql()
# one or more of every family; the driver compares all of them
CHOSEN = ["latest_per_key", "attempt_summary", "discovery_eligible", "refresh_candidates",
          "task_union", "first_last_reports", "registry_snapshot", "pending_probe",
          "status_counters", "court_map_audit", "import_legacy", "classify_publications",
          "derive_case_number", "redact_persons", "scrub_known_persons", "fanout_cases",
          "decode_search", "decode_case", "anonymize_cases", "probe_rows", "parse_listing_html",
          "split_sections", "parse_revenue", "debt_sections", "extract_company", "sink_fanout",
          "stream_restart", "stream_malformed", "compact_months", "refresh_batch", "oldest_batch",
          "normalise_cases", "live_extraction", "discovery_dedup"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def show(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)

    return sorted(tuple(show(r[i]) for i in order) for r in data)


def test_every_query_has_an_answer():
    assert set(base.ORACLES) == set(base.QUERIES) <= set(QUERIES)


@pytest.mark.parametrize("name", CHOSEN)
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    want = duck.execute(ANSWERS[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(df.columns)
    got = rows(df.columns, df.collect())
    assert got and got == rows(columns, want.fetchall())

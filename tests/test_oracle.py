"""Registered queries against the oracle engine on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SOME = ["series_analytics", "credit", "valuation", "regime", "headline_block", "security_factors", "upsert_rows", "since_high_water", "company_facts", "feed_items", "skew_measures", "vol_vs_history", "manifest_violations", "stream_upsert", "stream_append_keyed"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def plain(rows, columns):
    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return ""
        if isinstance(v, int | float) and not isinstance(v, bool):
            return f"{float(v):.6f}"
        return str(v)

    return sorted(tuple(cell(r[c]) for c in columns) for r in rows)


@pytest.mark.parametrize("name", SOME)
def test_query_equals_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{file}')")
    got = entry.queries()[name](spark, SF)
    found = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(got.columns)
    want = [dict(zip(names, r, strict=True)) for r in found.fetchall()]
    assert plain(got.collect(), got.columns) == plain(want, got.columns)


def test_entry_and_names(spark):
    assert entry.entry(spark).columns[0] == "series_id"
    known = entry.queries()
    assert set(entry.oracle_sql()) <= set(known) and len(known) > 80

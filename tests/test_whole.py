"""Queries over whole texts and whole tables, against the oracle engine; and cleaning against the standard library."""

import html
import os

import pytest
from pyspark.sql import functions as F
import test_oracle

from tidemark.sources import parse

needs_data = pytest.mark.skipif(not os.path.isdir(test_oracle.SF), reason="no test data")


@needs_data
@pytest.mark.parametrize("name", ["clean_text", "clean_text_whole", "feed_titles"])
def test_whole_texts(spark, name):
    test_oracle.test_query_equals_oracle(spark, name)


@needs_data
@pytest.mark.parametrize("name", ["replace_by_key_whole", "replace_by_key_empty_clears_whole", "upsert_rows_whole", "upsert_counts_whole", "since_high_water_whole", "wide_prices_long_whole", "statements_long_whole"])
def test_whole_tables(spark, name):
    test_oracle.test_query_equals_oracle(spark, name)


@needs_data
@pytest.mark.parametrize("name", ["factor_matrix", "manifest_rows"])
def test_no_step_holds_the_whole_table(spark, name):
    import __spark_entry__ as entry
    from tidemark.plans import fixtures, payload_queries

    test_oracle.test_query_equals_oracle(spark, name)
    if name == "factor_matrix":
        plan = entry.queries()[name](spark, test_oracle.SF)._jdf.queryExecution().analyzed().toString()
        assert "max(price_date" in plan and "_w0" not in plan and not [x for x in plan.split("\n") if "Window" in x and "windowspecdefinition(1" in x]
    else:
        seen = []
        packs, payload_queries.marts.manifest_rows = payload_queries.marts.manifest_rows, lambda m, *_: seen.append(m.count()) or m
        try:
            payload_queries._manifest(lambda n: fixtures.view(spark, test_oracle.SF, n))
        finally:
            payload_queries.marts.manifest_rows = packs
        assert seen[0] > 1


def test_keys_that_one_side_lacks(spark):
    from tidemark.operators import upsert

    names = "user_id long, event_type string, ord long"
    stored = spark.createDataFrame([(1, "a", 1), (2, "a", 2)], names)
    incoming = spark.createDataFrame([(2, "b", 3), (3, "a", 4)], names)
    key = lambda df: sorted((r.user_id, r.event_type) for r in df.collect())
    assert key(upsert.replace_by_key(stored, incoming, ["user_id"])) == [(1, "a"), (2, "b"), (3, "a")]
    loaded = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    assert key(upsert.replace_by_key(stored, incoming, ["user_id"], loaded)) == [(2, "b"), (3, "a")]
    assert key(upsert.upsert(stored, incoming, ["user_id", "event_type"], "ord")[0]) == [(1, "a"), (2, "a"), (2, "b"), (3, "a")]


def test_clean_decodes_every_reference(spark):
    texts = ["a &#8217; b", "&#x27;x&#X41;", "&eacute;&nbsp;", "&amp;lt;", "&notin;&ngE;", "&#0; &#xD800;", "AT&T &copy 5", " ", "&#32;", None, "x" * 5000 + "&hellip;"]
    got = [r.c for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", parse.clean(F.col("t")).alias("c")).orderBy("i").collect()]
    assert got == [None if t is None else html.unescape(t).strip() or None for t in texts]

"""Trailing frames put together from parts against sliding ones; results of some groups read only their rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.stats import by, trailing
from tidemark.operators.scan import trailing_max, trailing_means
from tidemark.plans import fixtures, gold, registry


def test_trailing_frames_equal_sliding_ones(spark):
    r = random.Random(5)
    rows = [(k, i, None if r.random() < 0.2 else r.uniform(-9, 9)) for k, n in (("a", 700), ("b", 9), ("c", 1)) for i in range(n)] + [("d", i, None) for i in range(70)]
    df, w = spark.createDataFrame(rows, "k string, i int, v double"), by("k", "i")
    lengths = {f"m{n}": n for n in (1, 3, 8, 50, 64, 200)}
    got = trailing_means(df, w, "v", lengths)
    for n in (1, 7, 8, 63, 252):
        got = trailing_max(got, w, "v", f"g{n}", n)
    assert got.columns == ["k", "i", "v", *lengths, "g1", "g7", "g8", "g63", "g252"]
    got = got.withColumns({f"w_{m}": F.avg("v").over(trailing(w, n)) for m, n in lengths.items()} | {f"w_g{n}": F.max("v").over(trailing(w, n)) for n in (1, 7, 8, 63, 252)})
    for x in got.collect():
        for c in got.columns[3 : 3 + 11]:
            assert x[c] == (None if x[f"w_{c}"] is None else pytest.approx(x[f"w_{c}"], abs=1e-12)), (x.k, x.i, c)


def test_no_long_frame_slides(spark):
    prices = spark.createDataFrame([], "ticker string, price_date date, close double, adj_close double")
    dim = spark.createDataFrame([], "ticker string, currency string, `group` string, sector string")
    rates = spark.createDataFrame([], "date date, gbp_per_usd double, gbp_per_eur double")
    plan = gold.equity_analytics(prices, dim, rates)._jdf.queryExecution().optimizedPlan().toString()
    assert "RowFrame, -20, currentrow" in plan and not any(f"RowFrame, {-n}, currentrow" in plan for n in (49, 199))


def test_results_of_some_groups_do_not_build_all_of_equity(spark):
    asked = []

    def view(name, held=True):
        asked.append(name)
        return registry.GOLD[name](view) if name in registry.GOLD else fixtures.view(spark, "/root/testdata/sf0.001", name)

    for name in ("value", "scores", "strength", "sector_strength", "index_equity", "equity_block"):
        registry.GOLD[name](view)
    assert "lineitem" in asked and "equity" not in asked and "prices" not in asked
    whole = gold.equity_analytics(view("prices"), view("dim_instrument"), view("fx")).where("`group` = 'watchlist'")
    some = registry.GOLD["watch_equity"](view)
    key = ["ticker", "price_date"]
    assert [tuple(r) for r in some.orderBy(*key).select(*key, F.round("ma_200", 6), F.round("vol_21d", 6)).collect()] == [tuple(r) for r in whole.orderBy(*key).select(*key, F.round("ma_200", 6), F.round("vol_21d", 6)).collect()]

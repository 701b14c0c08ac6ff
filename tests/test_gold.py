"""Hand-checked values of the gold tables on small inputs."""

import datetime as dt

import pytest

from tidemark.operators.asof import asof_calendar, asof_keyed
from tidemark.plans import gold, insights, marts, regime, security

D = dt.date


def rows(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_series_growth_over_a_year_and_z(spark):
    obs = [("A", D(2024, m, 1), 100.0 + m) for m in range(1, 13)] + [("A", D(2025, 1, 1), 113.12), ("B", D(2024, 1, 1), 5.0), ("B", D(2024, 2, 1), 7.0)]
    dim = spark.createDataFrame([("A", "M", "yoy"), ("B", "M", "level")], "series_id string, freq string, transform string")
    out = rows(gold.series_analytics(spark.createDataFrame(obs, "series_id string, obs_date date, value double"), dim), "series_id", "obs_date")
    last = out["A", D(2025, 1, 1)]
    assert last.value_1y_ago == 101.0 and last.chg_yoy == pytest.approx(0.12) and last.primary_value == last.chg_yoy
    assert out["B", D(2024, 1, 1)].primary_zscore is None and out["B", D(2024, 2, 1)].primary_zscore == out["B", D(2024, 2, 1)].zscore
    assert out["B", D(2024, 2, 1)].prev_value == 5.0 and out["B", D(2024, 2, 1)].chg_pct == pytest.approx(0.4)


def test_fx_crosses(spark):
    obs = spark.createDataFrame([("DEXUSUK", D(2021, 3, 8), 1.6), ("DEXUSEU", D(2021, 3, 8), 1.2)], "series_id string, obs_date date, value double")
    r = gold.fx(obs).first()
    assert (r.gbp_per_usd, r.eur_per_gbp, r.gbp_per_eur) == pytest.approx((0.625, 4 / 3, 0.75))


def test_prices_in_pounds(spark):
    prices = spark.createDataFrame([("N", D(2021, 3, 9), 3120.0, 3120.0), ("V", D(2021, 3, 9), 47.5, 47.5), ("V", D(2021, 3, 5), 44.0, 44.0), ("E", D(2021, 3, 20), 12.0, 10.0), ("K", D(2021, 3, 9), 7.0, 7.0)], "ticker string, price_date date, close double, adj_close double")
    dim = spark.createDataFrame([("N", "GBp", "g", "s"), ("V", "USD", "g", "s"), ("E", "EUR", "h", "s"), ("K", "SEK", "g", "s")], "ticker string, currency string, group string, sector string")
    rates = spark.createDataFrame([(D(2021, 3, 8), 0.72, 0.85), (D(2021, 3, 15), 0.73, 0.86)], "date date, gbp_per_usd double, gbp_per_eur double")
    out = rows(gold.equity_analytics(prices, dim, rates), "ticker", "price_date")
    assert out["N", D(2021, 3, 9)].gbp_adj_close == pytest.approx(31.2) and out["V", D(2021, 3, 9)].gbp_adj_close == pytest.approx(34.2)
    assert out["E", D(2021, 3, 20)].gbp_adj_close == pytest.approx(8.6)
    assert out["V", D(2021, 3, 5)].gbp_adj_close is None and out["K", D(2021, 3, 9)].gbp_adj_close is None


def test_vol_states(spark):
    obs = [(s, D(2024, 1, d), v) for d, a, b in ((1, 11.0, 16.0), (2, 33.0, 27.0), (3, 20.9, 21.0)) for s, v in (("VIXCLS", a), ("VXVCLS", b))]
    out = rows(gold.vol_term(spark.createDataFrame(obs, "series_id string, obs_date date, value double")), "date")
    assert [out[(D(2024, 1, d),)].ts_state for d in (1, 2, 3)] == ["contango", "backwardation", "flat"]


def test_positioning_percentile_and_z(spark):
    weeks = [("vix", "VIX", D(2024, 1, 1) + dt.timedelta(days=7 * i), D(2024, 1, 4) + dt.timedelta(days=7 * i), 1000, n, 0, 0, 0) for i, n in enumerate((30, -50, 90, 40, 65))]
    out = rows(gold.positioning(spark.createDataFrame(weeks, "market_id string, market string, report_date date, available_from date, open_interest long, lev_long long, lev_short long, am_long long, am_short long")), "report_date")
    assert out[(D(2024, 1, 15),)].net_lev_pctile == 1.0 and out[(D(2024, 1, 15),)].net_lev_z == pytest.approx((90 - 70 / 3) / (14800 / 3) ** 0.5)
    assert [out[(D(2024, 1, d),)].net_lev_pctile for d in (22, 29)] == [0.75, 0.8] and out[(D(2024, 1, 29),)].net_lev_wow == 25


def test_skew_percentile_and_null_value(spark):
    days = [("spx", "SPY", D(2024, 1, i + 1), "x", 30, 1.0, 0.2, 0.3, 0.1, v, v) for i, v in enumerate((0.04, 0.03, 0.09, 0.06, None))]
    out = rows(gold.skew(spark.createDataFrame(days, "ticker_id string, ticker string, capture_date date, expiry string, dte int, spot double, atm_iv double, put_iv double, call_iv double, put_skew double, risk_reversal double")), "capture_date")
    assert out[(D(2024, 1, 3),)].put_skew_pctile == 1.0 and out[(D(2024, 1, 4),)].put_skew_pctile == 0.75
    assert out[(D(2024, 1, 4),)].put_skew_chg == pytest.approx(-0.03) and out[(D(2024, 1, 5),)].put_skew_pctile == 0.0


def test_as_of_joins_take_rows_also_with_null_values(spark):
    left = spark.createDataFrame([("a", D(2024, 1, d)) for d in (1, 5, 9)] + [("b", D(2024, 1, 5))], "k string, d date")
    right = spark.createDataFrame([("a", D(2024, 1, 2), 1.0), ("a", D(2024, 1, 9), None), ("a", None, 7.0)], "k string, known date, v double")
    got = {(r.k, r.d.day): r.v for r in asof_keyed(left, right, ["k"], "d", "known", ["v"]).collect()}
    assert got == {("a", 1): None, ("a", 5): 1.0, ("a", 9): None, ("b", 5): None}
    got = {(r.k, r.d.day): r.v for r in asof_calendar(left, right.drop("k"), "d", "known", ["v"]).collect()}
    assert got == {("a", 1): None, ("a", 5): 1.0, ("a", 9): None, ("b", 5): 1.0}
    assert asof_calendar(left, right.drop("k").limit(0), "d", "known", ["v"]).count() == 4


def test_regime_axis_and_label(spark):
    z = [("INDPRO", 2.0), ("UNRATE", 1.0), ("CPIAUCSL", -0.5), ("NFCI", 0.1)]
    series = spark.createDataFrame([(s, D(2024, 1, 1), v, v) for s, v in z], "series_id string, obs_date date, value double, primary_zscore double")
    vol = spark.createDataFrame([(D(2024, 1, 1), 0.9, "contango")], "date date, vix_ts_ratio double, ts_state string")
    r = regime.regime(series, vol).first()
    assert r.growth_axis == pytest.approx(0.5) and r.regime_label == "Growth Above-trend · Inflation Below-trend · Conditions Neutral · Vol Calm"
    assert regime.regime(series.where("series_id <> 'NFCI'")).first().regime_label is None


def test_momentum_offsets(spark):
    closes = [50.0] * 290
    closes[-1], closes[-22], closes[-100], closes[-127], closes[-253] = 66.0, 60.0, 88.0, 55.0, 48.0
    prices = spark.createDataFrame([("Q", D(2019, 6, 1) + dt.timedelta(days=i), c) for i, c in enumerate(closes)], "ticker string, date date, close double")
    r = security.momentum(prices, "2020-12-31").first()
    assert (r.ret_1m, r.ret_6m, r.ret_12_1m, r.dist_52w_high) == pytest.approx((0.1, 0.2, 0.25, -0.25))


def test_facts_known_at_two_dates(spark):
    known = [(D(2021, 6, 30), "FY", D(2021, 9, 1), 512.0), (D(2020, 6, 30), "FY", D(2020, 9, 3), 430.0), (D(2020, 6, 30), "FY", D(2021, 10, 4), 431.5), (D(2021, 9, 30), "Q1", D(2021, 11, 2), 140.0)]
    facts = spark.createDataFrame([("Q", "revenue", *k) for k in known], "ticker string, metric string, period_end date, fiscal_period string, filed_date date, value double")
    early, late = security.facts_known(facts, "2021-08-31").first(), security.facts_known(facts, "2021-12-31").first()
    assert early.revenue == 430.0 and early.revenue_prev is None and late.revenue == 512.0 and late.revenue_prev == 431.5


def test_factors_of_equal_values_are_zero_and_missing_stays_missing(spark):
    m = spark.createDataFrame([(f"T{i}", D(2024, 1, 1), "s" if i else None, float(i), 1.0, None) for i in range(5)], "ticker string, asof_date date, sector string, roe double, ret_6m double, pb double")
    out = rows(security.security_factors(m), "ticker")
    assert out[("T0",)].momentum_z == 0.0 and out[("T0",)].value_z is None and out[("T4",)].quality_pct == 1.0 and out[("T0",)].momentum_pct == pytest.approx(0.6)
    assert rows(security.security_factors(m, sector_neutral=True), "ticker")[("T0",)].quality_z is None


def test_violations_and_reconciliation(spark):
    m = spark.createDataFrame([("a", "x", "https://e.com"), ("a", None, "ftp://e.com"), ("b", "y", "https://e.com")], "id string, kind string, url string")
    got = {(r.key, r.rule) for r in marts.violations(m, "id", ["kind"], {"kind": ["x"]}, {"url": "^https?://"}).collect()}
    assert got == {("a", "missing kind"), ("a", "url malformed"), ("b", "kind not allowed"), ("a", "duplicate")}
    assert [r.rule for r in marts.violations(m.limit(0), "id", ["kind"]).collect()] == ["empty"]
    with pytest.raises(ValueError):
        marts.require_columns(m, ["id", "z"])
    r = marts.reconciliation(m, m.where("id = 'a'"), m.where("id = 'a'"), "id").first()
    assert not r.matched and r.explained


def test_latest_measures(spark):
    s = spark.createDataFrame([(D(2024, 1, i + 1), float(v)) for i, v in enumerate((1, 5, 3))] + [(D(2024, 2, 1), None)], "d date, v double")
    r = insights.latest_measures(s, "d", "v").first()
    assert (r.n, r.last, r.z_latest) == (3, 3.0, 0.0) and r.pctile_latest == pytest.approx(200 / 3)
    assert insights.latest_measures(s.limit(2), "d", "v").first().z_latest is None

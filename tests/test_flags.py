"""Every insight rule on hand-made tables: what makes it speak, what keeps it silent, and what a missing table does."""

import datetime as dt

import pytest

from tidemark.plans import insights

D = dt.date
DAYS = [D(2023, 5, 1) + dt.timedelta(days=i) for i in range(10)]


def history(last, base=(4.0, 6.0, 5.0, 4.0, 6.0, 5.0, 4.0, 6.0, 5.0)):
    return [*base, last]


def said(spark, **tables):
    """Rule numbers of the flags over the tables, each a schema and rows."""
    frames = {n: spark.createDataFrame(rows, schema) for n, (schema, rows) in tables.items()}
    return {r.rule for r in insights.flags(**frames).collect()}


def wide(columns):
    names = list(columns)
    rows = list(zip(DAYS, *columns.values(), strict=True))
    kinds = {n: "string" if isinstance(v[-1], str) else "double" for n, v in columns.items()}
    return "date date, " + ", ".join(f"{n} {kinds[n]}" for n in names), rows


def vol(vix, ratio=0.92, state="contango", others=5.0):
    return wide({"vix": history(vix), "ovx": history(others), "gvz": history(others), "vxeem": history(others), "evz": history(others), "vix_ts_ratio": [1.0] * 9 + [ratio], "ts_state": ["flat"] * 9 + [state]})


def credit(quality=5.0, spread=5.0, hy=5.0):
    return wide({"quality_spread": history(quality), "ig_hy_spread": history(spread), "hy_oas": history(hy)})


def market(name, net, rank, wow=0):
    return "market_id string, report_date date, net_lev long, net_lev_pctile double, net_lev_wow long", [(name, DAYS[0], 7, 0.5, 0), (name, DAYS[5], net, rank, wow)]


def skew(rank):
    return "ticker_id string, capture_date date, put_skew_pctile double", [("spx", DAYS[0], 0.5), ("spx", DAYS[3], rank), ("ndx", DAYS[9], 0.99)]


def regime(label="L", growth=0.0):
    return "date date, regime_label string, growth_axis double, inflation_axis double, conditions double", [(DAYS[0], "old", 3.0, 3.0, 3.0), (DAYS[1], label, growth, 0.2, None)]


CASES = {
    1: ({"regimes": regime()}, {"regimes": ("date date, regime_label string, growth_axis double, inflation_axis double, conditions double", [(DAYS[0], None, 0.0, 0.0, 0.0)])}),
    2: ({"regimes": regime(growth=-1.0)}, {"regimes": regime(growth=0.9)}),
    3: ({"curve": wide({"slope_2s10s": [1.0] * 9 + [-0.1], "real_10y": history(5.0)})}, {"curve": wide({"slope_2s10s": [-1.0] * 9 + [0.1], "real_10y": history(5.0)})}),
    4: ({"curve": wide({"slope_2s10s": [1.0] * 10, "real_10y": history(8.0)})}, {"curve": wide({"slope_2s10s": [1.0] * 10, "real_10y": history(5.5)})}),
    5: ({"credit": credit(quality=7.0)}, {"credit": credit(quality=7.0, spread=7.0)}),
    6: ({"credit": credit(hy=3.0)}, {"credit": credit(hy=5.0)}),
    7: ({"vol": vol(9.0)}, {"vol": vol(5.0)}),
    8: ({"equity": ("ticker string, price_date date, ret_1d double", [("^GSPC", DAYS[0], 0.0), ("^GSPC", DAYS[1], -0.015), ("T1", DAYS[2], 0.0)])}, {"equity": ("ticker string, price_date date, ret_1d double", [("^GSPC", DAYS[0], 0.9), ("^GSPC", DAYS[1], 0.01), ("T1", DAYS[2], 0.5)])}),
    9: ({"vol": vol(5.0, 1.1, "backwardation")}, {"vol": vol(5.0)}),
    10: ({"vol": vol(3.0, 0.89)}, {"vol": vol(3.0, 0.90)}),
    11: ({"vol": vol(4.0, others=7.0)}, {"vol": vol(6.0, others=7.0)}),
    12: ({"vol": vol(3.0), "credit": credit(hy=3.0)}, {"vol": vol(3.0), "credit": credit(hy=5.0)}),
    13: ({"positions": market("vix", -4, 0.15)}, {"positions": market("vix", 4, 0.10)}),
    14: ({"positions": market("sp500", 4, 0.90)}, {"positions": market("vix", 4, 0.90)}),
    15: ({"positions": market("gold", 4, 0.05)}, {"positions": market("gold", 4, 0.06)}),
    16: ({"positions": market("gold", 4, 0.5, -5)}, {"positions": market("gold", 4, 0.5, 4)}),
    17: ({"vol": vol(3.0), "positions": market("vix", -4, 0.20)}, {"vol": vol(3.0), "positions": market("vix", -4, 0.21)}),
    18: ({"skews": skew(0.15)}, {"skews": skew(0.2)}),
    19: ({"skews": skew(0.80), "vol": vol(3.0)}, {"skews": skew(0.80), "vol": vol(6.0)}),
    20: ({"strength": ("ticker string, price_date date, group string, excess_63d double", [("T1", DAYS[0], "sector_etfs", 0.1)])}, {"strength": ("ticker string, price_date date, group string, excess_63d double", [("T1", DAYS[0], "style_etfs", 0.1)])}),
    21: ({"scores": ("ticker string, price_date date, composite_z double", [("T1", DAYS[0], 1.0)])}, {"scores": ("ticker string, price_date date, composite_z double", [("T1", DAYS[0], None)])}),
    22: ({"value": ("ticker string, price_date date, earnings_yield double", [("T1", DAYS[0], 1.0)])}, {"value": ("ticker string, price_date date, earnings_yield double", [])}),
    23: ({"series": ("series_id string, obs_date date, primary_value double, primary_zscore double", [("A", DAYS[0], 1.0, 2.0)])}, {"series": ("series_id string, obs_date date, primary_value double, primary_zscore double", [("A", DAYS[0], 1.0, None)])}),
    24: ({"stories": ("published_date date", [(DAYS[0],), (DAYS[1],)])}, {"stories": ("published_date date", [(None,)])}),
}


@pytest.mark.parametrize("rule", CASES)
def test_rule_speaks_and_stays_silent(spark, rule):
    yes, no = CASES[rule]
    assert rule in said(spark, **yes) and rule not in said(spark, **no)


def test_missing_and_empty_tables(spark):
    assert insights.flags().count() == 0 and insights.flags().columns == ["severity", "rule", "category", "text"]
    everything = {k: v for yes, _ in CASES.values() for k, v in yes.items()}
    assert said(spark, **{n: (schema, []) for n, (schema, _) in everything.items()}) == set()
    assert 12 not in said(spark, vol=vol(3.0)) and 17 not in said(spark, positions=market("vix", -4, 0.1))


def test_words_and_severity(spark):
    frames = {n: spark.createDataFrame(rows, schema) for n, (schema, rows) in {"vol": vol(3.0, 0.85), "credit": credit(hy=3.0), "positions": market("vix", -4, 0.125), "skews": skew(0.9)}.items()}
    got = [tuple(r) for r in insights.by_severity(insights.flags(**frames)).collect()]
    assert got[0] == (3, 17, "positioning", "Fragile calm") and [g[0] for g in got] == sorted((g[0] for g in got), reverse=True)
    assert (2, 18, "skew", "Tails bid at 0.90") in got and (2, 10, "vol", "Complacency: ratio 0.85, percentile 10") in got and (2, 13, "positioning", "Crowded short volatility at 0.12") in got

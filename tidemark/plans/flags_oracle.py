"""The insight flags once more, in SQL for the oracle engine."""

from __future__ import annotations


def _num(x: str, digits: int = 2) -> str:
    return f"printf('%.{digits}f', round_even({x}, {digits}) + CAST(0 AS DOUBLE))"


def _m(src: str, value: str) -> str:
    """One row: z of the last value and its percentile."""
    return f"""(SELECT CASE WHEN n >= 3 THEN (last - mean) / nullif(sd, 0) END AS z, CASE WHEN n >= 3 THEN 100.0 * (SELECT count(*) FROM {{{src}}} WHERE {value} <= last) / n END AS p
        FROM (SELECT count({value}) AS n, arg_max({value}, date) AS last, avg({value}) AS mean, stddev_samp({value}) AS sd FROM {{{src}}} WHERE {value} IS NOT NULL))"""


def _rule(severity: str, rule: int, category: str, text: str, source: str) -> str:
    return f"SELECT CAST({severity} AS INT) AS severity, {rule} AS rule, '{category}' AS category, {text} AS text FROM {source}"


def _last(src: str, where: str = "true", by: str = "date", n: int = 1) -> str:
    return f"(SELECT * FROM {{{src}}} WHERE {where} ORDER BY {by} DESC LIMIT {n})"


_POS = "(SELECT * FROM {g_positions} QUALIFY row_number() OVER (PARTITION BY market_id ORDER BY report_date DESC) = 1)"
_TERM = f"{_last('g_vol', 'vix_ts_ratio IS NOT NULL')} t, {_m('g_vol', 'vix')} v, {_m('g_credit', 'hy_oas')} h"
_SPX = _last("g_skew", "ticker_id = 'spx'", "capture_date")
_SECTORS = "{g_strength} WHERE \"group\" = 'sector_etfs' AND excess_63d IS NOT NULL AND price_date = (SELECT max(price_date) FROM {g_strength} WHERE \"group\" = 'sector_etfs' AND excess_63d IS NOT NULL)"
_OTHERS = " + ".join(f"{c}.z" for c in ("ovx", "gvz", "vxeem", "evz"))

RULES = [
    _rule("2", 1, "regime", "'Regime: ' || regime_label", _last("g_regime", "regime_label IS NOT NULL")),
    *[_rule("2", 2, "regime", f"'{a} is far from its norm: ' || {_num(a)}", f"{_last('g_regime')} WHERE abs({a}) >= 1.0") for a in ("growth_axis", "inflation_axis", "conditions")],
    _rule("3", 3, "rates", f"'Curve inverted: ' || {_num('slope_2s10s')}", f"{_last('g_curve', 'slope_2s10s IS NOT NULL')} WHERE slope_2s10s < 0"),
    _rule("2", 4, "rates", f"'Real yield at ' || {_num('z')} || ' deviations'", f"{_m('g_curve', 'real_10y')} WHERE abs(z) >= 1.5"),
    _rule("2", 5, "credit", f"'Stress below a calm surface: quality spread at ' || {_num('q.z')}", f"{_m('g_credit', 'quality_spread')} q, {_m('g_credit', 'ig_hy_spread')} s WHERE q.z > 1 AND s.z < 0.5"),
    _rule("1", 6, "credit", f"'High yield spread at percentile ' || {_num('p', 0)}", f"{_m('g_credit', 'hy_oas')} WHERE p >= 80 OR p <= 20"),
    _rule("CASE WHEN p >= 80 THEN 2 ELSE 1 END", 7, "vol", f"'Volatility index at percentile ' || {_num('p', 0)}", f"{_m('g_vol', 'vix')} WHERE p >= 80 OR p <= 15"),
    _rule("1", 8, "equity", f"'Index moved by ' || {_num('ret_1d', 4)}", f"{_last('g_equity', chr(39).join(['ticker = ', '^GSPC', '']), 'price_date')} WHERE abs(ret_1d) >= 0.015"),
    _rule("2", 9, "vol", f"'Volatility curve in backwardation at ' || {_num('vix_ts_ratio')}", f"{_TERM} WHERE ts_state = 'backwardation'"),
    _rule("2", 10, "vol", f"'Complacency: ratio ' || {_num('vix_ts_ratio')} || ', percentile ' || {_num('v.p', 0)}", f"{_TERM} WHERE ts_state = 'contango' AND vix_ts_ratio < 0.90 AND v.p <= 30"),
    _rule("1", 11, "vol", f"'Calm is narrow: other markets at ' || {_num(f'({_OTHERS}) / 4')}", ", ".join(f"{_m('g_vol', c)} {c}" for c in ("vix", "ovx", "gvz", "vxeem", "evz")) + f" WHERE vix.z < 0 AND ({_OTHERS}) / 4 > 0.8"),
    _rule("0", 12, "vol", "'Calm looks earned'", f"{_TERM} WHERE ts_state = 'contango' AND v.p <= 30 AND h.p <= 30"),
    _rule("2", 13, "positioning", f"'Crowded short volatility at ' || {_num('net_lev_pctile')}", f"{_POS} WHERE market_id = 'vix' AND net_lev < 0 AND net_lev_pctile <= 0.15"),
    _rule("1", 14, "positioning", f"'Crowded long equity at ' || {_num('net_lev_pctile')}", f"{_POS} WHERE market_id = 'sp500' AND net_lev_pctile >= 0.90"),
    _rule("1", 15, "positioning", f"'Positioning stretched in ' || market_id || ' at ' || {_num('net_lev_pctile')}", f"{_POS} WHERE net_lev_pctile >= 0.95 OR net_lev_pctile <= 0.05"),
    _rule("1", 16, "positioning", "'Positioning unwinding in ' || market_id", f"{_POS} WHERE abs(net_lev_wow) > abs(net_lev) AND net_lev <> 0"),
    _rule("3", 17, "positioning", "'Fragile calm'", f"{_TERM}, {_POS} x WHERE ts_state = 'contango' AND v.p <= 35 AND x.market_id = 'vix' AND x.net_lev < 0 AND x.net_lev_pctile <= 0.20"),
    _rule("CASE WHEN put_skew_pctile >= 0.85 THEN 2 ELSE 1 END", 18, "skew", f"CASE WHEN put_skew_pctile >= 0.85 THEN 'Tails bid at ' ELSE 'Skew complacent at ' END || {_num('put_skew_pctile')}", f"{_SPX} WHERE put_skew_pctile >= 0.85 OR put_skew_pctile <= 0.15"),
    _rule("2", 19, "skew", f"'Nervous tails under a calm index at ' || {_num('put_skew_pctile')}", f"{_SPX} s, {_m('g_vol', 'vix')} v WHERE v.p <= 35 AND put_skew_pctile >= 0.80"),
    *[_rule("1", 20, "equity", f"ticker || ' {word} by ' || {_num('excess_63d', 4)}", f"(SELECT * FROM {_SECTORS} ORDER BY round(excess_63d, 9) {way}, ticker LIMIT 1)") for word, way in (("leads", "DESC"), ("lags", "ASC"))],
    _rule("1", 21, "factors", f"'Top name ' || ticker || ' at ' || {_num('composite_z')}", "(SELECT * FROM {g_scores} WHERE composite_z IS NOT NULL ORDER BY price_date DESC, round(composite_z, 9) DESC, ticker LIMIT 1)"),
    _rule("1", 22, "value", f"'Cheapest name ' || ticker || ' at ' || {_num('earnings_yield', 4)}", "(SELECT * FROM {g_value} WHERE earnings_yield IS NOT NULL ORDER BY price_date DESC, round(earnings_yield, 9) DESC, ticker LIMIT 1)"),
    _rule("1", 23, "extremes", f"series_id || ' at ' || {_num('primary_zscore')}", "(SELECT * FROM (SELECT * FROM {g_series} WHERE primary_zscore IS NOT NULL QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY obs_date DESC) = 1) ORDER BY round(abs(primary_zscore), 9) DESC, series_id LIMIT 3)"),
    _rule("0", 24, "news", "count(*) || ' stories on ' || published_date", "{g_headlines} WHERE published_date = (SELECT max(published_date) FROM {g_headlines}) GROUP BY published_date"),
]

FLAGS = " UNION ALL ".join(RULES)

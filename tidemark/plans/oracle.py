"""The gold tables once more, in SQL for the oracle engine: independent statements of what each query must return."""

from __future__ import annotations

from tidemark.plans.fixtures import SERIES


# fixed values: series codes with the columns they fill, members of the axes, metrics and factors. They are stated here
# once more, so that a code that the library lacks shows as a difference
CURVE = {
    "DGS3MO": "y3m", "DGS2": "y2", "DGS5": "y5", "DGS10": "y10", "DGS30": "y30", "T10Y2Y": "slope_2s10s", "T10Y3M": "slope_3m10y",
    "DFII10": "real_10y", "T10YIE": "breakeven_10y", "THREEFYTP10": "term_premium_10y", "DFII5": "real_5y", "T5YIE": "breakeven_5y",
    "T5YIFR": "breakeven_5y5y",
}
CREDIT = {
    "BAMLC0A0CM": "ig_oas", "BAMLH0A0HYM2": "hy_oas", "BAMLC0A1CAAA": "aaa_oas", "BAMLC0A4CBBB": "bbb_oas", "BAMLH0A1HYBB": "bb_oas",
    "BAMLH0A3HYC": "ccc_oas", "BAMLEMCBPIOAS": "em_oas",
}
FX = {"DEXUSUK": "usd_per_gbp", "DEXUSEU": "usd_per_eur"}
VOL = {"VIXCLS": "vix", "VXVCLS": "vix3m", "OVXCLS": "ovx", "GVZCLS": "gvz", "VXEEMCLS": "vxeem", "EVZCLS": "evz", "VXNCLS": "vxn", "RVXCLS": "rvx"}
FUNDAMENTALS = {
    "Total Revenue": "revenue", "Gross Profit": "gross_profit", "Operating Income": "operating_income",
    "Net Income Common Stockholders": "net_income", "Diluted EPS": "diluted_eps", "Diluted Average Shares": "diluted_shares",
    "Total Assets": "total_assets", "Stockholders Equity": "equity", "Total Debt": "total_debt",
    "Operating Cash Flow": "operating_cash_flow", "Capital Expenditure": "capex", "Free Cash Flow": "free_cash_flow",
}
GROWTH_UP = ["INDPRO", "RSAFS", "PAYEMS", "UMCSENT", "HOUST", "GDPC1"]
GROWTH_DOWN = ["UNRATE", "ICSA"]
INFLATION = ["CPIAUCSL", "CPILFESL", "PCEPILFE", "T10YIE", "T5YIFR"]
CONDITIONS = ["NFCI"]
LEVELS = {"DGS2": "dgs2", "DGS10": "dgs10", "BAMLC0A0CM": "ig_oas", "BAMLH0A0HYM2": "hy_oas", "VIXCLS": "vix", "DTWEXBGS": "usd_broad", "DCOILWTICO": "oil_wti"}
INDICES = {"^GSPC": "spx", "^FTSE": "ftse", "^STOXX50E": "estoxx"}
FLOWS = ["revenue", "net_income", "gross_profit", "operating_income", "op_cash_flow", "capex", "eps_diluted"]
STOCKS = ["assets", "equity", "shares", "long_term_debt"]
FACTORS = {
    "value": {"earnings_yield": 1, "fcf_yield": 1, "pb": -1, "ps": -1},
    "momentum": {"ret_12_1m": 1, "ret_6m": 1, "dist_52w_high": 1},
    "quality": {"roe": 1, "gross_margin": 1, "op_margin": 1, "net_margin": 1, "debt_to_equity": -1},
    "growth": {"rev_growth_yoy": 1, "eps_growth_yoy": 1},
}


def _pick(names: dict[str, str], src: str, extra: str) -> str:
    cols = ", ".join(f"max(value) FILTER (series_id = '{k}') AS {n}" for k, n in names.items())
    ids = ", ".join(f"'{k}'" for k in names)
    return f"SELECT *{extra} FROM (SELECT obs_date AS date, {cols} FROM {{{src}}} WHERE series_id IN ({ids}) GROUP BY obs_date)"


def _z(x: str, w: str) -> str:
    return f"({x} - avg({x}) OVER {w}) / nullif(stddev_samp({x}) OVER {w}, 0)"


def _mean(*xs: str) -> str:
    return f"list_avg(list_filter([{', '.join(f'CAST({x} AS DOUBLE)' for x in xs)}], lambda v: v IS NOT NULL))"


_HIST = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _filled(value: str, names: dict[str, str]) -> str:
    """Levels carried forward, by one as-of lookup for each series and date."""
    ids = ", ".join(f"('{k}', '{n}')" for k, n in names.items())
    cols = ", ".join(f"max(v) FILTER (n = '{n}') AS {n}" for n in names.values())
    return f"""SELECT date, {cols} FROM (
        SELECT s.date, s.n, k.{value} AS v FROM (SELECT date, sid, n FROM (SELECT DISTINCT obs_date AS date FROM {{g_series}} WHERE {value} IS NOT NULL) CROSS JOIN (VALUES {ids}) AS i(sid, n)) s
        ASOF LEFT JOIN (SELECT * FROM {{g_series}} WHERE {value} IS NOT NULL) k ON k.series_id = s.sid AND s.date >= k.obs_date) GROUP BY date"""


def _state(x: str, up: str, down: str) -> str:
    return f"CASE WHEN {x} > 0.25 THEN '{up}' WHEN {x} < -0.25 THEN '{down}' WHEN {x} IS NOT NULL THEN 'Neutral' END"


def _best(src: str, score: str, out: str, way: str, where: str = "true") -> str:
    return f"SELECT price_date AS date, string_agg(ticker, ', ' ORDER BY r) AS {out} FROM (SELECT *, row_number() OVER (PARTITION BY price_date ORDER BY round({score}, 9) {way}, ticker) AS r FROM {{{src}}} WHERE {score} IS NOT NULL AND {where}) WHERE r <= 3 GROUP BY price_date"


def _between(x: str, low: float, high: float) -> str:
    return f"CASE WHEN ({x}) BETWEEN {low} AND {high} THEN {x} END"


_MEMBERS = {m: m for m in GROWTH_UP + GROWTH_DOWN + INFLATION + CONDITIONS}
ASOF_DATE = "1999-06-30"
_METRICS = [m for ms in FACTORS.values() for m in ms]


def _fact(m: str, annual: bool, rank: int = 1) -> str:
    return f"SELECT ticker, value FROM (SELECT *, dense_rank() OVER (PARTITION BY ticker ORDER BY period_end DESC) AS y, row_number() OVER (PARTITION BY ticker, period_end ORDER BY filed_date DESC) AS r FROM {{known_facts}} WHERE metric = '{m}'{' AND fiscal_period = ' + chr(39) + 'FY' + chr(39) if annual else ''}) WHERE y = {rank} AND r = 1"


def _factor_steps(src: str, group: str, named: str) -> dict[str, str]:
    """Winsorised z, factor means, their z, percentile ranks and the composite, step by step."""
    neutral = "sector IS NOT NULL AND " if named == "n" else ""
    out = {
        f"{named}_w": "SELECT ticker, asof_date, sector, " + ", ".join(f"CASE WHEN count({m}) OVER g < 3 OR {m} IS NULL THEN {m} ELSE least(greatest({m}, quantile_cont({m}, 0.01) OVER g), quantile_cont({m}, 0.99) OVER g) END AS {m}" for m in _METRICS) + f" FROM {{{src}}} WINDOW g AS (PARTITION BY {group})",
        f"{named}_s": "SELECT ticker, asof_date, sector, " + ", ".join(f"CASE WHEN {neutral}{m} IS NOT NULL THEN coalesce(({m} - avg({m}) OVER g) / nullif(stddev_pop({m}) OVER g, 0), 0) END AS {m}" for m in _METRICS) + f" FROM {{{named}_w}} WINDOW g AS (PARTITION BY {group})",
        f"{named}_r": "SELECT ticker, asof_date, sector, " + ", ".join(_mean(*[m if d > 0 else f"-{m}" for m, d in ms.items()]) + f" AS {f}" for f, ms in FACTORS.items()) + f" FROM {{{named}_s}}",
        f"{named}_z": "SELECT ticker, asof_date, sector, " + ", ".join(f"CASE WHEN {f} IS NOT NULL THEN coalesce(({f} - avg({f}) OVER g) / nullif(stddev_pop({f}) OVER g, 0), 0) END AS {f}_z" for f in FACTORS) + f" FROM {{{named}_r}} WINDOW g AS (PARTITION BY asof_date)",
        f"{named}_c": f"SELECT *, {_mean(*[f + '_z' for f in FACTORS])} AS composite_z FROM {{{named}_z}}",
    }
    ranks = ", ".join(f"CASE WHEN {f}_z IS NOT NULL THEN (rank() OVER (PARTITION BY {f}_z IS NULL ORDER BY round({f}_z, 9)) + (count(*) OVER (PARTITION BY round({f}_z, 9)) - 1) / 2.0) / count({f}_z) OVER () END AS {f}_pct" for f in [*FACTORS, "composite"])
    out[f"g_factors_{named}"] = f"SELECT *, {ranks} FROM {{{named}_c}}"
    return out


STEPS: dict[str, str] = {
    "series_1": f"SELECT o.series_id, obs_date, value, d.freq, d.transform AS intended_transform, lag(value) OVER w AS prev_value, {_z('value', 'h')} AS zscore, CAST(obs_date - INTERVAL 1 YEAR AS DATE) AS back FROM {{series_obs}} o JOIN {{dim_series}} d ON d.series_id = o.series_id WINDOW w AS (PARTITION BY o.series_id ORDER BY obs_date), h AS (PARTITION BY o.series_id ORDER BY obs_date {_HIST})",
    "series_2": "SELECT a.*, a.value - prev_value AS chg, a.value / nullif(prev_value, 0) - 1 AS chg_pct, b.value AS value_1y_ago, a.value / nullif(b.value, 0) - 1 AS chg_yoy FROM {series_1} a ASOF LEFT JOIN {series_obs} b ON a.series_id = b.series_id AND a.back >= b.obs_date",
    "series_3": "SELECT *, CASE WHEN intended_transform = 'yoy' THEN chg_yoy WHEN intended_transform = 'mom' THEN chg ELSE value END AS primary_value, stddev_samp(chg_pct) OVER (PARTITION BY series_id ORDER BY obs_date ROWS 20 PRECEDING) AS roll_vol_21 FROM {series_2}",
    "g_series": f"SELECT *, {_z('primary_value', 'h')} AS primary_zscore FROM {{series_3}} WINDOW h AS (PARTITION BY series_id ORDER BY obs_date {_HIST})",
    "g_curve": _pick(CURVE, "series_obs", ", y10 - y2 AS slope_2s10s_calc"),
    "credit_1": _pick(CREDIT, "series_obs", ", hy_oas - ig_oas AS ig_hy_spread, ccc_oas - bb_oas AS quality_spread"),
    "g_credit": f"SELECT *, {_z('ig_hy_spread', 'h')} AS ig_hy_spread_z, {_z('quality_spread', 'h')} AS quality_spread_z FROM {{credit_1}} WINDOW h AS (ORDER BY date {_HIST})",
    "g_fx": _pick(FX, "series_obs", ", 1 / nullif(usd_per_gbp, 0) AS gbp_per_usd, usd_per_gbp / nullif(usd_per_eur, 0) AS eur_per_gbp, usd_per_eur / nullif(usd_per_gbp, 0) AS gbp_per_eur"),
    "g_vol": _pick(VOL, "series_obs", ", vix / nullif(vix3m, 0) AS vix_ts_ratio, CASE WHEN vix / nullif(vix3m, 0) >= 1.0 THEN 'backwardation' WHEN vix / nullif(vix3m, 0) >= 0.95 THEN 'flat' WHEN vix / nullif(vix3m, 0) < 0.95 THEN 'contango' END AS ts_state"),
    "equity_1": 'SELECT p.ticker, p.price_date, p.close, p.adj_close, i.currency, i."group", i.sector, p.adj_close * (CASE i.currency WHEN \'GBP\' THEN 1 WHEN \'GBp\' THEN 0.01 WHEN \'USD\' THEN x.gbp_per_usd WHEN \'EUR\' THEN x.gbp_per_eur END) AS gbp_adj_close FROM {prices} p JOIN {dim_instrument} i ON i.ticker = p.ticker ASOF LEFT JOIN {g_fx} x ON p.price_date >= x.date',
    "equity_2": "SELECT *, " + ", ".join(f"adj_close / nullif(lag(adj_close, {n}) OVER w, 0) - 1 AS ret_{n}d" for n in (1, 21, 63, 252)) + ", " + ", ".join(f"avg(adj_close) OVER (PARTITION BY ticker ORDER BY price_date ROWS {n - 1} PRECEDING) AS ma_{n}" for n in (50, 200)) + " FROM {equity_1} WINDOW w AS (PARTITION BY ticker ORDER BY price_date)",
    "g_equity": "SELECT *, stddev_samp(ret_1d) OVER (PARTITION BY ticker ORDER BY price_date ROWS 20 PRECEDING) AS vol_21d FROM {equity_2}",
    "strength_1": "SELECT e.ticker, e.price_date, e.\"group\", e.sector, e.adj_close, m.adj_close AS mkt_close, e.adj_close / nullif(m.adj_close, 0) AS rel_close, " + ", ".join(f"e.ret_{n}d - m.ret_{n}d AS excess_{n}d" for n in (21, 63, 252)) + " FROM {g_equity} e, {g_equity} m WHERE m.ticker = '^GSPC' AND m.price_date = e.price_date AND ends_with(e.\"group\", '_etfs')",
    "g_strength": "SELECT *, rel_close / nullif(lag(rel_close, 21) OVER (PARTITION BY ticker ORDER BY price_date), 0) - 1 AS rs_trend_21d FROM {strength_1}",
    "funds_1": "SELECT ticker, period_end, max(available_from) AS available_from, " + ", ".join(f"max(value) FILTER (metric = '{k}') AS {n}" for k, n in FUNDAMENTALS.items()) + " FROM {fundamentals_eav} WHERE freq = 'annual' GROUP BY ALL",
    "g_funds": "SELECT *, " + ", ".join(f"{a} / nullif({b}, 0) AS {n}" for n, a, b in (("gross_margin", "gross_profit", "revenue"), ("operating_margin", "operating_income", "revenue"), ("net_margin", "net_income", "revenue"), ("roe", "net_income", "equity"), ("roa", "net_income", "total_assets"), ("fcf_margin", "free_cash_flow", "revenue"), ("debt_to_equity", "total_debt", "equity"))) + ", " + ", ".join(f"{c} / nullif(lag({c}) OVER y, 0) - 1 AS {n}_growth_yoy" for n, c in (("revenue", "revenue"), ("net_income", "net_income"), ("eps", "diluted_eps"))) + " FROM {funds_1} WINDOW y AS (PARTITION BY ticker ORDER BY period_end)",
    "value_1": "SELECT e.ticker, e.price_date, e.gbp_adj_close * m.shares_outstanding AS market_cap_gbp, f.net_income, f.revenue, f.free_cash_flow, CASE m.financial_currency WHEN 'GBP' THEN 1.0 WHEN 'USD' THEN x.gbp_per_usd WHEN 'EUR' THEN x.gbp_per_eur END AS rate FROM (SELECT * FROM {g_equity} WHERE \"group\" = 'watchlist') e ASOF LEFT JOIN {g_funds} f ON f.ticker = e.ticker AND e.price_date >= f.available_from LEFT JOIN {company_meta} m ON m.ticker = e.ticker ASOF LEFT JOIN {g_fx} x ON e.price_date >= x.date",
    "value_2": "SELECT ticker, price_date, market_cap_gbp, net_income * rate / nullif(market_cap_gbp, 0) AS earnings_yield, revenue * rate / nullif(market_cap_gbp, 0) AS sales_yield, free_cash_flow * rate / nullif(market_cap_gbp, 0) AS fcf_yield FROM {value_1}",
    "g_value": f"SELECT *, {_mean('earnings_yield', 'sales_yield', 'fcf_yield')} AS value_raw FROM {{value_2}}",
    "scores_1": f"SELECT e.ticker, e.price_date, e.sector, f.period_end AS fund_period_end, e.ret_252d AS mom_raw, e.vol_21d AS vol_raw, e.adj_close / nullif(e.ma_200, 0) - 1 AS trend_raw, {_mean('f.net_margin', 'f.roe')} AS quality_raw, {_mean('f.revenue_growth_yoy', 'f.eps_growth_yoy')} AS growth_raw, v.value_raw FROM (SELECT * FROM {{g_equity}} WHERE \"group\" = 'watchlist') e ASOF LEFT JOIN {{g_funds}} f ON f.ticker = e.ticker AND e.price_date >= f.available_from LEFT JOIN {{g_value}} v ON v.ticker = e.ticker AND v.price_date = e.price_date",
    "scores_2": "SELECT *, " + ", ".join(f"{'-' if f == 'vol' else ''}{_z(f + '_raw', 'd')} AS {'lowvol' if f == 'vol' else f}_z" for f in ("mom", "vol", "trend", "quality", "growth", "value")) + " FROM {scores_1} WINDOW d AS (PARTITION BY price_date)",
    "g_scores": f"SELECT *, {_mean('mom_z', 'lowvol_z', 'trend_z', 'quality_z', 'growth_z', 'value_z')} AS composite_z FROM {{scores_2}}",
    "g_headlines": "SELECT item_id, title, nullif(trim(regexp_replace(coalesce(summary, ''), '<[^>]+>', '', 'g')), '') AS summary, link, published_at, CAST(published_at AS DATE) AS published_date, first_feed, f.feed_group AS section, f.region, first_seen_at FROM (SELECT * FROM {headline_items} QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY first_seen_at NULLS LAST, title NULLS LAST) = 1) h LEFT JOIN {news_feeds} f ON f.feed = h.first_feed",
    "g_positions": f"SELECT *, CAST(net_lev AS DOUBLE) / nullif(open_interest, 0) AS net_lev_pct_oi, CAST(net_am AS DOUBLE) / nullif(open_interest, 0) AS net_am_pct_oi, {_z('net_lev', 'h')} AS net_lev_z, {_z('net_am', 'h')} AS net_am_z, net_lev - lag(net_lev) OVER w AS net_lev_wow, CAST(len(list_filter(list(net_lev) OVER h, lambda v: v <= net_lev)) AS DOUBLE) / count(*) OVER h AS net_lev_pctile FROM (SELECT market_id, market, report_date, available_from, open_interest, lev_long - lev_short AS net_lev, am_long - am_short AS net_am FROM {{cot}}) WINDOW w AS (PARTITION BY market_id ORDER BY report_date), h AS (PARTITION BY market_id ORDER BY report_date {_HIST})",
    "g_skew": f"SELECT *, {_z('put_skew', 'h')} AS put_skew_z, {_z('risk_reversal', 'h')} AS rr_z, put_skew - lag(put_skew) OVER w AS put_skew_chg, CASE WHEN put_skew IS NULL THEN 0.0 ELSE CAST(len(list_filter(list(put_skew) OVER h, lambda v: v <= put_skew)) AS DOUBLE) / count(*) OVER h END AS put_skew_pctile FROM {{skew_captures}} WINDOW w AS (PARTITION BY ticker_id ORDER BY capture_date), h AS (PARTITION BY ticker_id ORDER BY capture_date {_HIST})",
    "regime_z": _filled("primary_zscore", _MEMBERS),
    "regime_1": f"SELECT date, {_mean(*GROWTH_UP, *['-' + c for c in GROWTH_DOWN])} AS growth_axis, {_mean(*INFLATION)} AS inflation_axis, CAST(NFCI AS DOUBLE) AS conditions FROM {{regime_z}}",
    "regime_2": f"SELECT r.*, {_state('growth_axis', 'Above-trend', 'Below-trend')} AS growth_state, {_state('inflation_axis', 'Above-trend', 'Below-trend')} AS inflation_state, {_state('conditions', 'Tight', 'Loose')} AS conditions_state, CASE v.ts_state WHEN 'contango' THEN 'Calm' WHEN 'flat' THEN 'Neutral' WHEN 'backwardation' THEN 'Stressed' END AS vol_state FROM {{regime_1}} r LEFT JOIN {{g_vol}} v ON v.date = r.date",
    "g_regime": "SELECT *, 'Growth ' || growth_state || ' · Inflation ' || inflation_state || ' · Conditions ' || conditions_state || coalesce(' · Vol ' || vol_state, '') AS regime_label FROM {regime_2}",
    "levels": _filled("value", LEVELS),
    "g_macro": "SELECT l.*, dgs10 - dgs2 AS slope_2s10s, hy_oas - ig_oas AS ig_hy_spread, growth_axis, inflation_axis, conditions, regime_label FROM {levels} l LEFT JOIN {g_regime} r ON r.date = l.date",
    "index_1": "SELECT price_date AS date, " + ", ".join(f"max(adj_close) FILTER (ticker = '{t}') AS {a}, max(ret_1d) FILTER (ticker = '{t}') AS {a}_ret_1d" for t, a in INDICES.items()) + " FROM {g_equity} WHERE ticker IN (" + ", ".join(f"'{t}'" for t in INDICES) + ") GROUP BY 1",
    "lead_1": _best("g_strength", "excess_63d", "sectors_leading", "DESC", "\"group\" = 'sector_etfs'"),
    "lag_1": _best("g_strength", "excess_63d", "sectors_lagging", "ASC", "\"group\" = 'sector_etfs'"),
    "top_1": _best("g_scores", "composite_z", "top_factor_names", "DESC"),
    "weak_1": _best("g_scores", "composite_z", "weak_factor_names", "ASC"),
    "block_days": "SELECT date FROM {index_1} UNION SELECT price_date FROM {g_strength} WHERE \"group\" = 'sector_etfs' UNION SELECT price_date FROM {g_scores}",
    "g_equity_block": "SELECT * FROM {block_days} LEFT JOIN {index_1} USING (date) LEFT JOIN {lead_1} USING (date) LEFT JOIN {lag_1} USING (date) LEFT JOIN {top_1} USING (date) LEFT JOIN {weak_1} USING (date)",
    "g_headline_block": "SELECT published_date AS date, count(*) AS n_headlines, array_to_string((list(title ORDER BY published_at DESC NULLS LAST, item_id) FILTER (trim(coalesce(title, '')) <> ''))[1:5], ' | ') AS top_headlines FROM {g_headlines} WHERE published_date IS NOT NULL GROUP BY 1",
    "g_positioning_block": "SELECT *, concat_ws(' | ', 'VIX lev ' || CAST(CAST(round_even(vix_lev_pctile * 100, 0) AS INT) AS STRING) || '%ile', 'S&P lev ' || CAST(CAST(round_even(sp500_lev_pctile * 100, 0) AS INT) AS STRING) || '%ile') AS positioning_note FROM (SELECT available_from, max(net_lev_pctile) FILTER (market_id = 'vix') AS vix_lev_pctile, max(net_lev_pctile) FILTER (market_id = 'sp500') AS sp500_lev_pctile FROM {g_positions} WHERE market_id IN ('vix', 'sp500') GROUP BY 1)",
    "g_skew_block": "SELECT capture_date, put_skew, put_skew_pctile, CASE WHEN put_skew IS NULL THEN '' ELSE printf('SPY put-skew %+.3f', round_even(put_skew, 3)) || coalesce(' (' || CAST(CAST(round_even(put_skew_pctile * 100, 0) AS INT) AS STRING) || '%ile)', '') END AS skew_note FROM {g_skew} WHERE ticker_id = 'spx'",
    "g_snapshot": "SELECT m.*, e.* EXCLUDE (date), h.n_headlines, h.top_headlines, v.vix_ts_ratio, v.ts_state, p.vix_lev_pctile, p.sp500_lev_pctile, p.positioning_note, s.put_skew, s.put_skew_pctile, s.skew_note FROM {g_macro} m LEFT JOIN {g_equity_block} e ON e.date = m.date LEFT JOIN {g_headline_block} h ON h.date = m.date LEFT JOIN {g_vol} v ON v.date = m.date ASOF LEFT JOIN {g_positioning_block} p ON m.date >= p.available_from ASOF LEFT JOIN {g_skew_block} s ON m.date >= s.capture_date",
    "g_label": "SELECT date, regime_label FROM {g_regime} WHERE regime_label IS NOT NULL ORDER BY date DESC LIMIT 1",
    "known_facts": f"SELECT * FROM {{universe_facts}} WHERE filed_date <= DATE '{ASOF_DATE}'",
    "closes": f"SELECT ticker, list(close ORDER BY price_date DESC) AS c FROM {{prices}} WHERE price_date <= DATE '{ASOF_DATE}' GROUP BY ticker",
    "facts_wide": "SELECT DISTINCT k.ticker, " + ", ".join(f"f_{m}.value AS {m}" for m in FLOWS + STOCKS) + ", f_rp.value AS revenue_prev, f_ep.value AS eps_prev FROM (SELECT DISTINCT ticker FROM {known_facts}) k " + " ".join(f"LEFT JOIN ({_fact(m, m in FLOWS)}) f_{m} ON f_{m}.ticker = k.ticker" for m in FLOWS + STOCKS) + f" LEFT JOIN ({_fact('revenue', True, 2)}) f_rp ON f_rp.ticker = k.ticker LEFT JOIN ({_fact('eps_diluted', True, 2)}) f_ep ON f_ep.ticker = k.ticker",
    "sec_1": "SELECT p.ticker, i.sector, c[1] AS last_close, c[1] / nullif(c[22], 0) - 1 AS ret_1m, c[1] / nullif(c[127], 0) - 1 AS ret_6m, nullif(c[22], 0) / nullif(c[253], 0) - 1 AS ret_12_1m, c[1] / nullif(list_max(c[1:252]), 0) - 1 AS dist_52w_high, f.* EXCLUDE (ticker), CASE WHEN shares > 0 AND c[1] * shares >= 5e7 THEN c[1] * shares END AS market_cap, CASE WHEN equity > 0 THEN equity END AS book FROM {closes} p LEFT JOIN {facts_wide} f ON f.ticker = p.ticker LEFT JOIN {dim_instrument} i ON i.ticker = p.ticker",
    "g_security": f"SELECT ticker, DATE '{ASOF_DATE}' AS asof_date, sector, last_close, market_cap, "
    + ", ".join(
        f"{_between(e, lo, hi)} AS {n}"
        for n, e, lo, hi in (
            ("earnings_yield", "net_income / nullif(market_cap, 0)", -0.5, 0.5),
            ("pe", "market_cap / (CASE WHEN net_income > 0 THEN net_income END)", 0, 2000),
            ("pb", "market_cap / book", 0, 200),
            ("ps", "market_cap / nullif(revenue, 0)", 0, 200),
            ("fcf_yield", "(op_cash_flow - capex) / nullif(market_cap, 0)", -0.5, 0.5),
            ("roe", "net_income / book", -5, 5),
            ("gross_margin", "gross_profit / nullif(revenue, 0)", -1, 1),
            ("op_margin", "operating_income / nullif(revenue, 0)", -2, 1),
            ("net_margin", "net_income / nullif(revenue, 0)", -2, 1),
            ("debt_to_equity", "long_term_debt / book", 0, 100),
            ("rev_growth_yoy", "(revenue - revenue_prev) / nullif(revenue_prev, 0)", -1, 10),
            ("eps_growth_yoy", "(eps_diluted - eps_prev) / nullif(abs(eps_prev), 0)", -10, 10),
        )
    )
    + ", ret_1m, ret_6m, ret_12_1m, dist_52w_high FROM {sec_1}",
    "g_sectors": "SELECT CASE WHEN sector = '' THEN '-' ELSE sector END AS sector, count(*) AS n, avg(composite_z) AS avg_composite FROM {g_factors_u} WHERE sector IS NOT NULL GROUP BY 1",
    "screen_rows": "SELECT f.*, m.earnings_yield, m.market_cap, m.pe, m.ret_12_1m FROM {g_factors_u} f LEFT JOIN {g_security} m ON m.ticker = f.ticker",
    "g_screens": "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS screen, row_number() OVER (ORDER BY round({s}, 9) DESC NULLS LAST, ticker) AS rank, ticker, sector, {s} AS score, earnings_yield, market_cap, pe, ret_12_1m FROM {{screen_rows}} WHERE {w}" for n, s, w in (("composite", "composite_z", "composite_z IS NOT NULL"), ("value", "value_z", "value_z IS NOT NULL"), ("momentum", "momentum_z", "momentum_z IS NOT NULL"), ("quality", "quality_z", "quality_z IS NOT NULL"), ("cheap_good", "composite_z", "value_pct > 0.7 AND quality_pct > 0.7"))) + ") WHERE rank <= 25",
}
STEPS |= _factor_steps("g_security", "asof_date", "u") | _factor_steps("g_security", "asof_date, sector", "n")

#: Month ends of the metrics panel.
PANEL = ["1998-07-31", "1998-08-31", "1998-09-30", "1998-10-31", "1998-11-30", "1998-12-31", "1999-01-31", "1999-02-28", "1999-03-31", "1999-04-30", "1999-05-31", ASOF_DATE]


def _on_date(name: str, k: int) -> str:
    """A step of the metrics as of PANEL[k]."""
    text = STEPS[name].replace(f"'{ASOF_DATE}'", f"'{PANEL[k]}'")
    for other in ("known_facts", "closes", "facts_wide", "sec_1"):
        text = text.replace(f"{{{other}}}", f"{{{other}_{k}}}")
    return text


STEPS |= {f"{n}_{k}": _on_date(n, k) for k in range(len(PANEL)) for n in ("known_facts", "closes", "facts_wide", "sec_1", "g_security")}
STEPS["g_panel"] = " UNION ALL ".join(f"SELECT * FROM {{g_security_{k}}}" for k in range(len(PANEL)))

__all__ = ["ASOF_DATE", "PANEL", "SERIES", "STEPS"]

"""Gold tables: one function each, from staging tables to analytics that hold no later knowledge."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.stats import by, change, expanding, growth, row_mean, safe_div, trailing, zscore_over
from tidemark.operators.asof import asof, asof_calendar, asof_keyed, value_before
from tidemark.operators.dedupe import first_by
from tidemark.operators.hold import cut
from tidemark.operators.pivot import pivot_max
from tidemark.operators.ranks import dominance, matched
from tidemark.operators.scan import BLOCK_ROWS, block_window, expanding_z, in_blocks, trailing_means, with_moments

# fixed values: public series codes and the columns they fill
CURVE = {"DGS3MO": "y3m", "DGS2": "y2", "DGS5": "y5", "DGS10": "y10", "DGS30": "y30", "T10Y2Y": "slope_2s10s", "T10Y3M": "slope_3m10y", "DFII10": "real_10y", "T10YIE": "breakeven_10y", "THREEFYTP10": "term_premium_10y", "DFII5": "real_5y", "T5YIE": "breakeven_5y", "T5YIFR": "breakeven_5y5y"}
CREDIT = {"BAMLC0A0CM": "ig_oas", "BAMLH0A0HYM2": "hy_oas", "BAMLC0A1CAAA": "aaa_oas", "BAMLC0A4CBBB": "bbb_oas", "BAMLH0A1HYBB": "bb_oas", "BAMLH0A3HYC": "ccc_oas", "BAMLEMCBPIOAS": "em_oas"}
FX = {"DEXUSUK": "usd_per_gbp", "DEXUSEU": "usd_per_eur"}
VOL = {"VIXCLS": "vix", "VXVCLS": "vix3m", "OVXCLS": "ovx", "GVZCLS": "gvz", "VXEEMCLS": "vxeem", "EVZCLS": "evz", "VXNCLS": "vxn", "RVXCLS": "rvx"}
FUNDAMENTALS = {"Total Revenue": "revenue", "Gross Profit": "gross_profit", "Operating Income": "operating_income", "Net Income Common Stockholders": "net_income", "Diluted EPS": "diluted_eps", "Diluted Average Shares": "diluted_shares", "Total Assets": "total_assets", "Stockholders Equity": "equity", "Total Debt": "total_debt", "Operating Cash Flow": "operating_cash_flow", "Capital Expenditure": "capex", "Free Cash Flow": "free_cash_flow"}
BENCHMARK = "^GSPC"
ETF_GROUPS = ("sector_etfs", "style_etfs", "country_etfs")
WATCHLIST = "watchlist"
#: Days of a slice of the series in which their year-old values are looked up.
SERIES_DAYS = 32


def series_analytics(obs: DataFrame, dim: DataFrame) -> DataFrame:
    """(series, date): change, growth over a year, expanding z, the value as intended by the manifest, rolling deviation.

    One shuffle by series serves all windows, the year-old value included.
    """
    w = by("series_id", "obs_date")
    base = obs.join(F.broadcast(dim.select("series_id", "freq", F.col("transform").alias("intended_transform"))), "series_id")
    x = base.withColumns({"prev_value": F.lag("value").over(w), "chg": change("value", w), "chg_pct": growth("value", w), "zscore": zscore_over("value", expanding(w)), "value_1y_ago": value_before("value", "series_id", "obs_date")})
    x = x.withColumns({"roll_vol_21": F.stddev_samp("chg_pct").over(trailing(w, 21)), "chg_yoy": safe_div("value", "value_1y_ago") - 1})
    x = x.withColumn("primary_value", F.when(F.col("intended_transform") == "yoy", F.col("chg_yoy")).when(F.col("intended_transform") == "mom", F.col("chg")).otherwise(F.col("value")))
    x = x.withColumn("primary_zscore", zscore_over("primary_value", expanding(w)))
    return x.select("series_id", "obs_date", "value", "prev_value", "chg", "chg_pct", "value_1y_ago", "chg_yoy", "zscore", "primary_value", "primary_zscore", "roll_vol_21", "freq", "intended_transform")


def series_analytics_blocks(obs: DataFrame, dim: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """As series_analytics, for series of any length: by blocks of rows, with the moments of earlier blocks carried in.

    The year-old value is an as-of join of the series with itself. obs has one row a date for each series.
    """
    known = obs.join(F.broadcast(dim.select("series_id", "freq", F.col("transform").alias("intended_transform"))), "series_id")
    aged = asof(known.withColumn("_back", F.add_months("obs_date", -12)), known.select("series_id", F.col("obs_date").alias("_then"), F.col("value").alias("value_1y_ago")), ["series_id"], "_back", "_then", ["value_1y_ago"], SERIES_DAYS)
    w = block_window("series_id", "obs_date")
    x = in_blocks(aged.drop("_back"), "series_id", "obs_date", 22, block_rows)  # a change, and 21 of them
    x = x.withColumns({"prev_value": F.lag("value").over(w), "chg": change("value", w), "chg_pct": growth("value", w)})
    x = x.withColumns({"roll_vol_21": F.stddev_samp("chg_pct").over(trailing(w, 21)), "chg_yoy": safe_div("value", "value_1y_ago") - 1}).where("_own")
    x = cut(x.withColumn("primary_value", F.when(F.col("intended_transform") == "yoy", F.col("chg_yoy")).when(F.col("intended_transform") == "mom", F.col("chg")).otherwise(F.col("value"))))
    x = with_moments(x, "series_id", ["value", "primary_value"])
    x = x.withColumns({"zscore": expanding_z("value", w), "primary_zscore": expanding_z("primary_value", w)})
    return x.select("series_id", "obs_date", "value", "prev_value", "chg", "chg_pct", "value_1y_ago", "chg_yoy", "zscore", "primary_value", "primary_zscore", "roll_vol_21", "freq", "intended_transform")


def _wide(obs: DataFrame, names: dict[str, str]) -> DataFrame:
    return pivot_max(obs, ["obs_date"], "series_id", "value", names).withColumnRenamed("obs_date", "date")


def curve(obs: DataFrame) -> DataFrame:
    return _wide(obs, CURVE).withColumn("slope_2s10s_calc", F.col("y10") - F.col("y2"))


def credit(obs: DataFrame) -> DataFrame:
    """Spreads of one row a date, and their expanding z; the unpartitioned window runs over that calendar only."""
    wide = _wide(obs, CREDIT).withColumns({"ig_hy_spread": F.col("hy_oas") - F.col("ig_oas"), "quality_spread": F.col("ccc_oas") - F.col("bb_oas")})
    w = expanding(Window.partitionBy(F.lit(0)).orderBy("date"))
    return wide.withColumns({"ig_hy_spread_z": zscore_over("ig_hy_spread", w), "quality_spread_z": zscore_over("quality_spread", w)})


def fx(obs: DataFrame) -> DataFrame:
    wide = _wide(obs, FX)
    return wide.withColumns({"gbp_per_usd": safe_div(F.lit(1.0), "usd_per_gbp"), "eur_per_gbp": safe_div("usd_per_gbp", "usd_per_eur"), "gbp_per_eur": safe_div("usd_per_eur", "usd_per_gbp")})


def equity_analytics(prices: DataFrame, dim: DataFrame, rates: DataFrame) -> DataFrame:
    """(ticker, date): price in pounds at the rate known that day, trailing returns, averages and deviation."""
    px = prices.join(F.broadcast(dim.select("ticker", "currency", "group", "sector")), "ticker")
    px = asof_calendar(px, rates, "price_date", "date", ["gbp_per_usd", "gbp_per_eur"])
    c = F.col("currency")
    pounds = F.when(c == "GBP", F.col("adj_close")).when(c == "GBp", F.col("adj_close") / 100).when(c == "USD", F.col("adj_close") * F.col("gbp_per_usd")).when(c == "EUR", F.col("adj_close") * F.col("gbp_per_eur"))
    w = by("ticker", "price_date")
    x = px.withColumn("gbp_adj_close", pounds).withColumns({f"ret_{n}d": growth("adj_close", w, n) for n in (1, 21, 63, 252)})
    x = trailing_means(x, w, "adj_close", {f"ma_{n}": n for n in (50, 200)})
    x = x.withColumn("vol_21d", F.stddev_samp("ret_1d").over(trailing(w, 21)))
    return x.select("ticker", "price_date", "close", "adj_close", "currency", "group", "sector", "gbp_adj_close", "ret_1d", "ret_21d", "ret_63d", "ret_252d", "vol_21d", "ma_50", "ma_200")


def relative_strength(equity: DataFrame, benchmark: str = BENCHMARK) -> DataFrame:
    """(ticker, date) of the fund groups against the benchmark: ratio, excess returns, 21-row trend of the ratio."""
    market = equity.where(F.col("ticker") == benchmark).select("price_date", F.col("adj_close").alias("mkt_close"), *[F.col(f"ret_{n}d").alias(f"mkt_{n}") for n in (21, 63, 252)])
    x = equity.where(F.col("group").isin(*ETF_GROUPS)).join(market, "price_date").withColumn("rel_close", safe_div("adj_close", "mkt_close"))
    x = x.withColumns({f"excess_{n}d": F.col(f"ret_{n}d") - F.col(f"mkt_{n}") for n in (21, 63, 252)})
    x = x.withColumn("rs_trend_21d", growth("rel_close", by("ticker", "price_date"), 21))
    return x.select("ticker", "price_date", "group", "sector", "adj_close", "mkt_close", "rel_close", "excess_21d", "excess_63d", "excess_252d", "rs_trend_21d")


def fundamentals(facts: DataFrame) -> DataFrame:
    """(ticker, period): annual metrics side by side, ratios, growth over the period before."""
    annual = facts.where(F.col("freq") == "annual")
    wide = annual.groupBy("ticker", "period_end").agg(F.max("available_from").alias("available_from"), *[F.max(F.when(F.col("metric") == k, F.col("value"))).alias(n) for k, n in FUNDAMENTALS.items()])
    ratio = {"gross_margin": ("gross_profit", "revenue"), "operating_margin": ("operating_income", "revenue"), "net_margin": ("net_income", "revenue"), "roe": ("net_income", "equity"), "roa": ("net_income", "total_assets"), "fcf_margin": ("free_cash_flow", "revenue"), "debt_to_equity": ("total_debt", "equity")}
    w = by("ticker", "period_end")
    return wide.withColumns({k: safe_div(*v) for k, v in ratio.items()}).withColumns({"revenue_growth_yoy": growth("revenue", w), "net_income_growth_yoy": growth("net_income", w), "eps_growth_yoy": growth("diluted_eps", w)})


def valuation(equity: DataFrame, funds: DataFrame, meta: DataFrame, rates: DataFrame) -> DataFrame:
    """(ticker, date) of the watchlist: yields on market value, both in pounds, from statements known that day."""
    px = equity.where(F.col("group") == WATCHLIST).select("ticker", "price_date", "gbp_adj_close")
    x = asof_keyed(px, funds, ["ticker"], "price_date", "available_from", ["revenue", "net_income", "free_cash_flow"])
    x = x.join(F.broadcast(meta.select("ticker", "financial_currency", "shares_outstanding")), "ticker", "left")
    x = asof_calendar(x, rates, "price_date", "date", ["gbp_per_usd", "gbp_per_eur"])
    c = F.col("financial_currency")
    rate = F.when(c == "GBP", F.lit(1.0)).when(c == "USD", F.col("gbp_per_usd")).when(c == "EUR", F.col("gbp_per_eur"))
    x = x.withColumns({"market_cap_gbp": F.col("gbp_adj_close") * F.col("shares_outstanding"), "rate": rate})
    x = x.withColumns({f"{k}_yield": safe_div(F.col(v) * F.col("rate"), "market_cap_gbp") for k, v in {"earnings": "net_income", "sales": "revenue", "fcf": "free_cash_flow"}.items()})
    return x.select("ticker", "price_date", "market_cap_gbp", "earnings_yield", "sales_yield", "fcf_yield", row_mean("earnings_yield", "sales_yield", "fcf_yield").alias("value_raw"))


def factor_scores(equity: DataFrame, funds: DataFrame, value: DataFrame) -> DataFrame:
    """(ticker, date) of the watchlist: six factors, their z across each date, and the mean of those that exist."""
    px = equity.where(F.col("group") == WATCHLIST).select("ticker", "price_date", "sector", F.col("ret_252d").alias("mom_raw"), F.col("vol_21d").alias("vol_raw"), (safe_div("adj_close", "ma_200") - 1).alias("trend_raw"))
    x = asof_keyed(px, funds, ["ticker"], "price_date", "available_from", ["period_end", "net_margin", "roe", "revenue_growth_yoy", "eps_growth_yoy"])
    x = x.join(value.select("ticker", "price_date", "value_raw"), ["ticker", "price_date"], "left")
    x = x.withColumns({"quality_raw": row_mean("net_margin", "roe"), "growth_raw": row_mean("revenue_growth_yoy", "eps_growth_yoy")})
    day, factors = Window.partitionBy("price_date"), ("mom", "vol", "trend", "quality", "growth", "value")
    x = x.withColumns({f"{f}_z": zscore_over(f"{f}_raw", day) for f in factors}).withColumn("lowvol_z", -F.col("vol_z"))
    zs = ["mom_z", "lowvol_z", "trend_z", "quality_z", "growth_z", "value_z"]
    return x.select("ticker", "price_date", "sector", F.col("period_end").alias("fund_period_end"), *[f"{f}_raw" for f in factors], *zs, row_mean(*zs).alias("composite_z"))


def headlines(items: DataFrame, feeds: DataFrame) -> DataFrame:
    """One row a story: the earliest seen, its summary without markup, its day and its feed's section."""
    once = first_by(items, ["item_id"], F.col("first_seen_at").asc_nulls_last(), F.col("title").asc_nulls_last())
    plain = F.nullif(F.trim(F.regexp_replace(F.coalesce("summary", F.lit("")), "<[^>]+>", "")), F.lit(""))
    section = F.broadcast(feeds.select(F.col("feed").alias("first_feed"), F.col("feed_group").alias("section"), "region"))
    x = once.join(section, "first_feed", "left").withColumns({"summary": plain, "published_date": F.to_date("published_at")})
    return x.select("item_id", "title", "summary", "link", "published_at", "published_date", "first_feed", "section", "region", "first_seen_at")


def vol_term(obs: DataFrame) -> DataFrame:
    wide = _wide(obs, VOL).withColumn("vix_ts_ratio", safe_div("vix", "vix3m"))
    r = F.col("vix_ts_ratio")
    return wide.withColumn("ts_state", F.when(r >= 1.0, "backwardation").when(r >= 0.95, "flat").when(r.isNotNull(), "contango"))


def expanding_percentile(df: DataFrame, key: str, date: str, value: str, out: str) -> DataFrame:
    """Share of a key's history, the current row included, that is not above the current value; 0 for null.

    A key's history has one row a date. It is counted by dominance over places and values, so that a long one spreads.
    """
    counts = dominance(df, key, date, value)
    share = F.coalesce(F.col("not_above") / (F.col("place") + 1), F.lit(0.0))
    return matched(df, counts.select(key, date, share.alias(out)), [key, date], [out])


def positioning(cot: DataFrame) -> DataFrame:
    """(market, week): net positions, shares of open interest, expanding z and percentile, change over a week."""
    x = cot.select("market_id", "market", "report_date", "available_from", "open_interest", (F.col("lev_long") - F.col("lev_short")).alias("net_lev"), (F.col("am_long") - F.col("am_short")).alias("net_am"))
    w = by("market_id", "report_date")
    x = x.withColumns({f"net_{k}_pct_oi": safe_div(f"net_{k}", "open_interest") for k in ("lev", "am")} | {f"net_{k}_z": zscore_over(f"net_{k}", expanding(w)) for k in ("lev", "am")} | {"net_lev_wow": change("net_lev", w)})
    return expanding_percentile(x, "market_id", "report_date", "net_lev", "net_lev_pctile")


def skew(captures: DataFrame) -> DataFrame:
    """(ticker, day): expanding z of both skew measures, change and expanding percentile of the put side."""
    x = captures.select("ticker_id", "ticker", "capture_date", "expiry", "dte", "spot", "atm_iv", "put_iv", "call_iv", "put_skew", "risk_reversal")
    w = by("ticker_id", "capture_date")
    x = x.withColumns({"put_skew_z": zscore_over("put_skew", expanding(w)), "rr_z": zscore_over("risk_reversal", expanding(w)), "put_skew_chg": change("put_skew", w)})
    return expanding_percentile(x, "ticker_id", "capture_date", "put_skew", "put_skew_pctile")



"""The registered queries over the given tables, and the oracle's SQL for each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.hold import hold, release
from tidemark.plans import fixtures, gold, regime, security
from tidemark.plans.oracle import ASOF_DATE, STEPS

View = Callable[..., DataFrame]

@dataclass
class Query:
    """run: from the relations to a result. The result's columns are exact (plain) or doubles, which are rounded; sql is
    the oracle's relation of the same columns, a name in STEPS or a statement."""

    run: Callable[[View], DataFrame]
    plain: str
    doubles: str = ""
    sql: str | None = None
    digits: int = 6
    many: bool = False  # whether run itself reads a gold table more than once

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        kept: dict[str, DataFrame] = {}
        release()

        def view(name: str, held: bool = True) -> DataFrame:
            """A relation. Gold tables that others are built from are held until the next query, as a saved table would
            be: they are read several times in one query."""
            if name not in kept:
                df = GOLD[name](view) if name in GOLD else fixtures.view(spark, sf_dir, name)
                if held and name in SHARED:
                    hold(df)
                kept[name] = df
            return kept[name]

        out = self.run(view if self.many else lambda name: view(name, held=False))
        return out.select(*[F.col(f"`{c}`") for c in self.plain.split()], *[(F.round(F.col(c).cast("double"), self.digits) + F.lit(0.0)).alias(c) for c in self.doubles.split()])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        name = self.sql if self.sql in STEPS else "result_"
        more = STEPS if name in STEPS else STEPS | {name: self.sql}
        cols = [f'"{c}"' for c in self.plain.split()] + [f"round(CAST({c} AS DOUBLE), {self.digits}) + CAST(0 AS DOUBLE) AS {c}" for c in self.doubles.split()]
        return f"{fixtures.ctes([name], more)} SELECT {', '.join(cols)} FROM {name}"


def _equity_of(v: View, *groups: str, tickers: tuple[str, ...] = ()) -> DataFrame:
    """equity of these groups and tickers only: others' rows fall away when lineitem meets the instruments, before they are
    grouped. Each ticker's values come from its own rows, so they are those of equity."""
    dim = v("dim_instrument").where(F.col("group").isin(*groups) | F.col("ticker").isin(*tickers))
    return gold.equity_analytics(fixtures.over(dim.sparkSession, "prices", {"lineitem": v("lineitem"), "dim_instrument": dim}), dim, v("fx"))


#: Gold tables by the name under which other queries read them.
GOLD: dict[str, Callable[[View], DataFrame]] = {
    "series": lambda v: gold.series_analytics(v("series_obs"), v("dim_series")),
    "curve": lambda v: gold.curve(v("series_obs")),
    "credit": lambda v: gold.credit(v("series_obs")),
    "fx": lambda v: gold.fx(v("series_obs")),
    "vol": lambda v: gold.vol_term(v("series_obs")),
    "equity": lambda v: gold.equity_analytics(v("prices"), v("dim_instrument"), v("fx")),
    "strength": lambda v: gold.relative_strength(_equity_of(v, *gold.ETF_GROUPS, tickers=(gold.BENCHMARK,))),
    "sector_strength": lambda v: gold.relative_strength(_equity_of(v, "sector_etfs", tickers=(gold.BENCHMARK,))),
    "index_equity": lambda v: _equity_of(v, tickers=tuple(regime.INDICES)),
    "watch_equity": lambda v: _equity_of(v, gold.WATCHLIST),
    "funds": lambda v: gold.fundamentals(v("fundamentals_eav")),
    "value": lambda v: gold.valuation(v("watch_equity", False), v("funds"), v("company_meta"), v("fx")),
    "scores": lambda v: gold.factor_scores(v("watch_equity"), v("funds"), v("value", False)),
    "stories": lambda v: gold.headlines(v("headline_items"), v("news_feeds")),
    "positions": lambda v: gold.positioning(v("cot")),
    "skews": lambda v: gold.skew(v("skew_captures")),
    "regimes": lambda v: regime.regime(v("series"), v("vol")),
    "macro": lambda v: regime.macro_snapshot(v("series"), v("regimes")),
    "equity_block": lambda v: regime.equity_block(v("index_equity"), v("sector_strength"), v("scores")),
    "headline_block": lambda v: regime.headline_block(v("stories")),
    "vol_block": lambda v: regime.vol_block(v("vol")),
    "positioning_block": lambda v: regime.positioning_block(v("positions")),
    "skew_block": lambda v: regime.skew_block(v("skews")),
    "snapshot": lambda v: regime.daily_snapshot(v("macro"), v("equity_block"), v("headline_block"), v("vol_block"), v("positioning_block"), v("skew_block")),
    "universe_prices": lambda v: v("prices").select("ticker", F.col("price_date").alias("date"), "close"),
    "security": lambda v: security.security_metrics(v("universe_prices"), v("universe_facts"), v("dim_instrument"), ASOF_DATE),
    "factors": lambda v: security.security_factors(v("security")),
}


#: Gold tables that several others read.
SHARED = {"series", "fx", "vol", "watch_equity", "sector_strength", "funds", "value", "scores", "stories", "positions", "skews", "security", "factors", "regimes"}


def _stamp(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps as text, so that both engines print them alike."""
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss") for n in names})


_BLOCK = "spx spx_ret_1d ftse ftse_ret_1d estoxx estoxx_ret_1d"
_MACRO = "dgs2 dgs10 slope_2s10s ig_oas hy_oas ig_hy_spread vix usd_broad oil_wti growth_axis inflation_axis conditions"
_FACTOR_COLS = "value_z momentum_z quality_z growth_z value_pct momentum_pct quality_pct growth_pct composite_z composite_pct"
_SECURITY = "earnings_yield pe pb ps fcf_yield roe gross_margin op_margin net_margin debt_to_equity rev_growth_yoy eps_growth_yoy ret_1m ret_6m ret_12_1m dist_52w_high last_close"

_SERIES = "value prev_value chg chg_pct value_1y_ago chg_yoy zscore primary_value primary_zscore roll_vol_21"

QUERIES: dict[str, Query] = {
    # blocks of few rows, so that the given series have several
    "series_analytics_blocks": Query(lambda v: gold.series_analytics_blocks(v("series_obs"), v("dim_series"), 128), "series_id obs_date freq intended_transform", _SERIES, "g_series"),
    "series_analytics": Query(lambda v: v("series"), "series_id obs_date freq intended_transform", "value prev_value chg chg_pct value_1y_ago chg_yoy zscore primary_value primary_zscore roll_vol_21", "g_series"),
    "curve": Query(lambda v: v("curve"), "date", " ".join(gold.CURVE.values()) + " slope_2s10s_calc", "g_curve"),
    "credit": Query(lambda v: v("credit"), "date", " ".join(gold.CREDIT.values()) + " ig_hy_spread quality_spread ig_hy_spread_z quality_spread_z", "g_credit"),
    "fx": Query(lambda v: v("fx"), "date", "usd_per_gbp usd_per_eur gbp_per_usd eur_per_gbp gbp_per_eur", "g_fx"),
    "vol_term": Query(lambda v: v("vol"), "date ts_state", " ".join(gold.VOL.values()) + " vix_ts_ratio", "g_vol"),
    "equity_analytics": Query(lambda v: v("equity"), "ticker price_date currency group sector", "close adj_close gbp_adj_close ret_1d ret_21d ret_63d ret_252d vol_21d ma_50 ma_200", "g_equity"),
    "relative_strength": Query(lambda v: v("strength"), "ticker price_date group sector", "adj_close mkt_close rel_close excess_21d excess_63d excess_252d rs_trend_21d", "g_strength"),
    "fundamentals": Query(lambda v: v("funds"), "ticker period_end available_from", " ".join(gold.FUNDAMENTALS.values()) + " gross_margin operating_margin net_margin roe roa fcf_margin debt_to_equity revenue_growth_yoy net_income_growth_yoy eps_growth_yoy", "g_funds", digits=4),
    "valuation": Query(lambda v: v("value"), "ticker price_date", "market_cap_gbp earnings_yield sales_yield fcf_yield value_raw", "g_value", digits=4),
    "factor_scores": Query(lambda v: v("scores"), "ticker price_date sector fund_period_end", "mom_raw vol_raw trend_raw quality_raw growth_raw value_raw mom_z lowvol_z trend_z quality_z growth_z value_z composite_z", "g_scores"),
    "headlines": Query(lambda v: _stamp(v("stories"), "published_at", "first_seen_at"), "item_id title summary link published_at published_date first_feed section region first_seen_at", "", "SELECT * REPLACE (strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at, strftime(first_seen_at, '%Y-%m-%d %H:%M:%S') AS first_seen_at) FROM {g_headlines}"),
    "positioning": Query(lambda v: v("positions"), "market_id market report_date available_from open_interest net_lev net_am net_lev_wow", "net_lev_pct_oi net_am_pct_oi net_lev_z net_am_z net_lev_pctile", "g_positions"),
    "skew": Query(lambda v: v("skews"), "ticker_id ticker capture_date expiry dte", "spot atm_iv put_iv call_iv put_skew risk_reversal put_skew_z rr_z put_skew_chg put_skew_pctile", "g_skew"),
    "regime": Query(lambda v: v("regimes"), "date growth_state inflation_state conditions_state vol_state regime_label", "growth_axis inflation_axis conditions", "g_regime"),
    "macro_snapshot": Query(lambda v: v("macro"), "date regime_label", _MACRO, "g_macro"),
    "equity_block": Query(lambda v: v("equity_block"), "date sectors_leading sectors_lagging top_factor_names weak_factor_names", _BLOCK, "g_equity_block"),
    "headline_block": Query(lambda v: v("headline_block"), "date n_headlines top_headlines", "", "g_headline_block"),
    "vol_block": Query(lambda v: v("vol_block"), "date ts_state", "vix_ts_ratio", "g_vol"),
    "positioning_block": Query(lambda v: v("positioning_block"), "available_from positioning_note", "vix_lev_pctile sp500_lev_pctile", "g_positioning_block"),
    "skew_block": Query(lambda v: v("skew_block"), "capture_date skew_note", "put_skew put_skew_pctile", "g_skew_block"),
    "daily_snapshot": Query(lambda v: v("snapshot"), "date regime_label sectors_leading sectors_lagging top_factor_names weak_factor_names n_headlines top_headlines ts_state positioning_note skew_note", f"{_MACRO} {_BLOCK} vix_ts_ratio vix_lev_pctile sp500_lev_pctile put_skew put_skew_pctile", "g_snapshot"),
    "latest_regime_label": Query(lambda v: regime.latest_label(v("regimes")), "date regime_label", "", "g_label"),
    "security_metrics": Query(lambda v: v("security"), "ticker asof_date sector", f"{_SECURITY} market_cap", "g_security", digits=4),
    "security_factors": Query(lambda v: v("factors"), "ticker asof_date sector", _FACTOR_COLS, "g_factors_u"),
    "security_factors_sector_neutral": Query(lambda v: security.security_factors(v("security"), sector_neutral=True), "ticker asof_date sector", _FACTOR_COLS, "g_factors_n"),
    "screens": Query(lambda v: security.screens(v("factors"), v("security")), "screen rank ticker sector", "score earnings_yield market_cap pe ret_12_1m", "g_screens", digits=4, many=True),
    "scatter": Query(lambda v: security.scatter(v("factors")), "ticker sector", "value_z momentum_z composite_z", "SELECT * FROM {g_factors_u} WHERE value_z IS NOT NULL AND momentum_z IS NOT NULL"),
    "sector_summary": Query(lambda v: security.sector_summary(v("factors")), "sector n", "avg_composite", "g_sectors"),
}

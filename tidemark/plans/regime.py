"""Macro regime and the daily snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stats import band, row_mean
from tidemark.operators.asof import asof_calendar
from tidemark.operators.dedupe import top_n
from tidemark.operators.pivot import forward_fill, pivot_last, pivot_max

# fixed values: members of the axes, series of the snapshot, bands and labels
GROWTH_UP = ["INDPRO", "RSAFS", "PAYEMS", "UMCSENT", "HOUST", "GDPC1"]
GROWTH_DOWN = ["UNRATE", "ICSA"]
INFLATION = ["CPIAUCSL", "CPILFESL", "PCEPILFE", "T10YIE", "T5YIFR"]
CONDITIONS = ["NFCI"]
BAND = 0.25
VOL_STATES = {"contango": "Calm", "flat": "Neutral", "backwardation": "Stressed"}
LEVELS = {"DGS2": "dgs2", "DGS10": "dgs10", "BAMLC0A0CM": "ig_oas", "BAMLH0A0HYM2": "hy_oas", "VIXCLS": "vix", "DTWEXBGS": "usd_broad", "DCOILWTICO": "oil_wti"}
INDICES = {"^GSPC": "spx", "^FTSE": "ftse", "^STOXX50E": "estoxx"}
TOP_NAMES, TOP_TITLES = 3, 5
SEP = " · "


def _filled(analytics: DataFrame, value: str, names: dict[str, str]) -> DataFrame:
    """Levels carried forward on the dates on which any series has a value, filled by series before the pivot."""
    known = analytics.where(F.col(value).isNotNull())
    spine = known.select("obs_date").distinct()
    long = forward_fill(known.where(F.col("series_id").isin(*names)).select("series_id", "obs_date", value), spine, "series_id", "obs_date", value)
    wide = pivot_max(long, ["obs_date"], "series_id", value, names)
    return spine.join(wide, "obs_date", "left").withColumnRenamed("obs_date", "date")


def regime(analytics: DataFrame, vol: DataFrame | None = None) -> DataFrame:
    """(date): growth, inflation and conditions axes as means of the z available, their states, vol state and label."""
    members = GROWTH_UP + GROWTH_DOWN + INFLATION + CONDITIONS
    z = _filled(analytics, "primary_zscore", {m: m for m in members})
    x = z.select("date", row_mean(*GROWTH_UP, *[-F.col(c) for c in GROWTH_DOWN]).alias("growth_axis"), row_mean(*INFLATION).alias("inflation_axis"), row_mean(*CONDITIONS).alias("conditions"))
    x = x.withColumns({"growth_state": band("growth_axis", BAND, "Above-trend", "Below-trend"), "inflation_state": band("inflation_axis", BAND, "Above-trend", "Below-trend"), "conditions_state": band("conditions", BAND, "Tight", "Loose")})
    if vol is None:
        x = x.withColumn("vol_state", F.lit(None).cast("string"))
    else:
        states = F.create_map(*[F.lit(v) for kv in VOL_STATES.items() for v in kv])
        x = x.join(vol.select("date", F.when(F.col("ts_state").isNotNull(), states[F.col("ts_state")]).alias("vol_state")), "date", "left")
    known = F.col("growth_state").isNotNull() & F.col("inflation_state").isNotNull() & F.col("conditions_state").isNotNull()
    label = F.concat_ws(SEP, F.concat(F.lit("Growth "), "growth_state"), F.concat(F.lit("Inflation "), "inflation_state"), F.concat(F.lit("Conditions "), "conditions_state"), F.concat(F.lit("Vol "), "vol_state"))
    return x.withColumn("regime_label", F.when(known, label))


def macro_snapshot(analytics: DataFrame, regimes: DataFrame) -> DataFrame:
    x = _filled(analytics, "value", LEVELS).withColumns({"slope_2s10s": F.col("dgs10") - F.col("dgs2"), "ig_hy_spread": F.col("hy_oas") - F.col("ig_oas")})
    x = x.join(regimes.select("date", "growth_axis", "inflation_axis", "conditions", "regime_label"), "date", "left")
    return x.select("date", "dgs2", "dgs10", "slope_2s10s", "ig_oas", "hy_oas", "ig_hy_spread", "vix", "usd_broad", "oil_wti", "growth_axis", "inflation_axis", "conditions", "regime_label")


def _named(df: DataFrame, score: str, out: str, ascending: bool, n: int = TOP_NAMES) -> DataFrame:
    """(date): the n best tickers by score, joined by commas; ties (to nine digits) by ticker."""
    s = F.round(score, 9)
    best = top_n(df.where(F.col(score).isNotNull()).withColumn("_s", s if ascending else -s), ["price_date"], n, F.col("_s"), F.col("ticker"))
    return best.groupBy(F.col("price_date").alias("date")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_s", "ticker"))), lambda x: x["ticker"]), ", ").alias(out))


def equity_block(equity: DataFrame, strength: DataFrame, scores: DataFrame) -> DataFrame:
    """(date): index levels and returns, leading and lagging sectors, strongest and weakest names; outer-joined."""
    index = equity.where(F.col("ticker").isin(*INDICES)).groupBy(F.col("price_date").alias("date")).agg(*[e for t, a in INDICES.items() for e in (F.max(F.when(F.col("ticker") == t, F.col("adj_close"))).alias(a), F.max(F.when(F.col("ticker") == t, F.col("ret_1d"))).alias(f"{a}_ret_1d"))])
    sectors = strength.where(F.col("group") == "sector_etfs")
    lead = sectors.select(F.col("price_date").alias("date")).distinct()
    lead = lead.join(_named(sectors, "excess_63d", "sectors_leading", False), "date", "left").join(_named(sectors, "excess_63d", "sectors_lagging", True), "date", "left")
    names = scores.select(F.col("price_date").alias("date")).distinct()
    names = names.join(_named(scores, "composite_z", "top_factor_names", False), "date", "left").join(_named(scores, "composite_z", "weak_factor_names", True), "date", "left")
    return index.join(lead, "date", "full_outer").join(names, "date", "full_outer")


def headline_block(stories: DataFrame, n: int = TOP_TITLES) -> DataFrame:
    """(date): stories of the day, and its freshest titles joined by bars (blank ones are counted, not shown)."""
    dated = stories.where(F.col("published_date").isNotNull())
    shown = top_n(dated.where(F.trim(F.coalesce("title", F.lit(""))) != ""), ["published_date"], n, F.col("published_at").desc_nulls_last(), F.col("item_id")).withColumn("_o", F.row_number().over(_fresh()))
    titles = shown.groupBy(F.col("published_date").alias("date")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_o", "title"))), lambda x: x["title"]), " | ").alias("top_headlines"))
    return dated.groupBy(F.col("published_date").alias("date")).agg(F.count(F.lit(1)).alias("n_headlines")).join(titles, "date", "left")


def _fresh():
    from pyspark.sql import Window

    return Window.partitionBy("published_date").orderBy(F.col("published_at").desc_nulls_last(), "item_id")


def vol_block(vol: DataFrame) -> DataFrame:
    have = [F.col(c) if c in vol.columns else F.lit(None).cast(t).alias(c) for c, t in (("vix_ts_ratio", "double"), ("ts_state", "string"))]
    return vol.where(F.col("date").isNotNull()).select("date", *have)


def percent(c: str) -> Column:
    """A share as a whole percentage."""
    return F.format_string("%.0f%%ile", F.bround(F.col(c) * 100, 0))


def positioning_block(pos: DataFrame) -> DataFrame:
    """(available_from): percentiles of the two key markets as released then, and a note."""
    wide = pivot_last(pos.where(F.col("available_from").isNotNull()), ["available_from"], "market_id", "net_lev_pctile", "report_date", {"vix": "vix_lev_pctile", "sp500": "sp500_lev_pctile"})
    note = F.concat_ws(" | ", F.when(F.col("vix_lev_pctile").isNotNull(), F.concat(F.lit("VIX lev "), percent("vix_lev_pctile"))), F.when(F.col("sp500_lev_pctile").isNotNull(), F.concat(F.lit("S&P lev "), percent("sp500_lev_pctile"))))
    return wide.withColumn("positioning_note", note)


def skew_block(captures: DataFrame, ticker: str = "spx") -> DataFrame:
    """(capture_date): skew and percentile of the key ticker, and a note."""
    x = captures.where((F.col("ticker_id") == ticker) & F.col("capture_date").isNotNull())
    note = F.concat(F.format_string("SPY put-skew %+.3f", F.bround("put_skew", 3)), F.coalesce(F.concat(F.lit(" ("), percent("put_skew_pctile"), F.lit(")")), F.lit("")))
    return x.select("capture_date", "put_skew", "put_skew_pctile", F.coalesce(note, F.lit("")).alias("skew_note"))


def daily_snapshot(macro: DataFrame, equity: DataFrame | None = None, stories: DataFrame | None = None, vol: DataFrame | None = None, pos: DataFrame | None = None, captures: DataFrame | None = None) -> DataFrame:
    """The macro calendar with each block that is there: by equal date, or by the last release not after the date."""
    x = macro
    for block in (equity, stories, vol):
        if block is not None:
            x = x.join(block, "date", "left")
    if pos is not None:
        x = asof_calendar(x, pos, "date", "available_from", ["vix_lev_pctile", "sp500_lev_pctile", "positioning_note"])
    if captures is not None:
        x = asof_calendar(x, captures, "date", "capture_date", ["put_skew", "put_skew_pctile", "skew_note"])
    return x


def latest_label(regimes: DataFrame) -> DataFrame:
    return regimes.where(F.col("regime_label").isNotNull()).orderBy(F.col("date").desc()).limit(1).select("date", "regime_label")

"""Insight flags: each rule is a filter and a sentence over the latest rows of a gold table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.stats import col
from tidemark.operators.dedupe import first_by

CRIT, WARN, NOTE, INFO = 3, 2, 1, 0
FLAG = "severity int, rule int, category string, text string"


def latest_measures(df: DataFrame, date: str, value: str, key: str | None = None) -> DataFrame:
    """(key): n, last, z of the last value against all (three values at least), and the share of values not above it in
    percent. One pass over the values."""
    known = df.where(F.col(value).isNotNull())
    keys = [F.col(key)] if key else [F.lit("all").alias("key")]
    x = known.select(*keys, F.col(date).alias("_d"), F.col(value).cast("double").alias("_v"))
    k = key or "key"
    last = F.first("_v").over(Window.partitionBy(k).orderBy(F.col("_d").desc(), F.col("_v").desc()))
    x = x.withColumn("_last", last)
    out = x.groupBy(k).agg(F.count("_v").alias("n"), F.first("_last").alias("last"), F.avg("_v").alias("mean"), F.stddev_samp("_v").alias("std"), F.min("_v").alias("low"), F.max("_v").alias("high"), (F.avg((F.col("_v") <= F.col("_last")).cast("double")) * 100).alias("share"))
    enough = F.col("n") >= 3
    return out.select(k, "n", "last", "mean", "std", "low", "high", F.when(enough & (F.col("std") != 0), (F.col("last") - F.col("mean")) / F.col("std")).alias("z_latest"), F.when(enough, F.col("share")).alias("pctile_latest"))


def flagged(df: DataFrame, rules: list[tuple[int, int | Column, str, Column, Column]]) -> DataFrame:
    """A row for each rule (rule, severity, category, when, text) that holds in a row of df. All rules in one pass."""
    found = [
        F.when(when, F.struct((F.lit(level) if isinstance(level, int) else level).cast("int").alias("severity"), F.lit(rule).alias("rule"), F.lit(category).alias("category"), text.alias("text")))
        for rule, level, category, when, text in rules
    ]
    return df.select(F.explode(F.array_compact(F.array(*found))).alias("f")).select("f.*")


def number(c: str | Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f", F.bround(col(c).cast("double"), digits))


def say(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


#: Columns whose last value is held against their history, by table.
MEASURED = {"curve": ["real_10y"], "credit": ["quality_spread", "ig_hy_spread", "hy_oas"], "vol": ["vix", "ovx", "gvz", "vxeem", "evz"]}
OTHERS = ["ovx", "gvz", "vxeem", "evz"]


def _at_last(df: DataFrame, name: str, date: str, *columns: str) -> DataFrame:
    """One row with a struct of the columns where the date is the last one; null without rows. No sort, no window."""
    return df.agg(F.max_by(F.struct(*columns), F.col(date)).alias(name))


def _measured(df: DataFrame, date: str, columns: list[str]) -> DataFrame:
    """One row with a struct (z_latest, pctile_latest) by column, all from one pass over the long form."""
    x = latest_measures(df.select(date, *[F.col(c).cast("double") for c in columns]).unpivot([date], columns, "measure", "value"), date, "value", "measure")
    return x.agg(*[F.max(F.when(F.col("measure") == c, F.struct("z_latest", "pctile_latest"))).alias(f"m_{c}") for c in columns])


def _state(tables: dict[str, DataFrame]) -> DataFrame | None:
    """One row with the last rows and measures that the rules compare; None without any of their tables.

    Each part is a global aggregate, hence one row, so its broadcast can't grow.
    """
    parts = []
    if (t := tables.get("regimes")) is not None:
        parts.append(_at_last(t, "axes", "date", "growth_axis", "inflation_axis", "conditions"))
        parts.append(_at_last(t.where("regime_label IS NOT NULL"), "label", "date", "regime_label"))
    if (t := tables.get("curve")) is not None:
        parts.append(_at_last(t.where("slope_2s10s IS NOT NULL"), "slope", "date", "slope_2s10s"))
    if (t := tables.get("vol")) is not None:
        parts.append(_at_last(t.where("vix_ts_ratio IS NOT NULL"), "term", "date", "vix_ts_ratio", "ts_state"))
    for name, columns in MEASURED.items():
        have = [c for c in columns if name in tables and c in tables[name].columns]
        if have:
            parts.append(_measured(tables[name], "date", have))
    if (t := tables.get("equity")) is not None:
        parts.append(_at_last(t.where(F.col("ticker") == "^GSPC"), "index", "price_date", "ret_1d"))
    if (t := tables.get("positions")) is not None:
        parts.append(_at_last(t.where("market_id = 'vix'"), "short", "report_date", "net_lev", "net_lev_pctile"))
    if (t := tables.get("skews")) is not None:
        parts.append(_at_last(t.where("ticker_id = 'spx'"), "tail", "capture_date", "put_skew_pctile"))
    one = [p.withColumn("one", F.lit(1)) for p in parts]
    return reduce(lambda a, b: a.join(F.broadcast(b), "one"), one) if one else None


def _state_rules(have: set[str]) -> list[tuple[int, int | Column, str, Column, Column]]:
    """The rules over that row whose parts are there."""
    c = F.col
    rules: list[tuple[set[str], int, int | Column, str, Column, Column]] = [({"label"}, 1, WARN, "regime", c("label.regime_label").isNotNull(), say("Regime: ", c("label.regime_label")))]
    for axis in ("growth_axis", "inflation_axis", "conditions"):
        rules.append(({"axes"}, 2, WARN, "regime", F.abs(c(f"axes.{axis}")) >= 1.0, say(f"{axis} is far from its norm: ", number(f"axes.{axis}"))))
    rules.append(({"slope"}, 3, CRIT, "rates", c("slope.slope_2s10s") < 0, say("Curve inverted: ", number("slope.slope_2s10s"))))
    rules.append(({"m_real_10y"}, 4, WARN, "rates", F.abs(c("m_real_10y.z_latest")) >= 1.5, say("Real yield at ", number("m_real_10y.z_latest"), " deviations")))
    calm = (c("m_quality_spread.z_latest") > 1) & (c("m_ig_hy_spread.z_latest") < 0.5)
    rules.append(({"m_quality_spread", "m_ig_hy_spread"}, 5, WARN, "credit", calm, say("Stress below a calm surface: quality spread at ", number("m_quality_spread.z_latest"))))
    p, hy = c("m_vix.pctile_latest"), c("m_hy_oas.pctile_latest")
    rules.append(({"m_hy_oas"}, 6, NOTE, "credit", (hy >= 80) | (hy <= 20), say("High yield spread at percentile ", number("m_hy_oas.pctile_latest", 0))))
    rules.append(({"m_vix"}, 7, F.when(p >= 80, WARN).otherwise(NOTE), "vol", (p >= 80) | (p <= 15), say("Volatility index at percentile ", number("m_vix.pctile_latest", 0))))
    rules.append(({"index"}, 8, NOTE, "equity", F.abs(c("index.ret_1d")) >= 0.015, say("Index moved by ", number("index.ret_1d", 4))))
    ratio, contango = c("term.vix_ts_ratio"), c("term.ts_state") == "contango"
    rules.append(({"term"}, 9, WARN, "vol", c("term.ts_state") == "backwardation", say("Volatility curve in backwardation at ", number("term.vix_ts_ratio"))))
    rules.append(({"term", "m_vix"}, 10, WARN, "vol", contango & (ratio < 0.90) & (p <= 30), say("Complacency: ratio ", number("term.vix_ts_ratio"), ", percentile ", number("m_vix.pctile_latest", 0))))
    others = [o for o in OTHERS if f"m_{o}" in have]
    if others:
        mean = reduce(lambda a, b: a + b, [c(f"m_{o}.z_latest") for o in others], F.lit(0.0)) / len(others)
        rules.append(({"m_vix"}, 11, NOTE, "vol", (c("m_vix.z_latest") < 0) & (mean > 0.8), say("Calm is narrow: other markets at ", number(mean))))
    rules.append(({"term", "m_vix", "m_hy_oas"}, 12, INFO, "vol", contango & (p <= 30) & (hy <= 30), F.lit("Calm looks earned")))
    crowded = (c("short.net_lev") < 0) & (c("short.net_lev_pctile") <= 0.20)
    rules.append(({"term", "m_vix", "short"}, 17, CRIT, "positioning", contango & (p <= 35) & crowded, F.lit("Fragile calm")))
    s = c("tail.put_skew_pctile")
    rules.append(({"tail"}, 18, F.when(s >= 0.85, WARN).otherwise(NOTE), "skew", (s >= 0.85) | (s <= 0.15), say(F.when(s >= 0.85, "Tails bid at ").otherwise("Skew complacent at "), number("tail.put_skew_pctile"))))
    rules.append(({"tail", "m_vix"}, 19, WARN, "skew", (p <= 35) & (s >= 0.80), say("Nervous tails under a calm index at ", number("tail.put_skew_pctile"))))
    return [r[1:] for r in rules if r[0] <= have]


def _position_flags(positions: DataFrame) -> DataFrame:
    pos = positions.groupBy("market_id").agg(F.max_by(F.struct("net_lev", "net_lev_pctile", "net_lev_wow"), F.col("report_date")).alias("x")).select("market_id", "x.*")
    market, rank, net = F.col("market_id"), F.col("net_lev_pctile"), F.col("net_lev")
    return flagged(pos, [
        (13, WARN, "positioning", (market == "vix") & (net < 0) & (rank <= 0.15), say("Crowded short volatility at ", number("net_lev_pctile"))),
        (14, NOTE, "positioning", (market == "sp500") & (rank >= 0.90), say("Crowded long equity at ", number("net_lev_pctile"))),
        (15, NOTE, "positioning", (rank >= 0.95) | (rank <= 0.05), say("Positioning stretched in ", market, " at ", number("net_lev_pctile"))),
        (16, NOTE, "positioning", (F.abs("net_lev_wow") > F.abs("net_lev")) & (F.abs("net_lev") > 0), say("Positioning unwinding in ", market)),
    ])


def _always(df: DataFrame, rule: int, severity: int, category: str, text: Column) -> DataFrame:
    return df.select(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), F.lit(category).alias("category"), text.alias("text"))


def _sector_flags(strength: DataFrame) -> list[DataFrame]:
    """Leader and laggard of the sectors on their last date."""
    sectors = strength.where((F.col("group") == "sector_etfs") & F.col("excess_63d").isNotNull())
    newest = sectors.join(F.broadcast(sectors.agg(F.max("price_date").alias("_last"))), F.col("price_date") == F.col("_last"))
    ends = ((F.round("excess_63d", 9).desc(), "leads"), (F.round("excess_63d", 9).asc(), "lags"))
    return [_always(newest.orderBy(way, "ticker").limit(1), 20, NOTE, "equity", say(F.col("ticker"), f" {word} by ", number("excess_63d", 4))) for way, word in ends]


def _top(df: DataFrame, date: str, value: str) -> DataFrame:
    return df.where(F.col(value).isNotNull()).orderBy(F.col(date).desc(), F.round(value, 9).desc(), "ticker").limit(1)


def flags(
    regimes: DataFrame | None = None, curve: DataFrame | None = None, credit: DataFrame | None = None, vol: DataFrame | None = None,
    positions: DataFrame | None = None, skews: DataFrame | None = None, equity: DataFrame | None = None, strength: DataFrame | None = None,
    scores: DataFrame | None = None, value: DataFrame | None = None, series: DataFrame | None = None, stories: DataFrame | None = None,
) -> DataFrame:
    """All rules over the gold tables: severity (3 critical to 0 for information), rule, category, text.

    A table may be missing (None) or empty: the rules that need it give no row, the others stay.
    """
    named = {"regimes": regimes, "curve": curve, "credit": credit, "vol": vol, "positions": positions, "skews": skews, "equity": equity}
    state = _state({n: t for n, t in named.items() if t is not None})
    out: list[DataFrame] = []
    if state is not None and (rules := _state_rules(set(state.columns))):
        out.append(flagged(state, rules))
    if positions is not None:
        out.append(_position_flags(positions))
    if strength is not None:
        out += _sector_flags(strength)
    if scores is not None:
        out.append(_always(_top(scores, "price_date", "composite_z"), 21, NOTE, "factors", say("Top name ", F.col("ticker"), " at ", number("composite_z"))))
    if value is not None:
        out.append(_always(_top(value, "price_date", "earnings_yield"), 22, NOTE, "value", say("Cheapest name ", F.col("ticker"), " at ", number("earnings_yield", 4))))
    if series is not None:
        out.append(_always(extremes(series, 3), 23, NOTE, "extremes", say(F.col("series_id"), " at ", number("primary_zscore"))))
    if stories is not None:
        days = stories.where("published_date IS NOT NULL").groupBy("published_date").agg(F.count(F.lit(1)).alias("n"))
        last = days.orderBy(F.col("published_date").desc()).limit(1)
        out.append(_always(last, 24, INFO, "news", say(F.col("n").cast("string"), " stories on ", F.col("published_date").cast("string"))))
    return reduce(DataFrame.unionByName, out) if out else SparkSession.active().createDataFrame([], FLAG)


def latest_z(series: DataFrame) -> DataFrame:
    """(series): the last z that there is."""
    return first_by(series.where("primary_zscore IS NOT NULL"), ["series_id"], F.col("obs_date").desc()).select("series_id", "obs_date", "primary_value", "primary_zscore")


def extremes(series: DataFrame, n: int = 10) -> DataFrame:
    """The n series whose last z is farthest from zero."""
    return latest_z(series).orderBy(F.round(F.abs("primary_zscore"), 9).desc(), "series_id").limit(n)


def by_severity(found: DataFrame) -> DataFrame:
    return found.orderBy(F.col("severity").desc(), "rule", "text")

"""Security selection: point-in-time metrics, cross-sectional factors, screens."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.stats import by, no_nan, safe_div, sane, weighted_mean
from tidemark.operators.asof import asof
from tidemark.operators.dedupe import first_by
from tidemark.operators.hold import cut
from tidemark.operators.ranks import matched, pct_ranks, quantiles
from tidemark.operators.scan import trailing_max

# fixed values: metrics, bounds, factors and screens
FLOWS = ["revenue", "net_income", "gross_profit", "operating_income", "op_cash_flow", "capex", "eps_diluted"]
STOCKS = ["assets", "equity", "shares", "long_term_debt"]
CAP_FLOOR = 5e7
FACTORS = {
    "value": {"earnings_yield": 1, "fcf_yield": 1, "pb": -1, "ps": -1},
    "momentum": {"ret_12_1m": 1, "ret_6m": 1, "dist_52w_high": 1},
    "quality": {"roe": 1, "gross_margin": 1, "op_margin": 1, "net_margin": 1, "debt_to_equity": -1},
    "growth": {"rev_growth_yoy": 1, "eps_growth_yoy": 1},
}
WEIGHTS = {"value": 0.25, "momentum": 0.25, "quality": 0.25, "growth": 0.25}
SCREEN_ROWS = 25
#: Days of a slice of prices in which a panel's dates are looked up.
PANEL_DAYS = 32


def momentum(prices: DataFrame, asof: str) -> DataFrame:
    """(ticker): last close on the date, returns to earlier rows, distance from the high of 252 rows."""
    w = Window.partitionBy("ticker").orderBy(F.col("date").desc())
    x = prices.where((F.col("date") <= F.lit(asof).cast("date")) & F.col("close").isNotNull()).withColumn("n", F.row_number().over(w)).where("n <= 253")
    at = {k: F.max(F.when(F.col("n") == k + 1, F.col("close"))).alias(f"c{k}") for k in (0, 21, 126, 252)}
    x = x.groupBy("ticker").agg(*at.values(), F.max(F.when(F.col("n") <= 252, F.col("close"))).alias("high"))
    return x.select("ticker", F.col("c0").alias("last_close"), (safe_div("c0", "c21") - 1).alias("ret_1m"), (safe_div("c0", "c126") - 1).alias("ret_6m"), F.when(F.col("c21") != 0, safe_div("c21", "c252") - 1).alias("ret_12_1m"), (safe_div("c0", "high") - 1).alias("dist_52w_high"))


def facts_known(facts: DataFrame, asof: str) -> DataFrame:
    """(ticker): annual flows, latest balance items and the year before, from facts filed by the date.

    Each metric takes its own latest period; of filings for one period the last one counts.
    """
    f = facts.where(F.col("filed_date") <= F.lit(asof).cast("date"))
    annual = F.col("fiscal_period") == "FY"
    order = F.struct("period_end", "filed_date")
    years = Window.partitionBy("ticker", "metric", annual).orderBy(F.col("period_end").desc())
    x = f.withColumns({"year": F.dense_rank().over(years), "annual": annual})
    latest = [F.max_by(F.when((F.col("metric") == m) & F.col("annual"), F.col("value")), F.when((F.col("metric") == m) & F.col("annual"), order)).alias(m) for m in FLOWS]
    latest += [F.max_by(F.when(F.col("metric") == m, F.col("value")), F.when(F.col("metric") == m, order)).alias(m) for m in STOCKS]
    before = [F.max_by(F.when((F.col("metric") == m) & F.col("annual") & (F.col("year") == 2), F.col("value")), F.when((F.col("metric") == m) & F.col("annual") & (F.col("year") == 2), order)).alias(n) for m, n in (("revenue", "revenue_prev"), ("eps_diluted", "eps_prev"))]
    return x.groupBy("ticker").agg(*latest, *before)


def security_metrics(prices: DataFrame, facts: DataFrame, dim: DataFrame, asof: str) -> DataFrame:
    """(ticker): all metrics as of a date; implausible values are null, tickers without a price are left out."""
    x = momentum(prices, asof).join(facts_known(facts, asof), "ticker", "full_outer").where("last_close IS NOT NULL")
    return _measured(x.withColumn("asof_date", F.lit(asof).cast("date")), dim)


def _measured(x: DataFrame, dim: DataFrame) -> DataFrame:
    """The metrics of rows with a price, momentum and known facts."""
    x = x.join(F.broadcast(dim.select("ticker", "sector")), "ticker", "left")
    cap = F.when(F.col("shares") > 0, F.col("last_close") * F.col("shares"))
    x = x.withColumn("market_cap", F.when(cap >= CAP_FLOOR, cap))
    book, profit = F.when(F.col("equity") > 0, F.col("equity")), F.when(F.col("net_income") > 0, F.col("net_income"))
    ratio = {
        "earnings_yield": (safe_div("net_income", "market_cap"), -0.5, 0.5),
        "pe": (safe_div("market_cap", profit), 0, 2000),
        "pb": (safe_div("market_cap", book), 0, 200),
        "ps": (safe_div("market_cap", "revenue"), 0, 200),
        "fcf_yield": (safe_div(F.col("op_cash_flow") - F.col("capex"), "market_cap"), -0.5, 0.5),
        "roe": (safe_div("net_income", book), -5, 5),
        "gross_margin": (safe_div("gross_profit", "revenue"), -1, 1),
        "op_margin": (safe_div("operating_income", "revenue"), -2, 1),
        "net_margin": (safe_div("net_income", "revenue"), -2, 1),
        "debt_to_equity": (safe_div("long_term_debt", book), 0, 100),
        "rev_growth_yoy": (safe_div(F.col("revenue") - F.col("revenue_prev"), "revenue_prev"), -1, 10),
        "eps_growth_yoy": (safe_div(F.col("eps_diluted") - F.col("eps_prev"), F.abs("eps_prev")), -10, 10),
    }
    return x.select("ticker", "asof_date", "sector", "last_close", "market_cap", *[sane(*v).alias(k) for k, v in ratio.items()], "ret_1m", "ret_6m", "ret_12_1m", "dist_52w_high")


def _long(df: DataFrame, keys: list[str], names: list[str], name: str, value: str) -> DataFrame:
    """A row for each of the columns names, with its name and value."""
    cells = F.array(*[F.struct(F.lit(n).alias(name), F.col(n).alias(value)) for n in names])
    return df.select(*keys, F.explode(cells).alias("_c")).select(*keys, f"_c.{name}", f"_c.{value}")


def _standardised(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """df with value as its z in its group, by the population deviation; 0 where all values are the same, null for null."""
    stats = df.groupBy(*keys).agg(F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_sd"))
    x, sd = F.col(value), F.coalesce("_sd", F.lit(0.0))
    z = F.when(sd == 0, x * 0.0).otherwise((x - F.col("_mean")) / F.col("_sd"))
    return matched(df, stats, keys, ["_mean", "_sd"]).withColumn(value, z).drop("_mean", "_sd")


def security_factors(metrics: DataFrame, sector_neutral: bool = False, weights: dict[str, float] | None = None) -> DataFrame:
    """(ticker, date): z and percentile of each factor and of the composite, across the universe of a date.

    Metrics are winsorised and standardised (by sector if wanted), oriented, averaged where present and standardised
    again. A metric column that is missing counts as null. Metrics and factors are rows, not columns, and a date's
    universe is measured by partial aggregates, exact quantiles and ranks over buckets of values: no window holds it.
    """
    weights = weights or WEIGHTS
    every = {m: (f, d) for f, ms in FACTORS.items() for m, d in ms.items()}
    row = ["ticker", "asof_date", "sector"]
    wide = metrics.select(*row, *[no_nan(F.col(m).cast("double")).alias(m) if m in metrics.columns else F.lit(None).cast("double").alias(m) for m in every])
    x = _long(wide, row, list(every), "metric", "v").where("v IS NOT NULL")
    x = cut(x.where("sector IS NOT NULL") if sector_neutral else x)
    group = ["asof_date", "metric", *(["sector"] if sector_neutral else [])]
    bounds = quantiles(x, group, "v", {"low": 0.01, "high": 0.99})
    x = matched(x, bounds, group, ["total", "low", "high"])
    x = x.withColumn("v", F.when(F.col("total") < 3, F.col("v")).otherwise(F.least(F.greatest("v", "low"), "high"))).drop("total", "low", "high")
    x = _standardised(cut(x), group, "v")
    factor, sign = (F.element_at(F.create_map(*[F.lit(y) for m, pair in every.items() for y in (m, pair[k])]), F.col("metric")) for k in (0, 1))
    raw = x.groupBy("ticker", "asof_date", factor.alias("factor")).agg(F.avg(F.col("v") * sign).alias("z"))
    z = _standardised(cut(raw), ["asof_date", "factor"], "z")
    side = z.groupBy("ticker", "asof_date").agg(*[F.max(F.when(F.col("factor") == f, F.col("z"))).alias(f"{f}_z") for f in FACTORS])
    scored = matched(metrics.select(*row), side, ["ticker", "asof_date"], [f"{f}_z" for f in FACTORS])
    scored = cut(scored.withColumn("composite_z", weighted_mean({f"{f}_z": weights.get(f, 0.0) for f in FACTORS})))
    names = [*FACTORS, "composite"]
    ranked = pct_ranks(_long(scored, ["ticker", "asof_date"], [f"{f}_z" for f in names], "factor", "z").where("z IS NOT NULL"), ["asof_date", "factor"], "z", "pct")
    shares = ranked.groupBy("ticker", "asof_date").agg(*[F.max(F.when(F.col("factor") == f"{f}_z", F.col("pct"))).alias(f"{f}_pct") for f in names])
    out = matched(scored, shares, ["ticker", "asof_date"], [f"{f}_pct" for f in names])
    return out.select(*row, *[f"{f}_z" for f in FACTORS], *[f"{f}_pct" for f in FACTORS], "composite_z", "composite_pct")


SCREENS = {
    "composite": ("composite_z", lambda: F.col("composite_z").isNotNull()),
    "value": ("value_z", lambda: F.col("value_z").isNotNull()),
    "momentum": ("momentum_z", lambda: F.col("momentum_z").isNotNull()),
    "quality": ("quality_z", lambda: F.col("quality_z").isNotNull()),
    "cheap_good": ("composite_z", lambda: (F.col("value_pct") > 0.7) & (F.col("quality_pct") > 0.7)),
}


def screens(factors: DataFrame, metrics: DataFrame, rows: int = SCREEN_ROWS) -> DataFrame:
    """The first rows of each of the five screens, with rank; ties by ticker."""
    joined = factors.join(metrics.select("ticker", "asof_date", "earnings_yield", F.col("roe").alias("metric_roe"), "market_cap", "pe", "ret_12_1m"), ["ticker", "asof_date"], "left")

    def one(name: str) -> DataFrame:
        score, keep = SCREENS[name]
        picked = joined.where(keep()).withColumns({"screen": F.lit(name), "score": F.col(score)})
        return picked

    every = reduce(DataFrame.unionByName, [one(n) for n in SCREENS])
    w = Window.partitionBy("screen").orderBy(F.round("score", 9).desc_nulls_last(), "ticker")
    return every.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= rows).select("screen", "rank", "ticker", "sector", "score", "earnings_yield", "market_cap", "pe", "ret_12_1m")


def scatter(factors: DataFrame) -> DataFrame:
    return factors.where("value_z IS NOT NULL AND momentum_z IS NOT NULL").select("ticker", "sector", "value_z", "momentum_z", "composite_z")


def sector_summary(factors: DataFrame) -> DataFrame:
    named = factors.where(F.col("sector").isNotNull()).withColumn("sector", F.when(F.col("sector") == "", "-").otherwise(F.col("sector")))
    return named.groupBy("sector").agg(F.count(F.lit(1)).alias("n"), F.avg("composite_z").alias("avg_composite")).orderBy(F.col("avg_composite").desc_nulls_last(), "sector")


def _closes(prices: DataFrame) -> DataFrame:
    """(ticker, date): what momentum() measures, on every date with a close."""
    w = by("ticker", "date")
    c = {k: F.lag("close", k).over(w) for k in (21, 126, 252)}
    x = prices.where("close IS NOT NULL").select("ticker", "date", "close", *[e.alias(f"c{k}") for k, e in c.items()])
    x = trailing_max(x, w, "close", "high", 252)
    returns = {"ret_1m": safe_div("close", "c21") - 1, "ret_6m": safe_div("close", "c126") - 1, "ret_12_1m": F.when(F.col("c21") != 0, safe_div("c21", "c252") - 1), "dist_52w_high": safe_div("close", "high") - 1}
    return x.select("ticker", "date", F.col("close").alias("last_close"), *[e.alias(n) for n, e in returns.items()])


def _filings(facts: DataFrame) -> DataFrame:
    """(ticker): for each metric its facts as an array of (period_end, filed_date, value)."""
    fact = F.struct("period_end", "filed_date", "value")
    wanted = {m: (F.col("metric") == m) & (F.col("fiscal_period") == "FY") for m in FLOWS} | {m: F.col("metric") == m for m in STOCKS}
    return facts.where(F.col("filed_date").isNotNull()).groupBy("ticker").agg(*[F.collect_list(F.when(c, fact)).alias(f"_{m}") for m, c in wanted.items()])


def metrics_panel(prices: DataFrame, facts: DataFrame, dim: DataFrame, dates: list[str]) -> DataFrame:
    """security_metrics on each of many dates, in one pass over prices and facts.

    A date takes the last close on or before it, with what the rows up to that one say, by an as-of join; and of each
    metric's filings (a few hundred at most for a ticker) those made by then: the latest period's, and the one before.
    """
    closes = _closes(prices)
    days = F.array(*[F.lit(d).cast("date") for d in dates])
    grid = closes.select("ticker").distinct().select("ticker", F.explode(days).alias("asof_date"))
    names = ["last_close", "ret_1m", "ret_6m", "ret_12_1m", "dist_52w_high"]
    x = asof(grid, closes, ["ticker"], "asof_date", "date", names, PANEL_DAYS).where("last_close IS NOT NULL")
    x = matched(x, _filings(facts), ["ticker"], [f"_{m}" for m in FLOWS + STOCKS])

    def latest(m: str, before: Column | None = None) -> Column:
        """The last of the filings of m known on the date, for a period before another."""
        made = F.filter(f"_{m}", lambda f: f["filed_date"] <= F.col("asof_date"))
        return F.array_max(made if before is None else F.filter(made, lambda f: f["period_end"] < before))

    x = x.withColumns({m: latest(m) for m in FLOWS + STOCKS})
    x = x.withColumns({n: latest(m, F.col(m)["period_end"])["value"] for m, n in (("revenue", "revenue_prev"), ("eps_diluted", "eps_prev"))})
    return _measured(x.withColumns({m: F.col(m)["value"] for m in FLOWS + STOCKS}), dim)


def latest_asof(df: DataFrame) -> DataFrame:
    """The rows of the last as-of date."""
    return first_by(df, ["ticker"], F.col("asof_date").desc())

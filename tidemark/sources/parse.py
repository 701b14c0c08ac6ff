"""Landed payloads to tidy rows. Nothing is fetched here: the files are there already."""

from __future__ import annotations

import html
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.dedupe import first_by

# fixed values: filing forms, and tags by metric in order of preference (taxonomy, tag, unit)
FORMS = ["10-K", "10-Q", "10-K/A", "10-Q/A", "20-F"]
CONCEPTS = [
    ("revenue", 1, "us-gaap", "Revenues", "USD"),
    ("revenue", 2, "us-gaap", "RevenueFromContractWithCustomerExcludingAssessedTax", "USD"),
    ("revenue", 3, "us-gaap", "SalesRevenueNet", "USD"),
    ("net_income", 1, "us-gaap", "NetIncomeLoss", "USD"),
    ("gross_profit", 1, "us-gaap", "GrossProfit", "USD"),
    ("operating_income", 1, "us-gaap", "OperatingIncomeLoss", "USD"),
    ("eps_diluted", 1, "us-gaap", "EarningsPerShareDiluted", "USD/shares"),
    ("eps_basic", 1, "us-gaap", "EarningsPerShareBasic", "USD/shares"),
    ("assets", 1, "us-gaap", "Assets", "USD"),
    ("equity", 1, "us-gaap", "StockholdersEquity", "USD"),
    ("shares", 1, "dei", "EntityCommonStockSharesOutstanding", "shares"),
    ("shares", 2, "us-gaap", "CommonStockSharesOutstanding", "shares"),
    ("shares", 3, "us-gaap", "WeightedAverageNumberOfDilutedSharesOutstanding", "shares"),
    ("op_cash_flow", 1, "us-gaap", "NetCashProvidedByUsedInOperatingActivities", "USD"),
    ("capex", 1, "us-gaap", "PaymentsToAcquirePropertyPlantAndEquipment", "USD"),
    ("long_term_debt", 1, "us-gaap", "LongTermDebtNoncurrent", "USD"),
    ("long_term_debt", 2, "us-gaap", "LongTermDebt", "USD"),
]
PUBLISH_LAG_DAYS = 90
TARGET_DTE = 30
MONEYNESS = {"put": 0.90, "atm": 1.00, "call": 1.10}


#: Texts that are decoded at a time, so that few of a batch's are Python strings at once.
DECODED_ROWS = 128


def _decoded(texts: pa.Array) -> pa.Array:
    parts = (texts.slice(i, DECODED_ROWS).to_pylist() for i in range(0, len(texts), DECODED_ROWS))
    done = [pa.array([None if t is None else html.unescape(t).strip() or None for t in part], pa.string()) for part in parts]
    return pa.concat_arrays(done) if done else pa.array([], pa.string())


def clean(c: Column) -> Column:
    """All references decoded once, named and numeric, then trimmed of white space; empty becomes null."""

    @F.arrow_udf("string")
    def decoded(texts: pa.Array) -> pa.Array:
        return _decoded(texts)

    return decoded(c)


def observations(payloads: DataFrame, key: str, body: str) -> DataFrame:
    """(key, date, value, status) from JSON with an observations array; missing marks and bad numbers are dropped.

    A payload without a usable observation gives one row of status 'empty', an unreadable one of status 'error'.
    """
    parsed = payloads.select(key, F.from_json(body, "observations array<struct<date: string, value: string>>").alias("p"))
    rows = parsed.select(key, F.col("p.observations").isNull().alias("bad"), F.explode_outer("p.observations").alias("o"))
    rows = rows.select(key, "bad", F.try_to_date(F.col("o.date"), "yyyy-MM-dd").alias("date"), F.expr("try_cast(o.value AS double)").alias("value"))
    good = rows.where("date IS NOT NULL AND value IS NOT NULL")
    none = rows.groupBy(key).agg(F.bool_or("bad").alias("bad"), F.count_if(F.col("date").isNotNull() & F.col("value").isNotNull()).alias("n")).where("n = 0")
    return good.select(key, "date", "value", F.lit("ok").alias("status")).unionByName(none.select(key, F.lit(None).cast("date").alias("date"), F.lit(None).cast("double").alias("value"), F.when(F.col("bad"), "error").otherwise("empty").alias("status")))


def whole_number(c: Column | str) -> Column:
    """A number as text, possibly with decimals, cut to a whole one; null if it isn't a number."""
    x = F.col(c) if isinstance(c, str) else c
    return x.try_cast("double").try_cast("bigint")


def positions(rows: DataFrame, numbers: Sequence[str], date: str = "report_date") -> DataFrame:
    """Text rows of a positioning report to typed ones; rows without a date are dropped."""
    keep = [c for c in rows.columns if c not in numbers and c != date]
    return rows.select(*keep, F.try_to_date(F.substring(date, 1, 10), "yyyy-MM-dd").alias(date), *[whole_number(c).alias(c) for c in numbers]).where(F.col(date).isNotNull())


def matches(c: str, needle: str) -> Column:
    """Case-insensitive substring; the needle is data, never a pattern."""
    return F.contains(F.upper(c), F.upper(F.lit(needle)))


def primary_contracts(rows: DataFrame, key: str, name: str, size: str) -> tuple[DataFrame, DataFrame]:
    """Of the names that one pattern caught, the one with the largest size in the batch; and the others (key, name)."""
    sizes = rows.groupBy(key, name).agg(F.max(size).alias("_size"))
    best = first_by(sizes, [key], F.col("_size").desc_nulls_last(), F.col(name)).select(key, name)
    return rows.join(best, [key, name], "left_semi"), sizes.join(best, [key, name], "left_anti").select(key, name)


def combined_only(rows: DataFrame, kind: str) -> DataFrame:
    """Rows of reports on futures and options combined; a report without a kind is none."""
    return rows.where(matches(kind, "comb"))


def names_like(rows: DataFrame, name: str, needle: str, kind: str | None = None) -> DataFrame:
    """Distinct names that hold the needle, of combined reports only if the column with their kind is given."""
    some = rows if kind is None else combined_only(rows, kind)
    return some.where(matches(name, needle)).select(name).distinct().orderBy(name)


def outcome(n: Column, error: Column, http_status: Column | None = None) -> Column:
    """Status of one fetch: error, not_modified (304), empty or ok."""
    same = F.lit(False) if http_status is None else F.coalesce(http_status == 304, F.lit(False))
    return F.when(error.isNotNull(), "error").when(same, "not_modified").when(F.coalesce(n, F.lit(0)) == 0, "empty").otherwise("ok")


def company_meta(payloads: DataFrame, ticker: str, body: str) -> DataFrame:
    """(ticker): reporting currency, shares and market value from JSON; all null where the payload can't be read."""
    x = payloads.select(F.col(ticker).alias("ticker"), F.from_json(body, "financialCurrency string, sharesOutstanding double, marketCap double").alias("m"))
    return x.select("ticker", F.col("m.financialCurrency").alias("financial_currency"), F.col("m.sharesOutstanding").alias("shares_outstanding"), F.col("m.marketCap").alias("market_cap"))


def company_facts(payloads: DataFrame, ticker: str, body: str, concepts: DataFrame, forms: Sequence[str] = tuple(FORMS)) -> DataFrame:
    """Tidy facts from nested JSON: for each metric the first tag in order of preference that a company has at all."""
    fact = "array<struct<`end`: string, val: double, fy: int, fp: string, form: string, filed: string>>"
    schema = f"facts map<string, map<string, struct<units: map<string, {fact}>>>>"
    x = payloads.select(F.col(ticker).alias("ticker"), F.from_json(body, schema)["facts"].alias("facts"))
    x = x.select("ticker", F.explode("facts").alias("taxonomy", "tags")).select("ticker", "taxonomy", F.explode("tags").alias("tag", "t")).select("ticker", "taxonomy", "tag", F.explode("t.units").alias("unit", "rows"))
    x = x.join(F.broadcast(concepts), ["taxonomy", "tag", "unit"])
    first = x.withColumn("_best", F.min("prio").over(Window.partitionBy("ticker", "metric"))).where("prio = _best")
    rows = first.select("ticker", "metric", F.col("tag").alias("xbrl_tag"), "unit", F.explode("rows").alias("r")).where(F.col("r.form").isin(*forms))
    return rows.select("ticker", "metric", "xbrl_tag", "unit", F.try_to_date("r.end").alias("period_end"), F.col("r.fy").alias("fiscal_year"), F.col("r.fp").alias("fiscal_period"), F.col("r.form").alias("form"), F.try_to_date("r.filed").alias("filed_date"), F.col("r.val").alias("value"))


def cik_map(payloads: DataFrame, body: str) -> DataFrame:
    """(ticker, cik): symbols in capitals, identifiers filled to ten digits."""
    rows = payloads.select(F.explode(F.map_values(F.from_json(body, "map<string, struct<cik_str: string, ticker: string>>"))).alias("x"))
    return rows.select(F.upper("x.ticker").alias("ticker"), F.lpad("x.cik_str", 10, "0").alias("cik"))


def daily_prices(rows: DataFrame) -> DataFrame:
    """Text rows of a daily price file to typed ones; rows with a bad date or without a close are dropped."""
    x = rows.select("ticker", F.try_to_date("Date", "yyyy-MM-dd").alias("date"), *[F.col(c).try_cast("double").alias(c.lower()) for c in ("Open", "High", "Low", "Close", "Volume")])
    return x.where("date IS NOT NULL AND close IS NOT NULL")


def unpivot_statements(wide: DataFrame, ids: Sequence[str], periods: Sequence[str], lag_days: int = PUBLISH_LAG_DAYS) -> DataFrame:
    """Metric rows with a column for each period to long rows, known lag_days after the period's end."""
    long = wide.select(*ids, *[F.col(f"`{p}`").try_cast("double").alias(p) for p in periods]).unpivot(list(ids), list(periods), "period_end", "value")
    long = long.where("value IS NOT NULL AND NOT isnan(value)").withColumn("period_end", F.try_to_date("period_end"))
    return long.withColumn("available_from", F.date_add("period_end", lag_days))


def unpivot_prices(wide: DataFrame, fields: Mapping[str, Sequence[str]]) -> DataFrame:
    """(ticker, date, fields) from a frame with a column ticker_field for each; rows without a close are dropped."""
    names = list(next(iter(fields.values())))
    each = F.array(*[F.struct(F.lit(t).alias("ticker"), *[F.nanvl(F.col(f"`{t}_{f}`").cast("double"), F.lit(None).cast("double")).alias(f) for f in names]) for t in fields])
    return wide.select("date", F.explode(each).alias("x")).select("x.ticker", "date", *[f"x.{f}" for f in names]).where("close IS NOT NULL")


def unpivot_price_maps(wide: DataFrame, column: str, fields: Sequence[str]) -> DataFrame:
    """(ticker, date, fields) from a map column of ticker to fields; rows without a close are dropped."""
    rows = wide.select("date", F.explode(column).alias("ticker", "x"))
    return rows.select("ticker", "date", *[F.nanvl(F.col(f"x.{f}").cast("double"), F.lit(None).cast("double")).alias(f) for f in fields]).where("close IS NOT NULL")


def yahoo_symbol(c: Column | str) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.replace(F.upper(F.trim(x)), F.lit("."), F.lit("-"))


def item_id(guid: Column, link: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(guid), F.lit("")), F.concat(F.lit("link:"), F.sha1(F.trim(link))))


def feed_time(raw: Column) -> Column:
    """RFC 822 or ISO 8601 to a timestamp; null if it is neither. The weekday says nothing and is left out."""
    plain = F.regexp_replace(F.trim(raw), r"^[A-Za-z]{3},\s*", "")
    named = F.regexp_replace(plain, r"\s(GMT|UT|UTC)$", " +0000")
    return F.coalesce(F.try_to_timestamp(named, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(plain))


def feed_items(items: DataFrame) -> DataFrame:
    """Rows of a feed's items (guid, link, title, description, published as text) to stories; those without an id go."""
    x = items.select(item_id(F.col("guid"), F.col("link")).alias("item_id"), clean(F.col("title")).alias("title"), clean(F.col("description")).alias("summary"), F.trim("link").alias("link"), feed_time(F.col("published")).alias("published_at"))
    return x.where("item_id IS NOT NULL")


def constituents(rows: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """A table under any of the known headers to (ticker, name, sector, cik); blank and NAN symbols go."""
    have = {c.lower().strip(): c for c in rows.columns}

    def take(n: str) -> Column:
        found = next((have[a.lower()] for a in aliases[n] if a.lower() in have), None)
        return F.col(f"`{found}`").cast("string") if found else F.lit(None).cast("string")

    x = rows.select(yahoo_symbol(take("ticker")).alias("ticker"), F.trim(take("name")).alias("name"), F.trim(take("sector")).alias("sector"), F.lpad(F.nullif(F.trim(take("cik")), F.lit("")), 10, "0").alias("cik"))
    return x.where((F.col("ticker") != "") & (F.col("ticker") != "NAN"))


def usable_quotes(chain: DataFrame) -> DataFrame:
    x = chain.withColumns({"strike": F.col("strike").try_cast("double"), "iv": F.col("iv").try_cast("double")})
    return x.where("strike > 0 AND iv > 0 AND NOT isnan(strike) AND NOT isnan(iv)")


def interpolated(m: Column, iv: Column, target: float, usable: Column) -> Column:
    """iv at the target moneyness, linear between its neighbours in order of (m, iv); null outside them or with fewer
    than two points. An aggregate expression."""
    point = F.struct(m.alias("m"), iv.alias("iv"))
    below, above = F.max(F.when(usable & (m < target), point)), F.min(F.when(usable & (m >= target), point))
    n = F.count(F.when(usable, 1))
    lowest = F.sort_array(F.collect_list(F.when(usable & (m >= target), point)))
    # nothing below the target: it sits on the lowest point, and of equal points the second one counts
    second = F.when((F.size(lowest) > 1) & (F.get(lowest, F.lit(1))["m"] == F.get(lowest, F.lit(0))["m"]), F.get(lowest, F.lit(1))["iv"]).otherwise(above["iv"])
    on = F.when(above["m"] == target, second)
    between = below["iv"] + (above["iv"] - below["iv"]) * (F.lit(target) - below["m"]) / (above["m"] - below["m"])
    return F.when(n < 2, None).when(below.isNull(), on).when(above.isNotNull(), between)


def skew_measures(chain: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys): volatilities of puts, at the money and of calls at fixed moneyness, put skew and risk reversal."""
    x = usable_quotes(chain).withColumn("m", F.col("strike") / F.col("spot"))
    m, iv = F.col("m"), F.col("iv")
    out = x.groupBy(*keys).agg(
        F.max("spot").alias("spot"),
        interpolated(m, iv, MONEYNESS["put"], (F.col("side") == "put") & (m <= 1.02)).alias("put_iv"),
        interpolated(m, iv, MONEYNESS["atm"], m.between(0.95, 1.05)).alias("atm_iv"),
        interpolated(m, iv, MONEYNESS["call"], (F.col("side") == "call") & (m >= 0.98)).alias("call_iv"),
    )
    return out.withColumns({"put_skew": F.col("put_iv") - F.col("atm_iv"), "risk_reversal": F.col("put_iv") - F.col("call_iv")})


def nearest_expiry(expiries: DataFrame, keys: Sequence[str], expiry: str, today: str, target: int = TARGET_DTE) -> DataFrame:
    """(keys, expiry, dte): the expiry nearest to target days away, at least one; of equals the first."""
    x = expiries.withColumn("dte", F.datediff(expiry, today)).where("dte >= 1")
    return first_by(x, list(keys), F.abs(F.col("dte") - target), F.col(expiry)).select(*keys, expiry, "dte")

"""Queries that turn given tables into payloads as they land, and parse them back; and the streams over landed files."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import marts
from tidemark.plans.registry import Query, View
from tidemark.sources import parse
from tidemark.streaming import loads


def _observation_payloads(v: View) -> DataFrame:
    """A JSON document for each series, with a dot where a value is missing; every eleventh has no observations."""
    rows = v("series_obs").select("series_id", F.struct(F.col("obs_date").cast("string").alias("date"), F.coalesce(F.col("value").cast("string"), F.lit(".")).alias("value")).alias("o"))
    return rows.groupBy("series_id").agg(F.to_json(F.struct(F.collect_list("o").alias("observations"))).alias("body"))


def _position_rows(v: View) -> DataFrame:
    x = v("cot")
    return x.select("market_id", F.concat(F.col("report_date").cast("string"), F.lit("T00:00:00.000")).alias("report_date"), F.concat(F.col("open_interest").cast("string"), F.lit(".0")).alias("open_interest"), F.when(F.col("lev_long") % 5 == 0, "n/a").otherwise(F.col("lev_long").cast("string")).alias("lev_long"))


#: Tags of the payloads beside revenue, with their taxonomy and unit.
_TAGS = [
    ("us-gaap", "NetIncomeLoss", "USD"), ("us-gaap", "GrossProfit", "USD"), ("us-gaap", "OperatingIncomeLoss", "USD"), ("us-gaap", "EarningsPerShareDiluted", "USD/shares"),
    ("us-gaap", "EarningsPerShareBasic", "USD/shares"), ("us-gaap", "Assets", "USD"), ("us-gaap", "StockholdersEquity", "USD"), ("dei", "EntityCommonStockSharesOutstanding", "shares"),
    ("us-gaap", "NetCashProvidedByUsedInOperatingActivities", "USD"), ("us-gaap", "PaymentsToAcquirePropertyPlantAndEquipment", "USD"), ("us-gaap", "LongTermDebt", "USD"), ("us-gaap", "Goodwill", "USD"),
]


def _facts_payloads(v: View) -> DataFrame:
    """A nested JSON document for each company: revenue under the second tag in order, the other metrics under one tag;
    a third of the companies have revenue's first tag as well, for one year."""
    x = v("year_sums").select("ticker", "suppkey", F.struct(F.concat(F.col("y").cast("string"), F.lit("-12-31")).alias("end"), F.col("rev").alias("val"), F.col("y").alias("fy"), F.lit("FY").alias("fp"), F.when(F.col("y") % 4 == 0, "8-K").otherwise("10-K").alias("form"), F.concat((F.col("y") + 1).cast("string"), F.lit("-02-01")).alias("filed")).alias("r"), F.col("y"))
    g = x.groupBy("ticker", "suppkey").agg(F.collect_list("r").alias("all"), F.collect_list(F.when(F.col("y") == 1997, F.col("r"))).alias("one"))

    def tag(name: str, rows: str, unit: str = "USD") -> Column:
        return F.create_map(F.lit(name), F.struct(F.create_map(F.lit(unit), F.col(rows)).alias("units")))

    second = tag("RevenueFromContractWithCustomerExcludingAssessedTax", "all")
    both = F.map_concat(second, tag("Revenues", "one"))
    us = F.map_concat(F.when(F.col("suppkey") % 3 == 0, both).otherwise(second), *[tag(n, "all", u) for t, n, u in _TAGS if t == "us-gaap"])
    dei = F.map_concat(*[tag(n, "all", u) for t, n, u in _TAGS if t == "dei"])
    return g.select("ticker", F.to_json(F.struct(F.create_map(F.lit("us-gaap"), us, F.lit("dei"), dei).alias("facts"))).alias("body"))


def _company_facts(v: View) -> DataFrame:
    payloads = _facts_payloads(v)
    concepts = payloads.sparkSession.createDataFrame(parse.CONCEPTS, "metric string, prio int, taxonomy string, tag string, unit string")
    return parse.company_facts(payloads, "ticker", "body", concepts)


def _price_rows(v: View) -> DataFrame:
    c = F.col("close").cast("string")
    return v("prices").select("ticker", F.when(F.col("volume") % 9 == 0, "soon").otherwise(F.col("price_date").cast("string")).alias("Date"), c.alias("Open"), c.alias("High"), c.alias("Low"), F.when(F.col("volume") % 7 == 0, "").otherwise(c).alias("Close"), F.col("volume").cast("string").alias("Volume"))


def _feed_rows(v: View, title: str = "text") -> DataFrame:
    d = F.col("doc_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (d % 300).cast("int"))
    published = F.when(d % 5 == 0, "yesterday").when(d % 5 == 1, F.concat(day.cast("string"), F.lit("T08:30:00Z"))).otherwise(F.concat(F.lit("Mon, "), F.date_format(day, "dd MMM yyyy"), F.lit(" 08:30:00 GMT")))
    return v("documents").select(F.when(d % 2 == 0, F.concat(F.lit(" id"), d.cast("string"), F.lit(" "))).alias("guid"), F.when(d % 10 != 7, F.concat(F.lit("https://example.com/"), d.cast("string"))).alias("link"), F.expr(title).alias("title"), F.lit("a &amp; b").alias("description"), published.alias("published"))


def _stories(v: View) -> DataFrame:
    return parse.feed_items(_feed_rows(v)).select("item_id", "summary", "link", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"))


def _titles(v: View) -> DataFrame:
    """Whole texts as titles, with references in them."""
    return parse.feed_items(_feed_rows(v, "concat(' &eacute;&#8217; ', text)")).select("item_id", "title")


def _meta(v: View) -> DataFrame:
    """Metadata as JSON; what a company lacks is left out of its payload, and every twelfth payload is broken."""
    x = v("company_meta").join(v("dim_instrument").select("ticker", "suppkey"), "ticker")
    body = F.to_json(F.struct(F.col("financial_currency").alias("financialCurrency"), F.col("shares_outstanding").alias("sharesOutstanding"), (F.col("suppkey") * 5.0).alias("marketCap")))
    return parse.company_meta(x.select("ticker", F.when(F.col("suppkey") % 12 == 0, "<html>").otherwise(body).alias("body")), "ticker", "body")


def _identifiers(v: View) -> DataFrame:
    """Symbols to identifiers, from documents with an entry for each salted part of the suppliers."""
    entry = F.struct(F.col("s_suppkey").cast("string"), F.struct(F.col("s_suppkey").cast("string").alias("cik_str"), F.lower("s_name").alias("ticker")))
    docs = v("supplier").groupBy(F.pmod(F.xxhash64("s_suppkey"), F.lit(256)).alias("part")).agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("body"))
    return parse.cik_map(docs, "body")


def _feed_runs(v: View) -> DataFrame:
    """A status for each feed and language: what a poll of it would have told."""
    x = v("documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("m"))
    error = F.when(F.col("m") % 7 == 3, "timeout")
    http = F.when(F.col("m") % 5 == 0, 304).otherwise(200)
    n = F.when(F.col("m") % 3 == 0, 0).otherwise(F.col("n_docs"))
    return x.select("source", "lang", n.alias("n_items"), error.alias("error"), parse.outcome(n, error, http).alias("status"))


_FEED_RUNS = "SELECT source, lang, CASE WHEN m % 3 = 0 THEN 0 ELSE n_docs END AS n_items, CASE WHEN m % 7 = 3 THEN 'timeout' END AS error, CASE WHEN m % 7 = 3 THEN 'error' WHEN m % 5 = 0 THEN 'not_modified' WHEN m % 3 = 0 THEN 'empty' ELSE 'ok' END AS status FROM (SELECT source, lang, count(*) AS n_docs, max(doc_id) AS m FROM {documents} GROUP BY 1, 2)"


def _constituents(v: View) -> DataFrame:
    rows = v("supplier").select(F.when(F.col("s_suppkey") % 10 == 0, "  ").when(F.col("s_suppkey") % 10 == 1, "nan").otherwise(F.concat(F.lit(" brk."), F.col("s_suppkey").cast("string"))).alias("Symbol"), F.col("s_name").alias("Security"), F.when(F.col("s_suppkey") % 4 != 0, F.col("s_suppkey").cast("string")).otherwise(F.lit(" ")).alias("CIK"))
    return parse.constituents(rows, {"ticker": ["ticker", "symbol"], "name": ["company", "security"], "sector": ["sector", "gics sector"], "cik": ["cik"]})


def _manifest(v: View) -> DataFrame:
    """A manifest row for each salted part of a group, so that no row grows with the instruments."""
    x = v("dim_instrument").groupBy("group", F.pmod(F.xxhash64("ticker"), F.lit(256)).alias("part")).agg(F.collect_list(F.struct("ticker", F.when(F.col("suppkey") % 6 != 0, F.col("currency")).alias("currency"))).alias("members"))
    packed = x.select(F.create_map("group", "members").alias("groups"))
    return marts.manifest_rows(packed, "groups", {"currency": "USD"})


def _wide_maps(v: View) -> DataFrame:
    """Wide frames of all tickers: a map column by ticker, one row for each date and group of tickers."""
    nan = F.lit(float("nan"))
    x = v("prices").select("price_date", "ticker", F.struct(F.when(F.col("ticker") == "T4", nan).otherwise(F.col("adj_close")).alias("open"), "close").alias("x"))
    # a group holds about a 256th of the tickers, so that no row grows with all of them
    wide = x.groupBy(F.col("price_date").alias("date"), F.pmod(F.xxhash64("ticker"), F.lit(256)).alias("part")).agg(F.map_from_entries(F.collect_list(F.struct("ticker", "x"))).alias("wide"))
    return parse.unpivot_price_maps(wide, "wide", ["open", "close"])


PAYLOADS = {
    "observations_parsed": Query(lambda v: parse.observations(_observation_payloads(v), "series_id", "body"), "series_id date status", "value", "SELECT series_id, obs_date AS date, 'ok' AS status, value FROM {series_obs} WHERE value IS NOT NULL"),
    "positions_parsed": Query(lambda v: parse.positions(_position_rows(v), ["open_interest", "lev_long"]), "market_id report_date open_interest lev_long", "", "SELECT market_id, report_date, open_interest, CASE WHEN lev_long % 5 <> 0 THEN CAST(lev_long AS BIGINT) END AS lev_long FROM {cot}"),
    "company_facts": Query(_company_facts, "ticker metric xbrl_tag period_end fiscal_year filed_date form", "value", "SELECT ticker, metric, xbrl_tag, make_date(y, 12, 31) AS period_end, CAST(y AS INT) AS fiscal_year, make_date(y + 1, 2, 1) AS filed_date, '10-K' AS form, rev AS value FROM (SELECT y.*, m.metric, m.xbrl_tag FROM {year_sums} y CROSS JOIN (VALUES ('net_income', 'NetIncomeLoss'), ('gross_profit', 'GrossProfit'), ('operating_income', 'OperatingIncomeLoss'), ('eps_diluted', 'EarningsPerShareDiluted'), ('eps_basic', 'EarningsPerShareBasic'), ('assets', 'Assets'), ('equity', 'StockholdersEquity'), ('shares', 'EntityCommonStockSharesOutstanding'), ('op_cash_flow', 'NetCashProvidedByUsedInOperatingActivities'), ('capex', 'PaymentsToAcquirePropertyPlantAndEquipment'), ('long_term_debt', 'LongTermDebt')) AS m(metric, xbrl_tag) UNION ALL SELECT *, 'revenue', CASE WHEN suppkey % 3 = 0 THEN 'Revenues' ELSE 'RevenueFromContractWithCustomerExcludingAssessedTax' END FROM {year_sums} WHERE suppkey % 3 <> 0 OR y = 1997) WHERE y % 4 <> 0"),
    "daily_prices_parsed": Query(lambda v: parse.daily_prices(_price_rows(v)), "ticker date", "close volume", "SELECT ticker, price_date AS date, close, volume FROM {prices} WHERE volume % 9 <> 0 AND volume % 7 <> 0"),
    "feed_items": Query(_stories, "item_id summary link published_at", "", "SELECT CASE WHEN doc_id % 2 = 0 THEN 'id' || doc_id ELSE 'link:' || sha1('https://example.com/' || doc_id) END AS item_id, 'a & b' AS summary, CASE WHEN doc_id % 10 <> 7 THEN 'https://example.com/' || doc_id END AS link, CASE WHEN doc_id % 5 <> 0 THEN CAST(DATE '2024-01-01' + CAST(doc_id % 300 AS INT) AS STRING) || ' 08:30:00' END AS published_at FROM {documents} WHERE doc_id % 10 <> 7"),
    "feed_titles": Query(_titles, "item_id title", "", "SELECT CASE WHEN doc_id % 2 = 0 THEN 'id' || doc_id ELSE 'link:' || sha1('https://example.com/' || doc_id) END AS item_id, rtrim('é’ ' || coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13)) AS title FROM {documents} WHERE doc_id % 10 <> 7 AND text IS NOT NULL UNION ALL SELECT CASE WHEN doc_id % 2 = 0 THEN 'id' || doc_id ELSE 'link:' || sha1('https://example.com/' || doc_id) END, NULL FROM {documents} WHERE doc_id % 10 <> 7 AND text IS NULL"),
    "constituents": Query(_constituents, "ticker name sector cik", "", "SELECT 'BRK-' || s_suppkey AS ticker, s_name AS name, CAST(NULL AS STRING) AS sector, CASE WHEN s_suppkey % 4 <> 0 THEN lpad(CAST(s_suppkey AS STRING), 10, '0') END AS cik FROM {supplier} WHERE s_suppkey % 10 NOT IN (0, 1)"),
    "manifest_rows": Query(_manifest, "group ticker currency", "", "SELECT \"group\", ticker, CASE WHEN suppkey % 6 <> 0 THEN currency ELSE 'USD' END AS currency FROM {dim_instrument}"),
    "wide_prices_long_whole": Query(_wide_maps, "ticker date", "open close", "SELECT ticker, price_date AS date, CASE WHEN ticker <> 'T4' THEN adj_close END AS open, close FROM {prices}"),
    "company_meta_parsed": Query(_meta, "ticker financial_currency", "shares_outstanding market_cap", "SELECT m.ticker, CASE WHEN suppkey % 12 <> 0 THEN financial_currency END AS financial_currency, CASE WHEN suppkey % 12 <> 0 THEN shares_outstanding END AS shares_outstanding, CASE WHEN suppkey % 12 <> 0 THEN suppkey * 5.0 END AS market_cap FROM {company_meta} m JOIN {dim_instrument} i ON i.ticker = m.ticker"),
    "identifiers": Query(_identifiers, "ticker cik", "", "SELECT upper(s_name) AS ticker, lpad(CAST(s_suppkey AS STRING), 10, '0') AS cik FROM {supplier}"),
    "combined_names": Query(lambda v: parse.names_like(v("cot").withColumn("kind", F.when(F.col("lev_long") % 2 == 0, "FutOnly").when(F.col("lev_long") % 3 == 0, "Combined")), "market", "i", "kind"), "market", "", "SELECT DISTINCT market FROM {cot} WHERE market LIKE '%I%' AND lev_long % 2 <> 0 AND lev_long % 3 = 0"),
    "feed_run_lines": Query(lambda v: marts.run_lines(_feed_runs(v), "lang", "source"), "source lang n_items error status", "", _FEED_RUNS),
    "feed_run_summary": Query(lambda v: marts.run_summary(_feed_runs(v), "feeds", "n_items"), "n ok not_modified empty failed total result", "", f"SELECT *, CASE WHEN failed = 0 THEN 'PASS' ELSE 'COMPLETED WITH ISSUES' END AS result FROM (SELECT count(*) AS n, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'not_modified') AS not_modified, count(*) FILTER (status = 'empty') AS empty, count(*) FILTER (status = 'error') AS failed, CAST(sum(n_items) AS BIGINT) AS total FROM ({_FEED_RUNS}))"),
    "feed_run_flagged": Query(lambda v: marts.run_flagged(_feed_runs(v), "positions"), "source lang status note", "", f"SELECT source, lang, status, CASE WHEN error IS NOT NULL THEN error WHEN status = 'empty' THEN 'no match - check the pattern' ELSE '' END AS note FROM ({_FEED_RUNS}) WHERE status <> 'ok'"),
    "gold_row_counts": Query(lambda v: marts.coverage({n: (v(n), d) for n, d in (("curve", "date"), ("fx", "date"), ("vol", "date"), ("positions", "report_date"), ("skews", "capture_date"))}), "source n_rows", "", "SELECT 'curve' AS source, count(*) AS n_rows FROM {g_curve} UNION ALL SELECT 'fx', count(*) FROM {g_fx} UNION ALL SELECT 'vol', count(*) FROM {g_vol} UNION ALL SELECT 'positions', count(*) FROM {g_positions} UNION ALL SELECT 'skews', count(*) FROM {g_skew}"),
}

PAYLOADS["wide_prices_long"] = PAYLOADS["wide_prices_long_whole"]

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _folder(spark: SparkSession) -> str:
    """A new folder that all executors share; a folder of this machine's own serves a local session only."""
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="stream-")
    return f"{base.rstrip('/')}/{uuid.uuid4()}"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a pattern, as a stream does not take the path of a single file
    return loads.landed(spark, f"{sf_dir}/events.parque[t]", EVENTS).withColumn("ts", F.col("ts").cast("timestamp"))


def stream_append_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event keys, each once, by the append-and-dedupe load."""
    at = _folder(spark)
    keyed = _events(spark, sf_dir).select(F.concat_ws("/", "user_id", "event_type").alias("item_id"), "ts")
    loads.append_dedupe(keyed, "item_id", "ts", "40 days", f"{at}/out", f"{at}/state").awaitTermination()
    return spark.read.parquet(f"{at}/out").select("item_id")


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user and type, by the keyed-upsert load."""
    at = _folder(spark)
    rows = _events(spark, sf_dir).select("user_id", "event_type", "event_id", "value")
    loads.upsert_log(rows, f"{at}/log", f"{at}/state").awaitTermination()
    return loads.current(spark.read.parquet(f"{at}/log"), ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id", F.round("value", 6).alias("value"))


def stream_append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event keys, each once, compared with all that are stored."""
    at = _folder(spark)
    keyed = _events(spark, sf_dir).select(F.concat_ws("/", "user_id", "event_type").alias("item_id"), "event_id")
    loads.append_once(keyed, "item_id", "event_id", f"{at}/out", f"{at}/state").awaitTermination()
    return spark.read.parquet(f"{at}/out").select("item_id", "event_id")


#: Days of events that land at a time.
LANDING_DAYS = 8


def stream_append_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event keys, each once, by keyed state, over batches that land one after the other: a run of the stream for each."""
    at = _folder(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    part = F.floor(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / LANDING_DAYS).cast("int")
    keyed = events.select(F.concat_ws("/", "user_id", "event_type").alias("item_id"), "event_id", part.alias("part"))
    parts = [r[0] for r in keyed.select("part").distinct().orderBy("part").collect()]  # a row for each landing
    for k in parts:
        keyed.where(F.col("part") == k).write.parquet(f"{at}/in/{k}")
        source = loads.landed(spark, f"{at}/in/*", "item_id string, event_id long, part int")
        loads.append_keyed(source, "item_id", "event_id", f"{at}/out", f"{at}/state").awaitTermination()
    return spark.read.parquet(f"{at}/out").select("item_id", "event_id", "part")


def stream_restatement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value filed last for each user and type, events being restatements filed on their day."""
    at = _folder(spark)
    rows = _events(spark, sf_dir).select("user_id", "event_type", F.to_date("ts").alias("filed"), "event_id", "value")
    loads.upsert_log(rows, f"{at}/log", f"{at}/state").awaitTermination()
    facts = loads.restated(spark.read.parquet(f"{at}/log"), ["user_id", "event_type"], "filed", "event_id")
    return facts.select("user_id", "event_type", "filed", "event_id", F.round("value", 6).alias("value"))


def stream_same_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last capture of each day and type."""
    at = _folder(spark)
    rows = _events(spark, sf_dir).select("event_type", F.to_date("ts").alias("day"), "event_id", "value")
    loads.upsert_log(rows, f"{at}/log", f"{at}/state").awaitTermination()
    kept = loads.current(spark.read.parquet(f"{at}/log"), ["event_type", "day"], "event_id")
    return kept.select("event_type", "day", "event_id", F.round("value", 6).alias("value"))


STREAMS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_append_dedupe": stream_append_dedupe, "stream_upsert": stream_upsert,
    "stream_append_keyed": stream_append_keyed, "stream_append_once": stream_append_once, "stream_restatement": stream_restatement, "stream_same_day": stream_same_day,
}

STREAM_ORACLES = {
    "stream_append_keyed": f"SELECT user_id || '/' || event_type AS item_id, event_id, CAST(floor((CAST(ts AS DATE) - DATE '2024-01-01') / {LANDING_DAYS}) AS INT) AS part FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY 3, event_id) = 1",
    "stream_append_once": "SELECT user_id || '/' || event_type AS item_id, min(event_id) AS event_id FROM events GROUP BY 1",
    "stream_restatement": "SELECT user_id, event_type, CAST(ts AS DATE) AS filed, event_id, round(value, 6) AS value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY CAST(ts AS DATE) DESC, event_id DESC) = 1",
    "stream_same_day": "SELECT event_type, CAST(ts AS DATE) AS day, event_id, round(value, 6) AS value FROM events QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY event_id DESC) = 1",
    "stream_append_dedupe": "SELECT DISTINCT user_id || '/' || event_type AS item_id FROM events",
    "stream_upsert": "SELECT user_id, event_type, event_id, round(value, 6) AS value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1",
}

"""All registered queries: the gold tables, and the loads, payloads, statistics, insights and marts around them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import formats
from tidemark.functions.stats import weighted_mean
from tidemark.operators import dedupe, upsert
from tidemark.operators.pivot import pivot_last
from tidemark.operators.ranks import pct_ranks
from tidemark.plans import gold, insights, marts, payload_queries, regime, registry, roundtrips, security
from tidemark.plans.flags_oracle import FLAGS
from tidemark.plans.oracle import ASOF_DATE, CURVE, PANEL, STEPS, VOL
from tidemark.plans.registry import Query, View
from tidemark.sources import parse


def _flags(v: View) -> DataFrame:
    names = ("regimes", "curve", "credit", "vol", "positions", "skews", "index_equity", "sector_strength", "scores", "value", "series", "stories")
    return insights.flags(*[v(n) for n in names])


def _stored(v: View) -> DataFrame:
    """Sums of events by user and type, as loaded before."""
    return v("event_batches").where("batch = 'stored'").groupBy("user_id", "event_type").agg(F.max("day").alias("day"), F.round(F.sum("value"), 6).alias("value"), F.max("event_id").alias("ord"))


def _all_incoming(v: View) -> DataFrame:
    return v("event_batches").where("batch = 'incoming'").select("user_id", "event_type", "day", "value", F.col("event_id").alias("ord"))


def _status(v: View) -> DataFrame:
    """One status row for each series: rows, and whether the run found any."""
    x = v("dim_series").join(v("series_obs").groupBy("series_id").agg(F.count("value").alias("n_rows")), "series_id", "left")
    n = F.coalesce("n_rows", F.lit(0))
    return x.select("series_id", "category", n.alias("n_rows"), F.when(n == 0, "empty").otherwise("ok").alias("status"))


def _facts(v: View, where: str) -> DataFrame:
    return v("universe_facts").where(where).select("ticker", "metric", "period_end", "filed_date", "value")


def _stories(v: View, seen: bool) -> DataFrame:
    return v("headline_items").where("doc_id % 4 = 0" if seen else "doc_id % 4 <> 0")


def _pairs(df: DataFrame) -> DataFrame:
    return df.select("item_id", F.col("first_feed").alias("feed"))


def _wide_all_years(v: View) -> DataFrame:
    """A column for each year that the orders cover; the calendar, not the data, bounds them."""
    wide = v("year_sums").groupBy("ticker").pivot("y", list(YEARS)).agg(F.max("rev"))
    return wide.withColumnsRenamed({str(y): f"{y}-12-31" for y in YEARS})


def _transform(v: View) -> DataFrame:
    counts = marts.coverage({"series": (v("series"), "obs_date"), "curve": (v("curve"), "date")})
    return marts.transform_summary(counts, marts.reconciliation(v("series_obs"), v("series"), v("dim_series"), "series_id"), regime.latest_label(v("regimes")))


def _expiries(v: View) -> DataFrame:
    return v("option_chain").withColumn("today", F.make_date("capture", F.lit(1), F.lit(1))).select("ticker_id", "capture", "expiry", "today").distinct()


def _guid() -> Column:
    n = F.col("page_id")
    return F.when(n % 3 == 0, F.lit("  ")).when(n % 3 == 1, F.concat(F.lit(" g"), n.cast("string")))


def _latest_valued(v: View) -> DataFrame:
    value = dedupe.latest(v("value"), ["ticker"], "price_date").select("ticker", "price_date", "earnings_yield")
    return dedupe.latest(v("funds"), ["ticker"], "period_end").join(value, "ticker")


_STORED = "SELECT user_id, event_type, max(day) AS day, round(sum(value), 6) AS value, max(event_id) AS ord FROM {event_batches} WHERE batch = 'stored' GROUP BY ALL"
_ALL_INCOMING = "SELECT user_id, event_type, day, value, event_id AS ord FROM {event_batches} WHERE batch = 'incoming'"
_ALL_LAST = f"SELECT * FROM ({_ALL_INCOMING}) QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ord DESC) = 1"
#: Years of the statements' columns.
YEARS = range(1990, 2031)
_FILED = "QUALIFY row_number() OVER (PARTITION BY ticker, metric, period_end ORDER BY filed_date DESC NULLS LAST, value DESC) = 1"
_TYPES = ("click", "view", "purchase")
_SCORES = ["mom_z", "lowvol_z", "trend_z", "quality_z", "growth_z", "value_z"]
_PCT = "(rank() OVER (PARTITION BY c_mktsegment ORDER BY round(c_acctbal, 9)) + (count(*) OVER (PARTITION BY c_mktsegment, round(c_acctbal, 9)) - 1) / 2.0) / count(*) OVER (PARTITION BY c_mktsegment)"


def _interp(name: str, target: float, where: str) -> str:
    """iv at the target, by its neighbours in order of (m, iv)."""
    pts = f"(list({{{{'m': m, 'iv': iv}}}} ORDER BY m, iv) FILTER ({where}))"
    low, high = f"list_filter({pts}, lambda x: x.m < {target})", f"list_filter({pts}, lambda x: x.m >= {target})"
    return f"""(CASE WHEN len({pts}) < 2 THEN NULL
        WHEN len({low}) = 0 THEN CASE WHEN {pts}[1].m = {target} THEN CASE WHEN {pts}[2].m = {target} THEN {pts}[2].iv ELSE {pts}[1].iv END END
        ELSE {low}[-1].iv + ({high}[1].iv - {low}[-1].iv) * ({target} - {low}[-1].m) / ({high}[1].m - {low}[-1].m) END) AS {name}"""


_SMILE = ", ".join([_interp("put_iv", 0.9, "side = 'put' AND m <= 1.02"), _interp("atm_iv", 1.0, "m BETWEEN 0.95 AND 1.05"), _interp("call_iv", 1.1, "side = 'call' AND m >= 0.98")])


def _measures(src: str, key: str, date: str, value: str) -> str:
    return f"""SELECT {key}, n, last, mean, std, low, high, CASE WHEN n >= 3 THEN (last - mean) / nullif(std, 0) END AS z_latest,
        CASE WHEN n >= 3 THEN 100.0 * (SELECT count(*) FROM {src} q WHERE q.{key} = t.{key} AND q.{value} <= t.last) / n END AS pctile_latest
        FROM (SELECT {key}, count({value}) AS n, arg_max({value}, {date}) AS last, avg({value}) AS mean, stddev_samp({value}) AS std, min({value}) AS low, max({value}) AS high FROM {src} WHERE {value} IS NOT NULL GROUP BY {key}) t"""


def _last(src: str, key: str, date: str) -> str:
    return f"SELECT * FROM {{{src}}} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {date} DESC) = 1"


#: Columns of the snapshot that a dashboard opens with.
_KPIS = ["dgs10", "slope_2s10s", "ig_hy_spread", "vix", "usd_broad", "oil_wti"]


def _shown(x: str, digits: int, sign: bool = False, unit: str = "") -> str:
    text = f"printf('%.{digits}f', round_even({f'abs({x})' if sign else x}, {digits}) + CAST(0 AS DOUBLE)) || '{unit}'"
    return f"CASE WHEN {x} IS NULL THEN '\u2014' ELSE {f'CASE WHEN {x} >= 0 THEN chr(43) ELSE chr(8722) END || ' if sign else ''}{text} END"


_FORMATTED = f"SELECT series_id, {_shown('value', 2)} AS num, {_shown('(chg_pct * 100)', 0, unit='%')} AS pct, {_shown('zscore', 1, True, chr(963))} AS sigma, {_shown('chg', 1, True)} AS signed, strftime(obs_date, '%Y-%m-%d') AS day FROM (SELECT * FROM {{g_series}} WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY obs_date DESC) = 1)"

LOADS = {
    "replace_by_key_whole": Query(lambda v: upsert.replace_by_key(_stored(v), _all_incoming(v), ["user_id"]), "user_id event_type day ord", "value", f"SELECT * FROM ({_STORED}) WHERE user_id NOT IN (SELECT user_id FROM ({_ALL_INCOMING})) UNION ALL SELECT * FROM ({_ALL_INCOMING})"),
    "replace_by_key_empty_clears_whole": Query(lambda v: upsert.replace_by_key(_stored(v), _all_incoming(v), ["user_id"], v("event_batches").select("user_id").distinct()), "user_id event_type day ord", "value", _ALL_INCOMING),
    "upsert_rows_whole": Query(lambda v: upsert.upsert(_stored(v), _all_incoming(v), ["user_id", "event_type"], "ord")[0], "user_id event_type day ord", "value", f"SELECT s.* FROM ({_STORED}) s ANTI JOIN ({_ALL_LAST}) l ON l.user_id = s.user_id AND l.event_type = s.event_type UNION ALL SELECT * FROM ({_ALL_LAST})"),
    "upsert_counts_whole": Query(lambda v: upsert.upsert(_stored(v), _all_incoming(v), ["user_id", "event_type"], "ord")[1], "n_seen n_new", "", f"SELECT count(*) AS n_seen, count(*) FILTER (s.ord IS NULL) AS n_new FROM ({_ALL_LAST}) l LEFT JOIN ({_STORED}) s ON l.user_id = s.user_id AND l.event_type = s.event_type"),
    "since_high_water_whole": Query(lambda v: upsert.since_high_water(v("event_batches"), v("event_batches").where("batch = 'stored'"), "user_id", "day", "2024-01-10"), "event_id user_id event_type day", "value", "SELECT e.* FROM {event_batches} e LEFT JOIN (SELECT user_id AS u, max(day) AS hwm FROM {event_batches} WHERE batch = 'stored' GROUP BY 1) ON u = user_id WHERE day > coalesce(hwm, DATE '2024-01-10')"),
    "restatement_upsert": Query(lambda v: upsert.latest_filed_upsert(dedupe.latest_filed_wins(_facts(v, "fiscal_year < 1998"), ["ticker", "metric", "period_end"], "filed_date", "value"), _facts(v, "fiscal_year >= 1997"), ["ticker", "metric", "period_end"], "filed_date", "value"), "ticker metric period_end filed_date", "value", f"SELECT * FROM {{universe_facts}} {_FILED}"),
    "append_new_stories": Query(lambda v: upsert.append_new(_stories(v, True), _stories(v, False), "item_id", "doc_id")[0], "item_id doc_id first_feed", "", "SELECT item_id, doc_id, first_feed FROM {headline_items} WHERE doc_id % 4 <> 0 AND item_id NOT IN (SELECT item_id FROM {headline_items} WHERE doc_id % 4 = 0) QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY doc_id) = 1"),
    "append_counts": Query(lambda v: upsert.append_new(_stories(v, True), _stories(v, False), "item_id", "doc_id")[1], "n_seen n_new", "", "SELECT count(*) AS n_seen, count(*) FILTER (NOT old) AS n_new FROM (SELECT item_id, bool_or(doc_id % 4 = 0) AS old, bool_or(doc_id % 4 <> 0) AS fresh FROM {headline_items} GROUP BY 1) WHERE fresh"),
    "story_feed_bridge": Query(lambda v: upsert.bridge_new(_pairs(_stories(v, True)), _pairs(v("headline_items")), ["item_id", "feed"]), "item_id feed", "", "SELECT item_id, first_feed AS feed FROM {headline_items} EXCEPT SELECT item_id, first_feed FROM {headline_items} WHERE doc_id % 4 = 0"),
    "latest_status": Query(lambda v: upsert.latest_status(v("event_batches"), "user_id", "event_id"), "user_id event_type event_id batch", "value", "SELECT * FROM {event_batches} QUALIFY event_id = max(event_id) OVER (PARTITION BY user_id)"),
    "evolve_schema": Query(lambda v: upsert.evolve(v("company_meta"), "ticker string, cik string, shares_outstanding double"), "ticker cik financial_currency", "shares_outstanding", "SELECT ticker, CAST(NULL AS STRING) AS cik, financial_currency, shares_outstanding FROM {company_meta}"),
    "keyed_replace_dimension": Query(lambda v: upsert.replace_by_key(v("company_meta"), v("company_meta").where("ticker LIKE 'T1%'").withColumn("shares_outstanding", F.lit(5.0)), ["ticker"]), "ticker financial_currency", "shares_outstanding", "SELECT ticker, financial_currency, CASE WHEN ticker LIKE 'T1%' THEN 5.0 ELSE shares_outstanding END AS shares_outstanding FROM {company_meta}"),
    "first_wins": Query(lambda v: dedupe.first_wins(v("event_batches"), ["user_id", "day"], "event_id"), "user_id day event_id", "", "SELECT user_id, day, min(event_id) AS event_id FROM {event_batches} GROUP BY 1, 2"),
    "last_wins": Query(lambda v: dedupe.last_wins(v("event_batches"), ["user_id", "day"], "event_id"), "user_id day event_id", "", "SELECT user_id, day, max(event_id) AS event_id FROM {event_batches} GROUP BY 1, 2"),
    "largest_wins": Query(lambda v: dedupe.largest_wins(v("event_batches"), ["event_type", "day"], "value", "event_id"), "event_type day event_id", "value", "SELECT * FROM {event_batches} QUALIFY row_number() OVER (PARTITION BY event_type, day ORDER BY value DESC NULLS LAST, event_id) = 1"),
    "latest_filed_wins": Query(lambda v: dedupe.latest_filed_wins(v("universe_facts"), ["ticker", "metric", "period_end"], "filed_date", "value"), "ticker metric period_end filed_date", "value", f"SELECT * FROM {{universe_facts}} {_FILED}"),
}

PAYLOADS = {
    "event_props": Query(lambda v: v("events").select("event_id", F.explode(F.from_json("props", "map<string, string>")).alias("key", "value")), "event_id key value", "", "SELECT event_id, key, json_extract_string(props, '$.' || key) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM {events})"),
    "primary_contracts": Query(lambda v: parse.primary_contracts(v("event_batches"), "event_type", "user_id", "event_id")[0], "event_type user_id event_id", "", "SELECT event_type, user_id, event_id FROM {event_batches} QUALIFY max(event_id) OVER (PARTITION BY event_type, user_id) = max(event_id) OVER (PARTITION BY event_type)"),
    "dropped_contracts": Query(lambda v: parse.primary_contracts(v("event_batches"), "event_type", "user_id", "event_id")[1], "event_type user_id", "", "SELECT event_type, user_id FROM (SELECT event_type, user_id, max(event_id) AS m FROM {event_batches} GROUP BY 1, 2) QUALIFY m < max(m) OVER (PARTITION BY event_type)"),
    "names_like": Query(lambda v: parse.names_like(v("supplier"), "s_name", "r#00%").unionByName(parse.names_like(v("nation"), "n_name", "n_1").withColumnRenamed("n_name", "s_name")), "s_name", "", "SELECT DISTINCT n_name AS s_name FROM {nation} WHERE contains(upper(n_name), 'N_1') UNION ALL SELECT DISTINCT s_name FROM {supplier} WHERE contains(upper(s_name), 'R#00%')"),
    "story_ids": Query(lambda v: v("pages").select("page_id", parse.item_id(_guid(), F.col("url")).alias("item_id")), "page_id item_id", "", "SELECT page_id, CASE WHEN page_id % 3 = 1 THEN 'g' || page_id ELSE 'link:' || sha1(trim(url)) END AS item_id FROM {pages}"),
    "clean_text_whole": Query(lambda v: v("documents").select("doc_id", parse.clean(F.concat(F.lit(" &lt;b&gt; "), "text", F.lit(" &amp;lt; "))).alias("text")), "doc_id text", "", "SELECT doc_id, trim(replace(replace(replace(replace(' &lt;b&gt; ' || text || ' &amp;lt; ', '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')) AS text FROM {documents}"),
    "skew_measures": Query(lambda v: parse.skew_measures(v("option_chain"), ["ticker_id", "capture"]), "ticker_id capture", "spot put_iv atm_iv call_iv put_skew risk_reversal", f"SELECT *, put_iv - atm_iv AS put_skew, put_iv - call_iv AS risk_reversal FROM (SELECT ticker_id, capture, max(spot) AS spot, {_SMILE} FROM (SELECT *, strike / spot AS m FROM {{option_chain}} WHERE strike > 0 AND iv > 0) GROUP BY 1, 2)"),
    "nearest_expiry": Query(lambda v: parse.nearest_expiry(_expiries(v), ["ticker_id", "capture"], "expiry", "today"), "ticker_id capture expiry dte", "", "SELECT DISTINCT ticker_id, capture, expiry, expiry - make_date(capture, 1, 1) AS dte FROM {option_chain} WHERE expiry > make_date(capture, 1, 1) QUALIFY dense_rank() OVER (PARTITION BY ticker_id, capture ORDER BY abs(expiry - make_date(capture, 1, 1) - 30), expiry) = 1"),
    "statements_long_whole": Query(lambda v: parse.unpivot_statements(_wide_all_years(v), ["ticker"], [f"{y}-12-31" for y in YEARS]), "ticker period_end available_from", "value", "SELECT ticker, make_date(y, 12, 31) AS period_end, make_date(y, 12, 31) + 90 AS available_from, max(rev) AS value FROM {year_sums} GROUP BY ticker, y"),
}

STATISTICS = {
    "series_measures": Query(lambda v: insights.latest_measures(v("series"), "obs_date", "value", "series_id"), "series_id n", "last mean std low high z_latest pctile_latest", _measures("{g_series}", "series_id", "obs_date", "value")),
    "series_changes": Query(lambda v: marts.change_over(v("series_obs"), "series_id", "obs_date", "value", 5), "series_id", "last change pct_change", "SELECT series_id, v[-1] AS last, v[-1] - v[-6] AS change, v[-1] / nullif(v[-6], 0) - 1 AS pct_change FROM (SELECT series_id, list(value ORDER BY obs_date) AS v FROM {series_obs} WHERE value IS NOT NULL GROUP BY 1)"),
    "pivot_last": Query(lambda v: pivot_last(v("event_batches"), ["user_id"], "event_type", "value", "event_id", {t: t for t in _TYPES}), "user_id", " ".join(_TYPES), "SELECT user_id, " + ", ".join(f"arg_max(value, event_id) FILTER (event_type = '{t}') AS {t}" for t in _TYPES) + " FROM {event_batches} WHERE event_type IN ('click', 'view', 'purchase') AND value IS NOT NULL GROUP BY 1"),
    "percentile_ranks": Query(lambda v: pct_ranks(v("customer"), ["c_mktsegment"], "c_acctbal", "pct"), "c_custkey", "pct", f"SELECT c_custkey, {_PCT} AS pct FROM {{customer}}"),
    "weighted_composite": Query(lambda v: v("factors").select("ticker", weighted_mean({"value_z": 0.5, "momentum_z": 0.3, "quality_z": 0.2}).alias("composite")), "ticker", "composite", "SELECT ticker, (coalesce(value_z * 0.5, 0) + coalesce(momentum_z * 0.3, 0) + coalesce(quality_z * 0.2, 0)) / nullif(CASE WHEN value_z IS NULL THEN 0 ELSE 0.5 END + CASE WHEN momentum_z IS NULL THEN 0 ELSE 0.3 END + CASE WHEN quality_z IS NULL THEN 0 ELSE 0.2 END, 0) AS composite FROM {g_factors_u}"),
}

MARTS = {
    "insight_flags": Query(lambda v: insights.by_severity(_flags(v)), "severity rule category text", "", FLAGS, many=True),
    "extremes": Query(lambda v: insights.extremes(v("series")), "series_id obs_date", "primary_zscore", "SELECT * FROM (SELECT * FROM {g_series} WHERE primary_zscore IS NOT NULL QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY obs_date DESC) = 1) ORDER BY round(abs(primary_zscore), 9) DESC, series_id LIMIT 10"),
    "latest_z": Query(lambda v: insights.latest_z(v("series")), "series_id obs_date", "primary_value primary_zscore", "SELECT * FROM {g_series} WHERE primary_zscore IS NOT NULL QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY obs_date DESC) = 1"),
    "coverage": Query(lambda v: marts.coverage({"series": (v("series_obs"), "obs_date"), "prices": (v("prices"), "price_date"), "positions": (v("cot"), "report_date")}), "source first_date last_date n_rows", "", "SELECT 'series' AS source, min(obs_date) AS first_date, max(obs_date) AS last_date, count(*) AS n_rows FROM {series_obs} UNION ALL SELECT 'prices', min(price_date), max(price_date), count(*) FROM {prices} UNION ALL SELECT 'positions', min(report_date), max(report_date), count(*) FROM {cot}"),
    "staleness": Query(lambda v: marts.staleness(marts.coverage({"prices": (v("prices"), "price_date"), "positions": (v("cot"), "report_date")}), "2024-03-01"), "source days_stale", "", "SELECT 'prices' AS source, DATE '2024-03-01' - max(price_date) AS days_stale FROM {prices} UNION ALL SELECT 'positions', DATE '2024-03-01' - max(report_date) FROM {cot}"),
    "as_of": Query(lambda v: marts.as_of({"series": (v("series_obs"), "obs_date"), "positions": (v("cot"), "report_date")}), "as_of", "", "SELECT greatest((SELECT max(obs_date) FROM {series_obs}), (SELECT max(report_date) FROM {cot})) AS as_of"),
    "run_report": Query(lambda v: marts.run_report(_status(v)), "category n ok empty failed n_rows", "", "SELECT category, count(*) AS n, count(*) FILTER (r > 0) AS ok, count(*) FILTER (r = 0) AS empty, CAST(0 AS BIGINT) AS failed, CAST(sum(r) AS BIGINT) AS n_rows FROM (SELECT category, coalesce(c, 0) AS r FROM {dim_series} LEFT JOIN (SELECT series_id, count(value) AS c FROM {series_obs} GROUP BY 1) USING (series_id)) GROUP BY 1"),
    "key_status": Query(lambda v: marts.key_coverage(v("series_obs"), "series_id", "obs_date", "value"), "series_id first_date last_date n_rows", "", "SELECT series_id, min(obs_date) AS first_date, max(obs_date) AS last_date, count(*) AS n_rows FROM {series_obs} WHERE value IS NOT NULL GROUP BY 1"),
    "run_summary": Query(lambda v: marts.run_summary(_status(v), "positions", "n_rows"), "n ok empty failed total result", "", "SELECT count(*) AS n, count(*) FILTER (r > 0) AS ok, count(*) FILTER (r = 0) AS empty, CAST(0 AS BIGINT) AS failed, CAST(sum(r) AS BIGINT) AS total, CASE WHEN count(*) FILTER (r = 0) < count(*) THEN 'PASS' ELSE 'COMPLETED WITH ISSUES' END AS result FROM (SELECT coalesce(c, 0) AS r FROM {dim_series} LEFT JOIN (SELECT series_id, count(value) AS c FROM {series_obs} GROUP BY 1) USING (series_id))"),
    "transform_report": Query(_transform, "n_tables n_rows reconciled regime_label result", "", "SELECT CAST(2 AS BIGINT) AS n_tables, CAST((SELECT count(*) FROM {g_series}) + (SELECT count(*) FROM {g_curve}) AS BIGINT) AS n_rows, m AS reconciled, coalesce((SELECT regime_label FROM {g_label}), 'n/a') AS regime_label, CASE WHEN m THEN 'PASS' ELSE 'COMPLETED WITH ISSUES' END AS result FROM (SELECT (SELECT count(*) FROM {g_series}) = (SELECT count(*) FROM {series_obs}) AS m)", many=True),
    "kpi_tail": Query(lambda v: marts.kpi_tail(v("macro"), "date", _KPIS).withColumn("tail_sum", F.aggregate("tail", F.lit(0.0), lambda a, b: a + F.coalesce(b, F.lit(0.0)))).withColumn("n", F.size("tail")), "measure n", "last z_latest pctile_latest tail_sum", f"WITH long AS (SELECT date, measure, value FROM (SELECT * FROM {{g_macro}}) UNPIVOT INCLUDE NULLS (value FOR measure IN ({', '.join(_KPIS)}))), m AS ({_measures('long', 'measure', 'date', 'value')}), t AS (SELECT measure, date, value FROM long QUALIFY row_number() OVER (PARTITION BY measure ORDER BY date DESC) <= 90) SELECT t.measure, CAST(count(*) AS INT) AS n, arg_max_null(t.value, t.date) AS last, any_value(z_latest) AS z_latest, any_value(pctile_latest) AS pctile_latest, coalesce(sum(t.value), 0) AS tail_sum FROM t JOIN m ON m.measure = t.measure GROUP BY 1 HAVING arg_max_null(t.value, t.date) IS NOT NULL"),
    "valuation_table": Query(lambda v: marts.valuation_table(v("value")), "ticker", "earnings_yield sales_yield fcf_yield market_cap_bn", "SELECT ticker, earnings_yield, sales_yield, fcf_yield, market_cap_gbp / 1e9 AS market_cap_bn FROM {g_value} WHERE price_date = (SELECT max(price_date) FROM {g_value})"),
    "metrics_panel": Query(lambda v: security.latest_asof(security.metrics_panel(v("universe_prices"), v("universe_facts"), v("dim_instrument"), ["1997-06-30", ASOF_DATE])), "ticker asof_date", "last_close market_cap roe", "SELECT ticker, asof_date, last_close, market_cap, roe FROM {g_security}", digits=4),
    "metrics_panel_months": Query(
        lambda v: security.metrics_panel(v("universe_prices"), v("universe_facts"), v("dim_instrument"), PANEL),
        "ticker asof_date sector",
        "last_close market_cap earnings_yield pe roe rev_growth_yoy eps_growth_yoy ret_1m ret_12_1m dist_52w_high",
        "g_panel",
        digits=4,
    ),
    "formatted": Query(lambda v: dedupe.latest(v("series").where("value IS NOT NULL"), ["series_id"], "obs_date").select("series_id", formats.num("value").alias("num"), formats.pct("chg_pct", 0).alias("pct"), formats.sigma("zscore").alias("sigma"), formats.signed("chg", 1).alias("signed"), formats.day("obs_date").alias("day")), "series_id num pct sigma signed day", "", _FORMATTED),
    "reconciliation": Query(lambda v: marts.reconciliation(v("series_obs"), v("series"), v("dim_series"), "series_id"), "staged gold unknown matched explained", "", "SELECT *, staged = gold AS matched, staged - unknown = gold AS explained FROM (SELECT count(*) AS staged, count(*) FILTER (series_id NOT IN (SELECT series_id FROM {dim_series})) AS unknown, (SELECT count(*) FROM {g_series}) AS gold FROM {series_obs})"),
    "vol_vs_history": Query(lambda v: marts.level_vs_history(v("vol"), "date", list(gold.VOL.values())), "measure n", "last mean std low high z_latest pctile_latest", "WITH long AS (SELECT date, measure, value FROM (SELECT * FROM {g_vol}) UNPIVOT (value FOR measure IN (" + ", ".join(VOL.values()) + "))) " + _measures("long", "measure", "date", "value")),
    "rates_vs_history": Query(lambda v: marts.level_vs_history(v("curve"), "date", list(gold.CURVE.values())), "measure n", "last mean std low high z_latest pctile_latest", "WITH long AS (SELECT date, measure, value FROM (SELECT * FROM {g_curve}) UNPIVOT (value FOR measure IN (" + ", ".join(CURVE.values()) + "))) " + _measures("long", "measure", "date", "value")),
    "rebased_prices": Query(lambda v: marts.rebased(v("prices"), "ticker", "price_date", "adj_close"), "ticker price_date", "rebased", "SELECT ticker, price_date, 100 * adj_close / first_value(adj_close) OVER (PARTITION BY ticker ORDER BY price_date) AS rebased FROM {prices}"),
    "tail_90": Query(lambda v: marts.tail(v("prices"), "ticker", "price_date"), "ticker price_date", "adj_close", "SELECT * FROM {prices} QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY price_date DESC) <= 90"),
    "factor_matrix": Query(lambda v: marts.factor_matrix(v("scores"), _SCORES), "ticker factor", "z", "SELECT ticker, factor, z FROM (SELECT ticker, mom_z, lowvol_z, trend_z, quality_z, growth_z, value_z FROM {g_scores} WHERE price_date = (SELECT max(price_date) FROM {g_scores}) AND composite_z IS NOT NULL ORDER BY round(abs(composite_z), 9) DESC, ticker LIMIT 12) UNPIVOT INCLUDE NULLS (z FOR factor IN (mom_z, lowvol_z, trend_z, quality_z, growth_z, value_z))"),
    "headline_days": Query(lambda v: v("stories").where("published_date IS NOT NULL").groupBy("published_date").agg(F.count(F.lit(1)).alias("n")), "published_date n", "", "SELECT published_date, count(*) AS n FROM {g_headlines} WHERE published_date IS NOT NULL GROUP BY 1"),
    "recent_stories": Query(lambda v: marts.recent(v("stories")), "item_id title", "", "SELECT item_id, title FROM {g_headlines} WHERE published_at IS NOT NULL ORDER BY published_at DESC, item_id LIMIT 40"),
    "latest_positions": Query(lambda v: dedupe.latest(v("positions"), ["market_id"], "report_date"), "market_id report_date net_lev", "net_lev_pctile", _last("g_positions", "market_id", "report_date")),
    "latest_skew": Query(lambda v: dedupe.latest(v("skews"), ["ticker_id"], "capture_date"), "ticker_id capture_date", "put_skew put_skew_pctile", _last("g_skew", "ticker_id", "capture_date")),
    "sector_rotation": Query(lambda v: dedupe.latest(v("strength"), ["ticker"], "price_date"), "ticker price_date group", "excess_63d rs_trend_21d", _last("g_strength", "ticker", "price_date")),
    "fundamentals_latest_valued": Query(_latest_valued, "ticker period_end price_date", "roe net_margin earnings_yield", f"SELECT f.ticker, f.period_end, v.price_date, f.roe, f.net_margin, v.earnings_yield FROM ({_last('g_funds', 'ticker', 'period_end')}) f JOIN ({_last('g_value', 'ticker', 'price_date')}) v ON v.ticker = f.ticker"),
    "manifest_violations": Query(lambda v: marts.violations(v("dim_instrument").withColumn("region", F.when(F.col("suppkey") % 9 != 0, "x")), "ticker", ["name", "region", "sector"], {"currency": ["USD", "EUR", "GBP", "GBp"]}, {"ticker": "^(T|\\^)"}), "key rule", "", "SELECT ticker AS key, unnest(list_filter([CASE WHEN suppkey % 9 = 0 THEN 'missing region' END, CASE WHEN sector IS NULL THEN 'missing sector' END, CASE WHEN currency NOT IN ('USD', 'EUR', 'GBP', 'GBp') THEN 'currency not allowed' END], lambda x: x IS NOT NULL)) AS rule FROM {dim_instrument}"),
}

# the same queries under the names that they were first registered by
WHOLE = LOADS | PAYLOADS
WHOLE = {n: WHOLE[f"{n}_whole"] for n in ("replace_by_key", "replace_by_key_empty_clears", "upsert_rows", "upsert_counts", "since_high_water", "clean_text", "statements_long")}

QUERIES: dict[str, Query] = registry.QUERIES | WHOLE | LOADS | PAYLOADS | payload_queries.PAYLOADS | STATISTICS | MARTS


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: q.frame for n, q in QUERIES.items()} | payload_queries.STREAMS | roundtrips.queries()


def oracles() -> dict[str, str]:
    return {n: s for n, q in QUERIES.items() if (s := q.oracle()) is not None} | payload_queries.STREAM_ORACLES | roundtrips.oracles(STEPS)

"""Staging tables derived from the given tables, so that every query's work grows with them.

Each is one statement in SQL that Spark and DuckDB both read, with {names} of other relations; Spark gets data frames
in their place, the oracle their names.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

TABLES = {"region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations", "benchmark", "labels", "embeddings"}

# fixed values: series codes in the order in which customers are dealt to them
SERIES = [
    "DGS3MO", "DGS2", "DGS5", "DGS10", "DGS30", "T10Y2Y", "T10Y3M", "DFII10", "T10YIE", "THREEFYTP10", "DFII5", "T5YIE", "T5YIFR",
    "BAMLC0A0CM", "BAMLH0A0HYM2", "BAMLC0A1CAAA", "BAMLC0A4CBBB", "BAMLH0A1HYBB", "BAMLH0A3HYC", "BAMLEMCBPIOAS", "DEXUSUK", "DEXUSEU",
    "VIXCLS", "VXVCLS", "OVXCLS", "GVZCLS", "VXEEMCLS", "EVZCLS", "VXNCLS", "RVXCLS", "INDPRO", "RSAFS", "PAYEMS", "UMCSENT", "HOUST",
    "GDPC1", "UNRATE", "ICSA", "CPIAUCSL", "CPILFESL", "PCEPILFE", "NFCI", "DTWEXBGS", "DCOILWTICO",
]
_DEALT = ", ".join(f"({i}, '{s}')" for i, s in enumerate(SERIES))

VIEWS = {
    "series_obs": f"""
        SELECT s.series_id, CAST(o.o_orderdate AS DATE) AS obs_date,
               round(avg(CASE WHEN o.o_custkey % 97 = 0 THEN NULL ELSE o.o_totalprice / 100000 + 0.5 END), 9) / 0.97 AS value
        FROM {{orders}} o JOIN (VALUES {_DEALT}) AS s(idx, series_id) ON o.o_custkey % {len(SERIES)} = s.idx
        GROUP BY s.series_id, CAST(o.o_orderdate AS DATE)""",
    "dim_series": f"""
        SELECT series_id, series_id AS name, CASE WHEN idx < 13 THEN 'rates' ELSE 'other' END AS category, 'D' AS freq,
               CASE idx % 3 WHEN 0 THEN 'level' WHEN 1 THEN 'yoy' ELSE 'mom' END AS transform
        FROM (VALUES {_DEALT}) AS s(idx, series_id) WHERE idx <> 29""",
    "dim_instrument": """
        SELECT CASE s_suppkey WHEN 1 THEN '^GSPC' WHEN 2 THEN '^FTSE' WHEN 3 THEN '^STOXX50E' ELSE 'T' || CAST(s_suppkey AS STRING) END AS ticker,
               s_name AS name, s_suppkey AS suppkey,
               CASE s_suppkey % 5 WHEN 0 THEN 'indices' WHEN 1 THEN 'sector_etfs' WHEN 2 THEN 'style_etfs' WHEN 3 THEN 'country_etfs' ELSE 'watchlist' END AS "group",
               CASE s_nationkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'GBp' ELSE 'JPY' END AS currency,
               CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE n_name END AS sector
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "prices": """
        SELECT d.ticker, CAST(l_shipdate AS DATE) AS price_date, max(l_extendedprice / l_quantity) / 3.7193 AS close,
               round(avg(l_extendedprice / l_quantity), 9) / 3.7193 AS adj_close, sum(l_quantity) AS volume
        FROM {lineitem} JOIN {dim_instrument} d ON l_suppkey = d.suppkey GROUP BY d.ticker, CAST(l_shipdate AS DATE)""",
    "year_sums": """
        SELECT d.ticker, d.suppkey, year(l_shipdate) AS y, round(sum(l_extendedprice), 6) AS rev, round(sum(l_extendedprice * (1 - l_discount)), 6) AS net, sum(l_quantity) AS qty
        FROM {lineitem} JOIN {dim_instrument} d ON l_suppkey = d.suppkey GROUP BY d.ticker, d.suppkey, year(l_shipdate)""",
    "fundamentals_eav": """
        SELECT ticker, 'income' AS statement, CASE WHEN m.k = 12 AND suppkey % 4 = 0 THEN 'quarterly' ELSE 'annual' END AS freq, m.metric,
               make_date(y, 12, 31) AS period_end, make_date(y + 1, 3, 31) AS available_from,
               (m.a * rev + m.b * net + m.c * qty) / 0.97 AS value
        FROM {year_sums} CROSS JOIN (VALUES (1, 'Total Revenue', 1.0, 0.0, 0.0), (2, 'Gross Profit', -0.4, 0.9, 0.0), (3, 'Operating Income', -0.7, 0.9, 0.0),
             (4, 'Net Income Common Stockholders', -0.88, 0.95, 0.0), (5, 'Diluted EPS', -0.00088, 0.00095, 0.0), (6, 'Diluted Average Shares', 0.0, 0.0, 1.0),
             (7, 'Total Assets', 2.0, 0.0, 1.0), (8, 'Stockholders Equity', 1.5, -0.6, 0.0), (9, 'Total Debt', 0.3, 0.1, 0.0), (10, 'Operating Cash Flow', -0.8, 0.95, 0.0),
             (11, 'Capital Expenditure', 0.01, 0.0, 0.0), (12, 'Free Cash Flow', -0.81, 0.95, 0.0)) AS m(k, metric, a, b, c)
        WHERE NOT (suppkey % 7 = 0 AND m.k = 2)""",
    "company_meta": """
        SELECT ticker, CASE WHEN suppkey % 11 = 0 THEN NULL WHEN currency = 'GBp' THEN 'GBP' ELSE currency END AS financial_currency,
               CASE WHEN suppkey % 17 = 0 THEN NULL ELSE 1000.0 * suppkey END AS shares_outstanding FROM {dim_instrument}""",
    "cot": """
        SELECT CASE event_type WHEN 'view' THEN 'vix' WHEN 'click' THEN 'sp500' ELSE event_type END AS market_id, upper(event_type) AS market,
               CAST(ts AS DATE) AS report_date, CAST(CAST(ts AS DATE) + INTERVAL 3 DAY AS DATE) AS available_from,
               count(*) AS open_interest,
               sum(CASE WHEN user_id % 2 = 0 THEN 1 ELSE 0 END) AS lev_long, sum(CASE WHEN user_id % 2 = 1 THEN 1 ELSE 0 END) AS lev_short,
               sum(CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END) AS am_long, sum(CASE WHEN user_id % 3 = 1 THEN 1 ELSE 0 END) AS am_short
        FROM {events} GROUP BY event_type, CAST(ts AS DATE)""",
    "skew_captures": """
        SELECT CASE user_id % 3 WHEN 0 THEN 'spx' WHEN 1 THEN 'ndx' ELSE 'rut' END AS ticker_id, CASE user_id % 3 WHEN 0 THEN 'SPY' WHEN 1 THEN 'QQQ' ELSE 'IWM' END AS ticker,
               CAST(ts AS DATE) AS capture_date, CAST(CAST(CAST(ts AS DATE) + INTERVAL 33 DAY AS DATE) AS STRING) AS expiry, 33 AS dte,
               round(avg(value), 6) AS spot, round(avg(CASE WHEN event_type = 'view' THEN value END), 6) AS atm_iv, round(avg(CASE WHEN event_type = 'click' THEN value END), 6) AS put_iv,
               round(avg(CASE WHEN event_type = 'signup' THEN value END), 6) AS call_iv,
               round(avg(CASE WHEN event_type = 'click' THEN value END) - avg(CASE WHEN event_type = 'view' THEN value END), 6) AS put_skew,
               round(avg(CASE WHEN event_type = 'click' THEN value END) - avg(CASE WHEN event_type = 'signup' THEN value END), 6) AS risk_reversal
        FROM {events} GROUP BY user_id % 3, CAST(ts AS DATE)""",
    "headline_items": """
        SELECT md5(d.text) AS item_id, d.text AS title, p.html AS summary, 'https://example.com/' || CAST(d.doc_id AS STRING) AS link,
               CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 7 MINUTE * CAST(d.doc_id % 40000 AS INT) END AS published_at,
               d.source AS first_feed, TIMESTAMP '2024-01-02 00:00:00' + INTERVAL 1 MINUTE * CAST(d.doc_id AS INT) AS first_seen_at, d.doc_id
        FROM {documents} d LEFT JOIN {pages} p ON d.doc_id = p.page_id""",
    "news_feeds": """
        SELECT source AS feed, 'section-' || min(lang) AS feed_group, max(lang) AS region FROM {documents} WHERE source <> 'src3' GROUP BY source""",
    "universe_facts": """
        SELECT ticker, m.metric, make_date(y, 12, 31) AS period_end, y AS fiscal_year, CASE WHEN y % 3 = 2 AND m.k = 8 THEN 'Q4' ELSE 'FY' END AS fiscal_period,
               CAST(make_date(y + 1, 3, 31) + INTERVAL 1 DAY * CAST(suppkey % 30 + 40 * r.n AS INT) AS DATE) AS filed_date,
               (m.a * rev + m.b * net + m.c * qty) * (1 + 0.01 * r.n) / 0.97 AS value
        FROM {year_sums} CROSS JOIN (VALUES (1, 'revenue', 1.0, 0.0, 0.0), (2, 'gross_profit', -0.4, 0.9, 0.0), (3, 'operating_income', -0.7, 0.9, 0.0),
             (4, 'net_income', -0.88, 0.95, 0.0), (5, 'eps_diluted', -0.00088, 0.00095, 0.0), (6, 'shares', 0.0, 0.0, 20.0), (7, 'assets', 2.0, 0.0, 1.0),
             (8, 'equity', 1.5, -0.6, 0.0), (9, 'long_term_debt', 0.3, 0.1, 0.0), (10, 'op_cash_flow', -0.8, 0.95, 0.0), (11, 'capex', 0.01, 0.0, 0.0)) AS m(k, metric, a, b, c)
        CROSS JOIN (VALUES (0), (1)) AS r(n) WHERE (r.n = 0 OR suppkey % 5 = 0) AND NOT (suppkey % 7 = 0 AND m.k = 2)""",
    "option_chain": """
        SELECT d.ticker AS ticker_id, year(l_shipdate) AS capture, CASE WHEN l_returnflag = 'A' THEN 'put' ELSE 'call' END AS side,
               round(l_extendedprice / l_quantity, 9) AS strike, l_discount AS iv,
               round(avg(l_extendedprice / l_quantity) OVER (PARTITION BY d.ticker, year(l_shipdate)), 9) AS spot, CAST(l_shipdate AS DATE) AS expiry, l_orderkey, l_linenumber
        FROM {lineitem} JOIN {dim_instrument} d ON l_suppkey = d.suppkey""",
    "event_batches": """
        SELECT user_id, event_type, CAST(ts AS DATE) AS day, value, event_id, CASE WHEN CAST(ts AS DATE) < DATE '2024-01-20' THEN 'stored' ELSE 'incoming' END AS batch FROM {events}""",
    "messages": "SELECT conv_id, turn, role, text FROM {conversations}",
}


def names_in(template: str) -> list[str]:
    return list(dict.fromkeys(f for _, f, _, _ in string.Formatter().parse(template) if f))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or one of VIEWS, as a data frame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return over(spark, name, {n: view(spark, sf_dir, n) for n in names_in(VIEWS[name])})


def over(spark: SparkSession, name: str, frames: dict[str, DataFrame]) -> DataFrame:
    """One of VIEWS over given frames."""
    return spark.sql(VIEWS[name].replace('"group"', "`group`"), **frames)


def ctes(names: list[str], more: dict[str, str] | None = None) -> str:
    """WITH clause for DuckDB that defines the named relations, and those they need, from VIEWS and more."""
    known, done = VIEWS | (more or {}), {}

    def need(n: str) -> None:
        if n in TABLES or n in done:
            return
        for m in names_in(known[n]):
            need(m)
        done[n] = known[n].format_map({m: m for m in names_in(known[n])})

    for n in names:
        need(n)
    return "WITH " + ", ".join(f"{n} AS ({q})" for n, q in done.items()) if done else ""

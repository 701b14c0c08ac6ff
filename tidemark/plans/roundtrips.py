"""Queries that write tables or files and read them back: landing, feeds, CSV, rebuilt tables, bucketed upserts.

Each derives what it lands from the given tables, in a new folder that driver and executors share.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ranks import matched
from tidemark.plans import fixtures, gold, marts
from tidemark.plans.incremental import DOUBLES, analytics, update_series
from tidemark.plans.payload_queries import LANDING_DAYS, _folder
from tidemark.sources import files, parse
from tidemark.streaming import loads

#: Rows that go into one landed body or feed, about.
BODY_ROWS, FEED_ROWS = 500, 200
#: How the day of an event tells the batch that it lands with, and the same for the oracle.
PART = f"floor(datediff(to_date(ts), DATE '2024-01-01') / {LANDING_DAYS})"
PART_SQL = f"CAST(floor((CAST(ts AS DATE) - DATE '2024-01-01') / {LANDING_DAYS}) AS BIGINT)"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return fixtures.view(spark, sf_dir, name)


def _dealt(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """rows with the part of their key's bodies that they go into: a key has one for each n rows, so that the files are as
    many as the rows ask for, however many keys there are."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / n).alias("_bodies"))
    return matched(rows, F.broadcast(sizes), keys, ["_bodies"], "inner").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("_bodies"))).drop("_bodies")


def landed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' sizes as JSON bodies, several of a key, landed twice and parsed from their files."""
    at = _folder(spark)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.concat("source", F.lit("/"), "lang").alias("key"))
    bodies = _dealt(docs, ["key"], BODY_ROWS).groupBy("key", "part").agg(F.to_json(F.collect_list(F.struct("doc_id", "n_chars"))).alias("body"))
    for _ in range(2):  # the second landing replaces the first
        files.land_payloads(bodies, f"{at}/raw", "2024-01-31", "key", "body")
    rows = F.explode(F.from_json("body", "array<struct<doc_id long, n_chars long>>")).alias("x")
    return files.raw_payloads(spark, f"{at}/raw").select(F.col("run_date").cast("string").alias("run_date"), "key", rows).select("run_date", "key", "x.doc_id", "x.n_chars")


def raw_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as snapshots by run date and type; a date that is landed again is replaced."""
    at, events = _folder(spark), _table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    files.save_raw(events.where("event_id % 2 = 0"), at, "2024-01-31", "event_type")
    for date in ("2024-01-31", "2024-02-29"):
        files.save_raw(events, at, date, "event_type")
    return spark.read.parquet(at).groupBy(F.col("run_date").cast("string").alias("run_date"), "key").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id"))


def csv_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored state as CSV, dumped and restored."""
    at = _folder(spark)
    events = _table(spark, sf_dir, "event_batches").select("event_id", "user_id", "event_type", "day", "value")
    files.dump({"events": events}, at)
    return files.restore(spark, {"events": "event_id long, user_id long, event_type string, day date, value double"}, at)["events"]


def constituents_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The constituents' table, written as CSV and read under its own headers."""
    at = _folder(spark)
    rows = _table(spark, sf_dir, "supplier").select(F.concat(F.lit("t."), F.col("s_suppkey").cast("string")).alias("Symbol"), F.col("s_name").alias("Security"), F.col("s_suppkey").cast("string").alias("CIK"))
    files.write_csv(rows, at)
    back = files.read_csv(spark, at, "Symbol string, Security string, CIK string")
    return parse.constituents(back, {"ticker": ["symbol"], "name": ["security"], "sector": ["gics sector"], "cik": ["cik"]})


def tables_gathered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns of tables by name, with those that aren't there."""
    mark = uuid.uuid4().hex
    names = {n: f"tm_{n}_{mark}" for n in ("nation", "supplier", "absent")}
    files.register({names[n]: _table(spark, sf_dir, n) for n in ("nation", "supplier")})
    found = files.gather(spark, {names["nation"]: ["n_nationkey", "n_name"], names["supplier"]: ["s_suppkey"], names["absent"]: ["x"]})
    every = {n: found[names[n]] if found[names[n]] is not None else files.table_or_empty(spark, names[n], "x int") for n in names}
    lines = [df.agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n_rows")).withColumns({"n_columns": F.lit(len(df.columns)).cast("long"), "present": F.lit(found[names[n]] is not None)}) for n, df in every.items()]
    return lines[0].unionByName(lines[1]).unionByName(lines[2])


def rebuilt_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gold table and a dimension built twice: the second build replaces the first wholly."""
    base = f"tm_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {base} LOCATION '{_folder(spark)}'")
    vol, dim = gold.vol_term(_table(spark, sf_dir, "series_obs")), _table(spark, sf_dir, "dim_series").select("series_id", "category")
    for name, df in (("vol", vol.select("date", "ts_state")), ("dim", dim)):
        files.rebuild(df.limit(3), f"{base}.{name}")
        files.rebuild(df, f"{base}.{name}")
    a = spark.table(f"{base}.vol").select(F.lit("vol").alias("name"), F.col("date").cast("string").alias("key"), F.col("ts_state").alias("value"))
    return a.unionByName(spark.table(f"{base}.dim").select(F.lit("dim").alias("name"), F.col("series_id").alias("key"), F.col("category").alias("value")))


def contract_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of listed tickers, from a table whose columns are checked first."""
    prices = marts.require_columns(_table(spark, sf_dir, "prices"), ["ticker", "price_date", "adj_close"])
    return marts.only(prices, "ticker", ["T4", "T9", "^GSPC"]).groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), F.max("price_date").alias("last_date"))


def _xml(c: Column) -> Column:
    """A text as XML content; carriage returns would be read as line feeds."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _feeds(spark: SparkSession, sf_dir: str, at: str) -> None:
    """Documents as RSS (even identifiers) and Atom (odd) files of some hundred items, a broken file and an empty one."""
    docs = _table(spark, sf_dir, "documents")
    n, title = F.col("doc_id").cast("string"), F.concat(F.lit("t "), _xml(F.coalesce("text", F.lit(""))))
    day = F.date_format(F.expr("timestamp_seconds(1704067200 + doc_id % 300 * 86400)"), "yyyy-MM-dd")
    rss_day = F.date_format(F.expr("timestamp_seconds(1704067200 + doc_id % 300 * 86400)"), "EEE, dd MMM yyyy")
    rss = F.concat(F.lit("<item><guid>g"), n, F.lit("</guid><title>"), title, F.lit("</title><link>https://example.com/"), n, F.lit("</link><pubDate>"), rss_day, F.lit(" 08:30:00 GMT</pubDate></item>"))
    atom = F.concat(F.lit("<entry><id>g"), n, F.lit("</id><title>"), title, F.lit('</title><link rel="self" href="https://example.com/self"/><link href="https://example.com/'), n, F.lit('"/><updated>'), day, F.lit("T08:30:00Z</updated></entry>"))
    for kind, odd, item, head, tail in (("rss", 0, rss, "<rss><channel>", "</channel></rss>"), ("atom", 1, atom, '<feed xmlns="http://www.w3.org/2005/Atom">', "</feed>")):
        some = _dealt(docs.where(F.abs(F.col("doc_id")) % 2 == odd), ["source"], FEED_ROWS).groupBy("source", "part").agg(F.concat(F.lit(head), F.array_join(F.collect_list(item), ""), F.lit(tail)).alias("body"))
        files.land_payloads(some, f"{at}/{kind}", "2024-01-31", "source", "body")
    other = [("broken", "<rss><channel><item>"), ("empty", "<rss><channel/></rss>")]
    files.land_payloads(spark.createDataFrame(other, "source string, body string"), f"{at}/rss", "2024-01-31", "source", "body")


def feeds_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stories of landed RSS and Atom files, read as XML."""
    at = _folder(spark)
    _feeds(spark, sf_dir, at)
    items = files.feed_file(spark, f"{at}/rss/*/*/*").unionByName(files.feed_file(spark, f"{at}/atom/*/*/*", "entry"))
    return parse.feed_items(items).select("item_id", "title", "link", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"))


def feeds_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of each landed feed: items by source, a broken file and one without items."""
    at = _folder(spark)
    _feeds(spark, sf_dir, at)
    told = files.feed_status(files.raw_payloads(spark, f"{at}/rss")).unionByName(files.feed_status(files.raw_payloads(spark, f"{at}/atom")))
    return told.groupBy(F.col("key").alias("source"), "status").agg(F.sum(F.coalesce("n_items", F.lit(0))).cast("long").alias("n_items"))


PRICE_CSV = "ticker string, date date, close double, volume double"


def _priced(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    at = _folder(spark)
    v = F.col("volume").cast("long")
    close = F.when(v % 13 == 0, F.lit("n/a")).when(v % 17 == 0, F.concat(F.lit("-"), F.col("close").cast("string"))).otherwise(F.col("close").cast("string"))
    more = F.when(v % 11 == 0, F.lit(",7")).otherwise("")
    line = F.concat(F.concat_ws(",", "ticker", F.col("price_date").cast("string"), close, v.cast("string")), more)
    _table(spark, sf_dir, "prices").select(line).write.text(at)
    return files.read_csv_checked(spark, at, PRICE_CSV, {"close isn't above zero": F.col("close") > 0}, header=False)


def checked_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a price file that fit the schema and the rule."""
    return _priced(spark, sf_dir)[0].select("ticker", "date", F.round("close", 6).alias("close"), "volume")


def quarantined_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined rows of a price file by reason, and how many were good."""
    good, bad = _priced(spark, sf_dir)
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).unionByName(good.agg(F.lit("good").alias("reason"), F.count(F.lit(1)).alias("n")))


def reconciled_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series analytics built and reconciled with its staging rows in the same pass."""
    staged, dim = _table(spark, sf_dir, "series_obs"), _table(spark, sf_dir, "dim_series")
    return marts.build_reconciled(staged, dim, "series_id", lambda rows: gold.series_analytics(rows, dim), f"{_folder(spark)}/series")


def series_analytics_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series analytics by updates: a first load with wrong values in places and without the last years, then revisions of
    single dates, then the rows that came late."""
    root, dim = _folder(spark), _table(spark, sf_dir, "dim_series")
    obs = _table(spark, sf_dir, "series_obs").withColumn("late", F.year("obs_date") >= 1997)
    wrong = (F.dayofmonth("obs_date") == 15) & (F.month("obs_date") == 7) & (F.year("obs_date") > 1993)
    first = obs.where(~F.col("late")).withColumn("value", F.when(wrong, F.col("value") * 1.5).otherwise(F.col("value")))
    for version, batch in enumerate((first, obs.where(wrong & ~F.col("late")), obs.where("late"))):
        update_series(batch, dim, root, version, 8)
    return analytics(spark, root).select("series_id", "obs_date", "freq", "intended_transform", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in DOUBLES])


def _upserted(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Events that land part by part, each part a run of the upserting stream; the table's folder and an empty batch."""
    at = _folder(spark)
    rows = _table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", F.round("value", 6).alias("value"), F.expr(PART).cast("long").alias("part"))
    for k in [r[0] for r in rows.select("part").distinct().orderBy("part").collect()]:  # a row for each landing
        rows.where(F.col("part") == k).write.parquet(f"{at}/in/{k}")
        source = loads.landed(spark, f"{at}/in/*", "user_id long, event_type string, event_id long, value double, part long")
        loads.upsert_buckets(source, ["user_id", "event_type"], "event_id", f"{at}/table", f"{at}/state").awaitTermination()
    return f"{at}/table", rows.limit(0)


def stream_upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user and type, by upserts that rewrite touched buckets only."""
    from tidemark.operators.buckets import current

    root, empty = _upserted(spark, sf_dir)
    return current(spark, root, empty.schema)


def stream_upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seen and new keys of each landed batch."""
    root, _ = _upserted(spark, sf_dir)
    return spark.read.parquet(f"{root}/counts").select(F.col("batch_id").cast("long").alias("batch_id"), "n_seen", "n_new")


_DAY = "CAST(DATE '2024-01-01' + CAST(doc_id % 300 AS INT) AS STRING) || ' 08:30:00'"
_V = "CAST(volume AS BIGINT)"
_REASON = f"CASE WHEN {_V} % 11 = 0 OR {_V} % 13 = 0 THEN 'not a row of the schema' WHEN {_V} % 17 = 0 THEN 'close isn''t above zero' ELSE 'good' END"

#: Each query with its SQL over the staging views.
ROUNDTRIPS: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "landed_payloads": (landed_payloads, "SELECT '2024-01-31' AS run_date, source || '_' || lang AS key, doc_id, n_chars FROM {documents}"),
    "raw_snapshots": (raw_snapshots, "SELECT run_date, event_type AS key, count(*) AS n, max(event_id) AS last_id FROM {events}, (VALUES ('2024-01-31'), ('2024-02-29')) AS d(run_date) GROUP BY ALL"),
    "csv_state": (csv_state, "SELECT event_id, user_id, event_type, day, value FROM {event_batches}"),
    "constituents_written": (constituents_written, "SELECT 'T-' || s_suppkey AS ticker, s_name AS name, CAST(NULL AS STRING) AS sector, lpad(CAST(s_suppkey AS STRING), 10, '0') AS cik FROM {supplier}"),
    "tables_gathered": (tables_gathered, "SELECT 'nation' AS name, count(*) AS n_rows, CAST(2 AS BIGINT) AS n_columns, true AS present FROM {nation} UNION ALL SELECT 'supplier', count(*), 1, true FROM {supplier} UNION ALL SELECT 'absent', 0, 1, false"),
    "rebuilt_tables": (rebuilt_tables, "SELECT 'vol' AS name, CAST(date AS STRING) AS key, ts_state AS value FROM {g_vol} UNION ALL SELECT 'dim', series_id, category FROM {dim_series}"),
    "contract_checked": (contract_checked, "SELECT ticker, count(*) AS n, max(price_date) AS last_date FROM {prices} WHERE ticker IN ('T4', 'T9', '^GSPC') GROUP BY 1"),
    "feeds_read": (feeds_read, f"SELECT 'g' || doc_id AS item_id, rtrim('t ' || coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13)) AS title, 'https://example.com/' || doc_id AS link, {_DAY} AS published_at FROM {{documents}}"),
    "feeds_status": (feeds_status, "SELECT source, 'ok' AS status, count(*) AS n_items FROM {documents} GROUP BY 1 UNION ALL VALUES ('broken', 'error', 0), ('empty', 'empty', 0)"),
    "checked_prices": (checked_prices, f"SELECT ticker, price_date AS date, round(close, 6) AS close, CAST({_V} AS DOUBLE) AS volume FROM {{prices}} WHERE {_REASON} = 'good'"),
    "quarantined_prices": (quarantined_prices, f"SELECT {_REASON} AS reason, count(*) AS n FROM {{prices}} GROUP BY 1"),
    "reconciled_build": (reconciled_build, "SELECT *, staged = gold AS matched, staged - unknown = gold AS explained FROM (SELECT count(*) AS staged, count(*) FILTER (series_id NOT IN (SELECT series_id FROM {dim_series})) AS unknown, (SELECT count(*) FROM {g_series}) AS gold FROM {series_obs})"),
    "series_analytics_updated": (series_analytics_updated, "SELECT series_id, obs_date, freq, intended_transform, " + ", ".join(f"round({c}, 6) + CAST(0 AS DOUBLE) AS {c}" for c in DOUBLES) + " FROM {g_series}"),
    "stream_upsert_buckets": (stream_upsert_buckets, f"SELECT user_id, event_type, event_id, round(value, 6) AS value, part FROM (SELECT *, {PART_SQL} AS part FROM {{events}}) QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY part DESC, event_id DESC) = 1"),
    "stream_upsert_counts": (stream_upsert_counts, f"WITH keys AS (SELECT DISTINCT user_id, event_type, {PART_SQL} AS part FROM {{events}}), parts AS (SELECT part, CAST(dense_rank() OVER (ORDER BY part) - 1 AS BIGINT) AS batch_id, part = min(part) OVER (PARTITION BY user_id, event_type) AS fresh FROM keys) SELECT batch_id, count(*) AS n_seen, count(*) FILTER (fresh) AS n_new FROM parts GROUP BY 1"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: f for n, (f, _) in ROUNDTRIPS.items()}


def oracles(steps: dict[str, str]) -> dict[str, str]:
    return {n: f"{fixtures.ctes(['result_'], steps | {'result_': sql})} SELECT * FROM result_" for n, (_, sql) in ROUNDTRIPS.items()}

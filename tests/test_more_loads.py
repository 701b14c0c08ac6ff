"""Landing, feeds, statuses, reports, formats and streams over several batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import formats
from tidemark.operators import upsert
from tidemark.plans import marts, security
from tidemark.sources import files, parse
from tidemark.streaming import loads


def test_payloads_land_and_come_back(spark, tmp_path):
    df = spark.createDataFrame([("a/b", '{"x": 1}\n{"y": 2}'), ("c", ""), ("d", None)], "k string, body string")
    at = str(tmp_path / "raw")
    assert files.land_payloads(df, at, "2024-01-01", "k", "body") and files.land_payloads(df, at, "2024-01-01", "k", "body")
    assert not files.land_payloads(df.where("k = 'd'"), at, "2024-01-02", "k", "body")
    got = files.raw_payloads(spark, at).collect()
    assert [(r.key, r.body.rstrip("\n")) for r in got] == [("a_b", '{"x": 1}\n{"y": 2}')]


RSS = '<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><item><title>A</title><link>http://e/1</link><guid isPermaLink="false">g1</guid><dc:date>2024-06-05T10:30:00Z</dc:date></item></channel></rss>'
ATOM = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>e1</id><title>T</title><link rel="self" href="http://e/s"/><link href="http://e/a"/><content type="html">body</content><updated>2024-06-05T10:30:00Z</updated></entry></feed>'


def test_feeds_with_other_names_and_broken_ones(spark, tmp_path):
    for name, text in {"rss": RSS, "atom": ATOM, "broken": "<rss><channel><item>", "none": "<rss><channel/></rss>"}.items():
        (tmp_path / f"{name}.xml").write_text(text)
    r = parse.feed_items(files.feed_file(spark, str(tmp_path / "rss.xml"))).first()
    assert (r.item_id, str(r.published_at)) == ("g1", "2024-06-05 10:30:00")
    r = parse.feed_items(files.feed_file(spark, str(tmp_path / "atom.xml"), "entry")).first()
    assert (r.item_id, r.link, r.summary, str(r.published_at)) == ("e1", "http://e/a", "body", "2024-06-05 10:30:00")
    status = {r.path.rsplit("/", 1)[-1]: (r.status, r.n_items) for r in files.feed_status(files.raw_payloads(spark, str(tmp_path))).collect()}
    assert status == {"rss.xml": ("ok", 1), "atom.xml": ("ok", 1), "broken.xml": ("error", None), "none.xml": ("empty", 0)}


def test_outcomes_and_run_reports(spark):
    x = spark.createDataFrame([("a", 3, None, 200), ("b", None, None, 304), ("c", 0, None, 200), ("d", 5, "lost", 304)], "k string, n long, error string, http int")
    status = x.withColumn("status", parse.outcome(F.col("n"), F.col("error"), F.col("http")))
    assert [r.status for r in status.orderBy("k").collect()] == ["ok", "not_modified", "empty", "error"]
    assert [r.k for r in marts.run_lines(status, "http", "k").collect()] == ["d", "a", "c", "b"]
    s = marts.run_summary(status, "feeds", "n").first()
    assert (s.n, s.ok, s.not_modified, s.empty, s.failed, s.total, s.result) == (4, 1, 1, 1, 1, 8, "COMPLETED WITH ISSUES")
    good = status.where("k IN ('a', 'c')")
    assert [marts.run_summary(good, kind, "n").first().result for kind in marts.PASSES] == ["PASS"] * 4
    none = status.where("k = 'c'")
    assert [marts.run_summary(none, kind, "n").first().result for kind in ("series", "positions", "skew")] == ["PASS", "COMPLETED WITH ISSUES", "COMPLETED WITH ISSUES"]
    assert {r.k: r.note for r in marts.run_flagged(status, "positions").collect()} == {"b": "", "c": "no match - check the pattern", "d": "lost"}
    assert [r.k for r in marts.run_flagged(status, "series").collect()] == ["d"]


def test_metadata_identifiers_and_combined_reports(spark):
    x = spark.createDataFrame([("A", '{"financialCurrency": "EUR", "marketCap": 7}'), ("B", "no json"), ("C", None)], "t string, body string")
    assert sorted(tuple(r) for r in parse.company_meta(x, "t", "body").collect()) == [("A", "EUR", None, 7.0), ("B", None, None, None), ("C", None, None, None)]
    y = spark.createDataFrame([('{"0": {"cik_str": 42, "ticker": "ab"}}',)], "body string")
    assert [tuple(r) for r in parse.cik_map(y, "body").collect()] == [("AB", "0000000042")]
    z = spark.createDataFrame([("VIX", "Combined"), ("VIX 2", "FutOnly"), ("GOLD", None)], "name string, kind string")
    assert [r.name for r in parse.names_like(z, "name", "vix", "kind").collect()] == ["VIX"]


def test_formats(spark):
    x = spark.createDataFrame([(1234.5,), (-0.125,), (float("nan"),), (None,)], "v double")
    shown = [formats.num("v"), formats.pct("v"), formats.bps("v"), formats.sigma("v"), formats.signed("v")]
    got = [list(r) for r in x.select(*[c.alias(str(i)) for i, c in enumerate(shown)]).collect()]
    assert got[0] == ["1,234.50", "123,450.0%", "123,450 bps", "+1234.5σ", "+1,234.50"] and got[1] == ["-0.12", "-12.5%", "-12 bps", "−0.1σ", "−0.12"]
    assert got[2] == got[3] == ["—"] * 5
    assert spark.range(1).select(formats.day(F.lit(dt.date(2024, 1, 31))), formats.day(F.lit(None).cast("date"))).first()[:] == ("2024-01-31", "—")


def test_tables_by_name(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    files.register({"tm_view": df})
    assert files.gather(spark, {"tm_view": ["v"], "tm_absent": ["v"]})["tm_absent"] is None
    assert files.gather(spark, {"tm_view": ["v"]})["tm_view"].columns == ["v"]
    assert marts.only(df, "k", ["a", "z"]).count() == 1
    with pytest.raises(ValueError, match="no k"):
        marts.only(df, "k", ["z"])
    x = spark.createDataFrame([("T", dt.date(2024, 1, 1)), ("T", dt.date(2024, 2, 1))], "ticker string, asof_date date")
    assert security.latest_asof(x).first().asof_date == dt.date(2024, 2, 1)


def test_rebuild(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tm_db LOCATION '{tmp_path}/db'")
    try:
        files.rebuild(df, "tm_db.t")
        files.rebuild(df.limit(1), "tm_db.t")
        assert spark.table("tm_db.t").count() == 1
    finally:
        spark.sql("DROP DATABASE tm_db CASCADE")


def test_kpi_tail_and_valuation_table(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(100)]
    x = spark.createDataFrame([(d, float(i), None if i == 99 else 1.0) for i, d in enumerate(days)], "date date, a double, b double")
    r = marts.kpi_tail(x, "date", ["a", "b"]).collect()
    assert [(q.measure, q.last, q.pctile_latest, q.tail) for q in r] == [("a", 99.0, 100.0, [float(i) for i in range(10, 100)])]
    v = spark.createDataFrame([("A", days[0], 0.9, 0.1, 0.1, 2e9), ("A", days[1], 0.1, 0.1, 0.1, 2e9), ("B", days[1], 0.2, 0.1, None, None)], "ticker string, price_date date, earnings_yield double, sales_yield double, fcf_yield double, market_cap_gbp double")
    assert [(q.ticker, q.market_cap_bn) for q in marts.valuation_table(v).collect()] == [("B", None), ("A", 2.0)]


def test_streams_over_batches_that_land_later(spark, tmp_path):
    schema = "item_id string, filed date, seq long, v int"
    day = dt.date(2024, 1, 1)
    later = day + dt.timedelta(days=900)

    def land(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / name))

    def run():
        src = loads.landed(spark, str(tmp_path / "in/*"), schema)
        loads.append_once(src, "item_id", "seq", str(tmp_path / "once"), str(tmp_path / "c1")).awaitTermination()
        loads.upsert_log(src, str(tmp_path / "log"), str(tmp_path / "c2")).awaitTermination()

    land("a", [("x", later, 1, 1), ("x", day, 2, 2), ("y", day, 3, 3), (None, day, 4, 4)])
    run()
    run()  # nothing new has landed: the mark holds
    land("b", [("x", day, 5, 5), ("z", later, 6, 6)])
    run()
    assert sorted((r.item_id, r.seq) for r in spark.read.parquet(str(tmp_path / "once")).collect()) == [("x", 1), ("y", 3), ("z", 6)]
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 6
    facts = loads.restated(log.where("item_id IS NOT NULL"), ["item_id"], "filed", "seq")
    assert sorted((r.item_id, r.v) for r in facts.collect()) == [("x", 5), ("y", 3), ("z", 6)]
    first = loads.restated(log.where("batch_id = 0 AND item_id IS NOT NULL"), ["item_id"], "filed", "seq")
    assert sorted((r.item_id, r.v) for r in first.collect()) == [("x", 1), ("y", 3)]


def test_daily_counts_of_a_stream(spark, tmp_path):
    at = [dt.datetime(2024, 1, d, 12) for d in (1, 1, 2, 9)]
    spark.createDataFrame([("k", t) for t in at], "k string, t timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = loads.windowed_counts(loads.landed(spark, str(tmp_path / "in"), "k string, t timestamp"), "t", "k").select(F.col("window.start").alias("start"), "k", "n")
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.start.day, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, 2), (2, 1)]


def test_loads_keep_keys_that_did_not_come(spark):
    names = "user_id long, day date, value int"
    d = dt.date(2024, 1, 1)
    stored = spark.createDataFrame([(1, d, 1), (2, d, 2), (None, d, 3)], names)
    incoming = spark.createDataFrame([(2, dt.date(2024, 1, 5), 9), (3, dt.date(2023, 1, 1), 9)], names)
    assert sorted((r.user_id is None, r.user_id or 0, r.value) for r in upsert.replace_by_key(stored, incoming, ["user_id"]).collect()) == [(False, 1, 1), (False, 2, 9), (False, 3, 9), (True, 0, 3)]
    assert [r.user_id for r in upsert.since_high_water(incoming, stored, "user_id", "day", "2023-06-01").collect()] == [2]

"""Loads, payloads, files and streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedupe, upsert
from tidemark.sources import files, parse
from tidemark.streaming import loads


def test_loading_twice_changes_nothing(spark):
    stored = spark.createDataFrame([("a", 1, 10), ("b", 1, 20)], "k string, d int, v int")
    new = spark.createDataFrame([("a", 1, 11), ("a", 2, 12)], "k string, d int, v int")
    once, counts = upsert.upsert(stored, new, ["k", "d"], "v")
    twice, again = upsert.upsert(once, new, ["k", "d"], "v")
    assert sorted(once.collect()) == sorted(twice.collect()) and counts.first()[:] == (2, 1) and again.first()[:] == (2, 0)
    assert upsert.replace_by_key(stored, new, ["k"]).count() == 3


def test_restatement(spark):
    s = "k string, filed date, v int"
    stored = spark.createDataFrame([("a", dt.date(2024, 5, 1), 1)], s)
    new = spark.createDataFrame([("a", dt.date(2024, 2, 1), 2), ("a", dt.date(2024, 3, 1), 3), ("a", None, 4)], s)
    assert [r.v for r in upsert.latest_filed_upsert(stored, new, ["k"], "filed", "v").collect()] == [3]
    assert [r.v for r in upsert.latest_filed_upsert(stored, new, ["k"], "filed", "v", compare_stored=True).collect()] == [1]


def test_larger_open_interest_wins(spark):
    x = spark.createDataFrame([("w", 5, 1), ("w", 9, 2), ("w", None, 3)], "week string, oi int, ord int")
    assert dedupe.largest_wins(x, ["week"], "oi", "ord").first().ord == 2


def test_observations_drop_missing_marks(spark):
    x = spark.createDataFrame([("A", '{"observations": [{"date": "2024-01-01", "value": "1.5"}, {"date": "2024-01-02", "value": "."}]}'), ("B", '{"observations": []}'), ("C", "nonsense")], "id string, body string")
    got = {(r.id, r.value, r.status) for r in parse.observations(x, "id", "body").collect()}
    assert got == {("A", 1.5, "ok"), ("B", None, "empty"), ("C", None, "error")}


def test_first_tag_present_counts(spark):
    body = '{"facts": {"us-gaap": {"SalesRevenueNet": {"units": {"USD": [{"end": "2023-12-31", "val": 5, "fy": 2023, "fp": "FY", "form": "10-K", "filed": "2024-02-01"}, {"end": "2023-12-31", "val": 6, "fy": 2023, "fp": "FY", "form": "8-K", "filed": "2024-02-02"}]}}, "RevenueFromContractWithCustomerExcludingAssessedTax": {"units": {"USD": [{"end": "2023-12-31", "val": 7, "fy": 2023, "fp": "FY", "form": "10-K", "filed": "2024-02-01"}]}}}}}'
    x = spark.createDataFrame([("T", body)], "ticker string, body string")
    concepts = spark.createDataFrame(parse.CONCEPTS, "metric string, prio int, taxonomy string, tag string, unit string")
    assert [(r.metric, r.value) for r in parse.company_facts(x, "ticker", "body", concepts).collect()] == [("revenue", 7.0)]


def test_smile_interpolation(spark):
    pts = [("put", 200.0, 0.36), ("put", 225.0, 0.29), ("put", 250.0, 0.21), ("call", 250.0, 0.21), ("call", 260.0, 0.19), ("call", 285.0, 0.15)]
    chain = spark.createDataFrame([("x", s, k, v, 250.0) for s, k, v in pts], "t string, side string, strike double, iv double, spot double")
    r = parse.skew_measures(chain, ["t"]).first()
    assert (r.put_iv, r.atm_iv, r.call_iv) == pytest.approx((0.29, 0.21, 0.166)) and (r.put_skew, r.risk_reversal) == pytest.approx((0.08, 0.124))
    few = parse.skew_measures(chain.where("strike > 240"), ["t"]).first()
    assert few.put_iv is None and few.put_skew is None


def test_feed_times_ids_and_text(spark):
    x = spark.createDataFrame([("Wed, 05 Jun 2024 10:30:00 GMT",), ("2024-06-05T10:30:00Z",), ("soon",)], "t string")
    assert [str(r[0]) if r[0] else None for r in x.select(parse.feed_time(F.col("t"))).collect()] == ["2024-06-05 10:30:00", "2024-06-05 10:30:00", None]
    assert x.select(parse.clean(F.lit(" a &amp; b "))).first()[0] == "a & b" and x.select(parse.clean(F.lit("  "))).first()[0] is None
    assert x.select(parse.whole_number(F.lit("12.9")), parse.whole_number(F.lit("x")), parse.yahoo_symbol(F.lit(" rds.a "))).first()[:] == (12, None, "RDS-A")


def test_constituents_under_other_headers(spark):
    x = spark.createDataFrame([("xyl", "Xylo Works", "4711"), (" ", "?", None), ("nan", "?", None)], "Symbol string, Security string, CIK string")
    out = parse.constituents(x, {"ticker": ["symbol", "ticker"], "name": ["security"], "sector": ["gics sector"], "cik": ["cik"]}).collect()
    assert [tuple(r) for r in out] == [("XYL", "Xylo Works", None, "0000004711")]


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a/b", 1), ("c", 2)], "k string, v int")
    assert files.save_raw(df, str(tmp_path / "raw"), "2024-01-01", "k") and files.save_raw(df, str(tmp_path / "raw"), "2024-01-01", "k")
    assert not files.save_raw(df.limit(0), str(tmp_path / "none"), "2024-01-01", "k")
    back = spark.read.parquet(str(tmp_path / "raw"))
    assert back.count() == 2 and {r.key for r in back.collect()} == {"a_b", "c"}
    assert files.dump({"t": df}, str(tmp_path)) == {"t": 2} and sorted(files.restore(spark, {"t": "k string, v int"}, str(tmp_path))["t"].collect()) == sorted(df.collect())
    assert files.table_or_empty(spark, "no_such_table", "a int").count() == 0


def test_feed_file(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>A &amp; B</title><link>http://e/1</link><pubDate>Wed, 05 Jun 2024 10:30:00 GMT</pubDate></item><item><title>C</title><link>http://e/2</link><guid>g2</guid></item></channel></rss>")
    out = {r.item_id: r.title for r in parse.feed_items(files.feed_file(spark, str(tmp_path / "f.xml"))).collect()}
    assert out["g2"] == "C" and len(out) == 2 and any(k.startswith("link:") for k in out)


def test_streams_are_idempotent(spark, tmp_path):
    schema = "item_id string, title string, seen timestamp"
    at = dt.datetime(2024, 1, 1, 12)
    batch = spark.createDataFrame([(f"i{k % 50}", f"t{k}", at) for k in range(200)], schema)
    batch.coalesce(1).write.parquet(str(tmp_path / "in/a"))
    batch.coalesce(1).write.parquet(str(tmp_path / "in/b"))
    src = loads.landed(spark, str(tmp_path / "in/*"), schema)
    loads.append_dedupe(src, "item_id", "seen", "1 day", str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50
    loads.upsert_log(src, str(tmp_path / "log"), str(tmp_path / "c2")).awaitTermination()
    assert loads.current(spark.read.parquet(str(tmp_path / "log")), ["item_id"], "title").count() == 50

"""Upserts that rewrite touched buckets only, quarantined rows, counts taken while writing."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import buckets
from tidemark.plans import marts, roundtrips
from tidemark.sources import files

NAMES = "k long, t string, ord long, v double"
SF = "/root/testdata/sf0.001"


def kept_files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{root}/data") for f in fs if f.startswith("part-")}


def test_files_of_other_buckets_stay(spark, tmp_path):
    root = str(tmp_path / "t")
    frame = lambda rows: spark.createDataFrame(rows, NAMES)
    first = [(k, "a", k, float(k)) for k in range(300)] + [(None, "a", 1, 1.0), (5, "a", 99, 50.0)]
    assert buckets.upsert_touched(root, frame(first), 0, ["k", "t"], "ord") == {"n_seen": 301, "n_new": 301, "n_buckets": len(buckets.versions(spark, root))}
    schema = frame([]).schema
    before = kept_files(root)
    second = [(7, "a", 1, -7.0), (7, "b", 2, 8.0), (None, "a", 5, -1.0), (7, "a", 0, 3.0)]
    counts = buckets.upsert_touched(root, frame(second), 1, ["k", "t"], "ord")
    assert (counts["n_seen"], counts["n_new"]) == (3, 1) and counts["n_buckets"] <= 3
    after = kept_files(root)
    assert all(after[f] == t for f, t in before.items())  # nothing that was there is touched
    assert len({f.split("bucket=")[1].split("/")[0] for f in after if f not in before}) == counts["n_buckets"]
    rows = {(r.k, r.t): r.v for r in buckets.current(spark, root, schema).collect()}
    assert len(rows) == 302 and rows[7, "a"] == -7.0 and rows[7, "b"] == 8.0 and rows[None, "a"] == -1.0 and rows[5, "a"] == 50.0 and rows[9, "a"] == 9.0
    # the same batch again under its version: the same counts, the same rows
    assert buckets.upsert_touched(root, frame(second), 1, ["k", "t"], "ord") == counts
    assert {(r.k, r.t): r.v for r in buckets.current(spark, root, schema).collect()} == rows
    # files of a version that never came to its commit don't count
    frame([(9, "a", 1, 1e9)]).withColumns({"bucket": F.lit(0), "version": F.lit(2)}).write.mode("append").partitionBy("bucket", "version").parquet(f"{root}/data")
    assert {(r.k, r.t): r.v for r in buckets.current(spark, root, schema).collect()} == rows
    assert buckets.upsert_touched(root, frame([]), 3, ["k", "t"], "ord") == {"n_seen": 0, "n_new": 0, "n_buckets": 0}
    assert buckets.current(spark, str(tmp_path / "none"), schema).count() == 0


def test_rows_that_do_not_fit_are_quarantined(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,d,x\na,2024-01-01,1.5\nb,nope,2\nc,2024-01-02\nd,2024-01-03,4,9\ne,2024-01-04,-1\nf,,\n,2024-01-05,3\n")
    good, bad = files.read_csv_checked(spark, str(tmp_path), "k string, d date, x double", {"no key": F.col("k").isNotNull(), "x is negative": F.coalesce(F.col("x"), F.lit(0)) >= 0})
    assert sorted((r.k, str(r.d), r.x) for r in good.collect()) == [("a", "2024-01-01", 1.5), ("f", "None", None)]
    got = {r.line: r.reason for r in bad.collect()}
    assert got == {"b,nope,2": "not a row of the schema", "c,2024-01-02": "not a row of the schema", "d,2024-01-03,4,9": "not a row of the schema", "e,2024-01-04,-1.0": "x is negative", ",2024-01-05,3.0": "no key"}
    assert bad.groupBy("reason").count().count() == 3 and all(r.path.endswith("a.csv") for r in bad.collect())


def test_bodies_of_one_key_have_files_of_their_own(spark, tmp_path):
    df = spark.createDataFrame([("a", "x"), ("a", "y\nz"), ("b", "q")], "k string, body string").coalesce(1)
    at = str(tmp_path / "raw")
    files.land_payloads(df, at, "2024-01-01", "k", "body")
    files.land_payloads(df.where("body <> 'x'"), at, "2024-01-01", "k", "body")
    assert sorted((r.key, r.body.rstrip("\n")) for r in files.raw_payloads(spark, at).collect()) == [("a", "y\nz"), ("b", "q")]


def test_counts_while_writing(spark, tmp_path):
    staged = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("z", 4)], "k string, v int")
    dim = spark.createDataFrame([("a",), ("b",)], "k string")
    known = lambda x: x.join(dim, "k", "left_semi")
    whole = marts.build_reconciled(staged, dim, "k", known, str(tmp_path / "g")).first()
    assert tuple(whole) == (4, 3, 1, False, True) and spark.read.parquet(str(tmp_path / "g")).count() == 3
    lost = marts.build_reconciled(staged, dim, "k", lambda x: known(x).where("v > 1"), str(tmp_path / "h")).first()
    assert tuple(lost) == (4, 2, 1, False, False)
    assert files.write_observed(staged, str(tmp_path / "i"), n=F.count(F.lit(1)), top=F.max("v")) == {"n": 4, "top": 4}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_feeds_with_marks_and_line_ends_come_back(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(1, 'a <b> & "c"\r\nd', "s"), (2, None, "s"), (3, " é ", "t")], "doc_id long, text string, source string")
    monkeypatch.setattr(roundtrips, "_table", lambda *a: docs)
    assert {r.item_id: r.title for r in roundtrips.feeds_read(spark, SF).collect()} == {"g1": 't a <b> & "c"\r\nd', "g2": "t", "g3": "t  é"}

"""Landed files follow the rows, not the keys times the rows."""

import glob

import pytest
from pyspark.sql import functions as F

from tidemark.plans import roundtrips


@pytest.fixture
def many_keys(spark, tmp_path):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.concat(F.lit("s"), (F.col("id") % 20).cast("string")).alias("source"), F.concat(F.lit("l"), (F.col("id") % 7).cast("string")).alias("lang"), F.lit(3).cast("long").alias("n_chars"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_bodies_follow_the_rows(spark, tmp_path, many_keys, monkeypatch):
    monkeypatch.setattr(roundtrips, "_folder", lambda _: str(tmp_path / "at"))
    assert roundtrips.landed_payloads(spark, many_keys).count() == 4000
    assert len(glob.glob(f"{tmp_path}/at/raw/*/*/*.txt")) <= 140  # one for each of the 140 keys; 985 when dealt by identifier
    assert sorted(r[0] for r in roundtrips.feeds_read(spark, many_keys).select("item_id").collect()) == sorted(f"g{i}" for i in range(4000))
    assert len(glob.glob(f"{tmp_path}/at/rss/*/*/*.txt")) + len(glob.glob(f"{tmp_path}/at/atom/*/*/*.txt")) <= 42

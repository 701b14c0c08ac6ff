"""Append-and-dedupe by keyed state: ids months apart, restarts, replays, rows loaded before."""

import datetime as dt
import os
import shutil

import pytest

from tidemark.streaming import loads

SCHEMA = "item_id string, seq long, day date"


def rows_of(spark, path):
    return sorted((r.item_id, r.seq) for r in spark.read.parquet(str(path)).collect())


@pytest.fixture
def land(spark, tmp_path):
    def put(name, rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / name))

    return put


@pytest.fixture
def run(spark, tmp_path):
    def once(stored=None):
        source = loads.landed(spark, str(tmp_path / "in/*"), SCHEMA, files_per_trigger=1)
        query = loads.append_keyed(source, "item_id", "seq", str(tmp_path / "out"), str(tmp_path / "state"), stored)
        query.awaitTermination()
        return query

    return once


def test_each_id_once_over_months_and_restarts(spark, tmp_path, land, run):
    day, later = dt.date(2024, 1, 1), dt.date(2025, 6, 1)
    before = spark.conf.get(loads.STORE, None)
    land("a", [("x", 2, day), ("x", 1, later), ("y", 3, day), (None, 4, day)] + [("hot", 100 + i, day) for i in range(3000)])
    run(spark.createDataFrame([("old", 1), (None, 2)], "item_id string, seq long"))
    assert rows_of(spark, tmp_path / "out") == [("hot", 100), ("x", 1), ("y", 3)]
    run()  # nothing new has landed
    land("b", [("x", 0, later), ("z", 6, later), ("old", 7, later)])
    land("c", [("z", 5, later), ("w", 8, day), ("hot", 1, later)])
    query = run()
    assert rows_of(spark, tmp_path / "out") == [("hot", 100), ("w", 8), ("x", 1), ("y", 3), ("z", 6)]
    # the last batch read the state of its own keys: rows updated are its new keys, not the table's
    assert query.lastProgress["stateOperators"][0]["numRowsUpdated"] <= 2
    assert spark.conf.get(loads.STORE, None) == before


def test_a_replayed_batch_writes_nothing_twice(spark, tmp_path, land, run):
    land("a", [("x", 1, None), ("y", 2, None)])
    run()
    land("b", [("x", 3, None), ("z", 4, None)])
    run()
    want = rows_of(spark, tmp_path / "out")
    # as if the driver had died after the batch was written and before it was committed
    commits = [f for f in os.listdir(tmp_path / "state" / "commits") if "1" in f]
    assert commits
    for f in commits:
        os.remove(tmp_path / "state" / "commits" / f)
    run()
    assert rows_of(spark, tmp_path / "out") == want == [("x", 1), ("y", 2), ("z", 4)]
    shutil.rmtree(tmp_path / "in")

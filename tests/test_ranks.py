"""Ranks, quantiles and dominance counts against plain Python, with ties, nulls and groups larger than a chunk."""

import math
import random
from bisect import bisect_right, insort

import numpy as np
import pytest

from tidemark.operators import ranks
from tidemark.plans import gold


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    out = [("big", i, float(r.choice([1, 1, 1, 1, r.randint(-50, 50), r.random()])) if r.random() > 0.1 else None) for i in range(1500)]
    out += [("few", i, x) for i, x in enumerate([3.0, None, 1.0, 2.0])] + [("one", 0, 7.0), ("none", 0, None), (None, 5, 2.0), (None, 6, 1.0)]
    r.shuffle(out)
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(k, 3 * i - 40, v) for k, i, v in rows], "k string, t int, v double").repartition(3)


def test_ranks_and_quantiles(table, rows):
    held = {}
    for k, _, v in rows:
        held.setdefault(k, []).extend([] if v is None else [v])
    got = {(r.k, r.v): (r.n, r.below, r.total) for r in ranks.value_ranks(table, ["k"], "v", buckets=8).collect()}
    assert got == {(k, x): (v.count(x), sum(y < x for y in v), len(v)) for k, v in held.items() for x in set(v)}
    shares = ranks.pct_ranks(table, ["k"], "v", "p").collect()
    assert len(shares) == len(rows)
    for r in shares:
        v = held[r.k]
        assert r.p is None if r.v is None else math.isclose(r.p, (sum(y < r.v for y in v) + (v.count(r.v) + 1) / 2) / len(v))
    for r in ranks.quantiles(table, ["k"], "v", {"a": 0.01, "b": 0.5, "c": 0.99}).collect():
        assert r.total == len(held[r.k]) and np.allclose([r.a, r.b, r.c], np.quantile(held[r.k], [0.01, 0.5, 0.99]))
    assert ranks.quantiles(table.limit(0), [], "v", {"a": 0.5}).count() == 0


@pytest.mark.parametrize("bits", [4, 6, 14])
def test_dominance_counts(table, rows, bits):
    got = {(r.k, (r.t + 40) // 3): (r.place, r.not_above) for r in ranks.dominance(table, "k", "t", "v", bits).collect()}
    want = {}
    for k in {k for k, *_ in rows}:
        seen = []
        for place, (i, v) in enumerate(sorted((i, v) for q, i, v in rows if q == k)):
            seen.append(v)
            want[k, i] = (place, None if v is None else sum(x is not None and x <= v for x in seen))
    assert got == want


def test_no_window_holds_a_group(table):
    plan = ranks.dominance(table, "k", "t", "v")._jdf.queryExecution().optimizedPlan().toString()
    alone = [x for x in plan.splitlines() if "Window" in x and "windowspecdefinition(k#" in x]
    assert alone and all("_b#" in x or "_level#" in x for x in alone)


def test_expanding_percentile_of_a_long_history(spark):
    """One key with more rows than a chunk, and short ones beside it, against a merge of sorted blocks in numpy."""
    n = 40_000
    x = np.random.default_rng(3).integers(0, 900, n).astype(float)
    x[::17] = np.nan
    frame = spark.createDataFrame([(i, None if np.isnan(v) else float(v)) for i, v in enumerate(x)], "t int, v double").selectExpr("IF(t < 39000, 'long', concat('k', t % 50)) AS k", "date_add(DATE '1970-01-01', t) AS day", "v")
    got = gold.expanding_percentile(frame, "k", "day", "v", "p").toPandas().sort_values("day")
    for _, part in got.groupby("k"):
        seen, values = [], part.v.to_numpy(dtype=float)
        want = []
        for place, v in enumerate(values):
            if not np.isnan(v):
                insort(seen, v)
            want.append(0.0 if np.isnan(v) else bisect_right(seen, v) / (place + 1))
        assert np.allclose(part.p.to_numpy(dtype=float), want)

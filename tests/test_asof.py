"""As-of joins by time slices against plain Python: hot keys, gaps over many slices, nulls, ties, no job while planning."""

import datetime as dt
import random

import pytest

from tidemark.operators import asof

FIRST = dt.date(1969, 6, 1)


@pytest.fixture(scope="module")
def sides():
    r = random.Random(8)
    day = lambda n: FIRST + dt.timedelta(days=n)
    right = [(k, day(n), float(r.randint(0, 9)), None if r.random() < 0.2 else "x") for k, step in (("hot", 3), ("far", 900), (None, 40)) for n in range(5, 3000, step)]
    right += [("hot", day(5), 99.0, "tie"), ("hot", None, 1.0, "never"), ("once", day(700), 5.0, "o")]
    left = [(i, r.choice(["hot"] * 6 + ["far", "once", "absent", None]), None if i % 97 == 0 else day(r.randint(-50, 4500))) for i in range(3000)]
    return left, right


def latest(right, key, day, keyed=True):
    known = [(d, v, s is not None, s or "") for k, d, v, s in right if d is not None and day is not None and d <= day and (k == key or not keyed)]
    if not known:
        return None, None
    _, v, there, s = max(known)
    return v, s if there else None


@pytest.mark.parametrize("days", [1, 16, 368])
def test_keyed_and_unkeyed(spark, sides, days):
    left, right = sides
    a, b = spark.createDataFrame(left, "i int, k string, at date").repartition(3), spark.createDataFrame(right, "k string, d date, v double, s string").repartition(2)
    got = {r.i: (r.v, r.s) for r in asof.asof(a, b, ["k"], "at", "d", ["v", "s"], days).collect()}
    assert got == {i: latest(right, k, d) for i, k, d in left}
    alone = [x for x in right if x[0] != "far"]
    free = asof.asof(a, b.where("k <> 'far' OR k IS NULL").drop("k"), [], "at", "d", ["v", "s"], days)
    assert free.columns == ["i", "k", "at", "v", "s"]
    assert {r.i: (r.v, r.s) for r in free.collect()} == {i: latest(alone, k, d, keyed=False) for i, k, d in left}


def test_nothing_runs_while_the_plan_is_built_and_no_side_is_ordered_whole(spark, sides):
    left, right = sides
    a, b = spark.createDataFrame(left, "i int, k string, at date"), spark.createDataFrame(right, "k string, d date, v double, s string")
    spark.sparkContext.setJobGroup("asof", "plans only")
    plans = [asof.asof_keyed(a, b, ["k"], "at", "d", ["v"]), asof.asof_calendar(a, b.drop("k"), "at", "d", ["v"])]
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("asof") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for plan in plans:
        windows = [x for x in plan._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in x]
        assert windows and all("_slice" in x and "at#" not in x.split("windowspecdefinition")[-1] for x in windows)
    assert asof.asof_calendar(a, b.drop("k").limit(0), "at", "d", ["v"]).where("v IS NULL").count() == len(left)

"""Updates of the series analytics against a rebuild: revisions, late rows, old gaps, replays, and what they touch."""

import datetime as dt
import os

import numpy as np

from tidemark.plans import gold, incremental

NAMES = "series_id string, obs_date date, value double"


def day(n):
    return dt.date(2015, 1, 1) + dt.timedelta(days=n)


def files_of(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs if f.startswith("part-")}


def same(spark, root, rows, dim):
    obs = spark.createDataFrame([(k, d, v) for (k, d), v in rows.items()], NAMES)
    keys = ["series_id", "obs_date"]
    want, got = (f.toPandas().sort_values(keys).reset_index(drop=True) for f in (gold.series_analytics(obs, dim), incremental.analytics(spark, root)))
    assert len(got) == len(want) and (got[keys] == want[keys]).all().all()
    for c in incremental.DOUBLES:
        assert (got[c].isna() == want[c].isna()).all() and np.allclose(got[c].dropna(), want[c].dropna(), rtol=1e-8, atol=1e-9), c


def test_updates_equal_a_rebuild(spark, tmp_path):
    root, r = str(tmp_path), np.random.default_rng(5)
    dim = spark.createDataFrame([("daily", "D", "yoy"), ("monthly", "M", "mom"), ("gap", "D", "level"), ("far", "D", "yoy")], "series_id string, freq string, transform string")
    rows = {("daily", day(n)): None if n % 11 == 0 else float(r.normal() + n / 100) for n in range(1500)}
    rows |= {("monthly", day(31 * n)): float(r.normal()) for n in range(50)} | {("gap", day(n)): float(r.normal()) for n in [*range(40), *range(1400, 1460)]}
    rows |= {("far", day(n)): float(r.normal()) for n in (0, 1, 1490)} | {("unknown", day(0)): 1.0}
    frame = lambda x: spark.createDataFrame([(k, d, v) for (k, d), v in x.items()], NAMES)
    first = {k: v for k, v in rows.items() if k[1] < day(1300)}
    out = incremental.update_series(frame(first), dim, root, 0)
    assert out["n_series"] == 5 and out["n_rows"] == len(first) - 1
    same(spark, root, first, dim)
    # one late revision: the rows of its series from its slice on, and no file of another bucket
    before = files_of(root)
    change = {("daily", day(1200)): 99.0}
    first |= change
    out = incremental.update_series(frame(change), dim, root, 1)
    assert (out["n_series"], out["n_buckets"]) == (1, 1) and out["n_rows"] < 100 + incremental.SLICE_DAYS
    same(spark, root, first, dim)
    after = files_of(root)
    assert all(after[f] == t for f, t in before.items()) and {f.split("bucket=")[1].split("/")[0] for f in after if f not in before and "bucket=" in f and "/data/" in f} == {str(b) for b in incremental.buckets_of(frame(change), ["series_id"])}
    # the same update again
    assert incremental.update_series(frame(change), dim, root, 1) == out
    same(spark, root, first, dim)
    # late rows, new series dates after a gap of years, a value before all others, a value that becomes null
    more = {k: v for k, v in rows.items() if k not in first} | {("monthly", day(-40)): 3.0, ("daily", day(700)): None, ("gap", day(20)): 7.0}
    incremental.update_series(frame(more), dim, root, 2)
    same(spark, root, first | more, dim)
    assert incremental.update_series(frame({}), dim, root, 3) == {"n_series": 0, "n_buckets": 0, "n_rows": 0}

"""Two-level scans against one window over the whole history."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.stats import by, expanding, zscore_over
from tidemark.operators import scan
from tidemark.plans import gold


@pytest.fixture(scope="module")
def series(spark):
    r = np.random.default_rng(6)
    rows = [("long", i, None if i % 13 == 0 else float(1e6 + i * 3 + r.normal())) for i in range(2000)]
    rows += [("flat", i, 0.1) for i in range(300)] + [("gap", i, None if i < 150 else float(r.normal())) for i in range(200)] + [("one", 0, 5.0), ("none", 0, None)]
    rows += [("few", i, float(x)) for i, x in enumerate([2, 2, 4])]
    day = lambda i: dt.date(1990, 1, 1) + dt.timedelta(days=i + i // 7)
    return spark.createDataFrame([(k, day(i), v) for k, i, v in rows], "series_id string, obs_date date, value double").repartition(3)


@pytest.mark.parametrize("block", [30, 128, scan.BLOCK_ROWS])
def test_expanding_z_by_blocks(series, block):
    x = scan.in_blocks(series, "series_id", "obs_date", 0, block)
    got = scan.with_moments(x, "series_id", ["value"]).withColumn("z", scan.expanding_z("value", scan.block_window("series_id", "obs_date")))
    want = series.withColumn("z", zscore_over("value", expanding(by("series_id", "obs_date")))).toPandas().set_index(["series_id", "obs_date"]).z
    found = got.select("series_id", "obs_date", "z").toPandas().set_index(["series_id", "obs_date"]).z
    want, found = want.drop("flat", level=0), found.reindex(want.index)
    assert found.loc["flat"].isna().all()
    found = found.drop("flat", level=0)
    assert (found.isna() == want.isna()).all() and np.allclose(found.dropna(), want.dropna(), rtol=1e-9)


def test_halos_hold_the_last_rows_before_a_block(series):
    x = scan.in_blocks(series, "series_id", "obs_date", 22, 40).where("series_id = 'long'")
    sizes = x.groupBy("_block").agg(F.count_if("_own").alias("own"), F.count_if(~F.col("_own")).alias("halo"), F.max(F.when(~F.col("_own"), F.col("obs_date"))).alias("a"), F.min(F.when(F.col("_own"), F.col("obs_date"))).alias("b")).collect()
    assert all((r.own, r.halo) in {(40, 22), (40, 0), (0, 22)} for r in sizes) and all(r.a < r.b for r in sizes if r.a and r.b)
    with pytest.raises(ValueError, match="halo"):
        scan.in_blocks(series, "series_id", "obs_date", 50, 40)


@pytest.mark.parametrize("block", [22, 500])
def test_series_analytics_by_blocks(spark, series, block):
    dim = spark.createDataFrame([("long", "D", "yoy"), ("flat", "D", "level"), ("gap", "D", "mom"), ("few", "D", "level"), ("one", "D", "yoy"), ("none", "D", "level")], "series_id string, freq string, transform string")
    keys = ["series_id", "obs_date"]
    want, got = (f.toPandas().sort_values(keys).reset_index(drop=True) for f in (gold.series_analytics(series, dim), gold.series_analytics_blocks(series, dim, block)))
    assert list(got.columns) == list(want.columns) and len(got) == len(want) == series.count()
    for c in want.columns[2:12]:
        a, b = got[c], want[c]
        if c in ("zscore", "primary_zscore"):  # the one window leaves noise where all values are the same
            a, b = a[got.series_id != "flat"], b[want.series_id != "flat"]
        assert (a.isna() == b.isna()).all() and np.allclose(a.dropna(), b.dropna(), rtol=1e-8, atol=1e-9), c
    plan = gold.series_analytics_blocks(series, dim, block)._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert windows and all("_block" in x for x in windows)

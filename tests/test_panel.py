"""The metrics panel in one pass against one plan for each date."""

import datetime as dt
import random

from tidemark.plans import security


def test_panel_equals_one_plan_for_each_date(spark):
    r = random.Random(3)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    prices = [(f"T{k}", day(n), None if r.random() < 0.1 else round(50 + 30 * r.random(), 6)) for k in range(4) for n in range(k * 100, 700) if r.random() < 0.8]
    facts = []
    for k in range(5):  # T4 has facts and no price
        for m in security.FLOWS + security.STOCKS:
            for year in range(2016, 2022):
                for again in range(r.randint(0, 2)):
                    filed = dt.date(year + 1, r.randint(1, 12), r.randint(1, 28)) if r.random() > 0.05 else None
                    facts.append((f"T{k}", m, dt.date(year, 12, 31), r.choice(["FY", "FY", "Q4"]), filed, round(1e8 * r.random() * (again + 1), 3)))
    kept = {}
    for f in facts:  # one filing for a period and day
        kept[f[0], f[1], f[2], f[4]] = f
    p = spark.createDataFrame(prices, "ticker string, date date, close double")
    f = spark.createDataFrame(list(kept.values()), "ticker string, metric string, period_end date, fiscal_period string, filed_date date, value double")
    dim = spark.createDataFrame([("T0", "a"), ("T1", None), ("T2", "b")], "ticker string, sector string")
    dates = ["2019-06-30", "2020-02-29", "2020-11-15", "2021-06-30", "2021-11-30", "2030-01-01"]
    got = sorted(security.metrics_panel(p, f, dim, dates).collect(), key=lambda x: (x.asof_date, x.ticker))
    want = sorted((x for d in dates for x in security.security_metrics(p, f, dim, d).collect()), key=lambda x: (x.asof_date, x.ticker))
    assert len(got) == len(want) > 15
    for a, b in zip(got, want, strict=True):
        for c in b.asDict():
            assert (a[c] is None) == (b[c] is None) and (a[c] == b[c] or abs(a[c] - b[c]) < 1e-9), (c, a, b)
    plan = security.metrics_panel(p, f, dim, [f"2020-{m:02d}-01" for m in range(1, 13)] * 20)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 4 * len(security.metrics_panel(p, f, dim, dates)._jdf.queryExecution().optimizedPlan().toString())

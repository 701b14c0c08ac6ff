"""Series analytics kept up to date: a late revision recomputes the rows after it, not the table.

Three bucketed tables lie under one folder, their buckets told by series: the observations, the analytics, and the state
of each series at the end of each slice of time: how many values it had, their mean and sum of squares, and its last
rows. A batch of new or revised observations touches the buckets of its series. Of these series, rows from the slice of
the earliest change on are computed again, from the state before that slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.stats import by, change, growth, safe_div, trailing
from tidemark.operators.asof import asof, slice_of
from tidemark.operators.buckets import BUCKETS, buckets_of, current, upsert_touched
from tidemark.operators.hold import cut
from tidemark.operators.ranks import matched
from tidemark.operators.scan import running_moments, z_of

#: Days of a slice, and rows before one that its windows reach back to: a change, and 21 of them.
SLICE_DAYS, TAIL = 368, 22
KEY, VALUES = ["series_id"], ("value", "primary_value")
OBS = "series_id string, obs_date date, value double"
MOMENTS = [f"{c}_{v}" for v in VALUES for c in "nmq"]
STATE = f"series_id string, slice int, {', '.join(f'{m} {"long" if m[0] == "n" else "double"}' for m in MOMENTS)}, tail array<struct<obs_date date, value double>>"
DOUBLES = ["value", "prev_value", "chg", "chg_pct", "value_1y_ago", "chg_yoy", "zscore", "primary_value", "primary_zscore", "roll_vol_21"]
GOLD = f"series_id string, obs_date date, {', '.join(f'{c} double' for c in DOUBLES)}, freq string, intended_transform string"


def analytics(spark: SparkSession, root: str) -> DataFrame:
    """The series analytics as of the last update."""
    return current(spark, f"{root}/gold", GOLD)


def _state_before(state: DataFrame, since: DataFrame, back: int) -> DataFrame:
    """(series_id): the last state of each series before its slice of the earliest change, less so many slices."""
    x = matched(state, since, KEY, ["since"], "inner").where(F.col("slice") < F.col("since") - back)
    return x.groupBy(*KEY).agg(F.max_by(F.struct("slice", *MOMENTS, "tail"), "slice").alias("s")).select(*KEY, "s.*")


def update_series(changes: DataFrame, dim: DataFrame, root: str, version: int, buckets: int = BUCKETS) -> dict[str, int]:
    """Takes changes (series_id, obs_date, value), one row a series and date, into the tables under root.

    Returns n_series, n_buckets (of the changed series; no other file is read or written) and n_rows computed again.
    Repeating an update under its version gives the same tables. dim's transforms and the
    number of buckets must be those of earlier updates.
    """
    spark = changes.sparkSession
    changes = cut(changes.select("series_id", F.col("obs_date").cast("date").alias("obs_date"), F.col("value").cast("double").alias("value")))
    touched = buckets_of(changes, KEY, buckets)
    if not touched:
        return {"n_series": 0, "n_buckets": 0, "n_rows": 0}
    upsert_touched(f"{root}/obs", changes, version, ["series_id", "obs_date"], "value", buckets, KEY)
    since = cut(changes.groupBy(*KEY).agg(F.min(slice_of("obs_date", SLICE_DAYS)).alias("since")))
    n_series = since.count()
    state = current(spark, f"{root}/state", STATE, touched)
    rows = matched(current(spark, f"{root}/obs", OBS, touched), since, KEY, ["since"], "inner").withColumn("slice", slice_of("obs_date", SLICE_DAYS))
    # the year-old values lie in the slice before or the one before that; for those still older the state has the last row
    aged = rows.where(F.col("slice") >= F.col("since") - 2).select("series_id", F.col("obs_date").alias("_then"), F.col("value").alias("value_1y_ago"))
    oldest = F.element_at("tail", -1)
    aged = aged.unionByName(_state_before(state, since, 2).select("series_id", oldest["obs_date"].alias("_then"), oldest["value"].alias("value_1y_ago")))
    known = F.broadcast(dim.select("series_id", "freq", F.col("transform").alias("intended_transform")))
    later = rows.where(F.col("slice") >= F.col("since")).join(known, "series_id").withColumn("_back", F.add_months("obs_date", -12))
    x = asof(later, aged, KEY, "_back", "_then", ["value_1y_ago"], SLICE_DAYS).drop("_back").withColumn("_own", F.lit(True))
    before = cut(_state_before(state, since, 0))
    tails = before.select("series_id", F.explode("tail").alias("t")).select("series_id", "t.obs_date", "t.value", F.lit(False).alias("_own"))
    w = by("series_id", "obs_date")
    x = x.unionByName(tails, allowMissingColumns=True)
    x = x.withColumns({"prev_value": F.lag("value").over(w), "chg": change("value", w), "chg_pct": growth("value", w), "tail": F.collect_list(F.struct("obs_date", "value")).over(trailing(w, TAIL))})
    x = x.withColumns({"roll_vol_21": F.stddev_samp("chg_pct").over(trailing(w, 21)), "chg_yoy": safe_div("value", "value_1y_ago") - 1}).where("_own")
    x = x.withColumn("primary_value", F.when(F.col("intended_transform") == "yoy", F.col("chg_yoy")).when(F.col("intended_transform") == "mom", F.col("chg")).otherwise(F.col("value")))
    x = matched(x, before, KEY, MOMENTS).withColumnsRenamed({m: f"_{m}" for m in MOMENTS})
    x = x.withColumns({f"_n_{v}": F.coalesce(f"_n_{v}", F.lit(0)) for v in VALUES})
    moments = {v: running_moments(v, w) for v in VALUES}
    x = x.withColumns({f"{c}_{v}": e for v in VALUES for c, e in zip("nmq", moments[v], strict=True)})
    x = cut(x.withColumns({"zscore": z_of(F.col("value"), *[F.col(f"{c}_value") for c in "nmq"]), "primary_zscore": z_of(F.col("primary_value"), *[F.col(f"{c}_primary_value") for c in "nmq"])}))
    ends = Window.partitionBy("series_id", "slice").orderBy(F.col("obs_date").desc())
    final = x.withColumn("_r", F.row_number().over(ends)).where("_r = 1").select("series_id", "slice", *MOMENTS, "tail")
    upsert_touched(f"{root}/gold", x.select("series_id", "obs_date", *DOUBLES, "freq", "intended_transform"), version, ["series_id", "obs_date"], "value", buckets, KEY)
    upsert_touched(f"{root}/state", final, version, ["series_id", "slice"], "slice", buckets, KEY)
    return {"n_series": n_series, "n_buckets": len(touched), "n_rows": x.count()}

"""As-of joins: each left row with the latest right row that was known on its date.

Row semantics throughout: the latest row counts, also where its values are null. Right rows without a date never match.

Time is cut into slices. The right rows of a key and slice become one row, an array in order of date that begins with
the row carried in from before; a left row meets the array of its own slice and takes the last entry on or before its
date. So neither side is ordered as a whole: left rows are joined by key and slice, each for itself, and those of a hot
key spread over the slices (and, as left rows, over the parts of a skewed join). A right side without a key is a calendar,
whose size no data can grow, and is broadcast, so that the left side stays where it is. Nothing runs while the plan is
built.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days of a slice: of a join by key, whose right side has a few rows a year, and of one without, with a row a day.
KEYED_DAYS, CALENDAR_DAYS = 368, 16


def value_before(value: str, key: str, date: str, interval: str = "INTERVAL 1 YEAR"):
    """The latest row's value at least interval before each row, of the same key: a frame, not a join."""
    return F.expr(f"last_value(`{value}`) OVER (PARTITION BY `{key}` ORDER BY `{date}` RANGE BETWEEN UNBOUNDED PRECEDING AND {interval} PRECEDING)")


def slice_of(date: Column | str, days: int) -> Column:
    """The number of the slice that a date lies in."""
    return F.floor(F.unix_date(F.col(date) if isinstance(date, str) else date) / days).cast("int")


def sliced(right: DataFrame, keys: Sequence[str], right_date: str, take: Sequence[str], days: int) -> DataFrame:
    """(keys, _slice): _rows, the right rows of the slice by date (day, got), after the last row before the slice.

    Slices without rows of their own are filled in up to the last one of all of right. Of rows with equal keys and date,
    the one with the largest taken values counts.
    """
    keys = list(keys)
    dated = right.where(F.col(right_date).isNotNull())
    once = dated.groupBy(*keys, F.col(right_date).cast("date").alias("day")).agg(F.max(F.struct(*take)).alias("got"))
    own = once.groupBy(*keys, slice_of("day", days).alias("_slice")).agg(F.sort_array(F.collect_list(F.struct("day", "got"))).alias("_own"))
    last = dated.agg(F.max(slice_of(F.col(right_date).cast("date"), days))).scalar()  # inside the plan
    order = Window.partitionBy(*keys).orderBy("_slice")  # a row for each slice
    spans = own.withColumn("_last", F.element_at("_own", -1))
    spans = spans.withColumns({"_carried": F.lag("_last").over(order), "_until": F.coalesce(F.lead("_slice").over(order) - 1, last)})
    filled = spans.select(*keys, "_slice", "_own", "_last", "_carried", F.explode(F.sequence("_slice", "_until")).alias("_at"))
    begun = F.when(F.col("_carried").isNull(), F.col("_own")).otherwise(F.concat(F.array("_carried"), F.col("_own")))
    return filled.select(*keys, F.col("_at").alias("_slice"), F.when(F.col("_at") == F.col("_slice"), begun).otherwise(F.array("_last")).alias("_rows"))


def asof(left: DataFrame, right: DataFrame, keys: Sequence[str], left_date: str, right_date: str, take: Sequence[str], days: int) -> DataFrame:
    """left with the columns take of the latest right row of the same keys (null equals null) whose right_date is not
    after left_date. Left rows after the last right row meet its slice."""
    keys, names = list(keys), list(left.columns)
    r = sliced(right, keys, right_date, take, days)
    if not keys:
        return _on_days(left, r, left_date, right, right_date, take, days)
    r = r.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_slice").alias("_r_slice"), "_rows")
    last = right.where(F.col(right_date).isNotNull()).agg(F.max(slice_of(F.col(right_date).cast("date"), days))).scalar()
    day = F.col(left_date).cast("date")
    x = left.withColumn("_slice", F.when(day.isNotNull(), F.least(slice_of(day, days), last)))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.col("_slice") == F.col("_r_slice"))
    known = F.filter("_rows", lambda x: x["day"] <= day)
    found = x.join(r, on, "left").withColumn("_got", F.when(F.size(known) > 0, F.element_at(known, -1)["got"]))
    return found.select(*names, *[F.col(f"_got.{c}").alias(c) for c in take])


def _on_days(left: DataFrame, r: DataFrame, left_date: str, right: DataFrame, right_date: str, take: Sequence[str], days: int) -> DataFrame:
    """The as-of join without a key: the slices r are filled in by day and broadcast, so that a left row looks up one.

    A row a day is some forty thousand in a century and 3.7 million in all that a date can be.
    """
    begin, day = F.col("_slice") * days, F.date_from_unix_date(F.col("_day"))
    each = r.select("_rows", F.explode(F.sequence(begin, begin + (days - 1))).alias("_day"))
    known = F.filter("_rows", lambda x: x["day"] <= day)
    each = each.select("_day", F.when(F.size(known) > 0, F.element_at(known, -1)["got"]).alias("_got"))
    last = right.where(F.col(right_date).isNotNull()).agg(F.max(F.unix_date(F.col(right_date).cast("date")))).scalar()
    at = F.col(left_date).cast("date")
    x = left.withColumn("_at", F.when(at.isNotNull(), F.least(F.unix_date(at), last)))
    found = x.join(F.broadcast(each), F.col("_at") == F.col("_day"), "left")
    return found.select(*left.columns, *[F.col(f"_got.{c}").alias(c) for c in take])


def asof_keyed(left: DataFrame, right: DataFrame, keys: Sequence[str], left_date: str, right_date: str, take: Sequence[str]) -> DataFrame:
    """The as-of join by keys, whose right side has a few rows a year for each."""
    return asof(left, right, keys, left_date, right_date, take, KEYED_DAYS)


def asof_calendar(left: DataFrame, right: DataFrame, left_date: str, right_date: str, take: Sequence[str]) -> DataFrame:
    """The as-of join without a key: right holds one row for a date, such as the rates of a day."""
    return asof(left, right, [], left_date, right_date, take, CALENDAR_DAYS)

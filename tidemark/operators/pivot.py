"""Pivots with closed column lists, and forward fill in long form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pivot_max(df: DataFrame, index: Sequence[str], key: str, value: str, names: Mapping[str, str]) -> DataFrame:
    """One row for each index with the largest value of each key in names, under its new name.

    The key filter is written before the grouping so that it reaches the scan; the closed list makes it a single pass.
    """
    few = df.where(F.col(key).isin(*names))
    return few.groupBy(*index).agg(*[F.max(F.when(F.col(key) == k, F.col(value))).alias(n) for k, n in names.items()])


def pivot_last(df: DataFrame, index: Sequence[str], key: str, value: str, order: str, names: Mapping[str, str]) -> DataFrame:
    """As pivot_max, with the last non-null value by order; indexes whose values are all null vanish."""
    few = df.where(F.col(key).isin(*names) & F.col(value).isNotNull())
    return few.groupBy(*index).agg(*[F.max_by(F.when(F.col(key) == k, F.col(value)), F.when(F.col(key) == k, F.col(order))).alias(n) for k, n in names.items()])


def forward_fill(df: DataFrame, spine: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """(key, date, value) for each key on every date of the spine from its first value on, carried forward.

    Filled in long form: a key's intervals between values are spread over the spine, so keys run in parallel.
    """
    days = spine.select(F.col(date).alias("_day")).distinct()  # a calendar: one row a day
    last = days.agg(F.max("_day")).scalar()  # inside the plan
    known = df.where(F.col(value).isNotNull()).select(key, F.col(date).alias("_from"), value)
    nxt = F.lead("_from").over(Window.partitionBy(key).orderBy("_from"))
    until = F.least(F.coalesce(F.date_sub(nxt, 1), last), last)
    spans = known.withColumn("_until", until).where("_from <= _until")
    held = spans.select(key, value, F.explode(F.sequence("_from", "_until")).alias(date))
    return held.join(days, F.col(date) == F.col("_day"), "left_semi").select(key, date, value)

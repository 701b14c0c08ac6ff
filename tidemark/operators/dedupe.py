"""Latest rows, top rows and in-batch dedupe by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    return top_n(df, keys, 1, *order)


def top_n(df: DataFrame, keys: Sequence[str], n: int, *order: Column) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


def latest(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    return first_by(df, keys, F.col(date).desc_nulls_last())


def first_wins(df: DataFrame, keys: Sequence[str], ord_col: str) -> DataFrame:
    return first_by(df, keys, F.col(ord_col).asc_nulls_last())


def last_wins(df: DataFrame, keys: Sequence[str], ord_col: str) -> DataFrame:
    return first_by(df, keys, F.col(ord_col).desc_nulls_last())


def largest_wins(df: DataFrame, keys: Sequence[str], size: str, ord_col: str) -> DataFrame:
    """The row of largest size, of ties the first; rows without a size come last."""
    return first_by(df, keys, F.col(size).desc_nulls_last(), F.col(ord_col).asc_nulls_last())


def latest_filed_wins(df: DataFrame, keys: Sequence[str], filed: str, ord_col: str) -> DataFrame:
    """The row filed last, of ties the later one."""
    return first_by(df, keys, F.col(filed).desc_nulls_last(), F.col(ord_col).desc_nulls_last())

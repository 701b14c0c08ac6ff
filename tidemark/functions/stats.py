"""Column helpers. All of them are built-in expressions: no Python runs per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a: Column | str, b: Column | str) -> Column:
    """a / b, null where b is zero or either is null."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def no_nan(c: Column | str) -> Column:
    """NaN becomes null, so that it neither sorts above all numbers nor spreads through averages."""
    return F.when(~F.isnan(col(c)), col(c))


def row_mean(*columns: Column | str) -> Column:
    """Mean of those columns that are not null; null if all are."""
    cs = [col(c) for c in columns]
    total = reduce(add, [F.coalesce(c, F.lit(0.0)) for c in cs])
    count = reduce(add, [c.isNotNull().cast("int") for c in cs])
    return F.try_divide(total, count)


def weighted_mean(weights: Mapping[str, float]) -> Column:
    """Weighted mean of the named columns that are not null; null if their weights sum to zero."""
    total = reduce(add, [F.coalesce(F.col(c), F.lit(0.0)) * w for c, w in weights.items()])
    used = reduce(add, [F.when(F.col(c).isNotNull(), w).otherwise(0.0) for c, w in weights.items()])
    return F.try_divide(total, used)


def sane(c: Column | str, low: float, high: float) -> Column:
    """The value where it lies within the bounds, else null."""
    return F.when(col(c).between(low, high), col(c))


def band(c: Column | str, threshold: float, above: str, below: str, middle: str = "Neutral") -> Column:
    """above beyond +threshold, below beyond -threshold, middle between (bounds included); null stays null."""
    x = col(c)
    return F.when(x > threshold, above).when(x < -threshold, below).when(x.isNotNull(), middle)


def by(key: str | Sequence[str], order: str) -> WindowSpec:
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(order)


def expanding(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def trailing(w: WindowSpec, rows: int) -> WindowSpec:
    """The current row and the rows - 1 before it."""
    return w.rowsBetween(-(rows - 1), Window.currentRow)


def zscore_over(c: Column | str, w: WindowSpec) -> Column:
    """z of the current value against the frame (sample deviation); null where the deviation is null or zero."""
    x, sd = col(c), F.stddev_samp(col(c)).over(w)
    return F.when(sd != 0, (x - F.avg(x).over(w)) / sd)


def change(c: Column | str, w: WindowSpec, rows: int = 1) -> Column:
    return col(c) - F.lag(c, rows).over(w)


def growth(c: Column | str, w: WindowSpec, rows: int = 1) -> Column:
    """value / value rows before - 1; null where that is zero or missing."""
    return safe_div(c, F.lag(c, rows).over(w)) - 1

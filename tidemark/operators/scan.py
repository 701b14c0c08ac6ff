"""Running statistics of long histories by a two-level scan.

A key's rows are numbered and cut into blocks of equal size. Inside a block windows run as usual; frames that reach back
find the last rows of the block before, which are there as a halo; and what an expanding frame needs of all earlier
blocks is carried in as their moments. So one long history spreads over as many tasks as it has blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.operators.ranks import matched, value_ranks

#: Rows of a block.
BLOCK_ROWS = 65_536
#: A deviation below this share of the mean counts as none: it is what adding up leaves.
NOISE = 1e-13


#: Rows (or parts) that one part of a trailing frame is put together from.
PART = 8


def _parts(df: DataFrame, w: WindowSpec, value: Column, rows: int, join: Callable[[list[Column]], Column], none: float | None, name: str) -> tuple[DataFrame, list[tuple[int, str]]]:
    """df with trailing parts of 1, 8, 64, ... rows (to rows at most), each joined from eight of the one before; their
    lengths and columns."""
    x, size, parts = df.withColumn(f"{name}1", value), 1, [(1, f"{name}1")]
    while size * PART <= rows:
        below, size = parts[-1], size * PART
        x = x.withColumn(f"{name}{size}", join([F.lag(below[1], k * below[0], none).over(w) if k else F.col(below[1]) for k in range(PART)]))
        parts.append((size, f"{name}{size}"))
    return x, parts


def trailing_means(df: DataFrame, w: WindowSpec, value: str, names: Mapping[str, int]) -> DataFrame:
    """df with the mean of value over each number of trailing rows (the current one included), null where none has one.

    A frame is added up from parts of 8 and 64 rows that the rows before have as well, so a row's cost grows with the
    logarithm of the frame; nothing is subtracted, so that no digits are lost.
    """
    x, parts = _parts(df.withColumn("_n", F.count(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))), w, F.coalesce(F.col(value).cast("double"), F.lit(0.0)), max(names.values()), lambda cs: reduce(add, cs), 0.0, "_s")
    out = {}
    for name, rows in names.items():
        cells, at = [], 0
        for size, c in reversed(parts):
            while rows - at >= size:
                cells.append(F.lag(c, at, 0.0).over(w) if at else F.col(c))
                at += size
        out[name] = F.try_divide(reduce(add, cells), F.col("_n") - F.lag("_n", rows, 0).over(w))
    return x.withColumns(out).drop("_n", *[c for _, c in parts])


def trailing_max(df: DataFrame, w: WindowSpec, value: str, name: str, rows: int) -> DataFrame:
    """df with the largest value of so many trailing rows, from the largest of parts; the last part may overlap."""
    x, parts = _parts(df, w, F.col(value), rows, lambda cs: F.greatest(*cs), None, "_g")
    size, c = parts[-1]
    cells = [F.lag(c, at).over(w) if at else F.col(c) for at in sorted({*range(0, rows - size, size), rows - size})]
    return x.withColumn(name, F.greatest(*cells) if len(cells) > 1 else cells[0]).drop(*[c for _, c in parts])


def in_blocks(df: DataFrame, key: str, order: str, halo: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows of df with _block and _own; the last halo rows of a block come once more in the next one, not its own.

    order is unique in its key, and halo at most block_rows.
    """
    if not 0 <= halo <= block_rows:
        raise ValueError("a halo must fit a block")
    places = value_ranks(df.select(key, order), [key], order)
    x = matched(df, places, [key, order], ["below"], "inner")
    home = F.floor(F.col("below") / block_rows)
    late = F.col("below") % block_rows >= block_rows - halo
    x = x.withColumns({"_home": home, "_block": F.explode(F.when(late, F.array(home, home + 1)).otherwise(F.array(home)))})
    return x.withColumn("_own", F.col("_block") == F.col("_home")).drop("_home", "below")


def block_window(key: str, order: str) -> WindowSpec:
    return Window.partitionBy(key, "_block").orderBy(order)


def with_moments(own: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """own (rows of blocks, without halos) with _n_, _m_ and _q_ of each value: how many values all earlier blocks of the
    key hold, their mean and the sum of squares around it. own is read twice."""
    parts = own.groupBy(key, "_block").agg(*[e for v in values for e in (F.count(v).alias(f"_c_{v}"), F.avg(v).alias(f"_a_{v}"), (F.var_pop(v) * F.count(v)).alias(f"_s_{v}"))])
    every = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # a row for each block
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = [key, "_block"]
    for v in values:
        # sums around the first block's mean, so that little is lost where the mean is large
        base = F.first(f"_a_{v}", ignorenulls=True).over(every)
        parts = parts.withColumn(f"_b_{v}", base).withColumn(f"_d_{v}", F.col(f"_a_{v}") - F.col(f"_b_{v}"))
        n = F.coalesce(F.sum(f"_c_{v}").over(before), F.lit(0))
        first, second = (F.coalesce(F.sum(e).over(before), F.lit(0.0)) for e in (F.col(f"_c_{v}") * F.col(f"_d_{v}"), F.col(f"_s_{v}") + F.col(f"_c_{v}") * F.col(f"_d_{v}") * F.col(f"_d_{v}")))
        parts = parts.withColumns({f"_n_{v}": n, f"_1_{v}": first, f"_2_{v}": second})
        carried += [F.col(f"_n_{v}"), F.when(F.col(f"_n_{v}") > 0, F.col(f"_b_{v}") + F.col(f"_1_{v}") / F.col(f"_n_{v}")).alias(f"_m_{v}"), F.when(F.col(f"_n_{v}") > 0, F.col(f"_2_{v}") - F.col(f"_1_{v}") * F.col(f"_1_{v}") / F.col(f"_n_{v}")).alias(f"_q_{v}")]
    return matched(own, parts.select(*carried), [key, "_block"], [f"_{c}_{v}" for v in values for c in "nmq"], "inner")


def running_moments(value: str, w: WindowSpec) -> tuple[Column, Column, Column]:
    """Count, mean and sum of squares around it of a value's history up to each row: the rows of the window w, and those
    before as carried in by _n_, _m_ and _q_ of the value."""
    x, run = F.col(value), w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n0, m0, q0 = (F.col(f"_{c}_{value}") for c in "nmq")
    n1, m1, q1 = F.count(x).over(run), F.avg(x).over(run), F.var_pop(x).over(run) * F.count(x).over(run)
    n, gap = n0 + n1, F.coalesce(m1 - m0, F.lit(0.0))
    mean = F.when(n0 == 0, m1).when(n1 == 0, m0).otherwise(m0 + gap * n1 / n)
    return n, mean, F.coalesce(q0, F.lit(0.0)) + F.coalesce(q1, F.lit(0.0)) + F.coalesce(F.try_divide(gap * gap * n0 * n1, n), F.lit(0.0))


def z_of(x: Column, n: Column, mean: Column, squares: Column) -> Column:
    """z by the sample deviation; null where that is null or nothing but what adding up leaves."""
    sd = F.when(n > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (n - 1)))
    return F.when(sd > F.abs(mean) * NOISE, (x - mean) / sd)


def expanding_z(value: str, w: WindowSpec) -> Column:
    """z of a value against all values of its key up to it: those of its block by the window w, those before as carried in
    by with_moments()."""
    return z_of(F.col(value), *running_moments(value, w))

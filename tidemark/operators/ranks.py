"""Exact ranks, quantiles and dominance counts in groups of any size.

No window runs over a whole group. Values are counted first, so ties are one row; approximate quantiles of a group's
values part it into buckets; ranks are counted inside a bucket and the counts of the buckets before are added. The
splitters needn't be exact for the ranks to be, and all of it is one plan: nothing runs while it is built.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.hold import cut

#: Buckets that a group's values are parted into.
BUCKETS = 64
#: Bits of a digit of a time rank, and of a chunk of value ranks, in dominance counting: a window has 2 ** CHUNK_BITS rows.
DIGIT_BITS, CHUNK_BITS = 4, 14


def matched(left: DataFrame, right: DataFrame, on: Sequence[str], take: Sequence[str], how: str = "left") -> DataFrame:
    """left with the columns take of the right row of equal keys (null equals null); right has one row a key at most."""
    r = right.select(*[F.col(k).alias(f"_k_{k}") for k in on], *take)
    return left.join(r, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in on], F.lit(True)), how).drop(*[f"_k_{k}" for k in on])


def value_ranks(df: DataFrame, keys: Sequence[str], value: str, buckets: int = BUCKETS) -> DataFrame:
    """(keys, value) once for each value that is not null: n rows hold it, below hold a smaller one, total hold any."""
    keys = list(keys)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    cuts = F.percentile_approx(value, [k / buckets for k in range(1, buckets)], 8 * buckets)
    split = counts.groupBy(*keys).agg(F.array_distinct(cuts).alias("_cuts"), F.sum("n").alias("total"))
    x = matched(counts, split, keys, ["_cuts", "total"], "inner")
    x = x.withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col(value))))
    held = x.groupBy(*keys, "_b").agg(F.first("total").alias("total"), F.sum("n").alias("_s"), F.collect_list(F.struct(value, "n")).alias("_x"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # a row for each bucket
    rows = held.withColumn("_o", F.coalesce(F.sum("_s").over(before), F.lit(0))).select(*keys, "_b", "_o", "total", F.explode("_x").alias("_x"))
    here = Window.partitionBy(*keys, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select(*keys, "_b", "_o", "total", f"_x.{value}", "_x.n").withColumn("_r", F.sum("n").over(here))
    return rows.select(*keys, value, "n", (F.col("_o") + F.col("_r") - F.col("n")).alias("below"), "total")


def pct_ranks(df: DataFrame, keys: Sequence[str], value: str, out: str, digits: int = 9) -> DataFrame:
    """df with the average rank of value among its ties (to so many digits) over the number of values; null for null."""
    x = df.withColumn("_v", F.round(value, digits))
    share = (F.col("below") + (F.col("n") + 1) / 2.0) / F.col("total")
    ranks = value_ranks(x, keys, "_v").select(*keys, "_v", share.alias(out))
    return matched(x.drop(out), ranks, [*keys, "_v"], [out]).drop("_v")


def quantiles(df: DataFrame, keys: Sequence[str], value: str, names: dict[str, float]) -> DataFrame:
    """(keys): total and the exact quantiles of value under their names, interpolated linearly between neighbours."""
    ranks = value_ranks(df, keys, value)

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("below") <= place) & (place < F.col("below") + F.col("n")), F.col(value)))

    def place(p: float) -> Column:
        return F.lit(p) * (F.col("total") - 1)

    ends = {f"_lo_{n}": F.floor(place(p)) for n, p in names.items()} | {f"_hi_{n}": F.ceil(place(p)) for n, p in names.items()}
    found = ranks.groupBy(*keys, "total").agg(*[at(c).alias(n) for n, c in ends.items()])
    return found.select(*keys, "total", *[(F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * (place(p) - F.floor(place(p)))).alias(n) for n, p in names.items()])


def dominance(df: DataFrame, key: str, order: str, value: str, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """(key, order): place (rows of the key before it, by order) and not_above (rows up to it whose value isn't above).

    order is unique in its key; a null value is counted by no row and has not_above null. A row's place is read as
    digits: at each digit, those rows count that agree in the digits above and have a smaller one here, which a running
    count by digit in order of values tells. Where such a group is large, it is cut into chunks of value ranks, and the
    counts of the chunks before are added; a value that makes up more than a chunk is cut by place.
    """
    places = value_ranks(df, [key], order).select(key, order, F.col("below").alias("place"), "total")
    values = value_ranks(df, [key], value).select(key, value, F.col("below").alias("_v"), F.col("n").alias("_ties"))
    x = matched(df.select(key, order, value), places, [key, order], ["place", "total"], "inner")
    known = cut(matched(x, values, [key, value], ["_v", "_ties"], "inner"))
    digits = F.length(F.hex(F.col("total") - 1))  # DIGIT_BITS is that of hexadecimal
    cells = known.select(key, order, "place", "_v", "_ties", F.explode(F.sequence(F.lit(0), digits - 1)).alias("_level"))
    large = (F.col("_level") + 1) * DIGIT_BITS > chunk_bits
    cells = cells.withColumns(
        {
            "_digit": F.expr(f"CAST(shiftright(place, {DIGIT_BITS} * _level) AS INT) & {(1 << DIGIT_BITS) - 1}"),
            "_above": F.expr(f"shiftright(place, {DIGIT_BITS} * (_level + 1))"),
            "_chunk": F.when(large, F.shiftright("_v", chunk_bits)).otherwise(0),
            # smaller values of the same chunk all come before a value of many rows
            "_part": F.when(large & (F.col("_ties") > (1 << chunk_bits)), F.shiftright("place", chunk_bits)).otherwise(-1),
        }
    )
    group = [key, "_level", "_above", "_chunk", "_part"]
    run = Window.partitionBy(*group).orderBy("_v", "place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    smaller = range((1 << DIGIT_BITS) - 1)

    def below(name: str) -> Column:
        return reduce(lambda a, b: a + b, [F.when(F.col("_digit") > k, F.coalesce(F.col(f"{name}{k}"), F.lit(0))).otherwise(0) for k in smaller])

    sums = cells.where(large).groupBy(*group).agg(*[F.count_if(F.col("_digit") == k).alias(f"_s{k}") for k in smaller])
    before = Window.partitionBy(key, "_level", "_above").orderBy("_chunk", "_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each chunk
    carried = sums.select(*group, *[F.sum(f"_s{k}").over(before).alias(f"_o{k}") for k in smaller])
    counted = cells.withColumns({f"_c{k}": F.count_if(F.col("_digit") == k).over(run) for k in smaller})
    counted = matched(counted, carried, group, [f"_o{k}" for k in smaller]).select(key, order, (below("_c") + below("_o")).alias("_n"))
    total = counted.groupBy(key, order).agg((F.sum("_n") + 1).alias("not_above"))
    return matched(x.select(key, order, "place"), total, [key, order], ["not_above"])

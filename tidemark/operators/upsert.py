"""Idempotent loads over plain tables: the stored rows and the incoming ones give the new table.

Every function is a pure query; a caller writes the result to a new path and swaps, as a path that is read can't be
overwritten. Keys are compared null-safely.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedupe import first_wins, last_wins, latest_filed_wins


def _on(a: DataFrame, b: DataFrame, keys: Sequence[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[k])
    return cond


def semi(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of df whose keys are in keys_df."""
    return df.join(keys_df, _on(df, keys_df, keys), "left_semi")


def anti(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of df whose keys are not in keys_df."""
    return df.join(keys_df, _on(df, keys_df, keys), "left_anti")


def _counts(rows: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    old = stored.select(*keys).distinct().withColumn("_old", F.lit(1))
    marked = rows.select(*keys).join(old, _on(rows, old, keys), "left")
    return marked.agg(F.count(F.lit(1)).alias("n_seen"), F.count_if(F.col("_old").isNull()).alias("n_new"))


def replace_by_key(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], loaded: DataFrame | None = None) -> DataFrame:
    """All rows of each incoming key replace the stored ones of that key.

    loaded: keys that were loaded, also those without rows; theirs are then cleared. Without it, a key that came empty
    keeps what is stored.
    """
    gone = loaded if loaded is not None else incoming.select(*keys).distinct()
    return anti(stored, gone, keys).unionByName(incoming, allowMissingColumns=True)


def upsert(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], ord_col: str) -> tuple[DataFrame, DataFrame]:
    """The new table, and counts (n_seen, n_new) of the incoming rows; within the batch the last row by ord_col wins."""
    rows = last_wins(incoming, keys, ord_col)
    counts = _counts(rows, stored, keys)
    columns = stored.columns
    return anti(stored, rows, keys).select(*columns).unionByName(rows, allowMissingColumns=True).select(*columns), counts


def latest_filed_upsert(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], filed: str, ord_col: str, compare_stored: bool = False) -> DataFrame:
    """Within the batch the row filed last wins. It overwrites the stored one even if that was filed later, unless
    compare_stored is set."""
    rows = latest_filed_wins(incoming, keys, filed, ord_col).select(*stored.columns)
    if not compare_stored:
        return anti(stored, rows, keys).unionByName(rows)
    both = stored.withColumn("_ord", F.lit(0)).unionByName(rows.withColumn("_ord", F.lit(1)))
    return latest_filed_wins(both, keys, filed, "_ord").drop("_ord")


def append_new(stored: DataFrame, incoming: DataFrame, id_col: str, ord_col: str) -> tuple[DataFrame, DataFrame]:
    """Appends rows with unseen identifiers; rows without one are dropped, within the batch the first wins.

    Returns the appended rows and counts (n_seen, n_new).
    """
    rows = first_wins(incoming.where(F.col(id_col).isNotNull()), [id_col], ord_col)
    fresh = anti(rows, stored, [id_col])
    return fresh, _counts(rows, stored, [id_col])


def bridge_new(stored: DataFrame, pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pairs that the bridge table doesn't hold yet, each once."""
    return anti(pairs.select(*keys).distinct(), stored, keys)


def latest_status(log: DataFrame, key: str, run_at: str) -> DataFrame:
    """The last status row of each key of an append-only log."""
    return last_wins(log, [key], run_at)


def since_high_water(incoming: DataFrame, stored: DataFrame, key: str, date: str, start: str) -> DataFrame:
    """Incoming rows later than the newest stored date of their key, or than start for new keys."""
    mark = stored.groupBy(F.col(key).alias("_k")).agg(F.max(date).alias("_hwm"))
    return incoming.join(mark, F.col(key) == F.col("_k"), "left").where(F.col(date) > F.coalesce("_hwm", F.lit(start).cast("date"))).drop("_k", "_hwm")


def evolve(df: DataFrame, target: str) -> DataFrame:
    """df with the columns of the target schema (DDL): those it lacks are null, those beyond it stay at the end."""
    from pyspark.sql.types import StructType

    want = StructType.fromDDL(target)
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in want.fields], *[c for c in df.columns if c not in want.names])

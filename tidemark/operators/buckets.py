"""A keyed table on files of which an upsert rewrites only the buckets that its batch touches.

Rows lie under data/bucket=B/version=V; a version counts once its commit, the list of its buckets, is written. A reader
takes each bucket's last committed version. An upsert writes new versions of the touched buckets and leaves all other
files as they are; one that is repeated under its version starts from what was there before and replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.dedupe import last_wins

#: Buckets of a table; a batch that touches all of them rewrites the table once.
BUCKETS = 64


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def versions(spark: SparkSession, root: str, before: int | None = None) -> dict[int, int]:
    """The last committed version of each bucket, of those before a version if one is given; a few numbers a bucket."""
    if not _exists(spark, f"{root}/commits"):
        return {}
    x = spark.read.schema("bucket int, version long").parquet(f"{root}/commits")
    x = x if before is None else x.where(F.col("version") < before)
    return {r[0]: r[1] for r in x.groupBy("bucket").agg(F.max("version")).collect()}


def _read(spark: SparkSession, root: str, schema: StructType | str, held: dict[int, int]) -> DataFrame:
    if not held:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/data/bucket={b}/version={v}" for b, v in sorted(held.items())])


def current(spark: SparkSession, root: str, schema: StructType | str, only: set[int] | None = None) -> DataFrame:
    """The table's rows as of its last commits, or those of some buckets; only their folders are listed and read."""
    return _read(spark, root, schema, {b: v for b, v in versions(spark, root).items() if only is None or b in only})


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def buckets_of(keys_df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> set[int]:
    """The buckets that hold the keys of a frame: a number for each at most."""
    return {r[0] for r in keys_df.select(bucket_of(keys, buckets)).distinct().collect()}


def upsert_touched(root: str, batch: DataFrame, version: int, keys: Sequence[str], ord_col: str, buckets: int = BUCKETS, bucket_by: Sequence[str] | None = None) -> dict[str, int]:
    """Upserts batch under a version and returns n_seen and n_new of its keys and n_buckets, those that were rewritten.

    Within the batch the last row of a key by ord_col wins, and it replaces the stored one. Keys are compared null-safely;
    versions ascend from batch to batch. bucket_by: those of the keys that tell a row's bucket, if not all. The batch and the touched buckets meet in one join by key, which counts as it
    writes.
    """
    spark, names = batch.sparkSession, batch.columns
    place = bucket_of(bucket_by or keys, buckets)
    rows = last_wins(batch, list(keys), ord_col).withColumn("_b", place)
    touched = buckets_of(batch, bucket_by or keys, buckets)
    if not touched:
        return {"n_seen": 0, "n_new": 0, "n_buckets": 0}
    held = {b: v for b, v in versions(spark, root, version).items() if b in touched}
    old = _read(spark, root, batch.schema, held)
    old = old.select(*[F.col(c).alias(f"_o_{c}") for c in names], F.lit(True).alias("_old"), place.alias("_ob"))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys])
    both = rows.withColumn("_new", F.lit(True)).join(old, on, "full_outer")
    seen = Observation()
    both = both.observe(seen, F.count("_new").alias("n_seen"), F.count_if(F.col("_new").isNotNull() & F.col("_old").isNull()).alias("n_new"))
    merged = both.select(*[F.when(F.col("_new"), F.col(c)).otherwise(F.col(f"_o_{c}")).alias(c) for c in names], F.coalesce("_b", "_ob").alias("bucket"), F.lit(version).alias("version"))
    merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "version").parquet(f"{root}/data")
    commit = spark.createDataFrame([(b, version) for b in sorted(touched)], "bucket int, version long").coalesce(1)
    commit.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(f"{root}/commits")
    return {**seen.get, "n_buckets": len(touched)}

"""Helpers that the training-data operators share."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one key from which the key counts as hot and is split.
SPLIT_ROWS = 256


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the checkpoint folder that all executors share, and reads it from there.

    The folder is the one in spark.checkpoint.dir. Where none is set, a temporary one serves a session whose driver
    is its only executor; on a cluster that is an error, as executors wouldn't see each other's files.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.match(r"local(\[|$)", context.master):
                raise ValueError("spark.checkpoint.dir names no shared folder")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint()


#: Rows of a few numbers each that one task may write: smaller frames aren't spread over more.
FILE_ROWS = 1 << 15


def few(df: DataFrame, rows: int, file_rows: int = FILE_ROWS) -> DataFrame:
    """df, which has at most so many rows, in no more partitions than they need.

    A partition that is cut becomes a file, for which local folders start processes. Nothing is exchanged; larger
    frames keep their partitions.
    """
    return df.coalesce(max(1, -(-rows // file_rows)))


#: Texts of a batch that are decoded at a time.
SLICE_ROWS = 256


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches' rows in their order, so many at a time: what is made of a batch's texts doesn't grow with the batch."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


#: Rows of an Arrow batch in a job whose Python stages all read whole texts.
BATCH_ROWS = 1024


def small_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches hold BATCH_ROWS rows at most; fewer, if that is what it has.

    A batch lies in the executor's native memory and in the worker's at once, and both keep what the largest took.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def row_keys(ident: Column, text: Column) -> tuple[Column, Column]:
    """Two longs that tell a row from all others but those equal in identifier and text.

    The identifier itself, or a hash of the text where it is null, and another hash of the text (null counts as
    empty). So rows without an identifier, or with the same one, are spread and judged each for itself.
    """
    plain = F.coalesce(text, F.lit(""))
    return F.coalesce(ident, F.xxhash64(F.concat(plain, F.lit("\0")))), F.xxhash64(plain)


def packed(rows: DataFrame, merge: bool = False) -> DataFrame:
    """rows (with k1, k2 and text) with text packed by zstandard into the binary column packed, and copies.

    merge: rows of one Arrow batch that share (k1, k2) become one; copies counts them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            copies = np.ones(b.num_rows, np.int64)
            if merge and b.num_rows:
                both = np.stack([b.column("k1").to_numpy(), b.column("k2").to_numpy()], axis=1)
                _, first, copies = np.unique(both, axis=0, return_index=True, return_counts=True)
                b = b.take(pa.array(first))
            texts = [None if t is None else pack(t.encode()) for t in b.column("text").to_pylist()]
            others = [n for n in b.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in others], pa.array(texts, pa.binary()), pa.array(copies, pa.int64())], names=[*others, "packed", "copies"])

    fields = [f for f in rows.schema.fields if f.name != "text"]
    return rows.mapInArrow(run, T.StructType([*fields, T.StructField("packed", T.BinaryType()), T.StructField("copies", T.LongType())]))


def fresh(taken: Iterable[str], *bases: str) -> list[str]:
    """Column names like bases that clash with none of taken (names don't differ by case)."""
    seen, out = {x.lower() for x in taken}, []
    for base in bases:
        name = base
        while name.lower() in seen:
            name += "_"
        seen.add(name.lower())
        out.append(name)
    return out


#: Bits of a filter of keys: for each key, at least, and at most (8 MB).
FILTER_BITS = (64, 1 << 20, 1 << 26)
#: Bits that a row of a filter holds, as bitmap_construct_agg makes them.
_ROW_BITS = 1 << 15


def marked(rows: DataFrame, mark: str, key: Sequence[str], keys: DataFrame, n: int) -> DataFrame:
    """rows with the boolean column mark, which is false only where the row's key (columns of rows) isn't in keys.

    Nothing is exchanged but the keys. Each of them sets one bit of a filter, and the filter is broadcast: what the driver
    and the executors hold of it is bounded. Of the rows whose key isn't there one in 64 is marked too, more if so many
    bits for each of the n keys are beyond the bound; so a mark asks for an exact join, or for a use that bears more rows.
    """
    each, least, most = FILTER_BITS
    size = min(most, max(least, 1 << (each * n - 1).bit_length()))
    at, own, bits = fresh([*rows.columns, mark], "flt_at", "flt_row", "flt_bits")

    def placed(df: DataFrame, names: Sequence[str]) -> DataFrame:
        return df.withColumn(at, F.pmod(F.xxhash64(*names), F.lit(size)).cast("int"))

    held = placed(keys, keys.columns).select(F.shiftright(at, 15).alias(own), (F.col(at) % _ROW_BITS).alias(at)).repartition(own)
    held = held.groupBy(own).agg(F.bitmap_construct_agg(at).alias(bits))  # FILTER_BITS[2] / _ROW_BITS rows at most
    place = F.col(at) % _ROW_BITS
    byte = F.conv(F.hex(F.substring(F.col(bits), F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    both = placed(rows, key).join(F.broadcast(held), F.shiftright(at, 15) == F.col(own), "left")
    return both.withColumn(mark, F.coalesce(F.getbit(byte, place % 8) == 1, F.lit(False))).drop(at, own, bits)


def hot_keys(keys: DataFrame, key: str, split_rows: int = SPLIT_ROWS) -> list[tuple[int, int]]:
    """The keys that hold more than split_rows rows, with their rows: 4 x partitions of them at most, the largest.

    A key that isn't among the largest 4 x P holds less than a (4 P)th of all rows, so that what is left fits a
    task; the list that reaches the driver is bounded by P.
    """
    found = (
        keys.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > split_rows)
        .orderBy(F.col("n").desc(), F.col(key))
        .limit(4 * partitions(keys.sparkSession))
        .collect()
    )
    return [(r[0], r[1]) for r in found]


def large_groups(keys: DataFrame, key: str, split_rows: int = SPLIT_ROWS) -> list[tuple[int, int]]:
    """The keys too large for a task, with the number of parts to split each into.

    Large is a key with more than split_rows rows and more than a (4 P)th of all rows, for P partitions; a part has no
    more than these. So there are fewer than 4 P keys and 8 P parts, and their list may be collected and broadcast.
    """
    most = 4 * partitions(keys.sparkSession)
    counts = keys.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    top = counts.where(F.col("n") > split_rows).orderBy(F.col("n").desc(), F.col(key)).limit(most).withColumn("every", F.lit(False))
    # all rows counted beside them, over the same exchange
    found = top.unionByName(counts.agg(F.lit(None).cast("long").alias(key), F.sum("n").alias("n"), F.lit(True).alias("every"))).collect()
    rows = max((r["n"] or 0 for r in found if r["every"]), default=0)
    size = max(split_rows, -(-rows // most))  # rows of a part
    return [(r[key], -(-r["n"] // size)) for r in found if not r["every"] and r["n"] > size]


def repeated(df: DataFrame, key: str, split_rows: int = SPLIT_ROWS, rows: Column | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The rows of df whose key (a long column) occurs more than once; those of hot keys apart, None if there are none.

    rows: for how many occurrences a row stands, one where it isn't given.

    Hot are the 4 x partitions keys at most with more than split_rows rows. Their list is bounded and broadcast; their
    rows are never brought together. df is read twice.
    """
    spark = df.sparkSession
    many = cut(df.groupBy(key).agg(F.sum(F.lit(1) if rows is None else rows).alias("n")).where("n > 1").select(F.col(key).alias("many_key"), "n"))
    hot = many.where(F.col("n") > split_rows).orderBy(F.col("n").desc(), "many_key").limit(4 * partitions(spark)).collect()
    if not hot:
        return df.join(many, F.col(key) == F.col("many_key"), "left_semi"), None
    few = F.broadcast(spark.createDataFrame([(r[0],) for r in hot], "hot_key long"))  # 4 x partitions rows at most
    rest = df.join(few, F.col(key) == F.col("hot_key"), "left_anti").join(many, F.col(key) == F.col("many_key"), "left_semi")
    return rest, df.join(few, F.col(key) == F.col("hot_key"), "left_semi")


#: Makes another key of a key, with the same equalities.
DERIVED = 0x5DEECE66D


def all_repeated(df: DataFrame, key: str) -> DataFrame:
    """The rows of df whose key (a long column) occurs more than once.

    Counts are summed before they are sent. The join is by a derived key, so both its sides are exchanged for it alone
    and adaptive execution can split the rows of a hot key. df is read twice; nothing runs while the plan is built.
    """
    many = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col(key).bitwiseXOR(F.lit(DERIVED)).alias("many_key"))
    return df.withColumn("derived_key", F.col(key).bitwiseXOR(F.lit(DERIVED))).join(many, F.col("derived_key") == F.col("many_key"), "left_semi").drop("derived_key")

"""Structured Streaming forms of the incremental loads: files that land are read once, state is kept by checkpoint.

Batches may be replayed after a failure, so each writes under its batch id and replaces what that id wrote before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.operators.buckets import BUCKETS, upsert_touched
from tidemark.operators.dedupe import first_by, first_wins, latest_filed_wins
from tidemark.operators.upsert import anti


def landed(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def append_dedupe(stream: DataFrame, id_col: str, event_time: str, delay: str, out: str, checkpoint: str) -> StreamingQuery:
    """Appends each story once. State is bounded: an id is forgotten once the watermark has passed it by delay."""
    once = stream.where(F.col(id_col).isNotNull()).withWatermark(event_time, delay).dropDuplicatesWithinWatermark([id_col])
    return once.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


#: The state store that keyed state with its own processor needs.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the session's own setting comes back afterwards."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STORE)
        else:
            spark.conf.set(STORE, before)


class FirstRows(StatefulProcessor):
    """Lets the first row of a key through, by an order column within the batch, and none after it.

    State is one flag for each key: neither rows nor times are kept, and a batch touches the flags of its own keys only.
    """

    def __init__(self, order: str):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "flag boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        if not self.seen.exists():
            self.seen.update((True,))
            yield min(rows, key=lambda r: (r[self.order] is None, r[self.order]))  # the first of equals; one row is held

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self.seen.update((True,))

    def close(self) -> None:
        pass


def append_keyed(stream: DataFrame, id_col: str, ord_col: str, out: str, checkpoint: str, stored: DataFrame | None = None) -> StreamingQuery:
    """Appends each story once, however late it comes again; rows without an identifier are left out.

    Whether an identifier was seen is keyed state, so the cost of a batch follows the batch, not the table. stored: rows
    that were loaded before the stream's first start; their identifiers count as seen. Files are written exactly once:
    a batch that is replayed after a failure starts from the state before it and replaces what it wrote.
    """
    rows = stream.where(F.col(id_col).isNotNull())
    seen = None if stored is None else stored.where(F.col(id_col).isNotNull()).select(id_col).distinct().groupBy(id_col)
    once = rows.groupBy(id_col).transformWithState(statefulProcessor=FirstRows(ord_col), outputStructType=rows.schema, outputMode="append", timeMode="none", initialState=seen)
    with keyed_state(stream.sparkSession):
        return once.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def append_once(stream: DataFrame, id_col: str, ord_col: str, out: str, checkpoint: str) -> StreamingQuery:
    """Appends each story once, however late it comes again: a batch is compared with all identifiers stored.

    State is the stored table itself. A replayed batch leaves its own rows out of the comparison and replaces them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = first_wins(batch.where(F.col(id_col).isNotNull()), [id_col], ord_col)
        spark = batch.sparkSession
        stored = spark.read.schema(StructType([*batch.schema.fields, StructField("batch_id", LongType())])).parquet(out) if batch_id else None
        fresh = rows if stored is None else anti(rows, stored.where(F.col("batch_id") != batch_id).select(id_col), [id_col])
        fresh.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out)

    return each_batch(stream, write, checkpoint)


def upsert_log(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Lands batches as an append-only log with batch ids; latest() reads the current rows of it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(log: DataFrame, keys: list[str], within: str) -> DataFrame:
    """The log's current rows: the last batch wins, within a batch the largest value of the column within."""
    return latest_filed_wins(log, keys, "batch_id", within)


def restated(log: DataFrame, keys: list[str], filed: str, ord_col: str) -> DataFrame:
    """The log's current facts: the last batch that has a key overwrites it; within the batch the row filed last wins,
    of ties the larger ord_col."""
    return first_by(log, keys, F.col("batch_id").desc(), F.col(filed).desc_nulls_last(), F.col(ord_col).desc_nulls_last())


def each_batch(stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_buckets(stream: DataFrame, keys: list[str], ord_col: str, root: str, checkpoint: str, n_buckets: int = BUCKETS) -> StreamingQuery:
    """Upserts each batch into a bucketed table, rewriting the buckets that the batch touches; counts by batch lie beside
    it. A replayed batch has its version again: it starts from what was there before it and replaces what it wrote."""

    def load(batch: DataFrame, batch_id: int) -> None:
        counts = upsert_touched(root, batch, batch_id, keys, ord_col, n_buckets)
        row = batch.sparkSession.createDataFrame([(batch_id, *(counts[c] for c in ("n_seen", "n_new", "n_buckets")))], "batch_id long, n_seen long, n_new long, n_buckets long")
        row.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{root}/counts")

    return each_batch(stream, load, checkpoint)


def windowed_counts(stream: DataFrame, event_time: str, key: str, window: str = "1 day", delay: str = "2 days") -> DataFrame:
    """Events by key and window; windows close once the watermark has passed them."""
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, window), key).agg(F.count(F.lit(1)).alias("n"))

"""Tables and files in and out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tidemark.sources.parse import outcome


def safe_key(c):
    """A key as part of a path: anything beyond letters, digits, dot, underscore and hyphen becomes an underscore."""
    return F.regexp_replace(c, r"[^A-Za-z0-9._-]", "_")


def save_raw(df: DataFrame, path: str, run_date: str, key: str) -> bool:
    """A snapshot of df under its run date and keys, replacing earlier ones of the same date and key. Nothing is
    written for an empty frame."""
    if df.isEmpty():
        return False
    x = df.withColumns({"run_date": F.lit(run_date), "key": safe_key(F.col(key).cast("string"))})
    x.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date", "key").parquet(path)
    return True


def land_payloads(df: DataFrame, path: str, run_date: str, key: str, body: str) -> bool:
    """Raw JSON or XML bodies under their run date and keys, as they came; null and empty ones land nowhere.

    Landing again on the same date replaces the keys that come again. Each body has a file of its own, also those of
    one key.
    """
    x = df.where(F.length(body) > 0).select(F.lit(run_date).alias("run_date"), safe_key(F.col(key).cast("string")).alias("key"), F.col(body).alias("value"))
    seen = Observation()  # rows are counted as they land, so that none is computed twice
    x.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("lineSep", "\n").option("maxRecordsPerFile", 1).partitionBy("run_date", "key").text(path)
    return seen.get["n"] > 0


def raw_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(path, body) of landed text payloads, one row a file, and the run date and key if they were landed under them."""
    x = spark.read.text(path, wholetext=True)
    return x.select(F.input_file_name().alias("path"), F.col("value").alias("body"), *[c for c in x.columns if c != "value"])


@F.arrow_udf(IntegerType())
def _items_in(bodies: pa.Array) -> pa.Array:
    """Items or entries of each feed; null for what is no XML."""

    def count(body: str | None) -> int | None:
        try:
            tags = [e.tag.rsplit("}", 1)[-1] for e in ElementTree.fromstring(body or "").iter()]
        except (ElementTree.ParseError, ValueError):
            return None
        return sum(t in ("item", "entry") for t in tags)

    return pa.array([count(b) for b in bodies.to_pylist()], pa.int32())


def feed_status(payloads: DataFrame, body: str = "body") -> DataFrame:
    """payloads with n_items and status: ok, empty, or error for a feed that is no well-formed XML."""
    return payloads.withColumn("n_items", _items_in(F.col(body))).withColumn("status", outcome(F.col("n_items"), F.when(F.col("n_items").isNull(), F.lit("XML"))))


def feed_file(spark: SparkSession, path: str, row: str = "item") -> DataFrame:
    """Items of landed RSS ('item') or Atom ('entry') files, as text columns.

    RSS dates may stand under dc:date, Atom texts under content. Malformed files give no items here; feed_status names
    them.
    """
    rss = "guid string, link string, title string, description string, pubDate string, `dc:date` string"
    atom = "id string, title string, summary string, content string, published string, updated string, link array<struct<_href: string, _rel: string>>"
    x = spark.read.format("xml").option("rowTag", row).option("mode", "DROPMALFORMED").schema(rss if row == "item" else atom).load(path)
    if row == "item":
        return x.select("guid", "link", "title", "description", F.coalesce(F.nullif(F.col("pubDate"), F.lit("")), F.col("`dc:date`")).alias("published"))
    chosen = F.coalesce(F.get(F.filter("link", lambda a: F.coalesce(a["_rel"], F.lit("alternate")) == "alternate"), F.lit(0))["_href"], F.get("link", F.lit(0))["_href"])
    summary, published = (F.coalesce(F.nullif(F.col(a), F.lit("")), F.col(b)) for a, b in (("summary", "content"), ("published", "updated")))
    return x.select(F.col("id").alias("guid"), chosen.alias("link"), "title", summary.alias("description"), published.alias("published"))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with a header under an explicit schema; what doesn't fit becomes null."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


#: The column of a row's text as it came, where it doesn't fit the schema.
CORRUPT = "_corrupt"


def read_csv_checked(spark: SparkSession, path: str, schema: str, rules: Mapping[str, Column] | None = None, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """The good rows of a CSV, and the quarantined ones as (path, line, reason).

    A row is quarantined that has other columns than the schema or values of other types ("not a row of the schema"), or
    for the first of the rules (reason to condition) that it doesn't meet; a condition that is null is not met. No row
    is lost: good and quarantined rows are those of the files.
    """
    fields = StructType.fromDDL(schema)
    names = fields.names
    x = spark.read.schema(StructType([*fields.fields, StructField(CORRUPT, StringType())])).option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", "false").csv(path)
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("not a row of the schema"))
    for name, met in (rules or {}).items():
        reason = reason.when(~F.coalesce(met, F.lit(False)), F.lit(name))
    x = x.withColumns({"path": F.input_file_name(), "reason": reason})
    line = F.coalesce(CORRUPT, F.to_csv(F.struct(*names)))
    return x.where("reason IS NULL").select(*names), x.where("reason IS NOT NULL").select("path", line.alias("line"), "reason")


def write_observed(df: DataFrame, path: str, **counted: Column) -> dict[str, int]:
    """Writes df and returns aggregates of its rows, taken as they pass: the table isn't read again to be counted."""
    seen = Observation()
    df.observe(seen, *[c.alias(n) for n, c in counted.items()]).write.mode("overwrite").parquet(path)
    return seen.get


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def table_or_empty(spark: SparkSession, name: str, schema: str) -> DataFrame:
    """A table, or an empty frame of the schema where there is none."""
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


def rebuild(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """A derived table from scratch; also the whole replacement of a dimension."""
    df.write.mode("overwrite").partitionBy(*partition_by).saveAsTable(name)


def register(frames: Mapping[str, DataFrame]) -> None:
    for n, df in frames.items():
        df.createOrReplaceTempView(n)


def gather(spark: SparkSession, wanted: Mapping[str, Sequence[str]]) -> dict[str, DataFrame | None]:
    """The wanted columns of each table, None for tables that aren't there. Nothing is read yet."""
    return {n: spark.table(n).select(*cols) if spark.catalog.tableExists(n) else None for n, cols in wanted.items()}


def dump(frames: Mapping[str, DataFrame], root: str) -> dict[str, int]:
    """Writes each frame as CSV under root; rows by name."""
    for n, df in frames.items():
        write_csv(df, f"{root}/{n}")
    return {n: df.count() for n, df in frames.items()}


def restore(spark: SparkSession, schemas: Mapping[str, str], root: str) -> dict[str, DataFrame]:
    return {n: read_csv(spark, f"{root}/{n}", s) for n, s in schemas.items()}

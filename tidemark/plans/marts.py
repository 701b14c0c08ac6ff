"""Small frames for a dashboard, run reports, coverage and data-quality checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.operators.dedupe import latest, top_n
from tidemark.plans.insights import latest_measures
from tidemark.sources.files import write_observed


def coverage(frames: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(source): first and last date and rows of each frame."""
    return reduce(DataFrame.unionByName, [df.agg(F.lit(n).alias("source"), F.min(d).cast("date").alias("first_date"), F.max(d).cast("date").alias("last_date"), F.count(F.lit(1)).alias("n_rows")) for n, (df, d) in frames.items()])


def staleness(found: DataFrame, today: str) -> DataFrame:
    return found.withColumn("days_stale", F.datediff(F.lit(today).cast("date"), "last_date"))


def as_of(frames: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    return coverage(frames).agg(F.max("last_date").alias("as_of"))


def run_report(status: DataFrame) -> DataFrame:
    """Counts by status for each category, failures first."""
    x = status.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") == "empty").alias("empty"), F.count_if(F.col("status") == "error").alias("failed"), F.sum("n_rows").alias("n_rows"))
    return x.orderBy(F.col("failed").desc(), "category")


def key_coverage(df: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """(key): first and last date and rows that hold a value, for the status of a run."""
    return df.where(F.col(value).isNotNull()).groupBy(key).agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.count(F.lit(1)).alias("n_rows"))


#: What a run of each kind must show to pass, over counts n, ok, empty, failed.
PASSES = {"series": "failed = 0", "feeds": "failed = 0", "positions": "failed = 0 AND empty < n", "skew": "failed = 0 AND ok > 0"}


def run_summary(status: DataFrame, kind: str, total: str) -> DataFrame:
    """One row: counts by status, the sum of total, and the result of a run of this kind (a key of PASSES)."""
    s = F.col("status")
    x = status.agg(F.count(F.lit(1)).alias("n"), F.count_if(s == "ok").alias("ok"), F.count_if(s == "not_modified").alias("not_modified"), F.count_if(s == "empty").alias("empty"), F.count_if(s == "error").alias("failed"), F.coalesce(F.sum(total), F.lit(0)).alias("total"))
    return x.withColumn("result", F.when(F.expr(PASSES[kind]), "PASS").otherwise("COMPLETED WITH ISSUES"))


def run_lines(status: DataFrame, group: str, key: str) -> DataFrame:
    """All status rows, failures first, then by group and key."""
    return status.orderBy((F.col("status") != "error").cast("int"), group, key)


def run_flagged(status: DataFrame, kind: str) -> DataFrame:
    """Rows to look at: errors, and for positions and skew whatever is not ok; an empty market asks for its pattern."""
    bad = F.col("status") != "ok" if kind in ("positions", "skew") else F.col("status") == "error"
    note = F.coalesce(F.col("error"), F.when((F.col("status") == "empty") & F.lit(kind == "positions"), "no match - check the pattern"), F.lit(""))
    return status.where(bad).withColumn("note", note)


def transform_summary(counts: DataFrame, checked: DataFrame, label: DataFrame) -> DataFrame:
    """One row: gold tables and rows, whether gold and staging agree, the regime's label, the result."""
    one = F.lit(1).alias("one")
    tables = counts.agg(F.count(F.lit(1)).alias("n_tables"), F.sum("n_rows").alias("n_rows")).select("*", one)
    agreed = checked.agg(F.bool_and("matched").alias("reconciled")).select("*", one)
    named = label.agg(F.first("regime_label").alias("regime_label")).select("*", one)
    x = tables.join(F.broadcast(agreed), "one").join(F.broadcast(named), "one")
    return x.select("n_tables", "n_rows", "reconciled", F.coalesce("regime_label", F.lit("n/a")).alias("regime_label"), F.when(F.col("reconciled"), "PASS").otherwise("COMPLETED WITH ISSUES").alias("result"))


def reconciliation(staged: DataFrame, gold: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """One row: rows staged, rows in gold, rows of keys that the manifest doesn't know, and whether gold accounts for all."""
    known = dim.select(F.col(key).alias("_k")).distinct().withColumn("_known", F.lit(1))
    counted = staged.join(F.broadcast(known), F.col(key) == F.col("_k"), "left").agg(F.count(F.lit(1)).alias("staged"), F.count_if(F.col("_known").isNull()).alias("unknown")).withColumn("one", F.lit(1))
    built = gold.agg(F.count(F.lit(1)).alias("gold")).withColumn("one", F.lit(1))
    return counted.join(built, "one").select("staged", "gold", "unknown", (F.col("staged") == F.col("gold")).alias("matched"), (F.col("staged") - F.col("unknown") == F.col("gold")).alias("explained"))


def build_reconciled(staged: DataFrame, dim: DataFrame, key: str, build: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """Builds a gold table at path and reconciles it with its staging rows, which are counted as they pass.

    build reads staged once. Rows that a lost executor makes Spark compute again count again in such passing counts, so
    where these don't account for gold, both are counted once more; else neither is read a second time.
    """
    known = F.broadcast(dim.select(F.col(key).alias("_k")).distinct().withColumn("_known", F.lit(1)))
    seen = Observation()
    marked = staged.join(known, F.col(key) == F.col("_k"), "left").observe(seen, F.count(F.lit(1)).alias("staged"), F.count_if(F.col("_known").isNull()).alias("unknown"))
    gold = write_observed(build(marked.drop("_k", "_known")), path, gold=F.count(F.lit(1)))["gold"]
    n, unknown = seen.get["staged"], seen.get["unknown"]
    if n - unknown != gold:
        return reconciliation(staged, staged.sparkSession.read.parquet(path), dim, key)
    row = (n, gold, unknown, n == gold, True)
    return staged.sparkSession.createDataFrame([row], "staged long, gold long, unknown long, matched boolean, explained boolean")


def level_vs_history(wide: DataFrame, date: str, columns: Sequence[str]) -> DataFrame:
    """(measure): last, mean, deviation, range, z and percentile of each column. Long first, so measures run in parallel."""
    return latest_measures(wide.unpivot([date], list(columns), "measure", "value"), date, "value", "measure")


def rebased(prices: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """Each series as 100 at its first value."""
    start = F.first(value, ignorenulls=True).over(Window.partitionBy(key).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return prices.select(key, date, (F.try_divide(F.col(value), start) * 100).alias("rebased"))


def tail(df: DataFrame, key: str, date: str, n: int = 90) -> DataFrame:
    return top_n(df, [key], n, F.col(date).desc())


def change_over(df: DataFrame, key: str, date: str, value: str, k: int) -> DataFrame:
    """(key): the last value against the one k observations earlier, among those that are there."""
    known = df.where(F.col(value).isNotNull())
    w = Window.partitionBy(key).orderBy(date)
    x = known.withColumn("_before", F.lag(value, k).over(w))
    x = latest(x, [key], date)
    return x.select(key, F.col(value).alias("last"), (F.col(value) - F.col("_before")).alias("change"), (F.try_divide(F.col(value), F.col("_before")) - 1).alias("pct_change"))


def factor_matrix(scores: DataFrame, names: Sequence[str], n: int = 12) -> DataFrame:
    """(ticker, factor): z of the n names whose composite is farthest from zero on the last date."""
    last = scores.agg(F.max("price_date").alias("_last"))
    newest = scores.join(F.broadcast(last), F.col("price_date") == F.col("_last")).where("composite_z IS NOT NULL")
    few = newest.orderBy(F.round(F.abs("composite_z"), 9).desc(), "ticker").limit(n)
    return few.unpivot(["ticker"], list(names), "factor", "z")


def recent(stories: DataFrame, n: int = 40) -> DataFrame:
    return stories.where("published_at IS NOT NULL").orderBy(F.col("published_at").desc(), "item_id").limit(n)


def kpi_tail(wide: DataFrame, date: str, columns: Sequence[str], n: int = 90) -> DataFrame:
    """(measure): the value on the last date, its z and percentile against the measure's history, and the values of the
    last n dates in order; measures without a value on the last date are left out."""
    long = wide.select(date, *[F.col(c).cast("double") for c in columns]).unpivot([date], list(columns), "measure", "value")
    history = latest_measures(long, date, "value", "measure").select("measure", "z_latest", "pctile_latest")
    points = tail(long, "measure", date, n).groupBy("measure").agg(F.sort_array(F.collect_list(F.struct(date, "value"))).alias("p"))
    x = points.join(history, "measure").withColumn("last", F.get("p", F.size("p") - 1)["value"]).where("last IS NOT NULL")
    return x.select("measure", "last", "z_latest", "pctile_latest", F.transform("p", lambda q: q["value"]).alias("tail"))


def valuation_table(value: DataFrame) -> DataFrame:
    """The yields of the last date, cheapest first, with the market value in billions."""
    last = value.agg(F.max("price_date").alias("_last"))
    newest = value.join(F.broadcast(last), F.col("price_date") == F.col("_last"))
    x = newest.select("ticker", "earnings_yield", "sales_yield", "fcf_yield", (F.col("market_cap_gbp") / 1e9).alias("market_cap_bn"))
    return x.orderBy(F.col("earnings_yield").desc_nulls_last(), "ticker")


def manifest_rows(manifest: DataFrame, groups: str, defaults: Mapping[str, str]) -> DataFrame:
    """Rows of a manifest column map<group, array<struct>>, with defaults where a field is missing."""
    x = manifest.select(F.explode(groups).alias("group", "members")).select("group", F.explode("members").alias("m")).select("group", "m.*")
    return x.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def violations(df: DataFrame, key: str, required: Sequence[str] = (), domains: Mapping[str, Sequence[str]] | None = None, patterns: Mapping[str, str] | None = None) -> DataFrame:
    """(key, rule): required fields that are missing, values outside their domain, texts unlike their pattern, keys that
    occur twice; and one row 'empty' if there are no rows at all."""
    rules = {f"missing {c}": F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "") for c in required}
    rules |= {f"{c} not allowed": ~F.col(c).isin(*v) for c, v in (domains or {}).items()}
    rules |= {f"{c} malformed": ~F.col(c).rlike(v) for c, v in (patterns or {}).items()}
    found = F.array_compact(F.array(*[F.when(cond, F.lit(n)) for n, cond in rules.items()])) if rules else F.array().cast("array<string>")
    bad = df.select(F.col(key).cast("string").alias("key"), F.explode(found).alias("rule"))
    twice = df.groupBy(F.col(key).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key", F.lit("duplicate").alias("rule"))
    none = df.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit(None).cast("string").alias("key"), F.lit("empty").alias("rule"))
    return bad.unionByName(twice).unionByName(none)


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """df, if it has the required columns."""
    lacking = sorted(set(required) - set(df.columns))
    if lacking:
        raise ValueError(f"columns missing: {', '.join(lacking)}")
    return df


def only(df: DataFrame, key: str, wanted: Sequence[str]) -> DataFrame:
    """The rows of the wanted keys; an error if there are none."""
    picked = df.where(F.col(key).isin(*wanted))
    if picked.isEmpty():
        raise ValueError(f"no {key} among {', '.join(wanted)}")
    return picked

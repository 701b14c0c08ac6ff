"""Exact dedup by content sort.

Texts are dealt out by sampled splitters over the head of the text and its digest, sorted inside each partition, and
neighbours are compared in full; equal texts stand next to each other. Groups of copies too large for a task are
salted by identifier first and their few representatives are compared once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPLIT_ROWS, fresh, large_groups, partitions

#: Characters of a text that splitters hold: sampled keys stay small however long texts are.
HEAD_CHARS = 32


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", split_rows: int = SPLIT_ROWS, keep: str = "largest") -> DataFrame:
    """Every row of docs with keep_id, group_size and kept; of equal texts one row is kept.

    keep: which identifier stays, the "largest" or the "smallest". Texts are equal when all their bytes are; a null
    text counts as empty, so null and empty texts form one group. Rows with a null identifier stay only in groups
    that have no other; of repeated rows (same text, same identifier) one is kept. An empty table gives an empty
    result. Columns of docs called keep_id, group_size or kept give way to the results; all others are returned.
    """
    spark = docs.sparkSession
    head, dig, salts, salt, rank, part_keep, part_size = fresh(docs.columns, "xd_head", "xd_digest", "xd_salts", "xd_salt", "xd_rank", "xd_keep", "xd_size")
    content, ident = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), F.col(f"`{id_col}`")
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in {"keep_id", "group_size", "kept"}]
    rows = docs.withColumns({dig: F.xxhash64(content), head: F.substring(content, 1, HEAD_CHARS)})
    by = [head, dig]
    hot = large_groups(rows.select(dig), dig, split_rows)
    if hot:
        few = F.broadcast(spark.createDataFrame(hot, f"`{dig}` long, `{salts}` long"))  # 4 x partitions rows at most
        rows = rows.join(few, dig, "left").withColumn(salt, F.when(F.col(salts).isNull(), -1).otherwise(F.pmod(F.xxhash64(ident), salts)))
        by.append(salt)
    # the range over these columns already clusters the window's keys, so the texts are exchanged once
    ranged = rows.repartitionByRange(partitions(spark), *by)
    same = Window.partitionBy(*by, content)
    first = ident.desc_nulls_last() if keep == "largest" else ident.asc_nulls_last()
    inner = ranged.withColumns({rank: F.row_number().over(same.orderBy(first)), part_keep: F.first(ident).over(same.orderBy(first)), part_size: F.count(F.lit(1)).over(same)})
    if not hot:
        return inner.select(*others, F.col(part_keep).alias("keep_id"), F.col(part_size).alias("group_size"), (F.col(rank) == 1).alias("kept"))
    # of each part of a split group, its representative meets those of the other parts, again in full
    parts = rows.where(F.col(salt) >= 0).groupBy(dig, salt, content.alias("g_text")).agg((F.max(ident) if keep == "largest" else F.min(ident)).alias("g_part"), F.count(F.lit(1)).alias("g_rows"))
    group = Window.partitionBy(dig, "g_text")
    best = F.max("g_part") if keep == "largest" else F.min("g_part")
    whole = parts.select(
        F.col(dig).alias("g_dig"),
        F.col(salt).alias("g_salt"),
        F.sha2("g_text", 256).alias("g_sha"),
        best.over(group).alias("g_keep"),
        F.sum("g_rows").over(group).alias("g_size"),
        F.min(salt).over(group).alias("g_first"),
    )
    # a row for each part: 8 x partitions, and one more for each text that shares a hot digest
    told = inner.join(F.broadcast(whole), (F.col(dig) == F.col("g_dig")) & (F.col(salt) == F.col("g_salt")) & (F.when(F.col(salt) >= 0, F.sha2(content, 256)) == F.col("g_sha")), "left")
    alone = F.col("g_size").isNull()
    stays = F.when(F.col("g_keep").isNull(), F.col(salt) == F.col("g_first")).otherwise(F.col(part_keep).eqNullSafe(F.col("g_keep")))
    return told.select(
        *others,
        F.when(alone, F.col(part_keep)).otherwise(F.col("g_keep")).alias("keep_id"),
        F.coalesce("g_size", part_size).alias("group_size"),
        ((F.col(rank) == 1) & (alone | stays)).alias("kept"),
    )


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows of docs with docs' own columns, in their order, whatever they are called."""
    (kept,) = fresh([*docs.columns, "keep_id", "group_size"], "kept")
    names = fresh([], *[f"c{i}" for i in range(len(docs.columns))])
    plain = docs.select(*[docs[f"`{c}`"].alias(n) for c, n in zip(docs.columns, names, strict=True)])
    place = {c.lower(): n for c, n in zip(docs.columns, names, strict=True)}
    out = exact_dedup(plain, place[id_col.lower()], place[text_col.lower()]).where("kept")
    return out.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])

"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position carries a non-zero code of r + 1 bits; mask v holds the positions whose code has odd parity with
v. The codes of any r positions are orthogonal to some v, so fingerprints that differ in at most r bits agree under
that mask: no pair within the radius is missed, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPLIT_ROWS, cut, hot_keys
from tidemark.llm.components import connected_components

BITS = 64
#: Fingerprints of a bucket up to which all are compared with all, in memory.
SMALL_BUCKET = 512


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """The 2^(radius+1) - 1 masks, as signed 64-bit numbers."""
    codes = [i % ((1 << (radius + 1)) - 1) + 1 for i in range(bits)]
    masks = [sum(1 << i for i, c in enumerate(codes) if (c & v).bit_count() & 1) for v in range(1, 1 << (radius + 1))]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def simhash(text: str | None, words_per_shingle: int = 3) -> int:
    """The 64-bit fingerprint of a text, as a signed number; 0 without words.

    A-Z are lower-cased, words are split at ASCII white space, shingles keep their repeats and are hashed with XXH64
    under seed 42; a bit is set if it is set in over half the hashes.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    n = len(found) - words_per_shingle + 1
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    if n <= 1:
        hashes = np.array([digest(joined, 42)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
        starts = np.concatenate(([0], ends[: n - 1]))
        stops = ends[words_per_shingle - 1 :] - 1
        hashes = np.fromiter([digest(joined[s:e], 42) for s, e in zip(starts.tolist(), stops.tolist(), strict=True)], np.uint64, n)
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        votes += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """doc_id and fp (long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([simhash(t, words_per_shingle) for t in b.column("t").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("i"), found], names=["doc_id", "fp"])

    return docs.select(docs[f"`{id_col}`"].cast("long").alias("i"), docs[f"`{text_col}`"].cast("string").alias("t")).mapInArrow(run, "doc_id long, fp long")


def links_in_bucket(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that join the fingerprints of one bucket exactly as all its pairs within radius do; a forest, not all pairs."""
    fps = np.unique(fps)
    n, parent, edges = len(fps), list(range(len(fps))), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    if n > SMALL_BUCKET and radius == 2:  # by shared neighbours at one bit: linear in n
        bits = np.concatenate(([np.uint64(0)], np.uint64(1) << np.arange(BITS, dtype=np.uint64))).view(np.int64)
        near, owner = np.bitwise_xor(fps[:, None], bits[None, :]).ravel(), np.repeat(np.arange(n), BITS + 1)
        order = np.argsort(near, kind="stable")
        same = np.flatnonzero(near[order][1:] == near[order][:-1])
        pairs = zip(owner[order[same + 1]].tolist(), owner[order[same]].tolist(), strict=True)
        for i, j in pairs:
            x, y = root(i), root(j)
            if x != y:
                parent[x] = y
                edges.append((int(fps[i]), int(fps[j])))
        return edges
    for i in range(1, n):
        for j in np.flatnonzero(np.bitwise_count(np.bitwise_xor(fps[:i], fps[i])) <= radius).tolist():
            x, y = root(i), root(j)
            if x != y:
                parent[x] = y
                edges.append((int(fps[i]), int(fps[j])))
    return edges


def link_fingerprints(distinct: DataFrame, radius: int = 2, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of fingerprints within radius.

    Buckets of up to split_rows fingerprints, and those beyond the list of hot keys, are compared inside a task. The
    few larger ones take another exact way: two fingerprints are within 2 bits just when they share a neighbour at one
    bit, so each is sent to its 65 neighbours and meets at most 64 others there.
    """
    masks = covering_masks(radius)
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("mask", "masked")).withColumn("bucket", F.xxhash64("mask", "masked"))
    hot = hot_keys(keyed, "bucket", split_rows) if radius == 2 else []

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [e for fps in pdf["fps"] for e in links_in_bucket(np.asarray(fps, np.int64), radius)]
            yield pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    few = distinct.sparkSession.createDataFrame(hot or [(0, 0)], "hot long, n long").where("n > 0")  # 4 x partitions at most
    small = keyed.join(F.broadcast(few), F.col("bucket") == F.col("hot"), "left_anti") if hot else keyed
    edges = small.groupBy("mask", "masked").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps").mapInPandas(compare, "a long, b long")
    if hot:
        crowded = keyed.join(F.broadcast(few), F.col("bucket") == F.col("hot"), "left_semi").select("fp").distinct()
        near = crowded.select("fp", F.explode(F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit((1 << i) - (1 << 64 if i == 63 else 0))) for i in range(BITS)])).alias("at"))
        met = near.groupBy("at").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)  # 65 at most
        edges = edges.unionByName(met.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a != b"))
    return edges


def near_duplicates(docs: DataFrame, radius: int = 2, words_per_shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", split_rows: int = SPLIT_ROWS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    component_id is the smallest identifier reachable through links of at most radius differing bits. Copies share a
    fingerprint, so links are sought between distinct fingerprints only. Null and empty texts, and texts without
    words, have fingerprint zero and link like any other; texts are read whole, however long. A row without an identifier gets its component's id, null if
    no member has one. Repeated rows are returned each; an empty table gives an empty result; other columns of docs
    play no part.
    """
    prints = cut(fingerprints(docs, id_col, text_col, words_per_shingle))
    smallest = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(link_fingerprints(smallest.select("fp"), radius, split_rows))
    of = smallest.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    groups = of.groupBy("root").agg(F.min("least").alias("component_id"))
    named = cut(of.join(groups, "root").select(F.col("fp").alias("of_fp"), "component_id"))
    return prints.join(named, F.col("fp") == F.col("of_fp")).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

"""Approximate nearest neighbours by inner product over balanced posting lists.

Vectors get one more component that makes their norms equal, so that the largest inner product is the smallest
distance. Centroids are fitted on a bounded sample and split until no list is far above the mean; a neighbour graph
over them, held in memory, finds the nearest ones. Boundary vectors are replicated to several lists. A query reads the
lists whose centroids are not much farther than its nearest one, and more while these hold fewer vectors than it
wants. The ratio is calibrated on the sample: the smallest one at which its nearest neighbours, found by brute force,
are reached. Where vectors form clusters it is small; where they have no structure, as few lists can be left out as
the recall allows. Lists and their queries are cut into blocks of bounded size, so no task grows with a list.

Of equal vectors only the k + 1 with the smallest identifiers can be neighbours, so only they are indexed.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import cut, partitions

#: Vectors at most that centroids are fitted on: those of smallest hash of the identifier.
SAMPLE_ROWS = 16_384
#: Mean vectors in a list, and lists at most before they are split (a list needs some sampled vectors).
LIST_ROWS, MOST_LISTS = 128, 1024
#: A list of more than this many times the mean of the sample is split.
FULL = 2.5
#: Vectors and queries at most in one block of a list; smaller lists share a block of about as many.
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 8192
#: Queries that are scored at once.
BATCH = 64
#: A vector also joins lists up to this much farther than its nearest, REPLICAS in all at most.
CLOSURE, REPLICAS = 1.08, 3
#: The share of the sample's nearest neighbours that the calibrated ratio reaches, and the queries that calibrate it.
RECALL, PROBES = 0.95, 512
#: Neighbours of a centroid in the graph, and the width of a search.
DEGREE, BEAM = 24, 64


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (-2 * (x @ c.T) + (c**2).sum(axis=1)).argmin(axis=1)


def balanced_centroids(x: np.ndarray, lists: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """Centroids of x by k-means; then the fullest lists are split in two until none holds over FULL times the mean.

    Lists of equal vectors can't be split and stay; at most twice as many lists come out as were asked for.
    """
    rng = np.random.default_rng(seed)
    if len(x) <= lists:
        return np.unique(x, axis=0)

    def mean_of(own: np.ndarray, c: np.ndarray) -> np.ndarray:
        order = np.argsort(own, kind="stable")
        used, first = np.unique(own[order], return_index=True)
        out = c.copy()
        out[used] = np.add.reduceat(x[order], first, axis=0) / np.diff(np.append(first, len(x)))[:, None]
        return out

    c = x[rng.choice(len(x), lists, replace=False)].copy()
    for _ in range(rounds):
        c = mean_of(_nearest(x, c), c)
    whole: set[int] = set()
    while len(c) < 2 * lists:
        own = _nearest(x, c)
        size = np.bincount(own, minlength=len(c))
        full = [i for i in np.argsort(-size).tolist() if size[i] > FULL * len(x) / lists and i not in whole][: 2 * lists - len(c)]
        if not full:
            break
        for i in full:
            members = x[own == i]
            far = members[((members - c[i]) ** 2).sum(axis=1).argmax()]
            two = np.stack([members[((members - far) ** 2).sum(axis=1).argmax()], far])
            for _ in range(4):
                side = _nearest(members, two)
                if side.min() == side.max():
                    break
                two = np.stack([members[side == 0].mean(axis=0), members[side == 1].mean(axis=0)])
            if (two[0] == two[1]).all():
                whole.add(i)
            else:
                c[i] = two[0]
                c = np.vstack([c, two[1]])
    return c


class CentroidGraph:
    """A graph that joins each centroid to its nearest ones, both ways; search() walks it from a few entries."""

    def __init__(self, centroids: np.ndarray, degree: int = DEGREE):
        self.c = centroids
        n = len(centroids)
        d = (centroids**2).sum(axis=1)[:, None] - 2 * centroids @ centroids.T + (centroids**2).sum(axis=1)[None, :]
        near = np.argsort(d, axis=1, kind="stable")[:, 1 : degree + 1] if n > 1 else np.zeros((n, 0), int)
        links: list[set[int]] = [set(r.tolist()) for r in near]
        for i, r in enumerate(near):
            for j in r.tolist():
                links[j].add(i)
        # a ring keeps the graph in one piece
        self.links = [np.array(sorted(s | ({(i + 1) % n} - {i})), int) for i, s in enumerate(links)]
        self.entries = np.linspace(0, n - 1, min(n, 8)).astype(int)

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search: up to width centroids near q and their distances, nearest first."""
        seen = np.zeros(len(self.c), bool)
        seen[self.entries] = True
        d = np.sqrt(((self.c[self.entries] - q) ** 2).sum(axis=1))
        open_ = list(zip(d.tolist(), self.entries.tolist(), strict=True))
        heapq.heapify(open_)
        best = [(-a, b) for a, b in open_]
        heapq.heapify(best)
        while open_:
            dist, at = heapq.heappop(open_)
            if len(best) >= width and dist > -best[0][0]:
                break
            new = self.links[at][~seen[self.links[at]]]
            if not len(new):
                continue
            seen[new] = True
            for a, b in zip(np.sqrt(((self.c[new] - q) ** 2).sum(axis=1)).tolist(), new.tolist(), strict=True):
                if len(best) < width or a < -best[0][0]:
                    heapq.heappush(open_, (a, b))
                    heapq.heappush(best, (-a, b))
                    if len(best) > width:
                        heapq.heappop(best)
        out = sorted((-a, b) for a, b in best)
        return np.array([b for _, b in out], int), np.array([a for a, _ in out])


def calibrated(x: np.ndarray, points: np.ndarray, centroids: np.ndarray, k: int, rows: int, recall: float = RECALL, probes: int = PROBES) -> float:
    """The ratio at which a share recall of the sample's nearest neighbours lies in lists that are read.

    x: the sample of rows vectors; points: the same vectors lifted. Of a vector's k nearest in the whole table about
    k * len(x) / rows are in the sample, and they are its nearest there, so these are the ones to be reached.
    """
    k = max(1, math.ceil(k * len(x) / max(rows, len(x))))
    if len(x) < 2 or len(centroids) < 2:
        return 1.0
    asks = x[:probes]
    scores = asks @ x.T
    scores[np.arange(len(asks)), np.arange(len(asks))] = -np.inf
    near = np.argsort(-scores, axis=1)[:, : min(k, len(x) - 1)]
    used, place = np.unique(near, return_inverse=True)

    def distances(p: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((p**2).sum(axis=1)[:, None] - 2 * (p @ centroids.T) + (centroids**2).sum(axis=1)[None, :], 0))

    to_query, to_vector = distances(np.hstack([asks, np.zeros((len(asks), 1))])), distances(points[used])
    best = np.argsort(to_vector, axis=1)[:, :REPLICAS]
    held = np.take_along_axis(to_vector, best, axis=1)
    lists = np.where(held <= CLOSURE * held[:, :1], best, best[:, :1])[place.reshape(near.shape)]  # query, neighbour, list
    needed = np.take_along_axis(to_query, lists.reshape(len(asks), -1), axis=1).reshape(lists.shape).min(axis=2)
    return float(max(1.0, np.quantile(needed / np.maximum(to_query.min(axis=1), 1e-12)[:, None], recall)))


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vec (doubles) of the vectors that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    plain = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("vec")).where("vec_id IS NOT NULL AND vec IS NOT NULL")
    good = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    return plain.where(good)


NOTHING = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})


def cut_to_best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k rows of largest score for each query, each vector once; ties to the smaller vec_id."""
    q, v, s = (found[c].to_numpy() for c in ("query_id", "vec_id", "score"))
    order = np.lexsort((-s, v, q))
    first = np.ones(len(order), bool)
    first[1:] = (q[order][1:] != q[order][:-1]) | (v[order][1:] != v[order][:-1])
    keep = order[first]
    keep = keep[np.lexsort((v[keep], -s[keep], q[keep]))]
    starts = np.flatnonzero(np.diff(q[keep], prepend=q[keep][0] - 1)) if len(keep) else np.zeros(0, int)
    place = np.arange(len(keep)) - np.repeat(starts, np.diff(np.append(starts, len(keep))))
    keep = keep[place < k]
    return pd.DataFrame({"query_id": q[keep], "vec_id": v[keep], "score": s[keep]})


def best_of(part: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best candidates of one list for each of its queries, by matrix products in batches of queries."""
    asks, ids, v = part["q"].to_numpy(bool), part["vec_id"].to_numpy(np.int64), np.stack(part["vec"].array)
    qi, qv, ci, cv = ids[asks], v[asks], ids[~asks], v[~asks]
    if not len(qi) or not len(ci):
        return NOTHING
    out = []
    for at in range(0, len(qi), BATCH):
        rough = qv[at : at + BATCH] @ cv.T
        rough[qi[at : at + BATCH, None] == ci[None, :]] = -np.inf
        bar = np.partition(rough, len(ci) - k, axis=1)[:, len(ci) - k] if len(ci) > k else np.full(len(rough), -np.inf)
        # a little below the bar, as products may differ in their last digit by the order of sums
        row, col = np.nonzero((rough >= (bar - 1e-9 * np.maximum(1.0, np.abs(bar)))[:, None]) & (rough > -np.inf)) if len(ci) > k else np.nonzero(rough > -np.inf)
        exact = (cv[col] * qv[at + row]).sum(axis=1)  # the same order of sums whatever the block
        out.append(cut_to_best(pd.DataFrame({"query_id": qi[at + row], "vec_id": ci[col], "score": exact}), k))
    return pd.concat(out)


def search(
    vectors: DataFrame,
    is_query: str,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    list_rows: int = LIST_ROWS,
    prune: float | None = None,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k found vectors of largest inner product for each query.

    is_query: a condition on vec_id (as SQL) that says which vectors are queries; a query isn't its own candidate.
    prune: the ratio of distances up to which lists are read; calibrated if None.
    Scores are inner products of the original vectors in double precision; ties go to the smaller vec_id. Vectors that
    are null, zero or hold null or non-finite components take no part, nor do rows without an identifier, nor vectors
    of another length than most (of equally many, the shorter). Of repeated identifiers, the candidate with the larger
    score counts. Fewer than k candidates give fewer rows; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    usable = _usable(vectors, id_col, vector_col)
    lengths = usable.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)).alias("norm2")).orderBy(F.col("n").desc(), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], schema)
    dim, n, top = int(lengths[0]["d"]), int(lengths[0]["n"]), float(lengths[0]["norm2"])
    usable = usable.where(F.size("vec") == dim)
    # of equal vectors, those that can be among the k nearest beside the query itself; cut down before they are sent
    alike = Window.partitionBy("vec").orderBy("vec_id")
    once = usable.dropDuplicates(["vec_id", "vec"])
    stored = once.withColumn("same", F.row_number().over(alike)).where(F.col("same") <= k + 1).select("vec_id", "vec")
    lists = int(min(MOST_LISTS, max(1, n // list_rows)))
    sampled = stored.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).collect()  # SAMPLE_ROWS vectors at most
    x = np.array([r["vec"] for r in sampled])

    def lifted(v: np.ndarray) -> np.ndarray:
        return np.hstack([v, np.sqrt(np.maximum(top - (v**2).sum(axis=1, keepdims=True), 0))])

    points = lifted(x)
    graph = CentroidGraph(balanced_centroids(points, lists))
    ratio = calibrated(x, points, graph.c, k, n) if prune is None else prune
    shared = spark.sparkContext.broadcast(graph)  # 2 x MOST_LISTS centroids at most

    def route(batches: Iterator[pd.DataFrame], held: dict[int, int]) -> Iterator[pd.DataFrame]:
        g = shared.value
        sizes = np.array([held.get(c, 0) for c in range(len(g.c))], np.int64)
        for pdf in batches:
            v = np.stack(pdf["vec"].array) if len(pdf) else np.zeros((0, dim))
            rows: list[tuple[int, int]] = []
            asks = pdf["q"].to_numpy(bool)
            points = np.where(asks[:, None], np.hstack([v, np.zeros((len(v), 1))]), lifted(v))
            for i in range(len(v)):
                if asks[i]:
                    # every list within the ratio, and enough for k others: the search widens until it sees one beyond
                    width = BEAM
                    while True:
                        found, d = g.search(points[i], width)
                        enough = np.searchsorted(np.cumsum(sizes[found]), k + 1) + 1
                        if len(found) == len(g.c) or len(found) < width or (d[-1] > ratio * d[0] and enough <= len(found)):
                            break
                        width *= 2
                    rows.extend((i, int(c)) for c in found[: max(int((d <= ratio * d[0]).sum()), enough)])
                else:
                    found, d = g.search(points[i], 16)
                    rows.extend((i, int(c)) for c in found[:REPLICAS][d[:REPLICAS] <= CLOSURE * d[0]])
            take = np.array([r[0] for r in rows], int)
            out = pdf.iloc[take].reset_index(drop=True)
            out["list"] = np.array([r[1] for r in rows], np.int64)
            out["home"] = np.concatenate(([True], take[1:] != take[:-1])) if len(take) else np.zeros(0, bool)
            yield out

    def placed(rows: DataFrame, held: dict[int, int]) -> DataFrame:
        rows = rows.repartition(max(partitions(spark), 1))  # routing is the costly part, so it is spread evenly
        fields = [*rows.schema.fields, T.StructField("list", T.LongType()), T.StructField("home", T.BooleanType())]
        return cut(rows.mapInPandas(lambda batches: route(batches, held), T.StructType(fields)))

    stored = placed(stored.withColumn("q", F.lit(False)), {})
    # each identifier in one list only, so that lists' sizes add up to distinct candidates; 2 x MOST_LISTS rows at most
    homes = stored.where("home").groupBy("vec_id").agg(F.min("list").alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    asked = placed(usable.where(is_query).select("vec_id", "vec", F.lit(True).alias("q")), {r["list"]: r["n"] for r in homes.collect()})
    routed = stored.unionByName(asked).drop("home")
    sizes = routed.groupBy("list", "q").agg(F.count(F.lit(1)).alias("n"))  # two rows for each list
    wide = sizes.groupBy("list").agg(F.max(F.when(~F.col("q"), F.col("n"))).alias("nv"), F.max(F.when(F.col("q"), F.col("n"))).alias("nq")).where("nv IS NOT NULL AND nq IS NOT NULL")
    wide = wide.select(F.col("list").alias("l"), F.ceil(F.col("nv") / BLOCK_ROWS).cast("int").alias("bv"), F.ceil(F.col("nq") / BLOCK_QUERIES).cast("int").alias("bq"))
    cells = routed.join(F.broadcast(wide), F.col("list") == F.col("l"))  # 2 x MOST_LISTS rows at most
    mine = F.pmod(F.xxhash64("vec_id"), F.when(F.col("q"), F.col("bq")).otherwise(F.col("bv")))
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("q"), F.col("bv")).otherwise(F.col("bq")) - 1))
    cells = cells.withColumn("own", mine).withColumn("across", other)
    blocks = max(1, -(-n // BLOCK_ROWS))
    split = F.concat_ws("/", "list", F.when(F.col("q"), F.col("across")).otherwise(F.col("own")), F.when(F.col("q"), F.col("own")).otherwise(F.col("across")))
    whole = (F.col("bv") == 1) & (F.col("bq") == 1)
    cells = cells.select(F.when(whole, F.concat(F.lit("-"), (F.col("list") % blocks).cast("string"))).otherwise(split).alias("cell"), "list", "vec_id", "vec", "q")

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        """The k best of the cell's candidates for each of its queries, each query against the lists that it reads."""
        out = [best_of(part, k) for _, part in pdf.groupby("list", sort=True)]
        return cut_to_best(pd.concat(out), k) if out else NOTHING

    found = cells.groupBy("cell").applyInPandas(score, "query_id long, vec_id long, score double")
    # replicas meet here: k rows of each list read, and of those one for each vector
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

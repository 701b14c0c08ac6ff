"""Connected components by rounds of hooking and pointer jumping, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, few


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node of edges; root is the component's smallest node.

    edges: two columns of one orderable type. Loops, repeated and reversed edges are allowed, rows with a null aren't
    edges. Each round every node with a smaller neighbour hooks to the smallest; the forest is flattened by pointer
    jumping and edges move to the roots. Two rounds leave at most half of the nodes: a root that nothing hooked to has
    only neighbours that hooked to smaller nodes, so it has a smaller neighbour in the next round and hooks itself; the
    other roots have two nodes or more in their trees. So rounds are logarithmic, on a star or a chain of any order
    too, and jumps in a round as well. Joins read written tables on both sides, so adaptive execution can split the edges of a
    hot root; no row stands for more than one edge. Edges are counted, so that small tables are few files.
    """
    live = cut(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    rows = most = live.count()
    levels: list[DataFrame] = []
    while rows:
        forest = cut(few(live.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("parent")), rows))
        while True:
            up = forest.select(F.col("node").alias("n2"), F.col("parent").alias("p2"))
            jumped = forest.join(up, F.col("parent") == F.col("n2"), "left").select("node", F.coalesce("p2", "parent").alias("parent"), F.col("p2").isNotNull().alias("moved"))
            jumped = cut(few(jumped, rows))
            forest = jumped.select("node", "parent")
            if jumped.where("moved").isEmpty():
                break
        levels.append(forest)
        moved = _relabel(_relabel(live, forest, "hi"), forest, "lo").where("hi != lo")
        live = cut(few(moved.select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")).distinct(), rows))
        rows = live.count()
    if not levels:
        empty = edges.select(F.col(a).alias("node"), F.col(a).alias("root")).limit(0)
        return empty
    out = levels[-1].select("node", F.col("parent").alias("root"))
    for level in reversed(levels[:-1]):
        top = out.select(F.col("node").alias("n2"), F.col("root").alias("r2"))
        out = level.join(top, F.col("parent") == F.col("n2"), "left").select("node", F.coalesce("r2", "parent").alias("root")).unionByName(out)
    roots = out.select(F.col("root").alias("node"), "root").distinct()
    return cut(few(out.unionByName(roots), 2 * most))


def _relabel(edges: DataFrame, forest: DataFrame, end: str) -> DataFrame:
    to = forest.select(F.col("node").alias("n2"), F.col("parent").alias("p2"))
    other = "lo" if end == "hi" else "hi"
    return edges.join(to, F.col(end) == F.col("n2"), "left").select(other, F.coalesce("p2", end).alias(end))

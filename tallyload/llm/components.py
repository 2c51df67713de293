"""Connected components of an edge list, as rounds of joins (large star, small star).

Each round is two joins and two aggregations over the edges; no component is
ever gathered in one task.  Every hub's minimum is pre-aggregated, and the join
that hands it to the hub's neighbours is a plain equi-join, which AQE can split
when one hub holds a large share of the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyload.llm.common import Scratch


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).head()
    return r[0], r[1]


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "cc", max_rounds: int = 60) -> DataFrame:
    """``edges(a long, b long)`` to ``(node, component)``; component is the smallest node reachable.

    Only nodes with an edge to another node are returned.  Nulls and self edges
    are ignored, repeated and reversed edges count once.  Raises if the rounds
    do not settle (they need a number logarithmic in the component size).
    """
    cur = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    cur = scratch.table(cur, f"{name}-0")
    seen = _fingerprint(cur)
    for i in range(1, max_rounds + 1):
        if seen[0] == 0:
            break
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = (both.where("b > a").join(low, F.col("a") == F.col("k"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        mins = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
        small = (large.join(mins, F.col("a") == F.col("k")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(mins.select(F.col("k").alias("a"), F.col("m").alias("b"))).distinct())
        nxt = scratch.table(small, f"{name}-{i}")
        now = _fingerprint(nxt)
        scratch.drop(f"{name}-{i - 1}")
        cur = nxt
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("connected components did not settle")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

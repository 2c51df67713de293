"""Operator 2: approximate nearest neighbours by stable projections, kd-trees and a chi-square stopping test.

The largest inner product becomes the smallest Euclidean distance with one more
component: a row x gets sqrt(M*M - |x|**2), a query 0, where M is the largest
length of a row.  Rows are projected by a Gaussian (2-stable) matrix to ``m``
numbers, so the squared projected distance is the squared distance times a
chi-square variable with m degrees of freedom.  Projected neighbours are taken
in order of distance and verified on the original vectors until, for the k-th
best distance d so far, a row at distance d would have been projected closer
than the next one with probability ``p``.

A kd-tree over a bounded sample cuts the projected space into cells; every row
is indexed in its cell, whose shards have bounded sizes and hold a kd-tree of
their own.  A query first searches its home cell; the bound found there and the
same test then decide, by the cells' boxes, which other cells it visits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyload.llm.common import Scratch, pick
from tallyload.llm.embeddings import usable


def chi_square_quantile(p: float, m: int) -> float:
    """x with P(chi-square with an even number m of degrees of freedom <= x) = p."""
    def cdf(x):
        return 1 - math.exp(-x / 2) * sum((x / 2) ** j / math.factorial(j) for j in range(m // 2))
    lo, hi = 0.0, 1.0
    while cdf(hi) < p:
        hi *= 2
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return hi


def projection(dim: int, m: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim, m]).standard_normal((dim + 1, m))


def project_rows(x: np.ndarray, longest: float, m: int, seed: int) -> np.ndarray:
    last = np.sqrt(np.maximum(longest**2 - np.einsum("ij,ij->i", x, x), 0.0))
    return np.column_stack([x, last]) @ projection(x.shape[1], m, seed)


def project_queries(x: np.ndarray, m: int, seed: int) -> np.ndarray:
    return x @ projection(x.shape[1], m, seed)[:-1]


def kd_cells(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Leaves of a kd-tree as lists of rows: halves along the widest side until ``size`` rows or one place are left."""
    todo, out = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        own = points[rows]
        width = own.max(axis=0) - own.min(axis=0)
        if len(rows) <= size or not width.max() > 0:
            out.append(rows)
            continue
        axis = int(np.argmax(width))
        order = np.argsort(own[:, axis], kind="stable")
        todo += [rows[order[len(rows) // 2:]], rows[order[:len(rows) // 2]]]
    return out


class Splits:
    """Top of the kd-tree: every point of the space is in one cell; a cell's box is open where nothing cuts it."""

    def __init__(self, sample: np.ndarray, cells: int):
        m = sample.shape[1]
        self.axis, self.cut, self.child = [], [], []
        self.low, self.high = [], []
        self._grow(np.arange(len(sample)), sample, max(1, cells), np.full(m, -np.inf), np.full(m, np.inf))
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _grow(self, rows, sample, cells, low, high) -> int:
        width = np.ptp(sample[rows], axis=0) if len(rows) else np.zeros(sample.shape[1])
        if cells <= 1 or not width.max() > 0:
            self.low.append(low)
            self.high.append(high)
            return -len(self.low)  # cell c is -1 - c
        axis = int(np.argmax(width))
        values = np.sort(sample[rows, axis])
        cut = values[len(values) // 2]
        if cut == values[0]:
            cut = values[values > cut][0]
        node = len(self.axis)
        self.axis.append(axis)
        self.cut.append(cut)
        self.child.append(None)
        left_high, right_low = high.copy(), low.copy()
        left_high[axis] = right_low[axis] = cut
        below = sample[rows, axis] < cut
        self.child[node] = (self._grow(rows[below], sample, cells // 2, low, left_high),
                            self._grow(rows[~below], sample, cells - cells // 2, right_low, high))
        return node

    def cell(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        todo = [(0 if self.axis else -1, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
                continue
            below = points[rows, self.axis[node]] < self.cut[node]
            todo += [(self.child[node][0], rows[below]), (self.child[node][1], rows[~below])]
        return out

    def squared(self, point: np.ndarray) -> np.ndarray:
        """Squared distance of a point to every cell's box."""
        away = np.maximum(np.maximum(self.low - point, point - self.high), 0.0)
        return (away * away).sum(axis=1)


def search_shard(ids, x, proj, qid, q, qproj, bound, k: int, longest: float, factor: float, leaf: int) -> pd.DataFrame:
    """The k best rows of one shard for each query, largest inner product first, ties to the smaller id.

    ``bound``: the k-th best inner product that a query has found elsewhere, or -inf.
    """
    leaves = kd_cells(proj, leaf)
    order = np.concatenate(leaves)
    ids, x = ids[order], x[order]
    starts = np.concatenate(([0], np.cumsum([len(r) for r in leaves])))
    low = np.array([proj[r].min(axis=0) for r in leaves])
    high = np.array([proj[r].max(axis=0) for r in leaves])
    out_q, out_r, out_s = [], [], []
    for i in range(len(qid)):
        away = np.maximum(np.maximum(low - qproj[i], qproj[i] - high), 0.0)
        far = (away * away).sum(axis=1)
        nearest = np.argsort(far, kind="stable")
        base = longest**2 + float(q[i] @ q[i])
        rows, scores, best, at, step = [], [], bound[i], 0, 1
        while at < len(nearest):
            limit = factor * max(base - 2 * best, 0.0) if best > -np.inf else np.inf
            if far[nearest[at]] > limit:  # the stopping test holds for this leaf and all later ones
                break
            lot = nearest[at:at + step]
            lot = lot[far[lot] <= limit]
            at += len(lot)
            step *= 2
            got = np.concatenate([np.arange(starts[c], starts[c + 1]) for c in lot])
            got = got[ids[got] != qid[i]]
            rows.append(got)
            scores.append(x[got] @ q[i])
            s = np.concatenate(scores)
            if len(s) >= k:
                best = max(best, float(np.partition(s, len(s) - k)[len(s) - k]))
        if not rows:
            continue
        r, s = np.concatenate(rows), np.concatenate(scores)
        if len(s) > k:  # keep all that may tie with the k-th, then score them alike and exactly
            edge = np.partition(s, len(s) - k)[len(s) - k]
            keep = s >= edge - 1e-9 * max(1.0, abs(edge))
            r = r[keep]
        s = np.einsum("ij,j->i", x[r], q[i])
        r, s = r[s >= bound[i]], s[s >= bound[i]]  # below it, k better ones are known already
        top = np.lexsort((ids[r], -s))[:k]
        out_q.append(np.full(len(top), qid[i]))
        out_r.append(ids[r[top]])
        out_s.append(s[top])
    if not out_q:
        return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
    return pd.DataFrame({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_r), "score": np.concatenate(out_s)})


def nearest_neighbours(vectors: DataFrame, k: int = 20, query_every: int = 20, m: int = 8, p: float = 0.98, shard_rows: int = 4096,
                       query_rows: int = 4096, sample_rows: int = 16384, seed: int = 11, id_col: str = "vec_id",
                       vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k rows with the largest inner product found for each query.

    Queries are the rows whose id is divisible by ``query_every``; a row is no
    candidate for its own id.  Null, zero and non-finite vectors and null ids
    take no part, and vectors of another length than the query's are no
    candidates.  Repeated rows are candidates of their own, and a repeated query
    id is one query (by its smallest vector).  With fewer than k candidates all are returned.
    ``sample_rows`` bounds the rows that the top of the kd-tree is fitted on; all
    rows are indexed.  Empty tables give empty results; other columns are ignored.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "neighbours")
    v = pick(vectors, vec_id=id_col, embedding=vector_col).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    v = v.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).withColumn("dim", F.size("embedding"))
    squares = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    stats = v.groupBy("dim").agg(F.sqrt(F.max(squares)).alias("longest"), F.count("*").alias("n")).collect()  # one row a vector length
    longest = {r["dim"]: r["longest"] for r in stats}
    factor = chi_square_quantile(p, m)
    splits: dict[int, Splits] = {}
    for r in stats:
        some = v.where(F.col("dim") == r["dim"]).orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("embedding").collect()
        cells = min(max(1, -(-2 * r["n"] // shard_rows)), max(1, sample_rows // 16))
        splits[r["dim"]] = Splits(project_rows(np.array([x[0] for x in some]), r["longest"], m, seed), cells)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, rows in batch.groupby("dim"):
                x = np.vstack(rows["embedding"].to_numpy())
                proj = project_rows(x, longest[dim], m, seed)
                yield pd.DataFrame({"dim": rows["dim"], "cell": splits[dim].cell(proj), "vec_id": rows["vec_id"],
                                    "x": [r.tobytes() for r in x], "proj": [r.tobytes() for r in proj]})

    def visits(home: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for dim, rows in batch.groupby("dim"):
                    x = np.vstack(rows["embedding"].to_numpy())
                    proj = project_queries(x, m, seed)
                    top = splits[dim]
                    own = top.cell(proj)
                    cells = [[c] for c in own]
                    if not home:
                        reach = factor * np.maximum(longest[dim]**2 + np.einsum("ij,ij->i", x, x) - 2 * rows["bound"].to_numpy(), 0.0)
                        near = [np.flatnonzero(top.squared(pt) <= r) for pt, r in zip(proj, reach)]
                        cells = [c[c != o].tolist() for c, o in zip(near, own)]
                    yield pd.DataFrame({"dim": rows["dim"], "query_id": rows["vec_id"], "bound": rows["bound"], "cells": cells,
                                        "q": [r.tobytes() for r in x], "qproj": [r.tobytes() for r in proj]})
        return run

    indexed = scratch.table(v.mapInPandas(index, "dim int, cell long, vec_id long, x binary, proj binary"), "index")
    shards = indexed.groupBy("dim", "cell").agg(F.count("*").alias("n")).select(
        "dim", "cell", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards"))  # one row a cell
    queries = v.where(F.col("vec_id") % query_every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    queries = scratch.table(queries.withColumn("dim", F.size("embedding")), "queries")
    lots = max(1, -(-queries.count() // query_rows))
    points = indexed.join(shards, ["dim", "cell"]).select(
        "dim", "cell", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("lot"), "vec_id", "x", "proj")

    def search(key: tuple, rows: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        def matrix(col):
            return np.frombuffer(b"".join(col), np.float64).reshape(len(col), -1)
        if not len(rows) or not len(qs):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        return search_shard(rows["vec_id"].to_numpy(), matrix(rows["x"]), matrix(rows["proj"]), qs["query_id"].to_numpy(),
                            matrix(qs["q"]), matrix(qs["qproj"]), qs["bound"].to_numpy(), k, longest[key[0]], factor, 128)

    def searched(qs: DataFrame, home: bool) -> DataFrame:
        routed = qs.mapInPandas(visits(home), "dim int, query_id long, bound double, cells array<long>, q binary, qproj binary")
        routed = (routed.withColumn("cell", F.explode("cells")).drop("cells").join(shards, ["dim", "cell"])
                  .withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
                  .withColumn("lot", F.pmod(F.xxhash64("query_id"), F.lit(lots)).cast("int")).drop("shards"))
        keys = ["dim", "cell", "shard", "lot"]
        return points.groupBy(*keys).cogroup(routed.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score double")

    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)

    home = scratch.table(searched(queries.withColumn("bound", F.lit(float("-inf"))), True), "home")
    bounds = best(home).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("bound"))
    rest = queries.join(bounds, "vec_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    return best(home.unionByName(searched(rest, False))).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

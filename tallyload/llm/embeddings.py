"""Operator 1: embedding near-duplicates by int8 tile products with error bounds.

Vectors are scaled to length 1 and rounded to 8-bit integers with a scale of
their own.  The product of two integer tiles is exact, so for a pair the true
cosine differs from ``scale * scale * product`` by at most
``ex * (1 + ey) + ey``, where ex and ey are the lengths of the two rounding
errors, known for each vector.  Only pairs that this bound does not exclude are
computed again in double precision.

Equal vectors are one class first, so a vector that fills a third of the table
costs one row.  Classes are dealt by hash into tiles of bounded size, a tile
meets every other tile once, and one task holds two tiles.  A tile pair returns
link counts and a spanning forest of its links, never the links themselves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyload.llm.common import Scratch, pick
from tallyload.llm.components import connected_components
from tallyload.llm.forest import Forest

_ROWS = 512  # rows of a tile multiplied at a time
_PAIRS = 65_536  # pairs computed again at a time
_ROUNDING = 1e-9  # far above the rounding of a product of unit vectors
_SLACK = 1e-6  # far above the rounding of the bound itself


def usable(vector: Column) -> Column:
    """Whether a vector is not null, not zero and has finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, without overflow for large components."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def quantised(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """8-bit integers (held as float32), scale and length of the rounding error of each unit vector."""
    scale = np.abs(u).max(axis=1) / 127.0
    q = np.rint(u / scale[:, None])
    err = u - q * scale[:, None]
    return q.astype(np.int8).astype(np.float32), scale, np.sqrt(np.einsum("ij,ij->i", err, err))


def products(qa: np.ndarray, qb: np.ndarray) -> np.ndarray:
    """Exact integer products: sums of 1024 terms below 2**14 stay below 2**24, the limit of float32."""
    if qa.shape[1] <= 1024:
        return qa @ qb.T
    return sum((qa[:, i:i + 1024] @ qb[:, i:i + 1024].T).astype(np.float64) for i in range(0, qa.shape[1], 1024))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings them near 1: exact, and safe from overflow."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def cosines(x: np.ndarray, norm: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot product over the product of lengths of each pair of rows, in double precision."""
    out = np.empty(len(a))
    for i in range(0, len(a), _PAIRS):
        p, q = a[i:i + _PAIRS], b[i:i + _PAIRS]
        out[i:i + _PAIRS] = np.einsum("ij,ij->i", x[p], x[q]) / (norm[p] * norm[q])
    return out


def tile_links(ids: np.ndarray, weights: np.ndarray, x: np.ndarray, first: int, threshold: float) -> pd.DataFrame:
    """Link counts and forest of a tile pair: rows before ``first`` against those after it (all pairs if it is 0).

    Whatever the tile, a pair at the threshold is decided by ``cosines`` of the
    vectors as they are, up to a power of two.
    """
    u, x = unit(x), scaled(x)
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    q, scale, err = quantised(u)
    links, forest = np.zeros(len(ids), np.int64), Forest(len(ids))
    b0 = first  # with one tile, b0 = 0 and only j > i counts
    for i in range(0, first or len(ids), _ROWS):
        j = min(i + _ROWS, first or len(ids))
        lo = b0 or i
        # |cos - approx| <= ex * (1 + ey) + ey
        bound = err[i:j, None] * (1 + err[None, lo:]) + err[None, lo:]
        near = products(q[i:j], q[lo:]) * (scale[i:j, None] * scale[None, lo:]) >= threshold - bound - _SLACK
        if not first:
            near &= np.arange(lo, len(ids))[None, :] > np.arange(i, j)[:, None]
        if near.mean() > 0.02:  # many: a product of the tile decides those that its rounding cannot reach
            over = u[i:j] @ u[lo:].T - threshold
            sure = near & (over > _ROUNDING)
            near &= np.abs(over) <= _ROUNDING
            sa, sb = np.nonzero(sure)
        else:
            sa = sb = np.zeros(0, np.int64)
        a, b = np.nonzero(near)
        keep = cosines(x, norm, a + i, b + lo) >= threshold
        a, b = np.concatenate([sa, a[keep]]) + i, np.concatenate([sb, b[keep]]) + lo
        links += np.bincount(a, weights[b], len(ids)).astype(np.int64) + np.bincount(b, weights[a], len(ids)).astype(np.int64)
        forest.add(a, b)
    hit = links > 0
    return pd.DataFrame({"node": ids[hit], "links": links[hit], "root": ids[forest.label[hit]]})


def _tile(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    x = np.vstack(rows["embedding"].to_numpy()).astype(np.float64)
    return pd.DataFrame({"dim": [key[0]], "tile": [key[1]], "ids": [rows["rep"].to_numpy().astype("<i8").tobytes()],
                         "weights": [rows["n"].to_numpy().astype("<i8").tobytes()],
                         "x": [x.astype("<f4").tobytes() if np.array_equal(x.astype("<f4"), x) else x.tobytes()]})


def _product(threshold: float):
    def run(key: tuple, tiles: pd.DataFrame) -> pd.DataFrame:
        dim, a, b = key
        tiles = tiles.sort_values("tile")
        ids = [np.frombuffer(x, "<i8") for x in tiles["ids"]]
        weights = [np.frombuffer(x, "<i8") for x in tiles["weights"]]
        x = [np.frombuffer(x, "<f4" if len(x) == 4 * dim * len(i) else "<f8").astype(np.float64).reshape(-1, dim)
             for x, i in zip(tiles["x"], ids)]
        if a != b and len(tiles) < 2:
            return pd.DataFrame({"node": ids[0][:0], "links": ids[0][:0], "root": ids[0][:0]})
        first = len(ids[0]) if a != b else 0
        return tile_links(np.concatenate(ids), np.concatenate(weights).astype(np.float64), np.vstack(x), first, threshold)
    return run


def embedding_neardup(vectors: DataFrame, threshold: float = 0.9, tile_rows: int = 4096, id_col: str = "vec_id",
                      vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row.

    Two vectors link if their cosine, in double precision, is at least
    ``threshold`` (above 0).  Null, zero and non-finite vectors and vectors of
    different lengths do not link; they are their own component.  Repeated rows
    are vectors of their own, of which the smallest id is kept; rows of one id
    share a component.  A row with a null id links with nothing, has no
    component and is not kept.  Empty tables give empty results.  Other columns
    are ignored.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    scratch = Scratch(vectors.sparkSession, "neardup")
    v = pick(vectors, vec_id=id_col, embedding=vector_col).withColumn("vec_id", F.col("vec_id").cast("long"))
    taking = F.col("vec_id").isNotNull() & usable(F.col("embedding"))
    reps = scratch.table(v.where(taking).groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "classes")
    tiles = max(1, -(-reps.count() // tile_rows))
    dealt = reps.select(F.size("embedding").alias("dim"), F.pmod(F.xxhash64("rep"), F.lit(tiles)).cast("int").alias("tile"),
                        "rep", "n", F.col("embedding").cast("array<double>").alias("embedding"))
    packed = scratch.table(dealt.groupBy("dim", "tile").applyInPandas(
        _tile, "dim int, tile int, ids binary, weights binary, x binary"), "tiles")
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    pairs = packed.withColumn("other", other).select("dim", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"),
                                                     "tile", "ids", "weights", "x")
    found = scratch.table(pairs.groupBy("dim", "a", "b").applyInPandas(_product(threshold), "node long, links long, root long"), "links")
    scratch.drop("tiles")
    components = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), scratch)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = (reps.join(links, reps["rep"] == links["node"], "left").drop("node")
               .join(components, F.col("rep") == components["node"], "left")
               .select(F.col("embedding").alias("e"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
                       F.coalesce("component", "rep").alias("component")))
    component = F.coalesce("component", "vec_id")
    linked = v.where(taking).join(classes, F.col("embedding") == F.col("e")).select(
        "vec_id", F.col("links").cast("long").alias("n_links"), component.alias("component_id"))
    # rows that take no part meet no class, so they share no key either
    others = v.where(~taking).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(others).select("vec_id", "n_links", "component_id", F.coalesce(
        F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))

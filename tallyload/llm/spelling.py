"""Operator 12: spelling variants by k-d trees over letter-count vectors.

One inserted letter adds one to one count of a word; one replaced letter takes
one from a count and adds one to another.  So near words are at most two apart
in the L1 distance of their letter counts, at most one up and one down, and
their lengths differ by at most one.

Words are points, by length.  A k-d tree for each length, fitted on a bounded
sample, deals all words of the length into cells.  For each pair of lengths (L
and L, L and L + 1) a word goes to every cell whose box its range reaches; the
others are pruned.  A cell's task builds a k-d tree over the cell's points,
prunes by boxes again, compares bitmaps of the counts in the leaves, and
verifies the order of letters.  A task returns counts and best words, never
pairs.

Roots are found by pointer jumping: joins of the table of forms with itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyload.llm.common import Scratch, pick

# The characters of a run, after A-Z are lower-cased.
_RUN = "[a-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_DIMS = 32  # 26 letters, and the others folded into 6, which never adds to a distance
_CELL = 16_384  # words of a cell
_CELLS = 4096  # cells of all trees; beyond that they grow
_SAMPLE = 64  # sampled words for each cell, the bound on what trees are fitted on
_LEAF = 64  # points of a leaf inside a cell
_BLOCK = 4_000_000  # elements compared at a time


class KdTree:
    """Splits of integer points; leaves hold the rows of the points that the tree was built on."""

    def __init__(self, x: np.ndarray, leaf_rows: int):
        self.nodes: list[tuple[int, int, int, int]] = []  # dimension, threshold, left, right; -1 and the leaf's number
        self.leaves: list[np.ndarray] = []
        self._grow(x, leaf_rows)

    def _grow(self, x: np.ndarray, leaf_rows: int) -> None:
        self.nodes.append((-1, 0, 0, 0))
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            split = self._split(x[rows]) if len(rows) > leaf_rows else None
            if split is None:
                self.nodes[node] = (-1, len(self.leaves), 0, 0)
                self.leaves.append(rows)
                continue
            dim, at = split
            low = x[rows, dim] <= at
            left = len(self.nodes)
            self.nodes[node] = (dim, at, left, left + 1)
            self.nodes += [(-1, 0, 0, 0)] * 2
            todo += [(left, rows[low]), (left + 1, rows[~low])]

    @staticmethod
    def _split(x: np.ndarray) -> tuple[int, int] | None:
        middle = np.sort(x, axis=0)[len(x) // 2]
        best = None
        for at in (middle, middle - 1):
            share = (x <= at).mean(axis=0)
            uneven = np.abs(share - 0.5)
            dim = int(uneven.argmin())
            if 0 < share[dim] < 1 and (best is None or uneven[dim] < best[0]):
                best = (uneven[dim], dim, int(at[dim]))
        return best[1:] if best else None

    def home(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            dim, at, left, right = self.nodes[node]
            if dim < 0:
                out[rows] = at
                continue
            low = x[rows, dim] <= at
            todo += [(left, rows[low]), (right, rows[~low])]
        return out

    def reach(self, x: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves whose box holds a point that is at most ``up`` more and ``down`` less than a query, with these queries."""
        start = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)), start, start, {}, {})]
        while todo:
            node, rows, ups, downs, low, high = todo.pop()
            if not len(rows):
                continue
            dim, at, left, right = self.nodes[node]
            if dim < 0:
                yield at, rows
                continue
            v = x[rows, dim]
            need = downs + np.maximum(v - at, 0) - np.maximum(v - high[dim], 0) if dim in high else downs + np.maximum(v - at, 0)
            ok = need <= down
            todo.append((left, rows[ok], ups[ok], need[ok], low, {**high, dim: at}))
            need = ups + np.maximum(at + 1 - v, 0) - (np.maximum(low[dim] - v, 0) if dim in low else 0)
            ok = need <= up
            todo.append((right, rows[ok], need[ok], downs[ok], {**low, dim: at + 1}, high))


def codes_of(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.int32)


def counts_of(codes: np.ndarray) -> np.ndarray:
    dims = np.where((codes >= 97) & (codes <= 122), codes - 97, 26 + codes % (_DIMS - 26))
    out = np.zeros((len(codes), _DIMS), np.int32)
    for i in range(codes.shape[1]):
        np.add.at(out, (np.arange(len(codes)), dims[:, i]), 1)
    return out


def bitmap_of(counts: np.ndarray) -> np.ndarray:
    """Two bits a dimension, for counts of one and of two or more: they differ in no more bits than the counts differ."""
    bits = np.uint64(1) << np.arange(_DIMS, dtype=np.uint64)
    one = ((counts >= 1) * bits).sum(axis=1, dtype=np.uint64)
    return one | (((counts >= 2) * bits).sum(axis=1, dtype=np.uint64) << np.uint64(_DIMS))


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of two code tables of one length that differ in exactly one place."""
    return (a != b).sum(axis=1) == 1


def inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of ``b``, one longer than those of ``a``, that are the row of ``a`` with one more character."""
    head = (np.cumsum(a != b[:, :-1], axis=1) == 0).sum(axis=1)
    tail = (np.cumsum((a != b[:, 1:])[:, ::-1], axis=1) == 0).sum(axis=1)
    return head + tail >= a.shape[1]


class _Side:
    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n = np.array(words, object), n
        self.codes = codes_of(words)
        self.counts = counts_of(self.codes)
        self.bitmap = bitmap_of(self.counts)


def near_pairs(queries: _Side, points: _Side, up: int, down: int, tree: KdTree, near) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of queries and points that ``near`` holds for."""
    for leaf, rows in tree.reach(queries.counts, up, down):
        at = tree.leaves[leaf]
        step = max(1, _BLOCK // len(at))
        for i in range(0, len(rows), step):
            q, p = np.nonzero(np.bitwise_count(queries.bitmap[rows[i:i + step], None] ^ points.bitmap[None, at]) <= up + down)
            q, p = rows[i:i + step][q], at[p]
            width = max(1, _BLOCK // max(_DIMS, points.codes.shape[1]))
            for j in range(0, len(q), width):
                a, b = q[j:j + width], p[j:j + width]
                d = points.counts[b] - queries.counts[a]
                ok = (np.maximum(d, 0).sum(axis=1) <= up) & (np.maximum(-d, 0).sum(axis=1) <= down)
                a, b = a[ok], b[ok]
                ok = near(queries.codes[a], points.codes[b])
                yield a[ok], b[ok]


class _Best:
    """Of each word its number of near words, and the one of largest n (the smallest of several)."""

    def __init__(self):
        self.found: list[pd.DataFrame] = []
        self.size = 0

    def add(self, words: np.ndarray, others: np.ndarray, n: np.ndarray) -> None:
        if len(words):
            self.found.append(pd.DataFrame({"word": words, "n_near": 1, "best_n": n, "best": others}))
            self.size += len(words)
            if self.size > 200_000:
                self.reduce()

    def reduce(self) -> pd.DataFrame:
        if not self.found:
            return pd.DataFrame({"word": pd.Series(dtype=object), "n_near": pd.Series(dtype="int64"), "best_n": pd.Series(dtype="int64"),
                                 "best": pd.Series(dtype=object)})
        rows = pd.concat(self.found).sort_values(["word", "best_n", "best"], ascending=[True, False, True])
        groups = rows.groupby("word", sort=False)
        out = groups.first()
        out["n_near"] = groups["n_near"].sum()
        self.found, self.size = [out.reset_index()[["word", "n_near", "best_n", "best"]]], 0
        return self.found[0]


def _search(rows: pd.DataFrame) -> pd.DataFrame:
    """Near words of one cell; ``role`` is 0 for points, 1 for other words of the length, 2 for words one shorter."""
    mine = rows[rows["role"] == 0]
    best = _Best()
    if len(mine):
        points = _Side(mine["word"].tolist(), mine["n"].to_numpy())
        tree = KdTree(points.counts, _LEAF)
        same, shorter = rows[rows["role"] < 2], rows[rows["role"] == 2]
        queries = _Side(same["word"].tolist(), same["n"].to_numpy())
        for a, b in near_pairs(queries, points, 1, 1, tree, replaced):
            best.add(queries.words[a], points.words[b], points.n[b])
        if len(shorter):
            queries = _Side(shorter["word"].tolist(), shorter["n"].to_numpy())
            for a, b in near_pairs(queries, points, 1, 0, tree, inserted):
                best.add(queries.words[a], points.words[b], points.n[b])
                best.add(points.words[b], queries.words[a], queries.n[a])
    return best.reduce()


def _route(trees: dict[int, KdTree | None]):
    """Send every word to its own cell and to the cells that its range reaches; a length without a tree has one cell."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, rows in batch.groupby(batch["word"].str.len()):
                words, n = rows["word"].to_numpy(), rows["n"].to_numpy()
                counts = counts_of(codes_of(words.tolist()))

                def sent(length: int, cell, at, role) -> pd.DataFrame:
                    return pd.DataFrame({"length": length, "cell": cell, "role": role, "word": words[at], "n": n[at]})

                own = trees.get(size)
                home = own.home(counts) if own else np.zeros(len(words), np.int64)
                yield sent(size, home, slice(None), 0)
                if own:
                    for cell, at in own.reach(counts, 1, 1):
                        at = at[home[at] != cell]
                        yield sent(size, cell, at, 1)
                if size + 1 in trees:
                    longer = trees[size + 1]
                    for cell, at in longer.reach(counts, 1, 0) if longer else [(0, slice(None))]:
                        yield sent(size + 1, cell, at, 2)
    return run


def _fit(words: DataFrame, cell_rows: int) -> dict[int, KdTree | None]:
    """A tree for each length with more than one cell's words (None for the others), fitted on a sample by hash."""
    sizes = {r["length"]: r["n"] for r in words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")).collect()}  # a row a length
    scale = max(1.0, sum(sizes.values()) / cell_rows / _CELLS)
    wanted = {size: int(n / (cell_rows * scale)) + 1 for size, n in sizes.items() if n > cell_rows * scale}
    trees: dict[int, KdTree | None] = dict.fromkeys(sizes)
    if not wanted:
        return trees
    share = F.lit(0)
    for size, cells in wanted.items():
        share = F.when(F.length("word") == size, F.lit(int(min(1.0, cells * _SAMPLE / sizes[size]) * (1 << 30)))).otherwise(share)
    sample = words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < share).select("word").toPandas()["word"]
    for size, rows in sample.groupby(sample.str.len()):
        rows = sorted(rows)
        trees[size] = KdTree(counts_of(codes_of(rows)), max(1, -(-len(rows) // wanted[size])))
        trees[size].leaves = []  # only the splits are sent to the tasks
    return trees


def counted_words(docs: DataFrame, noise: int = 199, min_length: int = 6, min_count: int = 5, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``(word, n)``: lower-cased runs of letters of whole texts, one of whose characters goes where ``noise`` divides their hash."""
    run = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.explode(F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(_RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % noise == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    # noise only shortens, so shorter runs never count
    words = run.where(F.length("run") >= min_length).select("run", h.alias("h")).select(word.alias("word"))
    return words.where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``(word, root)`` of every word with a form; ``n`` grows fivefold along forms, so there are few rounds."""
    jump, done, i = scratch.table(forms.select("word", F.col("form").alias("root")), "jump0"), False, 0
    while not done:
        on = jump.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        nxt = scratch.table(jump.join(on, F.col("root") == F.col("_w"), "left").select(
            "word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")), f"jump{i + 1}")
        done = not nxt.where("moved").limit(1).count()
        scratch.drop(f"jump{i}")
        jump, i = nxt.select("word", "root"), i + 1
    return jump


def variant_groups(docs: DataFrame, noise: int = 199, min_length: int = 6, min_count: int = 5, ratio: int = 5, id_col: str = "doc_id",
                   text_col: str = "text", cell_rows: int = _CELL) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of at least ``min_length`` code points and ``min_count`` occurrences.

    Words are maximal runs of letters, A-Z lower-cased, with the stated noise.
    Two words are near if they differ by exactly one inserted, deleted or
    replaced code point.  ``form`` is the near word of largest ``n`` (of several
    the smallest in code-point order) if that is at least ``ratio`` times the
    word's, else null; ``root`` is the last form.  Null and empty texts have no
    words.  Runs of a row with a null id get no noise.  Repeated rows count each
    time.  Other columns are ignored; an empty table gives an empty result.
    Words of any length take part.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2, or forms could go round in circles")
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.table(counted_words(docs, noise, min_length, min_count, id_col, text_col), "words")
    routed = words.mapInPandas(_route(_fit(words, cell_rows)), "length int, cell long, role int, word string, n long")
    found = routed.groupBy("length", "cell").applyInPandas(_search, "word string, n_near long, best_n long, best string")
    near = found.groupBy(F.col("word").alias("w")).agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b"))
    big = -F.col("b.m") >= ratio * F.col("n")
    joined = scratch.table(words.join(near, F.col("word") == F.col("w"), "left").select(
        "word", F.when(big, F.col("b.best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(big, -F.col("b.m")).alias("form_n")), "forms")
    roots = _roots(joined.where(F.col("form").isNotNull()), scratch)
    return joined.join(roots.withColumnRenamed("word", "w"), F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Operator 10: n-gram Jaccard join by size-banded tiles, bitmap signatures and exact sorted arrays.

A document's set is its distinct word shingles, as sorted 64-bit hashes.  Equal
sets are one class first.  Two sets with a Jaccard similarity of t or more
share one of the ``n - ceil(t * n) + 1`` smallest hashes of each (the prefix),
so classes that share a prefix hash form a tile, ordered by size.  A tile with
many classes is cut into size bands (sizes whose ratio is below t never link)
and the bands into pieces of bounded size that meet pairwise.

In a tile, sizes further apart than t are skipped, and then a bitmap decides:
each set has a bitmap in which every element flips one bit.  Two bitmaps differ
in no more bits than the sets differ in elements, so a bit count bounds the
overlap from above.  What passes is a candidate.  Pairs within a component that
is already connected need no test, which keeps tiles of many near copies
linear, and a tile returns a spanning forest, never its pairs.

Candidate components are then verified by exact intersection of the sorted
arrays, in groups of bounded size, again until they are connected.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyload.llm.common import Scratch, pick
from tallyload.llm.components import connected_components
from tallyload.llm.forest import Forest
from tallyload.llm.substrings import pack, unpack
from tallyload.llm.wordhash import Powers, normalise, range_hash, window_hashes

_TILE = 4096  # classes of a tile piece
_PER_BLOCK = 250_000  # prefix entries of a block, more for very many: blocks times batches stay long rows
_GROUP = 2_000_000  # shingles of a group to verify
_MOST_BROADCAST = 500_000  # rows of three longs and an integer, that is 14 MB


def shingle_set(text: str | None, k: int, powers: Powers, lower: bool = True) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer than k words are one shingle, no words none."""
    norm = normalise(text if isinstance(text, str) else None, lower)
    if not norm:
        return np.zeros(0, np.uint64)
    h = window_hashes(norm, k, powers)[0]
    return np.unique(h) if len(h) else np.array([range_hash(norm, powers)], np.uint64)


def node_of(shingles: np.ndarray) -> int:
    """Number of a set's class."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def bitmap_bits(n: int, num: int, den: int) -> int:
    """Power of two, at least four times the largest difference that two linked sets of this size can have, and 64."""
    most = 2 * n * (den - num) / (den + num)
    return max(64, 1 << math.ceil(math.log2(max(1.0, 4 * most))))


def bitmap(shingles: np.ndarray, bits: int) -> np.ndarray:
    """Parity of the number of elements at each bit, as 64-bit words."""
    at = (shingles & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits).astype(np.uint8) & 1, bitorder="little").view(np.uint64)


class Bitmaps:
    """Bitmaps of several sizes; a bitmap is halved by folding, so sets next in size can be compared."""

    def __init__(self, maps: list[np.ndarray]):
        self.words = np.array([len(b) for b in maps], np.int64)
        self.at: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for w in np.unique(self.words).tolist():
            own, twice = np.flatnonzero(self.words == w), np.flatnonzero(self.words == 2 * w)
            rows = [maps[i] for i in own] + [maps[i][:w] ^ maps[i][w:] for i in twice]
            place = np.full(len(maps), -1, np.int64)
            place[np.concatenate((own, twice))] = np.arange(len(rows))
            self.at[w] = place, np.vstack(rows)

    def difference(self, small: np.ndarray, large: np.ndarray) -> np.ndarray:
        """Number of differing bits of pairs, a lower bound of the number of differing elements."""
        out = np.zeros(len(small), np.int64)
        for w in np.unique(self.words[small]).tolist():
            sub = np.flatnonzero(self.words[small] == w)
            place, maps = self.at[w]
            a, b = place[small[sub]], place[large[sub]]
            known = b >= 0  # else the sizes are more than a factor of two apart: no bound
            sub, a, b = sub[known], a[known], b[known]
            out[sub] = np.bitwise_count(maps[a] ^ maps[b]).sum(axis=1)
        return out


def near_pairs(group: np.ndarray, node: np.ndarray, sizes: np.ndarray, maps: Bitmaps, forest: Forest, num: int, den: int
               ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of nodes of one group that size and bitmap do not exclude and that are not connected yet.

    ``group`` and ``node`` are rows sorted by group, then size.  The caller adds
    what it accepts to the forest between two lots.
    """
    n = sizes[node]
    i, lag = np.arange(len(node)), 0
    while True:
        lag += 1
        i = i[i + lag < len(node)]
        i = i[(group[i + lag] == group[i]) & (den * n[i] >= num * n[i + lag])]
        if not len(i):
            return
        a, b = node[i], node[i + lag]
        open_ = forest.open(a, b)
        a, b = a[open_], b[open_]
        if len(a):
            near = (den + num) * maps.difference(a, b) <= (den - num) * (sizes[a] + sizes[b])
            if near.any():
                yield a[near], b[near]
        if lag % 16 == 0:  # groups that are connected need no more lags
            label = forest.label[node]
            starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            one = np.minimum.reduceat(label, starts) == np.maximum.reduceat(label, starts)
            i = i[~np.repeat(one, np.diff(np.concatenate((starts, [len(group)]))))[i]]


def _signer(k: int, num: int, den: int, lower: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = Powers()
        for batch in batches:
            out = []
            for text in batch["text"]:
                s = shingle_set(text, k, powers, lower)
                n = len(s)
                prefix = s[: n - -(-num * n // den) + 1] if n else s
                out.append((n, node_of(s), bitmap(s, bitmap_bits(n, num, den)).tobytes(), prefix.tobytes()))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n": [x[0] for x in out], "node": [x[1] for x in out],
                                "bits": [x[2] for x in out], "prefix": [x[3] for x in out]})
    return run


def _dealer(blocks: int):
    """Prefix entries of a batch of documents, one packed row for each block (a range of the hash).

    Equal sets of a batch send their entries once.  A row holds the sorted
    hashes as differences, the classes of the batch, and each entry's class by
    its place among them.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cuts = np.array([(b << 64) // blocks for b in range(1, blocks)], np.uint64)
        for batch in batches:
            batch = batch.drop_duplicates("node")
            lists = [np.frombuffer(p, np.uint64) for p in batch["prefix"]]
            nodes = batch["node"].to_numpy()
            h = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
            place = np.repeat(np.arange(len(nodes)), [len(x) for x in lists])
            order = np.argsort(h, kind="stable")
            h, place = h[order], place[order]
            edges = np.concatenate(([0], np.searchsorted(h, cuts), [len(h)]))
            rows = []
            for b, (i, j) in enumerate(zip(edges[:-1], edges[1:])):
                if j > i:
                    used, at = np.unique(place[i:j], return_inverse=True)
                    rows.append((b, pack(np.diff(h[i:j], prepend=np.uint64(0))), nodes[used].tobytes(), pack(at.astype(np.int64))))
            yield pd.DataFrame(rows, columns=["block", "h", "nodes", "at"])
    return run


def _shared(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Entries of a block whose hash is in the prefix of two classes or more.

    ``hot``: of more classes than a tile piece holds; ``lead``: the smallest of them.
    """
    h = np.concatenate([np.cumsum(unpack(x, np.uint64), dtype=np.uint64) for x in rows["h"]])
    node = np.concatenate([np.frombuffer(n, np.int64)[unpack(a, np.int64)] for n, a in zip(rows["nodes"], rows["at"])])
    order = np.lexsort((node, h))
    h, node = h[order], node[order]
    first = np.concatenate(([True], (h[1:] != h[:-1]) | (node[1:] != node[:-1])))  # copies in several batches
    h, node = h[first], node[first]
    starts = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(h)])))
    count = np.repeat(sizes, sizes)
    keep = count > 1
    lead = np.repeat(node[starts], sizes)
    return pd.DataFrame({"h": h[keep].view(np.int64), "node": node[keep], "hot": count[keep] > _TILE, "lead": lead[keep]})


def _tile_forest(num: int, den: int):
    """Spanning forest of the candidates in the tiles of one block, from its entries and the classes they name."""
    def run(key: tuple, rows: pd.DataFrame, classes: pd.DataFrame) -> pd.DataFrame:
        classes = classes.sort_values("class")
        nodes = classes["class"].to_numpy()
        sizes = classes["n"].to_numpy().astype(np.int64)
        maps = Bitmaps([np.frombuffer(b, np.uint64) for b in classes["bits"]])
        at = np.searchsorted(nodes, rows["node"].to_numpy())
        tile = rows.groupby(["h", "band", "a", "b"], sort=False).ngroup().to_numpy()
        order = np.lexsort((sizes[at], tile))
        forest = Forest(len(nodes))
        for a, b in near_pairs(tile[order], at[order], sizes, maps, forest, num, den):
            forest.add(a, b)
        hit = np.flatnonzero(forest.label != np.arange(len(nodes)))
        return pd.DataFrame({"a": nodes[hit], "b": nodes[forest.label[hit]]})
    return run


def _verifier(k: int, num: int, den: int, lower: bool):
    """Spanning forest of the true links among the classes of each candidate component of a group."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        powers, out = Powers(), []
        for _, part in rows.groupby("comp"):
            found = {}
            for node, text in zip(part["node"], part["text"]):
                if node not in found:
                    s = shingle_set(text, k, powers, lower)
                    if node_of(s) == node:  # rows of one id may have other texts
                        found[node] = s
            nodes = sorted(found, key=lambda x: (len(found[x]), x))
            sets = [found[x] for x in nodes]
            sizes = np.array([len(s) for s in sets], np.int64)
            if len(nodes) < 2:
                continue
            maps = Bitmaps([bitmap(s, bitmap_bits(len(s), num, den)) for s in sets])
            forest = Forest(len(nodes))
            for a, b in near_pairs(np.zeros(len(nodes), np.int64), np.arange(len(nodes)), sizes, maps, forest, num, den):
                for i, j in zip(a.tolist(), b.tolist()):
                    if forest.label[i] != forest.label[j]:
                        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                        if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                            forest.add(np.array([i]), np.array([j]))
            out += [(nodes[i], nodes[j]) for i, j in enumerate(forest.label.tolist()) if i != j]
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)
    return run


def jaccard_components(docs: DataFrame, words: int = 5, threshold: tuple[int, int] = (80, 100), lower: bool = True,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row.

    Two documents link if ``den * intersection >= num * union`` of their sets,
    with ``threshold = (num, den)`` and ``0 < num <= den``, at least a half.
    ``component_id`` is the smallest id reachable by links, the own one
    included.  Null texts and texts without words have an empty set and link
    with nothing.  Rows of one id share no link by their id alone.  A row with a
    null id links with nothing and has no component.  Repeated rows give
    repeated results; empty tables empty results; other columns are ignored.
    """
    num, den = threshold
    if not 0 < num <= den or 2 * num < den:
        raise ValueError("the threshold must be between a half and 1")
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = scratch.table(rows.mapInPandas(_signer(words, num, den, lower), "doc_id long, n long, node long, bits binary, prefix binary"),
                           "signed")
    sets = signed.where("n > 0 AND doc_id IS NOT NULL")
    classes = scratch.table(sets.groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits")),
                            "classes")

    # prefix entries that classes share
    entries = sets.agg(F.sum(F.length("prefix")).alias("n")).head()["n"] or 0
    entries //= 8
    blocks = max(1, math.ceil(entries / max(_PER_BLOCK, math.sqrt(64 * entries))))
    shared = scratch.table(sets.select("node", "prefix").mapInPandas(_dealer(blocks), "block int, h binary, nodes binary, at binary")
                           .groupBy("block").applyInPandas(_shared, "h long, node long, hot boolean, lead long"), "shared")
    # tiles; only hashes with many classes are cut into bands and pieces
    no = F.lit(0)
    cold = shared.where(~F.col("hot")).select("h", F.lit(-1).cast("long").alias("band"), no.alias("a"), no.alias("b"), "node",
                                                 F.col("lead").alias("key"))
    band = F.floor(F.log(F.col("n")) / F.lit(math.log(den / num) if num < den else 1e-9)).cast("long")
    banded = (shared.where("hot").select("h", "node").join(classes.select("node", "n"), "node")
              .select("h", "node", F.explode(F.array(band, band + 1)).alias("band")))
    pieces = banded.groupBy("h", "band").agg(F.ceil(F.count("*") / _TILE).cast("int").alias("pieces"))
    piece = F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int")
    banded = (banded.join(pieces, ["h", "band"]).withColumn("piece", piece)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
              .select("h", "band", F.least("piece", "other").alias("a"), F.greatest("piece", "other").alias("b"), "node")
              .withColumn("key", F.xxhash64("h", "band", "a", "b")))
    # Near copies share many hashes, mostly with one leading class: by its number
    # these tiles meet in one block, where each class sends its bitmap once.  A
    # tile that is not hot is small, and a class leads no more than its prefix.
    tiles = cold.unionByName(banded).withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")).drop("key")
    named = tiles.select(F.col("block").alias("to"), F.col("node").alias("class")).distinct()
    named = named.join(classes.select("node", "n", "bits"), F.col("class") == F.col("node")).select("to", "class", "n", "bits")
    candidates = tiles.groupBy("block").cogroup(named.groupBy("to")).applyInPandas(_tile_forest(num, den), "a long, b long")
    components = connected_components(candidates, scratch, "candidates").withColumnRenamed("component", "comp")

    # exact sets of the candidate components
    members = scratch.table(components.join(classes.select("node", "rep", "n"), "node"), "members")
    weight = members.groupBy("comp").agg(F.sum("n").alias("weight"))
    total = weight.agg(F.sum("weight").alias("n")).head()["n"] or 0
    lots = max(1, -(-total // _GROUP))
    weight = weight.select("comp", F.ceil(F.col("weight") / _GROUP).cast("int").alias("pieces"))
    asked = scratch.table(members.join(weight, "comp").select("rep", "node", "comp", "pieces"), "asked")
    if asked.count() <= _MOST_BROADCAST:  # else the texts are shuffled to meet their rows
        asked = F.broadcast(asked)
    texts = rows.join(asked, rows["doc_id"] == asked["rep"]).select("node", "comp", "pieces", "text")
    texts = texts.withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    lot = F.when(F.col("pieces") == 1, F.pmod(F.xxhash64("comp"), F.lit(lots))).otherwise(F.col("comp"))
    groups = texts.select(lot.alias("lot"), F.least("piece", "other").alias("a"), F.greatest("piece", "other").alias("b"), "comp", "node", "text")
    links = groups.groupBy("lot", "a", "b").applyInPandas(_verifier(words, num, den, lower), "a long, b long")
    linked = connected_components(links, scratch, "links").withColumnRenamed("component", "root")
    for done in ("shared", "members", "asked"):
        scratch.drop(done)

    ids = classes.select("node", "rep").join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = ids.groupBy("root").agg(F.min("rep").alias("component_id"))
    ids = ids.join(least, "root").select("node", "component_id")
    key = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("node"))
    return (signed.select("doc_id", "n", key.alias("key")).join(ids, F.col("key") == F.col("node"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))

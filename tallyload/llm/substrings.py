"""Operator 3: substring deduplication by relative Lempel-Ziv factors.

The reference of a document is the text of all documents with a smaller id.
It is indexed by windows of ``window`` words, and the index is dealt by hash
into reference blocks.  Every document is held against every block: a block
answers, for each window, whether it also starts in a document with a smaller
id.  A document is then parsed greedily: a factor starts at the first word
whose window is in the reference and is extended word by word as long as the
next window is, too.  Where a factor ends, the windows across the boundary
are looked up one by one like all others, so a factor is a duplicate span
exactly if all its windows are duplicates, and no shorter span is one.

Documents are dealt into buckets and each bucket sends every distinct window
once, with its smallest id, as one packed row for each block.  A passage that a
third of all documents share therefore reaches its block once from each bucket,
and the block's answer is one bit for each window and bucket.  Buckets and
blocks hold about the square root of the corpus (times ``_PER_ROW``), so packed
rows stay long at any size and no task grows with the corpus itself.

Windows are told apart by 64-bit hashes: two different windows among n are
mistaken for each other with a probability of n * n / 2**65 at most.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyload.llm.common import pick
from tallyload.llm.wordhash import Powers, normalise, window_hashes

_PER_ROW = 256
_LEAST = 400_000
_NO_ID = np.int64(2**63 - 1)  # null ids come after all others


def pack(values: np.ndarray) -> bytes:
    """64-bit integers as byte planes, which compress well where high bytes are alike."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(data: bytes, dtype) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).reshape(-1).view(dtype)


def _ids(column: pd.Series) -> np.ndarray:
    return column.astype("Int64").fillna(int(_NO_ID)).astype("int64").to_numpy()


def _bucket_windows(texts, window: int, powers: Powers):
    """Normalised texts, their window hashes, and for all windows of the bucket the row they are from."""
    norms = [normalise(t if isinstance(t, str) else None) for t in texts]
    hashes = [window_hashes(x, window, powers)[0] for x in norms]
    rows = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
    return norms, hashes, rows


def _distinct(hashes: list[np.ndarray], rows: np.ndarray, ids: np.ndarray):
    """Sorted distinct windows of a bucket with the smallest id each, and each window's place among them."""
    flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    distinct, place = np.unique(flat, return_inverse=True)
    least = np.full(len(distinct), _NO_ID, np.int64)
    np.minimum.at(least, place, ids[rows])
    return distinct, least, place


def _block_edges(distinct: np.ndarray, blocks: int) -> np.ndarray:
    """Where each block begins among sorted hashes; blocks are equal ranges of the hash."""
    starts = np.array([(b << 64) // blocks for b in range(blocks)], np.uint64)
    return np.concatenate((np.searchsorted(distinct, starts), [len(distinct)]))


def _indexer(window: int, blocks: int):
    def run(key: tuple, docs: pd.DataFrame) -> pd.DataFrame:
        powers = Powers()
        _, hashes, rows = _bucket_windows(docs["text"], window, powers)
        distinct, least, _ = _distinct(hashes, rows, _ids(docs["doc_id"]))
        edges = _block_edges(distinct, blocks)
        out = [(b, key[0], pack(np.diff(distinct[i:j], prepend=np.uint64(0))), pack(least[i:j]))
               for b, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if j > i]
        return pd.DataFrame(out, columns=["block", "bucket", "windows", "ids"])
    return run


def _answer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One bit for each window that a bucket asked about: it starts in a document with a smaller id than the bucket's."""
    hashes = [np.cumsum(unpack(x, np.uint64), dtype=np.uint64) for x in rows["windows"]]
    sizes = [len(h) for h in hashes]
    ids = np.concatenate([unpack(x, np.int64) for x in rows["ids"]])
    flat = np.concatenate(hashes)
    order = np.argsort(flat, kind="stable")
    flat, by_hash = flat[order], ids[order]
    starts = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
    least = np.repeat(np.minimum.reduceat(by_hash, starts), np.diff(np.concatenate((starts, [len(flat)]))))
    earlier = np.empty(len(flat), bool)
    earlier[order] = least < by_hash
    parts = np.split(earlier, np.cumsum(sizes)[:-1])
    return pd.DataFrame({"bucket": rows["bucket"].to_numpy(), "block": key[0], "bits": [np.packbits(p).tobytes() for p in parts]})


def factors(duplicate: np.ndarray, window: int, n_words: int) -> np.ndarray:
    """Greedy factors as word ranges ``(start, end)``: maximal unions of duplicate windows that touch word after word."""
    if not duplicate.any():
        return np.zeros((0, 2), np.int64)
    covered = np.zeros(n_words + 1, np.int64)
    at = np.flatnonzero(duplicate)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + window, -1)
    inside = np.concatenate(([False], np.cumsum(covered)[:-1] > 0, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges.reshape(-1, 2)


def _parser(window: int, blocks: int, digests: bool):
    def run(key: tuple, docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        powers = Powers()
        ids = _ids(docs["doc_id"])
        norms, hashes, rows = _bucket_windows(docs["text"], window, powers)
        distinct, least, place = _distinct(hashes, rows, ids)
        edges = _block_edges(distinct, blocks)
        earlier = np.zeros(len(distinct), bool)
        for b, bits in zip(answers["block"], answers["bits"]):
            i, j = edges[b], edges[b + 1]
            earlier[i:j] = np.unpackbits(np.frombuffer(bits, np.uint8), count=j - i).astype(bool)
        duplicate = earlier[place] | (least[place] < ids[rows])
        ends = np.cumsum([len(h) for h in hashes])
        out = []
        for doc_id, norm, h, end in zip(docs["doc_id"], norms, hashes, ends):
            n_words = norm.count(b" ") + 1 if norm else 0
            spans = factors(duplicate[end - len(h):end], window, n_words)
            kept = norm
            if len(spans):
                words = norm.split(b" ")
                keep, at = [], 0
                for s, e in spans.tolist():
                    keep += words[at:s]
                    at = e
                kept = b" ".join(keep + words[at:])
            out.append((doc_id, n_words, int((spans[:, 1] - spans[:, 0]).sum()),
                        hashlib.sha256(kept).hexdigest() if digests else kept.decode("utf-8", "replace"),
                        [] if digests else spans.ravel().tolist()))
        return pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept", "spans"]).astype({"doc_id": "Int64"})
    return run


def substring_dedup(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text",
                    digests: bool = False) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept string, spans array<int>)`` for every row.

    ``kept`` is what is left of the words, joined by one space (with
    ``digests`` its SHA-256 in hexadecimal, and no spans); ``spans`` lists start
    and end word of each removed span, end exclusive.  A word goes if a window
    that covers it also starts in a document with a smaller id, judged on the
    input.  Within one document, or between rows of one id, nothing counts as
    smaller; a null id comes after all others.  Null, empty and short texts lose
    nothing.  Empty tables give empty results.  Other columns are ignored.
    """
    if window < 1:
        raise ValueError("window must be at least 1")
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    chars = rows.agg(F.sum(F.length("text")).alias("n")).head()["n"] or 0
    windows = chars / 6 + 1
    parts = max(1, math.ceil(windows / max(_LEAST, math.sqrt(windows * _PER_ROW))))
    spread = F.coalesce(F.col("doc_id"), F.xxhash64("text"))  # so that null ids spread as well
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(spread), F.lit(parts)).cast("int"))
    asked = dealt.groupBy("bucket").applyInPandas(_indexer(window, parts), "block int, bucket int, windows binary, ids binary")
    told = asked.groupBy("block").applyInPandas(_answer, "bucket int, block int, bits binary")
    return dealt.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInPandas(
        _parser(window, parts, digests), "doc_id long, n_words long, n_removed long, kept string, spans array<int>")

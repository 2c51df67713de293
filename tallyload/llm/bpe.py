"""Operator 6: byte-level BPE encoding and decoding with a segment tree over pair ranks.

A pre-token is a row of symbols.  The segment tree's leaves hold, for every
position, the key ``rank * width + position`` of the pair that begins there;
its root is the smallest key, that is the leftmost pair of the lowest rank.
Merging it changes three leaves (the pair itself, the right neighbour that
disappears and the pair that ends here), each a logarithmic point update.  It
stops when the root holds no mergeable pair.

Short pre-tokens of one width share array-shaped trees and merge in lockstep;
long ones use the same tree one at a time.  Text is cut at spaces that are
followed by a character other than white space.  Such a space always begins a
pre-token, so a piece can be encoded on its own and remembered, in a cache that
is emptied when it is full.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyload.llm.common import pick, worker_cache

# Fixed values of the byte-level format: White_Space characters, the pre-token
# pattern, and the printable stand-ins of the 256 bytes.
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"


def byte_stand_ins() -> dict[str, int]:
    """Printable character to byte: visible Latin-1 characters stand for themselves, the rest follow from U+0100."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in kept}
    out |= {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(kept))}
    return out


class Vocabulary:
    """Tables read from a ``tokenizers`` JSON file of the byte-level BPE kind."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("only byte-level BPE files without normaliser and prefix space are supported")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that strip or match single words are not supported")
        stand_in = byte_stand_ins()
        vocab = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for tok, i in vocab.items():
            self.token_bytes[i] = bytes(stand_in[c] for c in tok)
        for tok, i in self.added.items():
            self.token_bytes[i] = tok.encode()
        self.byte_id = np.array([vocab[c] for c, _ in sorted(stand_in.items(), key=lambda x: x[1])], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys))))
        self.no_rank = len(keys)
        self.lengths = np.array([len(b) for b in self.token_bytes], np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``no_rank`` where it is not mergeable or a side is missing (-1)."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], self.no_rank)


def encode_long(data: bytes, v: Vocabulary) -> list[int]:
    """One pre-token of any length: O(n log n) merges with a scalar segment tree."""
    n = len(data)
    sym = [int(v.byte_id[b]) for b in data]
    if n < 2:
        return sym
    width = 1 << (n - 1).bit_length()
    none = v.no_rank * width
    right, left = [*range(1, n), -1], [-1, *range(n - 1)]
    tree = [none] * (2 * width)

    def leaf(i: int) -> int:
        j = right[i]
        r = v.rank_of.get((sym[i] << 32) | sym[j]) if j >= 0 else None
        return none if r is None else r * width + i

    for i in range(n):
        tree[width + i] = leaf(i)
    for i in range(width - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])

    def put(i: int, key: int) -> None:
        i += width
        tree[i] = key
        i >>= 1
        while i:
            low = tree[2 * i] if tree[2 * i] < tree[2 * i + 1] else tree[2 * i + 1]
            if tree[i] == low:
                break
            tree[i] = low
            i >>= 1

    while tree[1] < none:
        rank, i = divmod(tree[1], width)
        j = right[i]
        sym[i] = int(v.merged[rank])
        right[i] = right[j]
        if right[j] >= 0:
            left[right[j]] = i
        put(j, none)
        put(i, leaf(i))
        if left[i] >= 0:
            put(left[i], leaf(left[i]))
    out, i = [], 0
    while i >= 0:
        out.append(sym[i])
        i = right[i]
    return out


def encode_short(tokens: list[bytes], width: int, v: Vocabulary) -> list[bytes]:
    """Pre-tokens of at most ``width`` (a power of two) bytes in lockstep; little-endian uint32 ids of each."""
    n = len(tokens)
    size = np.fromiter(map(len, tokens), np.int64, n)
    flat = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in tokens), np.uint8).reshape(n, width)
    col = np.arange(width)
    sym = np.where(col < size[:, None], v.byte_id[flat], -1)
    right = np.where(col + 1 < size[:, None], col + 1, -1)
    left = np.broadcast_to(col - 1, (n, width)).copy()
    none = v.no_rank * width
    tree = np.full((n, 2 * width), none, np.int64)
    ranks = v.pair_ranks(sym[:, :-1].ravel(), sym[:, 1:].ravel()).reshape(n, width - 1)
    tree[:, width: 2 * width - 1] = np.where(ranks < v.no_rank, ranks * width + col[:-1], none)
    for i in range(width - 1, 0, -1):
        np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1], out=tree[:, i])

    def put(rows, at, key):
        at = at + width
        tree[rows, at] = key
        at = at >> 1
        while at[0]:
            tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])
            at = at >> 1

    live = np.flatnonzero(tree[:, 1] < none)
    while len(live):
        rank, i = np.divmod(tree[live, 1], width)
        j = right[live, i]
        k = right[live, j]
        merged = v.merged[rank]
        sym[live, i] = merged
        sym[live, j] = -1
        right[live, i] = k
        has = k >= 0
        left[live[has], k[has]] = i[has]
        put(live, j, none)
        r = v.pair_ranks(merged, np.where(has, sym[live, k], -1))
        put(live, i, np.where(r < v.no_rank, r * width + i, none))
        p = left[live, i]
        has = p >= 0
        if has.any():
            rows, q = live[has], p[has]
            r = v.pair_ranks(sym[rows, q], merged[has])
            put(rows, q, np.where(r < v.no_rank, r * width + q, none))
        live = live[tree[live, 1] < none]
    kept = sym >= 0
    data = sym[kept].astype("<u4").tobytes()
    ends = np.cumsum(kept.sum(axis=1)) * 4
    return [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


class Encoder:
    """Encodes and decodes whole texts; ``max_cached`` bounds the remembered pieces."""

    SHORT = 32

    def __init__(self, vocabulary: str, max_cached: int = 800_000):
        self.v = Vocabulary(vocabulary)
        self.max_cached = max_cached
        self.pre_tokens = regex.compile(_PRE_TOKEN).findall
        self.cut = re.compile(f" (?=[^{_WS}])").split
        names = sorted(self.v.added, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.head: dict[str, bytes] = {}
        self.tail: dict[str, bytes] = {}

    def _encode_tokens(self, tokens: set[str]) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        by_width: dict[int, tuple[list[str], list[bytes]]] = {}
        for token in tokens:
            t = token.encode("utf-8", "replace")
            n = len(t)
            if n == 1:
                out[token] = int(self.v.byte_id[t[0]]).to_bytes(4, "little")
            elif n > self.SHORT:
                out[token] = np.array(encode_long(t, self.v), "<u4").tobytes()
            else:
                names, data = by_width.setdefault(4 if n <= 4 else 8 if n <= 8 else 16 if n <= 16 else 32, ([], []))
                names.append(token)
                data.append(t)
        for width, (names, data) in by_width.items():
            for i in range(0, len(data), 16384):
                out.update(zip(names[i:i + 16384], encode_short(data[i:i + 16384], width, self.v)))
        return out

    def _learn(self, head: set[str], tail: set[str]) -> None:
        """Remember the ids of pieces at the start of a text (``head``) and of pieces after a space (``tail``)."""
        for pieces, space, known in ((head, "", self.head), (tail, " ", self.tail)):
            words, ended, other = [], [], []
            for p in pieces:
                (words if p.isalpha() else ended if p[-1:] in ",.!?" and p[:-1].isalpha() else other).append(p)
            split = [self.pre_tokens(space + p) for p in other]
            tokens = {space + p for p in words}
            tokens.update([space + p[:-1] for p in ended], [p[-1] for p in ended])
            tokens.update(*split)
            ids = self._encode_tokens(tokens)
            known.update([(p, ids[space + p]) for p in words])
            known.update([(p, ids[space + p[:-1]] + ids[p[-1]]) for p in ended])
            known.update([(p, b"".join([ids[t] for t in ts])) for p, ts in zip(other, split)])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each whole text as little-endian unsigned 32-bit integers; null encodes as the empty text."""
        plan, head, tail = [], set(), set()
        if len(self.head) + len(self.tail) > self.max_cached:
            self.head, self.tail = {}, {}
        for text in texts:
            parts = []
            for part in self.specials.split(text or "") if self.specials else [text or ""]:
                if part in self.v.added:
                    parts.append(part)
                elif part:
                    first, *rest = self.cut(part)
                    # a part that begins with a space belongs to a pre-token of its own
                    head.add(first)
                    tail.update(rest)
                    parts.append((first, rest))
            plan.append(parts)
        head.difference_update(self.head)
        tail.difference_update(self.tail)
        if head or tail:
            gc.disable()  # the many small objects made here hold no cycles
            try:
                self._learn(head, tail)
            finally:
                gc.enable()
        out = []
        for parts in plan:
            pieces = []
            for part in parts:
                if isinstance(part, str):
                    pieces.append(self.v.added[part].to_bytes(4, "little"))
                else:
                    pieces.append(self.head[part[0]])
                    pieces.extend(map(self.tail.__getitem__, part[1]))
            out.append(b"".join(pieces))
        return out

    def decode(self, ids: bytes) -> str:
        """Text of the ids, added tokens included; bytes that are no UTF-8 become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def decode_bytes(self, ids: bytes) -> bytes:
        return b"".join(map(self.v.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def text_groups(texts: list[str | None], max_chars: int = 2_000_000) -> Iterator[slice]:
    """Consecutive runs of texts of about ``max_chars`` characters, at least one text each."""
    start = chars = 0
    for i, t in enumerate(texts):
        if i > start and chars + len(t or "") > max_chars:
            yield slice(start, i)
            start, chars = i, 0
        chars += len(t or "")
    if start < len(texts):
        yield slice(start, len(texts))


def read_vocabulary(path: str) -> str:
    """The tokenizer file's text, read on the driver (its size is that of a vocabulary, not of the data)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _codec(vocabulary: str, max_cached: int, digests: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = worker_cache(("bpe", hashlib.sha256(vocabulary.encode()).digest(), max_cached), lambda: Encoder(vocabulary, max_cached))
        for batch in batches:
            texts = batch["text"].tolist()
            texts = [t if isinstance(t, str) else None for t in texts]
            for part in text_groups(texts):
                ids = enc.encode(texts[part])
                out = {"doc_id": batch["doc_id"].iloc[part], "n_tokens": [len(x) // 4 for x in ids]}
                if digests:
                    out["ids_sha256"] = [hashlib.sha256(x).hexdigest() for x in ids]
                    out["decoded_sha256"] = [hashlib.sha256(enc.decode(x).encode("utf-8", "replace")).hexdigest() for x in ids]
                else:
                    out["ids"] = [np.frombuffer(x, "<u4").astype(np.int32) for x in ids]
                    out["decoded"] = [enc.decode(x) for x in ids]
                yield pd.DataFrame(out)
    return run


def bpe_encode(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
               max_cached: int = 800_000) -> DataFrame:
    """``(doc_id, n_tokens, ids array<int>, decoded string)`` of every whole text.

    Null and empty texts give no ids and the empty text.  A null id is kept.
    Repeated rows give repeated results.  Other columns are ignored.  Texts of
    any length are encoded whole.  It is one narrow pass: no shuffle.
    """
    return pick(docs, doc_id=id_col, text=text_col).mapInPandas(
        _codec(read_vocabulary(vocabulary_path), max_cached, False),
        "doc_id long, n_tokens long, ids array<int>, decoded string")


def bpe_digests(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
                max_cached: int = 800_000) -> DataFrame:
    """As ``bpe_encode``, with SHA-256 digests of ids and decoded text made in the same pass."""
    return pick(docs, doc_id=id_col, text=text_col).mapInPandas(
        _codec(read_vocabulary(vocabulary_path), max_cached, True),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

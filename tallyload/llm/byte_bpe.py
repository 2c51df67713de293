"""Operator 11: byte-level BPE by a rank file, as a fold of Spark's higher-order functions over distinct words.

A token is written as one character, its rank plus one, so a word is a string
of symbols and a pair of symbols is the key of a literal rank map (dealt into
an array of small maps by CRC-32, because Spark looks a map up linearly).

* Words of up to ``_LONG`` bytes: ``aggregate`` folds merges over the word.  The
  state holds the symbols and what every adjacent pair merges to; a step takes
  the smallest (leftmost if there are several), and looks up only the two pairs
  that it makes.
* Longer ones: a step replaces all occurrences of the lowest pair at once, and
  only the leftmost if that could differ, that is if several pairs have that
  rank or a pair made by the replacement has a lower one.

Words longer than ``_CUT`` bytes are cut beforehand between two bytes that
stand next to each other in no token, where nothing ever merges.

The documents stay where they are: a task bundles them into rows of numbers of
the pieces between spaces, of the pieces that it has not sent before (as numbers
of words) and of such words (as symbols of their bytes, with what each pair of
bytes merges to), Spark folds the words of each bundle, and the same task puts
the documents' ids together again, and the bytes of their tokens.  Both ends of
a task forget words and pieces together, once there are too many.  Nothing is
shuffled, and a lost executor costs its running tasks only.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyload.llm.common import pick

# The White_Space characters, which the library's \s means.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_BUCKETS = 65536  # small maps of the rank map, a power of two
_EDGE = "\ue000"  # beyond every symbol
_CUT, _LONG = 48, 256
_WORDS, _CODES = 100_000, 2_000_000  # new words (and half the new pieces) and piece numbers of a bundle
_KNOWN = 400_000  # words and pieces that a task remembers
# The pattern under which letters, with a mark at their end, are split without a search.
_MARKS = (",", ".", "!", "?")
_LETTERS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file (base64 and number on a line); read on the driver."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("a rank file must hold all single bytes")
    if max(ranks.values()) + 1 >= 0xD800:
        raise ValueError("ranks beyond 55294 do not fit a symbol of their own")
    return ranks


def _symbol(rank: int) -> str:
    return chr(rank + 1)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def library_pattern(pattern: str) -> regex.Pattern:
    """The split pattern with the library's meaning of white space."""
    return regex.compile(pattern.replace(r"[^\s", f"[^{_WHITE}").replace(r"\S", f"[^{_WHITE}]").replace(r"\s", f"[{_WHITE}]"))


def _merge_plain(word: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    parts = [word[i:i + 1] for i in range(len(word))]
    while len(parts) > 1:
        rank, i = min((ranks.get(a + b, len(ranks) + 1), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank > len(ranks):
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


def unreached(ranks: dict[bytes, int]) -> set[bytes]:
    """Tokens that the merges of their own bytes do not end in."""
    return {t for t in ranks if len(_merge_plain(t, ranks)) > 1}


class RankTables:
    """The literal of the fold, made from a rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        merges: list[dict[str, str]] = [{} for _ in range(_BUCKETS)]
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    key = _symbol(a) + _symbol(b)
                    merges[zlib.crc32(key.encode()) % _BUCKETS][key] = _symbol(rank)
        self._json = json.dumps({"merges": merges}, ensure_ascii=False, separators=(",", ":"))

    def words(self, words: Column) -> Column:
        """The tokens, as symbols, of each word of an array of ``(s, merges)``: symbols of bytes, and what their pairs merge to.

        The literal is parsed once for each array.  It depends on the array, so
        that it is not folded into the plan, where every task would have to
        read all its entries as objects.
        """
        tables = F.from_json(F.when(words.isNotNull(), F.lit(self._json)), "merges array<map<string,string>>")
        return _let(tables["merges"], lambda m: F.transform(
            words, lambda x: F.when(F.length(x["s"]) < 4, _inner(x["s"])).when(F.length(x["s"]) <= _LONG + 2, _fold(x, m))
            .otherwise(_rounds(_inner(x["s"]), m))))


def _inner(s: Column) -> Column:
    return F.substring(s, F.lit(2), F.length(s) - 2)


def _merged(pair: Column, merges: Column) -> Column:
    """The symbol that a pair of symbols merges to, or null; symbols order like ranks."""
    return F.try_element_at(F.get(merges, F.crc32(pair.cast("binary")).bitwiseAND(_BUCKETS - 1).cast("int")), pair)


def _fold(word: Column, ranks: Column) -> Column:
    # an _EDGE at both ends gives every pair two neighbours; merges[i] is what the pair at i merges to, or _EDGE
    def step(state: Column, _: Column) -> Column:
        def merge(low: Column, at: Column) -> Column:
            def spliced(s: Column) -> Column:
                pairs = F.array(F.substring(s, at - 1, F.lit(2)), F.substring(s, at, F.lit(2)))
                made = F.array_join(F.transform(pairs, lambda p: _merged(p, ranks)), "", _EDGE)
                return F.struct(s.alias("s"), F.overlay(state["merges"], made, at - 1, F.lit(3)).alias("merges"))

            return _let(F.overlay(state["s"], low, at, F.lit(2)), spliced)

        lowest = F.array_min(F.split(state["merges"], ""))
        return _let(lowest, lambda low: F.when(low == _EDGE, state).otherwise(_let(F.instr(state["merges"], low), lambda at: merge(low, at))))

    return F.aggregate(F.sequence(F.lit(4), F.length(word["s"])), word, step, lambda x: _inner(x["s"]))


def _rounds(text: Column, ranks: Column) -> Column:
    def pairs_of(s: Column) -> Column:
        parts = F.split(s, "")
        n = F.size(parts)
        return F.array_distinct(F.zip_with(F.slice(parts, F.lit(1), n - 1), F.slice(parts, F.lit(2), n - 1),
                                           lambda a, b: F.concat(a, b)))

    def step(state: Column, _: Column) -> Column:
        s = state["s"]

        def merge(found: Column) -> Column:
            low = F.array_min(found)

            def replaced(x: Column) -> Column:
                m, p = x["low"]["m"], x["low"]["p"]
                ties = F.filter(found, lambda y: y["m"] == m)
                everywhere = F.replace(s, p, m)
                made = F.concat(F.filter(pairs_of(everywhere), lambda y: F.contains(y, m)), F.array(F.concat(m, F.left(p, F.lit(1)))))
                lower = F.exists(made, lambda y: F.coalesce(_merged(y, ranks) < m, F.lit(False)))
                first = F.array_min(F.transform(ties, lambda y: F.instr(s, y["p"])))
                once = F.concat(F.substring(s, F.lit(1), first - 1), m, F.substring(s, first + 2, F.length(s)))
                return F.struct(F.when((F.size(ties) > 1) | lower, once).otherwise(everywhere).alias("s"), F.lit(False).alias("done"))

            ended = F.struct(s.alias("s"), F.lit(True).alias("done"))
            return F.when(low.isNull(), ended).otherwise(_let(F.struct(low.alias("low")), replaced))

        found = F.filter(F.transform(pairs_of(s), lambda p: F.struct(_merged(p, ranks).alias("m"), p.alias("p"))),
                         lambda x: x["m"].isNotNull())
        return F.when(state["done"], state).otherwise(_let(found, merge))

    start = F.struct(text.alias("s"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(2), F.length(text)), start, step, lambda state: state["s"])


_INTS = pa.list_(pa.int32())
_BUNDLE = pa.schema([("doc_ids", pa.list_(pa.int64())), ("lengths", _INTS), ("codes", _INTS), ("piece_lengths", _INTS), ("piece_words", _INTS),
                     ("words", pa.list_(pa.struct([("s", pa.string()), ("merges", pa.string())]))), ("forgotten", pa.bool_())])
_BUNDLE_DDL = ("doc_ids array<bigint>, lengths array<int>, codes array<int>, piece_lengths array<int>, piece_words array<int>, "
               "words array<struct<s: string, merges: string>>, forgotten boolean")


class _Numbers(dict):
    """Numbers of pieces; one that is looked up for the first time is learnt."""

    def __init__(self, learn):
        self._learn = learn

    def __missing__(self, piece: str) -> int:
        self[piece] = at = self._learn(piece)
        return at


def _cutter(ranks: dict[bytes, int], whole: set[bytes]):
    joined = np.zeros((256, 256), bool)
    for token in ranks:
        for a, b in zip(token, token[1:]):
            joined[a, b] = True

    def cut(word: bytes) -> list[bytes]:
        if len(word) <= _CUT:
            return [word]
        x = np.frombuffer(word, np.uint8)
        ends = [*(np.flatnonzero(~joined[x[:-1], x[1:]]) + 1).tolist(), len(word)]
        parts = [word[a:b] for a, b in zip([0, *ends], ends)]
        # such a token stands for whole words only
        return [word] if whole.intersection(parts) else parts
    return cut


def _starts(ranks: dict[bytes, int]):
    """From words of bytes to the states that their folds begin with: symbols, and what each pair merges to."""
    edge = ord(_EDGE)
    symbols = np.array([ranks[bytes([b])] + 1 for b in range(256)] + [edge], "<u4")
    merges = np.full((257, 257), edge, "<u4")
    for token, rank in ranks.items():
        if len(token) == 2:
            merges[token[0], token[1]] = rank + 1

    def starts(words: list[bytes]) -> list[pa.Array]:
        ends = np.cumsum([1 + len(w) for w in words], dtype=np.int64)
        x = np.zeros(ends[-1] + 1 if words else 1, np.int16)
        x[1:] = np.frombuffer(b"".join([w + b"\0" for w in words]), np.uint8)
        x[0] = x[ends] = 256  # the edges
        s, m = symbols[x].tobytes().decode("utf-32-le"), merges[x[:-1], x[1:]].tobytes().decode("utf-32-le")
        at = [0, *ends.tolist()]
        return [[s[a:b + 1] for a, b in zip(at, at[1:])], [m[a:b] for a, b in zip(at, at[1:])]]
    return starts


def _bundles(ranks: dict[bytes, int], alone: set[bytes], pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, letters = library_pattern(pattern).findall, pattern == _LETTERS
        # a space before another character always begins a word of its own, so what is between is split by itself, once
        spaced = re.compile(f" (?=[^{_WHITE}])").split
        cut, starts = _cutter(ranks, alone), _starts(ranks)
        known, words, whole, n_words = {}, [], {}, 0
        # word numbers of all remembered pieces, their ends, and how many pieces and numbers have been sent
        piece_words, piece_ends, sent = array("i"), array("i", [0]), (0, 0)
        doc_ids, lengths, codes, n_codes, forgotten = [], [], [], 0, True

        def new(token: str) -> range:
            nonlocal n_words
            word = token.encode("utf-8", "replace")
            if word in alone:
                # the library takes a word that is a token as it is, also where its merges end elsewhere
                whole[len(words)] = _symbol(ranks[word])
                words.append(b"")
            elif len(word) <= _CUT:
                words.append(word)
            else:
                words.extend(parts := cut(word))
                n_words += len(parts)
                return range(n_words - len(parts), n_words)
            n_words += 1
            return range(n_words - 1, n_words)

        def number(token: str) -> Sequence[int]:
            if letters:
                # letters are remembered as a piece only
                at = heads[token] if token.isalpha() else tails[token[1:]] if token[0] == " " and token[1:].isalpha() else None
                if at is not None:
                    return piece_words[piece_ends[at]:piece_ends[at + 1]]
            if token not in known:
                known[token] = new(token)
            return known[token]

        def learn(space: str, piece: str) -> int:
            if letters and piece.isalpha():
                at = new(space + piece)
            elif letters and piece[-1:] in _MARKS and piece[:-1].isalpha():
                at = [*number(space + piece[:-1]), *number(piece[-1])]
            else:
                at = [*chain.from_iterable(map(number, find(space + piece)))]
            piece_words.extend(at)
            piece_ends.append(len(piece_words))
            return len(piece_ends) - 2

        heads, tails = _Numbers(lambda piece: learn("", piece)), _Numbers(lambda piece: learn(" ", piece))

        def bundle() -> pa.RecordBatch:
            s, merges = starts(words)
            for at, symbol in whole.items():
                s[at], merges[at] = _EDGE + symbol + _EDGE, _EDGE + _EDGE
            pairs = pa.StructArray.from_arrays([pa.array(s, pa.string()), pa.array(merges, pa.string())], ["s", "merges"])
            lists = [doc_ids, lengths, np.concatenate(codes), np.diff(piece_ends[sent[0]:]), np.array(piece_words[sent[1]:], np.int32)]
            row = [pa.array([x], f.type) for x, f in zip(lists, _BUNDLE)]
            return pa.RecordBatch.from_arrays([*row, pa.ListArray.from_arrays([0, len(words)], pairs), pa.array([forgotten])], schema=_BUNDLE)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                first, *rest = spaced(text.as_py() or "")
                found = np.empty(1 + len(rest), np.int32)
                found[0] = heads[first]
                found[1:] = np.fromiter(map(tails.__getitem__, rest), np.int32, len(rest))
                doc_ids.append(doc_id)
                lengths.append(len(found))
                codes.append(found)
                n_codes += len(found)
                if len(words) > _WORDS or len(piece_ends) - sent[0] > 2 * _WORDS or n_codes > _CODES:
                    yield bundle()
                    doc_ids, lengths, codes, n_codes, words, whole, forgotten = [], [], [], 0, [], {}, False
                    if n_words + len(piece_ends) > _KNOWN:
                        piece_words, piece_ends, n_words, forgotten = array("i"), array("i", [0]), 0, True
                        for numbers in (known, heads, tails):
                            numbers.clear()
                    sent = len(piece_ends) - 1, len(piece_words)
        if doc_ids:
            yield bundle()
    return run


def _ends(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def _documents(ranks: dict[bytes, int], digests: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            token_bytes[rank] = token
        token_names = [f"{t} " for t in range(len(token_bytes))]
        for batch in batches:
            for i in range(batch.num_rows):
                doc_ids, lengths, codes, piece_lengths, piece_words, coded = (batch.column(c)[i].values for c in range(6))
                if batch.column(6)[i].as_py():
                    # of words: numbers of ids, their bytes, and the ids as text or as array; the same of pieces
                    word_sizes, word_bytes, word_ids = np.zeros(0, np.int64), [], []
                    sizes, pieces, ids = np.zeros(0, np.int64), [], []
                # symbols are characters of one code unit each, a rank and one
                new = pc.utf8_length(coded).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = np.frombuffer("".join(coded.to_pylist()).encode("utf-16-le"), "<u2").astype(np.int32) - 1
                ends, listed = _ends(new).tolist(), flat.tolist()
                each = [listed[a:b] for a, b in zip(ends, ends[1:])]
                word_sizes = np.concatenate([word_sizes, new])
                word_bytes += [b"".join([token_bytes[t] for t in x]) for x in each]
                word_ids += ["".join([token_names[t] for t in x]) for x in each] if digests else [flat[a:b] for a, b in zip(ends, ends[1:])]
                join = "".join if digests else lambda x: np.concatenate([flat[:0], *x])
                at = piece_words.to_numpy()
                ends, total, at = _ends(piece_lengths.to_numpy()), _ends(word_sizes[at]), at.tolist()
                sizes = np.concatenate([sizes, np.diff(total[ends])])
                ends = ends.tolist()
                for of_words, of_pieces, joined in ((word_bytes, pieces, b"".join), (word_ids, ids, join)):
                    of_pieces += [of_words[at[a]] if b - a == 1 else joined([of_words[w] for w in at[a:b]]) for a, b in zip(ends, ends[1:])]
                codes, at = codes.to_numpy(), _ends(lengths.to_numpy()).tolist()
                n_tokens, first, second = [], [], []
                for a, b in zip(at, at[1:]):
                    mine = codes[a:b].tolist()
                    n_tokens.append(int(sizes[codes[a:b]].sum()))
                    text, named = b"".join(map(pieces.__getitem__, mine)), join(map(ids.__getitem__, mine))
                    if digests:
                        first.append(hashlib.sha256(named[:-1].encode()).hexdigest())
                        second.append(hashlib.sha256(text).hexdigest())
                    else:
                        first.append(named)
                        second.append(text)
                columns = [doc_ids, n_tokens, first, second]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    return run


def _run(docs: DataFrame, ranks_path: str, pattern: str, id_col: str, text_col: str, digests: bool) -> DataFrame:
    ranks = read_ranks(ranks_path)
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    bundles = rows.mapInArrow(_bundles(ranks, unreached(ranks), pattern), _BUNDLE_DDL)
    coded = bundles.select("doc_ids", "lengths", "codes", "piece_lengths", "piece_words", RankTables(ranks).words(F.col("words")).alias("tokens"), "forgotten")
    kinds = [("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] if digests else [
        ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())]
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), *kinds])
    ddl = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded binary"
    return coded.mapInArrow(_documents(ranks, digests, schema), f"doc_id long, n_tokens long, {ddl}")


def byte_bpe_encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids array<int>, decoded binary)`` of every whole text.

    Each match of ``pattern`` is encoded by itself, without special tokens.
    Null and empty texts give no ids and no bytes.  Null and repeated ids are
    kept as they are, one row for each input row.  Other columns are ignored.
    An empty table gives an empty result.
    """
    return _run(docs, ranks_path, pattern, id_col, text_col, False)


def byte_bpe_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``byte_bpe_encode``, with SHA-256 of the decimal ids joined by one space, and of the decoded bytes."""
    return _run(docs, ranks_path, pattern, id_col, text_col, True)

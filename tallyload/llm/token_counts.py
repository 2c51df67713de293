"""Operator 7: token counts by field or section, attributed through token offsets.

A document is encoded once and whole.  Its tokens' spans and its sections'
spans are two sorted interval lists, which one ``searchsorted`` joins.  A token
that lies in several sections goes to one of them by rule:

* ``first``: the section that holds its first byte,
* ``last``: the section that holds its last byte,
* ``most``: the section that holds most of its bytes, ties to the earlier one.

Offsets are counted in bytes of UTF-8; sections begin at character borders, so
byte and character borders agree.  Counts of a document always add up to its
number of tokens.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyload.llm.bpe import Encoder, read_vocabulary, text_groups
from tallyload.llm.common import worker_cache

RULES = ("first", "last", "most")


def line_starts(data: bytes) -> np.ndarray:
    """Byte offsets at which the lines of a text begin; a line keeps its line feed.  No text, no line."""
    arr = np.frombuffer(data, np.uint8)
    starts = np.concatenate(([0], np.flatnonzero(arr == 10) + 1))
    return starts[starts < len(arr)]


def attribute(lengths: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, int]:
    """Tokens by section and number of tokens in several sections.

    ``lengths``: bytes of each token, in order; ``starts``: sorted section
    starts, the first of them 0.
    """
    counts = np.zeros(len(starts), np.int64)
    if not len(lengths):
        return counts, 0
    ends = np.cumsum(lengths)
    begins = ends - lengths
    first = np.searchsorted(starts, begins, "right") - 1
    last = np.searchsorted(starts, ends - 1, "right") - 1
    home = last if rule == "last" else first.copy()
    crossing = np.flatnonzero(first != last)
    if rule == "most":
        for t in crossing:
            edges = np.concatenate(([begins[t]], starts[first[t] + 1: last[t] + 1], [ends[t]]))
            home[t] = first[t] + int(np.argmax(np.diff(edges)))
    np.add.at(counts, home, 1) if len(home) < 16 else counts.__iadd__(np.bincount(home, minlength=len(starts)))
    return counts, len(crossing)


def _counter(vocabulary: str, rule: str, max_cached: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = worker_cache(("bpe", hashlib.sha256(vocabulary.encode()).digest(), max_cached), lambda: Encoder(vocabulary, max_cached))
        for batch in batches:
            rows = [[f if isinstance(f, str) else "" for f in (r if r is not None else [])] for r in batch["fields"]]
            texts = ["".join(r) for r in rows]
            for part in text_groups(texts):
                out = []
                for fields, ids in zip(rows[part], enc.encode(texts[part])):
                    sizes = [len(f.encode("utf-8", "replace")) for f in fields]
                    full = np.flatnonzero(sizes)
                    starts = np.concatenate(([0], np.cumsum(sizes)))[full].astype(np.int64)
                    lengths = enc.v.lengths[np.frombuffer(ids, "<u4")]
                    counts = np.zeros(len(fields), np.int64)
                    counts[full], crossing = attribute(lengths, starts, rule)
                    out.append((len(lengths), crossing, counts))
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[part], "n_tokens": [x[0] for x in out],
                                    "n_crossing": [x[1] for x in out], "section_tokens": [x[2] for x in out]})
    return run


def token_counts(docs: DataFrame, vocabulary_path: str, fields: list[str] | None = None, id_col: str = "doc_id",
                 text_col: str = "text", rule: str = "most", max_cached: int = 800_000) -> DataFrame:
    """``(doc_id, n_tokens, n_crossing, section_tokens array<long>)`` for each row.

    With ``fields``, a document is the named string columns joined without
    separator, and its sections are those fields (null: empty).  Otherwise the
    sections are the lines of ``text_col``, each with its line feed.  Empty
    sections get 0; null and empty documents get 0 tokens (and no lines).  A
    null id is kept, repeated rows give repeated results, other columns are
    ignored.  It is one narrow pass over whole texts: no shuffle.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    if fields:
        parts = F.array(*[F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")) for f in fields])
    else:
        text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
        lines = F.split(text, "(?<=\n)", -1)
        parts = F.when(text == "", F.array().cast("array<string>")).otherwise(F.filter(lines, lambda x: x != ""))
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), parts.alias("fields")).mapInPandas(
        _counter(read_vocabulary(vocabulary_path), rule, max_cached),
        "doc_id long, n_tokens long, n_crossing long, section_tokens array<long>")

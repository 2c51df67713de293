"""Operator 5: language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent letter n-grams (one to
three letters, words framed by a boundary mark), most frequent first.  A
document's own list is compared to every profile by the out-of-place distance:
the sum, over the document's n-grams, of how many places an n-gram is away from
its place in the profile, or of the profile length if it is not there.

Counts by language cover all training documents: partitions add up what they
hold, Spark adds up the partitions and ranks.  The driver reads ``profile_size``
n-grams of each language, whatever the number of documents.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyload.llm.common import crc32_mod, pick

_BOUNDARY = 1  # no letter has this code point


@functools.cache
def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None, is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (packed in 63 bits, 21 a letter) of the lower-cased letters of a text, and their counts."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cps = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    letter = is_letter[cps]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c = np.where(letter, cps, _BOUNDARY)
    c = np.concatenate(([_BOUNDARY], c, [_BOUNDARY]))
    c = c[np.concatenate(([True], (c[1:] != _BOUNDARY) | (c[:-1] != _BOUNDARY)))]  # one boundary between words
    two = (c[:-1] << 21) | c[1:]
    three = (two[:-1] << 21) | c[2:]
    three = three[(c[1:-1] != _BOUNDARY)]
    return np.unique(np.concatenate((c[c != _BOUNDARY], two, three)), return_counts=True)


def ranked(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first, ties by n-gram."""
    return grams[np.lexsort((grams, -counts))[:size]]


class Profiles:
    """Languages with their ranked n-grams, as one sorted table of (n-gram, language) places."""

    def __init__(self, ranks: dict[str, list[int]], size: int):
        self.langs, self.size = sorted(ranks), size
        grams = sorted({g for x in ranks.values() for g in x})
        self.grams = np.array(grams, np.int64)
        at = {g: i for i, g in enumerate(grams)}
        # the last row stands for n-grams of no profile
        self.place = np.full((len(grams) + 1, len(self.langs)), -1, np.int64)
        for j, lang in enumerate(self.langs):
            for r, g in enumerate(ranks[lang]):
                self.place[at[g], j] = r

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Out-of-place distance to each language, as a share of the largest possible one."""
        at = np.minimum(np.searchsorted(self.grams, own), max(len(self.grams) - 1, 0))
        at = np.where(self.grams[at] == own, at, len(self.grams)) if len(self.grams) else np.zeros(len(own), np.int64)
        place = self.place[at]
        away = np.where(place < 0, self.size, np.minimum(np.abs(place - np.arange(len(own))[:, None]), self.size))
        return away.sum(axis=0) / (self.size * max(len(own), 1))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    is_letter = _letters()
    held: dict[str, list] = {}

    def merged(parts):
        grams, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return grams, np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(grams)).astype(np.int64)

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            held.setdefault(lang, []).append(ngram_counts(text, is_letter))
        for lang, parts in held.items():
            held[lang] = [merged(parts)]
        if sum(len(p[0][0]) for p in held.values()) > 2_000_000:
            for lang, [(g, n)] in held.items():
                yield pd.DataFrame({"lang": lang, "gram": g, "n": n})
            held = {}
    for lang, [(g, n)] in held.items():
        yield pd.DataFrame({"lang": lang, "gram": g, "n": n})


def learn_profiles(docs: DataFrame, profile_size: int = 1000, held_out: int = 0, id_col: str = "doc_id",
                   text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Profiles of all documents with a language whose CRC-32 remainder modulo 5 is not ``held_out``."""
    rows = pick(docs, k=id_col, text=text_col, lang=lang_col).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("k").isNotNull() & (crc32_mod(F.col("k"), 5) != held_out))
    counts = (rows.select("lang", "text").mapInPandas(_count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    top = (counts.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")))
           .where(F.col("place") <= profile_size))
    got = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "gram"))).alias("g")).collect()
    return Profiles({r["lang"]: [x["gram"] for x in r["g"]] for r in got}, profile_size)


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row.

    ``score`` is the lead of the nearest language over the next, as a share of
    the next one's distance (1 with a single language; ties go to the smaller
    language code).  Null texts, texts without a letter and, when nothing was
    learnt, all texts are ``und`` with score 0.  Repeated rows give repeated
    results, a null id is kept, other columns are ignored.  No shuffle.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        is_letter = _letters()
        for batch in batches:
            pred, score = [], []
            for text in batch["text"]:
                grams, counts = ngram_counts(text if isinstance(text, str) else None, is_letter)
                if not len(grams) or not profiles.langs:
                    pred.append("und")
                    score.append(0.0)
                    continue
                d = profiles.distances(ranked(grams, counts, profiles.size))
                best = int(np.argmin(d))
                rest = np.delete(d, best)
                pred.append(profiles.langs[best])
                score.append(float((rest.min() - d[best]) / rest.min()) if len(rest) and rest.min() > 0 else float(not len(rest)))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": pred, "score": score})

    return pick(docs, doc_id=id_col, text=text_col).mapInPandas(run, "doc_id long, lang_pred string, score double")


def language_predictions(docs: DataFrame, profile_size: int = 1000, id_col: str = "doc_id", text_col: str = "text",
                         lang_col: str = "lang") -> DataFrame:
    """Learn on the rows outside the held-out fold, predict for every row; a null id counts as not held out."""
    found = identify(docs, learn_profiles(docs, profile_size, id_col=id_col, text_col=text_col, lang_col=lang_col), id_col, text_col)
    return found.select("doc_id", F.coalesce(crc32_mod(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")

"""Operator 4: quality classifier, a regularised quadratic discriminant.

Every whole text becomes a vector of transformed statistics (logs of sizes,
log-odds of character, word and line shares).  Each class has a mean and a
covariance shrunk towards the pooled covariance and towards its diagonal.  A
score is the difference of the two Gaussian log densities (Mahalanobis term and
log determinant, both from the cached Cholesky factors) plus the log prior
odds, mapped to 0..1.

Statistics are made in one pass and written once.  The classes' counts, sums
and cross products are sums over all labelled rows, added up by partition and
then by Spark; the driver sees them only as d + d*d numbers for each class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyload.llm.common import Scratch, crc32_mod, pick

#: Statistics of a text, in the order of the vector.
STATISTICS = ("chars", "words", "lines", "word_length", "distinct_words", "distinct_lines", "letters", "capitals", "digits",
              "sentence_ends", "commas", "marks", "pipes", "exclamations", "non_ascii", "spaces", "longest_word", "entropy")
_D = len(STATISTICS)

_ASCII = np.arange(256)
_UPPER = (_ASCII >= 65) & (_ASCII <= 90)
_LOWER = (_ASCII >= 97) & (_ASCII <= 122)
_DIGIT = (_ASCII >= 48) & (_ASCII <= 57)
_HIGH = _ASCII >= 128
_MARK = (_ASCII > 32) & (_ASCII < 127) & ~_UPPER & ~_LOWER & ~_DIGIT & ~np.isin(_ASCII, [ord(c) for c in ".,;:'\"()-?"])


def statistics(text: str | None) -> np.ndarray:
    """The transformed statistics of one whole text; null counts as empty."""
    raw = b"" if text is None else text.encode("utf-8", "replace")
    n = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(np.float64)
    chars = n.sum()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    w, ln = len(words), len(lines)
    word_bytes = sum(map(len, words))

    def odds(part: float, whole: float) -> float:
        return np.log((part + 0.5) / (max(whole - part, 0.0) + 0.5)) if whole else 0.0

    p = n[n > 0] / chars if chars else np.ones(1)
    return np.array([
        np.log1p(chars), np.log1p(w), np.log1p(ln), np.log1p(word_bytes / w) if w else 0.0,
        odds(len(set(words)), w), odds(len(set(lines)), ln),
        odds(n[_UPPER].sum() + n[_LOWER].sum() + n[_HIGH].sum(), chars), odds(n[_UPPER].sum(), n[_UPPER].sum() + n[_LOWER].sum()),
        odds(n[_DIGIT].sum(), chars), odds(n[46], w), odds(n[44], w), odds(n[_MARK].sum(), chars), odds(n[124], chars),
        odds(n[33], chars), odds(n[_HIGH].sum(), chars), odds(n[32], chars), np.log1p(max(map(len, words), default=0)),
        float(-(p * np.log(p)).sum())])


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"], "x": [statistics(t if isinstance(t, str) else None) for t in batch["text"]]})


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, x array<double>)`` of every whole text; null and empty texts have the same statistics."""
    return pick(docs, doc_id=id_col, text=text_col).mapInPandas(_measure, "doc_id long, x array<double>")


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    acc = {0: np.zeros((_D + 1, _D + 1)), 1: np.zeros((_D + 1, _D + 1))}
    for batch in batches:
        if len(batch):
            x = np.column_stack([np.ones(len(batch)), np.vstack(batch["x"].to_numpy())])
            y = batch["label"].to_numpy()
            for c in acc:
                acc[c] += x[y == c].T @ x[y == c]
    rows = [(c, i, float(v)) for c, m in acc.items() if m[0, 0] for i, v in enumerate(m.ravel())]
    yield pd.DataFrame(rows, columns=["label", "i", "v"]).astype({"label": "int32", "i": "int32", "v": "float64"})


@dataclass
class Discriminant:
    """Fitted classes: means, Cholesky factors of the shrunk covariances, log determinants, log prior odds."""

    mean: dict[int, np.ndarray]
    chol: dict[int, np.ndarray]
    logdet: dict[int, float]
    prior: float
    centre: np.ndarray
    scale: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        logp = {}
        for c in (0, 1):
            u = np.linalg.solve(self.chol[c], (z - self.mean[c]).T)
            logp[c] = -0.5 * ((u * u).sum(axis=0) + self.logdet[c])
        return 1.0 / (1.0 + np.exp(-np.clip(logp[1] - logp[0] + self.prior, -700, 700)))


def fit(moments: dict[int, np.ndarray], pooled: float = 0.2, diagonal: float = 0.05) -> Discriminant:
    """Classes from their moment matrices (counts, sums and cross products of ``(1, x)``).

    ``pooled`` is the share of the pooled covariance, ``diagonal`` the share of
    the diagonal.  A class without rows takes the pooled moments, so the fit is
    defined for any labels; without any labels every score is 0.5.
    """
    total = sum(moments.values(), np.zeros((_D + 1, _D + 1)))
    n = total[0, 0]
    if not n:
        one = {c: np.zeros(_D) for c in (0, 1)}
        return Discriminant(one, {c: np.eye(_D) for c in (0, 1)}, {0: 0.0, 1: 0.0}, 0.0, np.zeros(_D), np.ones(_D))
    centre = total[0, 1:] / n
    scale = np.sqrt(np.maximum(np.diag(total)[1:] / n - centre**2, 1e-6))
    means, covs, counts = {}, {}, {}
    for c in (0, 1):
        m = moments.get(c, np.zeros((_D + 1, _D + 1)))
        m, counts[c] = (m, m[0, 0]) if m[0, 0] else (total, 0.0)
        mu = m[0, 1:] / m[0, 0]
        covs[c] = (m[1:, 1:] / m[0, 0] - np.outer(mu, mu)) / np.outer(scale, scale)
        means[c] = (mu - centre) / scale
    within = sum(counts[c] * covs[c] for c in (0, 1)) / n
    chol, logdet = {}, {}
    for c in (0, 1):
        s = (1 - pooled) * covs[c] + pooled * within
        s = (1 - diagonal) * s + diagonal * np.diag(np.diag(s)) + 1e-3 * np.eye(_D)
        chol[c] = np.linalg.cholesky(s)
        logdet[c] = float(2 * np.log(np.diag(chol[c])).sum())
    return Discriminant(means, chol, logdet, float(np.log((counts[1] + 1) / (counts[0] + 1))), centre, scale)


def train(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", held_out: int = 2) -> Discriminant:
    """Fit on every labelled row whose CRC-32 remainder modulo 4 is not ``held_out``."""
    seen = (pick(labels, k=id_col, label=label_col)
            .where(F.col("label").isin(0, 1) & F.col("k").isNotNull() & (crc32_mod(F.col("k"), 4) != held_out))
            .select("k", F.col("label").cast("int").alias("label")))
    rows = measured.join(seen, measured["doc_id"] == seen["k"]).select("x", "label")
    sums = rows.mapInPandas(_moments, "label int, i int, v double").groupBy("label", "i").agg(F.sum("v").alias("v")).collect()
    moments = {c: np.zeros((_D + 1) ** 2) for c in (0, 1)}
    for r in sums:  # 2 * (d + 1)**2 rows, whatever the input
        moments[r["label"]][r["i"]] = r["v"]
    return fit({c: m.reshape(_D + 1, _D + 1) for c, m in moments.items()})


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Null and empty texts are scored by the statistics of the empty text.  A null
    id counts as not held out and is kept.  Repeated rows give repeated results;
    a document with several label rows counts once for each.  Labels other than
    0 and 1 are ignored.  Empty tables give empty results; without labels every
    score is 0.5.  Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    measured = scratch.table(document_statistics(docs, id_col, text_col), "statistics")
    model = train(measured, labels, id_col, label_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"doc_id": batch["doc_id"], "score": model.score(np.vstack(batch["x"].to_numpy()))})

    scored = measured.mapInPandas(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(crc32_mod(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality") -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns.

    Each row is judged by its own text, also with a null or repeated id.  The
    texts are measured a second time where they are scored, so no text is
    shuffled to meet its score.
    """
    scratch = Scratch(docs.sparkSession, "accepted")
    model = train(scratch.table(document_statistics(docs, id_col, text_col), "statistics"), labels, id_col, label_col)
    scratch.drop("statistics")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = model.score(np.vstack([statistics(t) for t in batch.column(text_col).to_pylist()]))
                yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)

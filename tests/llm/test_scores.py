"""Operators 4 and 5: held-out accuracy, folds and edge cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from tallyload.llm.language import Profiles, language_predictions, learn_profiles, ngram_counts, ranked, _letters
from tallyload.llm.quality import STATISTICS, fit, quality_scores, statistics

LABEL = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("x", T.StringType())])


def prose(rng, good):
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(20, 80))]
    return " ".join(words) + "." if good else " | ".join(w.upper() + "!!" for w in words)


def test_quality_separates_held_out_rows(spark, documents):
    rng = random.Random(1)
    rows = [(i, prose(rng, i % 5 != 0)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 5 != 0), None) for i, _ in rows] + [(1, None, None), (None, 1, None), (2, 7, None)], LABEL)
    got = {r.doc_id: r for r in quality_scores(documents(rows), labels).collect()}
    assert len(got) == 400
    for i in got:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= got[i].score <= 1 and got[i].predicted == int(got[i].score >= 0.7)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 5 != 0) for r in held) / len(held) > 0.95


def test_quality_ignores_held_out_labels(spark, documents):
    rng = random.Random(2)
    rows = [(i, prose(rng, i % 3 != 0)) for i in range(120)]
    def scores(flip):
        labels = [(i, int((i % 3 != 0) != (flip and zlib.crc32(str(i).encode()) % 4 == 2)), None) for i, _ in rows]
        return sorted((r.doc_id, round(r.score, 9)) for r in quality_scores(documents(rows), spark.createDataFrame(labels, LABEL)).collect())
    assert scores(False) == scores(True)


def test_quality_edges(spark, documents):
    none = spark.createDataFrame([], LABEL)
    rows = [(None, None), (1, ""), (1, ""), (2, "x" * 200_000), (3, " \n")]
    got = quality_scores(documents(rows), none).collect()
    assert len(got) == 5 and all(r.score == 0.5 and r.predicted == 0 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert quality_scores(documents([]), none).collect() == []
    one = spark.createDataFrame([(3, 1, None)], LABEL)
    assert all(0 <= r.score <= 1 for r in quality_scores(documents(rows), one).collect())
    assert (statistics(None) == statistics("")).all() and len(statistics("a")) == len(STATISTICS)


def test_discriminant_matches_densities():
    rng = np.random.default_rng(0)
    d = len(STATISTICS)
    x = {c: rng.normal(size=(300, d)) @ rng.normal(size=(d, d)) + c for c in (0, 1)}
    moments = {c: np.column_stack([np.ones(300), v]).T @ np.column_stack([np.ones(300), v]) for c, v in x.items()}
    model = fit(moments)
    z = (x[1][:5] - model.centre) / model.scale
    logp = {}
    for c in (0, 1):
        cov = model.chol[c] @ model.chol[c].T
        diff = z - model.mean[c]
        logp[c] = -0.5 * (np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff) + np.linalg.slogdet(cov)[1])
    assert np.allclose(model.score(x[1][:5]), 1 / (1 + np.exp(-(logp[1] - logp[0]))))


TEXT = {"xx": "the cat and the dog went there with their other brother", "yy": "der hund und die katze gingen dorthin mit ihrem bruder"}


def language_rows():
    rng = random.Random(3)
    rows = []
    for i in range(120):
        lang = "xx" if i % 2 else "yy"
        w = TEXT[lang].split()
        rows.append((i, " ".join(rng.choice(w) for _ in range(30)), lang))
    return rows


def test_language_held_out_and_edges(documents):
    odd = [(500, None, "xx"), (501, "", None), (502, "12 34 !?", "yy"), (503, "The DOG went", None), (503, "The DOG went", None),
           (None, "die katze", "yy"), (504, "the dog " * 20_000, "xx"), (505, "日本", None)]
    got = language_predictions(documents(language_rows() + odd)).collect()
    assert len(got) == 128
    by_id = {r.doc_id: r for r in got}
    for i, _, lang in language_rows():
        assert by_id[i].lang_pred == lang and by_id[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    assert all(0 <= r.score <= 1 for r in got)
    assert [(by_id[i].lang_pred, by_id[i].score) for i in (500, 501, 502)] == [("und", 0.0)] * 3
    assert by_id[503].lang_pred == "xx" and by_id[504].lang_pred == "xx" and by_id[505].lang_pred in ("xx", "yy")
    assert by_id[None].lang_pred == "yy" and not by_id[None].held_out
    assert language_predictions(documents([])).collect() == []
    assert {r.lang_pred for r in language_predictions(documents([(1, "abc", None)])).collect()} == {"und"}


def test_language_profiles_match_brute_force(documents):
    rows = language_rows()
    profiles = learn_profiles(documents(rows), profile_size=40)
    for j, lang in enumerate(profiles.langs):
        count = {}
        for i, text, own in rows:
            if own == lang and zlib.crc32(str(i).encode()) % 5 != 0:
                s = "\x01" + "\x01".join(text.split()) + "\x01"
                for n in (1, 2, 3):
                    for p in range(len(s) - n + 1):
                        g = s[p:p + n]
                        if g != "\x01" and not (n == 3 and g[1] == "\x01"):
                            code = 0
                            for c in g:
                                code = code << 21 | ord(c)
                            count[code] = count.get(code, 0) + 1
        want = sorted(count, key=lambda g: (-count[g], g))[:40]
        place = {int(g): int(p) for g, p in zip(profiles.grams, profiles.place[:-1, j]) if p >= 0}
        assert place == {g: p for p, g in enumerate(want)}


@pytest.mark.parametrize("text", ["the cat", "und die", "q"])
def test_out_of_place_distance(text):
    profiles = Profiles({"a": [5, 7, 9], "b": [9, 5, 11]}, 3)
    assert profiles.distances(np.array([9, 7, 4])).tolist() == [(2 + 0 + 3) / 9, (0 + 3 + 3) / 9]
    grams, counts = ngram_counts(text, _letters())
    assert len(ranked(grams, counts, 3)) <= 3

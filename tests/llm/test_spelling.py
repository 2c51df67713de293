"""Operator 12 against all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from tallyload.llm.spelling import KdTree, codes_of, counts_of, inserted, replaced, variant_groups


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, noise, ratio=5):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{w}".encode()) if doc_id is not None else 1
            if h % noise == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 6:
                n[w] += 1
    words = sorted(w for w in n if n[w] >= 5)
    out, form = [], {}
    for w in words:
        close = [x for x in words if near(w, x)]
        best = min(close, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
        out.append([w, form[w], None, n[w], len(close), n[form[w]] if form[w] else None])
    for r in out:
        root = r[0]
        while form[root]:
            root = form[root]
        r[2] = root
    return sorted(map(tuple, out), key=str)


def spark_rows(df, **kw):
    return sorted([tuple(r) for r in variant_groups(df, **kw).select("word", "form", "root", "n", "n_near", "form_n").collect()], key=str)


def corpus(seed, n_stems, n_docs):
    """Stems with variants of one or more edits, some far more frequent than others, so that chains and ties arise."""
    rng = random.Random(seed)
    pool = []
    for _ in range(n_stems):
        stem = "".join(rng.choice("abcdeéß") for _ in range(rng.randint(5, 9)))
        pool += [stem] * 400
        for weight in (60, 60, 9, 9, 1):
            w = list(stem)
            kind, at = rng.randrange(3), rng.randrange(len(w))
            w[at:at + (kind != 0)] = [rng.choice("abcdeéß")] if kind != 2 else []
            stem2 = "".join(w)
            pool += [stem2] * weight
            stem = stem2 if weight > 30 or rng.random() < 0.5 else stem
    rng.shuffle(pool)
    cuts = np.array_split(np.array(pool, object), n_docs)
    return [(i, " ".join(x.upper() if rng.random() < 0.1 and x.isascii() else x for x in c)) for i, c in enumerate(cuts)]


def test_groups_equal_all_pairs(documents):
    rows = corpus(1, 60, 40) + [(None, "nullid nullid nullid nullid nullid nullie"), (7, "twice twice"), (7, "twice twice"), (900, None), (901, ""),
                                (902, ("x" * 3000 + " ") * 5 + ("x" * 2999 + "y ") * 30), (903, "1234567 _____ Été-Été " * 9)]
    want = brute(rows, 19)
    assert any(r[1] for r in want) and any(r[2] != (r[1] or r[0]) for r in want)  # forms, and chains of them
    assert spark_rows(documents(rows), noise=19) == want
    assert spark_rows(documents(rows), noise=19, cell_rows=12) == want  # many cells
    assert spark_rows(documents([])) == []


def test_a_frequent_word_and_its_copies(documents):
    rows = [(i, "thewholeword " * 20) for i in range(50)] + [(100 + i, f"thewholeword{c} " * 5) for i, c in enumerate("abcdefgh")]
    assert spark_rows(documents(rows)) == brute(rows, 199)


def test_tree_reaches_every_near_word():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcd") for _ in range(7)) for _ in range(400)]
    x = counts_of(codes_of(words))
    tree = KdTree(x, 8)
    reached = {(int(q), int(p)) for leaf, qs in tree.reach(x, 1, 1) for q in qs for p in tree.leaves[leaf]}
    pairs = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if len(a) == len(b) and near(a, b)}
    assert pairs and pairs <= reached and len(reached) < len(words) ** 2
    home = tree.home(x)
    assert all(i in tree.leaves[home[i]] for i in range(len(words)))


def test_letter_order():
    a, b = codes_of(["abcdef", "abcdef", "abcdef"]), codes_of(["abcdex", "fbcdea", "abcdef"])
    assert replaced(a, b).tolist() == [True, False, False]
    b = codes_of(["abcdefg", "xabcdef", "abdcefg"])
    assert inserted(a, b).tolist() == [True, True, False]

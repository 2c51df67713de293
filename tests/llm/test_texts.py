"""Operators 3 and 10 against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from tallyload.llm.jaccard import jaccard_components, shingle_set
from tallyload.llm.substrings import pack, substring_dedup, unpack
from tallyload.llm.wordhash import Powers, normalise, window_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(rng.randint(0, 9))
    texts = [" ".join(word() for _ in range(rng.randint(0, 90))) for _ in range(40)]
    passage = " ".join(word() for _ in range(25))
    for i in range(5, 30, 3):
        texts[i] += "\n" + passage + "\t" + word()
    near = [word() for _ in range(120)]
    for i in range(30, 36):
        copy = list(near)
        copy[rng.randint(0, 119)] = word()
        texts[i] = "  ".join(copy)
    texts[36] = texts[7]
    texts[37] = texts[36].upper()
    return [(100 - i, t) for i, t in enumerate(texts)]


def brute_substrings(rows, k):
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for p in range(len(w) - k + 1):
            key = tuple(w[p:p + k])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = set()
        for p in range(len(w) - k + 1):
            f = first.get(tuple(w[p:p + k]))
            if f is not None and (i is None or f < i):
                gone.update(range(p, p + k))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


EDGES = [(None, "a b c d e f g"), (None, None), (200, None), (201, ""), (202, " \n\t "), (203, "a b c d e f g"), (203, "a b c d e f g"),
         (204, "x \x1c y z a b c d e f g"), (205, "word " * 3000), (206, "word " * 3000 + "end")]


@pytest.mark.parametrize("k", [4, 13])
def test_substrings_match_brute_force(documents, k):
    rows = corpus() + EDGES
    got = substring_dedup(documents(rows), window=k).collect()
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in got], key=key) == sorted(brute_substrings(rows, k), key=key)
    for r in got:
        assert sum(r.spans[1::2]) - sum(r.spans[::2]) == r.n_removed and all(b - a >= k for a, b in zip(r.spans[::2], r.spans[1::2]))
    digests = {(r.doc_id, r.n_removed, r.kept) for r in substring_dedup(documents(rows), window=k, digests=True).collect()}
    assert digests == {(r.doc_id, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got}


def test_substrings_many_blocks(documents, monkeypatch):
    import tallyload.llm.substrings as s
    monkeypatch.setattr(s, "_LEAST", 50)
    monkeypatch.setattr(s, "_PER_ROW", 1)
    rows = corpus(2)
    got = s.substring_dedup(documents(rows), window=6).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == sorted(brute_substrings(rows, 6))


def test_substrings_empty_table(documents):
    assert substring_dedup(documents([])).collect() == []


def test_window_hashes_tell_sequences_apart():
    rng = random.Random(4)
    powers, seen = Powers(), {}
    for _ in range(300):
        words = [rng.choice("abc") * rng.randint(1, 3) for _ in range(rng.randint(1, 12))]
        h, _, _ = window_hashes(normalise(" ".join(words)), 3, powers)
        assert len(h) == max(0, len(words) - 2)
        for p, x in enumerate(h.tolist()):
            assert seen.setdefault(x, tuple(words[p:p + 3])) == tuple(words[p:p + 3])
    assert len(set(seen.values())) == len(seen)
    v = np.array([1, 2**63 - 1, -5], np.int64)
    assert unpack(pack(v), np.int64).tolist() == v.tolist()


def brute_jaccard(rows, k, num, den):
    sets = {}
    for i, t in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[p:p + k]) for p in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize("k,threshold", [(3, (90, 100)), (5, (80, 100)), (2, (1, 2)), (3, (100, 100))])
def test_jaccard_matches_brute_force(documents, k, threshold):
    rows = corpus(3) + [(300, None), (301, ""), (302, "one"), (303, "ONE"), (304, "one two"), (305, "Kelvin One"), (306, "kelvin one"),
                        (307, "w " * 4000), (308, "w " * 9)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(documents(rows), k, threshold).collect()}
    assert got == brute_jaccard(rows, k, *threshold)


def test_jaccard_small_tiles_and_groups(documents, monkeypatch):
    import tallyload.llm.jaccard as j
    for name, value in (("_TILE", 2), ("_PER_BLOCK", 40), ("_GROUP", 200)):
        monkeypatch.setattr(j, name, value)
    rows = corpus(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in j.jaccard_components(documents(rows), 3, (90, 100)).collect()}
    assert got == brute_jaccard(rows, 3, 90, 100)


def test_jaccard_null_ids_repeated_ids_and_empty_table(documents):
    got = jaccard_components(documents([(None, "a b c"), (9, "a b c"), (9, "x y z"), (4, "x y z"), (9, "a b c")]), 3).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [
        (0, 1, 0), (4, 1, 4), (9, 1, 4), (9, 1, 9), (9, 1, 9)]
    assert jaccard_components(documents([])).collect() == []
    s = shingle_set("A b a B a", 2, Powers())
    assert len(s) == 2

"""Operator 13 against a plain tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tallyload.llm.merkle import merkle_manifest, verify_manifest

FIELDS = ["doc_id", "source", "lang", "text"]


def h(*xs):
    return hashlib.sha256("".join(xs).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes, fanout):
    """Root, and for every node its path: (before, after) of each level."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + fanout] for i in range(0, len(nodes), fanout)]
        for k, at in enumerate(place):
            run = runs[at // fanout]
            paths[k].append((run[:at % fanout], run[at % fanout + 1:]))
        nodes, place = [h(*r) for r in runs], [at // fanout for at in place]
    return nodes[0], paths


def brute(rows, fanout):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subroots, below = [], {}
    for s in order:
        mine = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        root, paths = tree([leaf(r) for r in mine], fanout)
        subroots.append(root)
        below[s] = (mine, paths)
    top, uppers = tree(subroots, fanout)
    out = []
    for s, sub, up in zip(order, subroots, uppers):
        for r, path in zip(*below[s]):
            path = path + up
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            text = r[3].translate({c: c + 32 for c in range(65, 91)}) if r[3] is not None else None
            node = leaf((*r[:3], text)) if changed else leaf(r)
            for a, b in path:
                node = h(*a, node, *b)
            out.append((r[0], leaf(r), sub, top, h(*[x for a, b in path for x in a + b]), node, node == top))
    return sorted(out, key=str)


def spark_rows(df, fanout):
    lower = lambda c: F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    m = merkle_manifest(df, FIELDS, fanout=fanout, altered={"text": lower},
                        altered_where=lambda k: F.crc32(k.cast("string").cast("binary")) % 5 == 0)
    v = verify_manifest(m).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted([tuple(r) for r in v.collect()], key=str)


@pytest.mark.parametrize("fanout", [2, 16])
def test_whole_manifest_equals_a_plain_tree(documents, fanout):
    # a hot source of 70 rows (more than two levels), single rows, null and empty names, null ids, texts and repeated rows
    rows = [(i, f"Text {i} É", "en", "hot") for i in range(70)] + [(100 + i, "Same", None, f"s{i}") for i in range(20)]
    rows += [(200, None, "de", None), (201, "", "de", None), (None, "No Id", "en", "hot"), (None, "No Id", "en", "hot"), (3, "Text 3 É", "en", "hot")]
    rows += [(300, "Empty Source", "en", ""), (301, "W " * 50_000, "en", "-"), (-5, "Minus", "en", "é")]
    got = spark_rows(documents(rows).repartition(5), fanout)
    want = brute([(i, s, lang, t) for i, t, lang, s in rows], fanout)
    assert got == want
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


def test_one_row_and_none(documents):
    (row,) = spark_rows(documents([(7, "only", "en", "s")]), 16)
    one = leaf((7, "s", "en", "only"))
    assert row == (7, one, one, one, h(""), one, True)
    assert spark_rows(documents([]), 16) == []

"""Operators 1 and 2 against brute force."""

import math

import numpy as np
import pytest

from tallyload.llm.embeddings import embedding_neardup, quantised, tile_links, unit
from tallyload.llm.forest import Forest
from tallyload.llm.neighbours import Splits, chi_square_quantile, kd_cells, nearest_neighbours


def cluster_rows(n=150, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = centres[rng.integers(0, 12, n)] + 0.25 * rng.normal(size=(n, dim))
    x[20:60] = x[20]  # a hot vector
    return x.astype(np.float32)


def odd_rows():
    return [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] * 16), (1004, [None] + [1.0] * 15),
            (1005, [float("inf")] + [1.0] * 15), (1006, [1.0, 2.0]), (1007, [2.0, 4.0]), (None, [1.0] * 16)]


def brute_components(ids, link):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in link:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("tile_rows", [4096, 16])
def test_neardup_matches_brute_force(vectors, tile_rows):
    x = cluster_rows()
    rows = [(int(i) * 3, [float(v) for v in r]) for i, r in enumerate(x)]
    got = {r.vec_id: r for r in embedding_neardup(vectors(rows + odd_rows()), 0.9, tile_rows).collect()}
    y = x.astype(np.float64)
    y /= np.linalg.norm(y, axis=1)[:, None]
    cos = y @ y.T
    links = [(i * 3, j * 3) for i in range(len(x)) for j in range(len(x)) if i != j and cos[i, j] >= 0.9]
    label = brute_components([r[0] for r in rows], links)
    for i, _ in rows:
        assert got[i].n_links == sum(a == i for a, _ in links)
        assert got[i].component_id == label[i] and got[i].kept == (label[i] == i)
    for i in (1000, 1001, 1002, 1003, 1004, 1005):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[1006].n_links == got[1007].n_links == 1 and got[1007].component_id == 1006
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)


def test_neardup_repeated_rows_and_empty_table(vectors):
    got = embedding_neardup(vectors([(7, [1.0, 0.0])] * 3 + [(5, [1.0, 0.0])]), 0.9).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == [(5, 3, 5, True)] + [(7, 3, 5, False)] * 3
    assert embedding_neardup(vectors([])).collect() == []
    assert embedding_neardup(vectors([(1, None)])).collect()[0].component_id == 1


def exactly_at(n=400, seed=5):
    """Pairs of integer vectors whose cosine is 0.9 exactly: dot and lengths are integers."""
    rng, out = np.random.default_rng(seed), []
    vectors = rng.integers(0, 10, (4000, 4))
    whole = [(v, math.isqrt(int(v @ v))) for v in vectors if v.any() and math.isqrt(int(v @ v)) ** 2 == int(v @ v)]
    for i, (a, p) in enumerate(whole):
        for b, q in whole[i + 1:]:
            if 10 * int(a @ b) == 9 * p * q:
                out.append((a, b))
                if len(out) == n:
                    return out
    return out


@pytest.mark.parametrize("dense", [False, True])
def test_pairs_exactly_at_the_threshold_link_in_every_tile(vectors, dense):
    found = exactly_at() + [(np.array([1, 0, 0, 0]), np.array([9, 3, 3, 1])), (np.array([0, 1, 2, 2]), np.array([1, 7, 5, 5]))]
    assert len(found) > 100
    for k, (a, b) in enumerate(found[::40] + found[-2:]):
        a, b = a.astype(np.float64), b.astype(np.float64)
        x = np.vstack([a, b, *([a] * 60 if dense else [])])
        x[2:] += np.linspace(1e-4, 1e-3, len(x) - 2)[:, None]  # in the dense tile most pairs are near
        ids, ones = np.arange(len(x)), np.ones(len(x))
        links = lambda y, t: int((tile_links(ids, ones, y, 0, t)["links"].to_numpy()[:1]).sum())
        assert tile_links(ids, ones, x, 0, 0.9)["node"].tolist()[:2] == [0, 1]
        base = links(x, 0.9)
        assert links(x, np.nextafter(0.9, 1)) == base - 1  # the next threshold above loses that pair alone
        assert links(x, np.nextafter(0.9, 0)) == base
        assert links(x * np.ldexp(1.0, 900), 0.9) == base  # and no length matters
    rows = [(2 * i + k, [float(c) for c in v]) for i, pair in enumerate(found[-2:]) for k, v in enumerate(pair)]
    got = {r.vec_id: r.n_links for r in embedding_neardup(vectors(rows), 0.9).collect()}
    assert got[0] >= 1 and got[1] >= 1 and got[2] >= 1 and got[3] >= 1


def test_quantisation_error_bound_holds():
    u = unit(np.random.default_rng(0).normal(size=(200, 48)))
    q, scale, err = quantised(u)
    approx = (q @ q.T) * np.outer(scale, scale)
    bound = err[:, None] * (1 + err[None, :]) + err[None, :]
    assert (np.abs(approx - u @ u.T) <= bound + 1e-6).all()
    assert np.abs(q).max() <= 127


def test_forest_keeps_connectivity():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a, b = rng.integers(0, 40, 30), rng.integers(0, 40, 30)
        f = Forest(40)
        f.add(a[:15], b[:15])
        f.add(a[15:], b[15:])
        want = brute_components(range(40), list(zip(a.tolist(), b.tolist())))
        assert f.label.tolist() == [want[i] for i in range(40)]


def brute_top(ids, x, q, k):
    s = np.einsum("ij,j->i", x, x[q])
    keep = ids != ids[q]
    top = np.lexsort((ids[keep], -s[keep]))[:k]
    return ids[keep][top].tolist()


def test_neighbours_recall_and_ties(vectors):
    x = cluster_rows(400, 16, 5) * np.linspace(0.5, 2, 400)[:, None].astype(np.float32)
    x[20:60] = x[20]
    rows = [(int(i), [float(v) for v in r]) for i, r in enumerate(x)]
    got = nearest_neighbours(vectors(rows + odd_rows()), k=20, query_every=20, shard_rows=64, query_rows=8).collect()
    ids, y = np.arange(400), x.astype(np.float64)
    hits = total = 0
    for q in range(0, 400, 20):
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in mine] == list(range(1, 21))
        assert all(abs(s - float(y[v] @ y[q])) < 1e-9 for _, v, s in mine)
        assert [(-s, v) for _, v, s in mine] == sorted((-s, v) for _, v, s in mine)
        want = brute_top(ids, y, q, 20)
        hits, total = hits + len(set(want) & {v for _, v, _ in mine}), total + 20
    assert hits / total >= 0.9
    hot = [r.vec_id for r in sorted((r for r in got if r.query_id == 40), key=lambda r: r.rank)]
    assert hot == brute_top(ids, y, 40, 20)


def test_neighbours_few_rows_other_lengths_and_empty_table(vectors):
    got = nearest_neighbours(vectors([(20, [1.0, 0.0]), (3, [1.0, 1.0]), (4, [2.0, 0.0]), (5, [1.0, 0.0, 0.0]), (40, None)]), k=20).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(20, 1, 4, 2.0), (20, 2, 3, 1.0)]
    assert nearest_neighbours(vectors([])).collect() == []
    repeated = nearest_neighbours(vectors([(20, [1.0, 0.0])] * 2 + [(3, [1.0, 1.0])] * 2)).collect()
    assert sorted((r["rank"], r.vec_id) for r in repeated) == [(1, 3), (2, 3)]


def test_kd_tree_and_quantile():
    pts = np.random.default_rng(2).normal(size=(500, 4))
    pts[:200] = 0
    cells = kd_cells(pts, 32)
    assert sorted(np.concatenate(cells).tolist()) == list(range(500))
    s = Splits(pts, 8)
    own = s.cell(pts)
    assert all(s.squared(p)[c] == 0 for p, c in zip(pts, own))
    x = chi_square_quantile(0.95, 8)
    assert abs(x - 15.507) < 1e-2 and math.isfinite(x)

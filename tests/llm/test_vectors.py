"""Top-k search and near-duplicate embeddings against brute force."""

import numpy as np
import pytest

from sigweave.llm import forest, topk
from tests.conftest import rows_of

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score string"


def _table(spark, rows):
    return spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA)


def _odd_rows():
    nan, inf = float("nan"), float("inf")
    return [
        (900, None, 1),
        (901, [nan, 1.0], 1),
        (902, [1.0, None], 1),
        (903, [inf, 0.0], 1),
        (904, [0.0, 0.0], 1),
        (905, [], 1),
        (None, [1.0, 0.5], 1),
        (906, [1.0, 0.5], None),
        (907, [1.0], 1),
    ]


def _near_rows(n, seed, dims=16):
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(max(1, n // 6), dims))
    return [
        (i, (heads[rng.integers(len(heads))] + rng.normal(0, 0.03, dims)).tolist(), int(i % 3))
        for i in range(n)
    ]


def _brute_top(rows, k):
    good = [
        (i, [int(np.floor(64 * np.float64(np.float32(x)))) for x in v])
        for i, v, _ in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    found = []
    for q, a in {i: min(v for j, v in good if j == i) for i, _ in good if i % 20 == 0}.items():
        scored = [
            (-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in good if i != q
        ]
        found += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(found, key=repr)


@pytest.mark.parametrize("n, k", [(300, 20), (12, 20)])
def test_top_k(spark, n, k):
    rows = _near_rows(n, 1) + _odd_rows()
    rows += [rows[3], (7, [0.5] * 16, 1), (40, [0.25] * 16, 2)]
    table = _table(spark, rows)
    found = topk.top_k(table, table.filter("vec_id % 20 = 0"), k)
    assert rows_of(found) == _brute_top(rows, k)


def test_top_k_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    rows = _near_rows(400, 2)
    table = _table(spark, rows)
    assert rows_of(topk.top_k(table, table.filter("vec_id % 20 = 0"))) == _brute_top(rows, 20)


def test_top_k_of_huge_values(spark):
    rows = [(0, [3e12, 2e12], 1), (1, [2e9, 1e3], 1), (2, [-4e6, 9e3], 1)]
    table = _table(spark, rows)
    assert rows_of(topk.top_k(table, table.filter("vec_id = 0"), 2)) == [
        (0, 1, 1, 2**63 - 1),
        (0, 2, 2, -(2**63)),
    ]


def test_branch_and_bound_prunes_nothing_it_needs():
    rng = np.random.default_rng(5)
    right = rng.integers(-60, 60, (32, 900))
    left = rng.integers(-60, 60, (30, 32))
    q, c, s = topk.best_of(left, np.arange(30) + 5000, right, np.arange(900), 7)
    full = left @ right
    for i in range(30):
        best = np.lexsort((np.arange(900), -full[i]))[:7]
        assert list(c[q == 5000 + i]) == list(best)
        assert list(s[q == 5000 + i]) == list(full[i][best])


def test_top_k_of_nothing(spark):
    empty = _table(spark, [])
    assert topk.top_k(empty, empty).count() == 0


def _brute_links(rows, least):
    good = []
    for n, (i, v, label) in enumerate(rows):
        fine = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if fine:
            v = np.array(v, dtype=np.float32).astype(float)
            good.append((n, label, v / np.linalg.norm(v)))
    links, part = [0] * len(rows), list(range(len(rows)))
    for a, (n, x, u) in enumerate(good):
        for m, y, w in good[a + 1 :]:
            if x == y and len(u) == len(w) and u @ w >= least:
                links[n] += 1
                links[m] += 1
                old, new = part[m], part[n]
                part = [new if p == old else p for p in part]
    names = {}
    for n, p in enumerate(part):
        names.setdefault(p, []).append(rows[n][0])
    out = []
    for n, p in enumerate(part):
        ids = [i for i in names[p] if i is not None]
        first = min(ids) if ids else None
        kept = None if rows[n][0] is None or first is None else rows[n][0] == first
        out.append((rows[n][0], links[n], first, kept))
    return sorted(out, key=repr)


def test_forest_links(spark):
    rows = _near_rows(240, 3) + _odd_rows()
    rows += [rows[3], rows[3], (500, rows[9][1], rows[9][2])]
    found = forest.near_duplicates(_table(spark, rows))
    assert rows_of(found) == _brute_links(rows, 0.98)


def test_forest_with_splits_and_grid_cells(spark, monkeypatch):
    monkeypatch.setattr(forest, "LEAF_ROWS", 32)
    monkeypatch.setattr(forest, "CELL_ROWS", 24)
    rows = _near_rows(500, 4) + [
        (1000 + i, [1.0] * 15 + [0.001 * i], 0) for i in range(120)
    ]
    found = forest.near_duplicates(_table(spark, rows))
    assert rows_of(found) == _brute_links(rows, 0.98)


def test_forest_of_nothing(spark):
    assert forest.near_duplicates(_table(spark, [])).count() == 0

import numpy as np
import pytest
from cases import clashing

from candlemill.llm import embed_dups as e

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.9):
    good = [(i, np.array(v, np.float64)) for i, v in rows]
    links, root = [0] * len(rows), list(range(len(rows)))
    changed = True
    pairs = []
    for a in range(len(rows)):
        for b in range(a):
            x, y = good[a][1], good[b][1]
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                links[a] += 1
                links[b] += 1
                pairs.append((a, b))
    while changed:
        changed = False
        for a, b in pairs:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return sorted((rows[i][0], links[i], rows[root[i]][0], root[i] == i) for i in range(len(rows)))


def vectors(count=400, dim=32):
    rng = np.random.default_rng(4)
    rows = []
    while len(rows) < count:
        base = rng.standard_normal(dim)
        for _ in range(int(rng.integers(1, 6))):
            rows.append((base + rng.standard_normal(dim) * rng.choice([0.0, 0.1, 0.15])).astype(np.float32).tolist())
    hot = rng.standard_normal(dim)
    rows += [(hot + 0.15 * rng.standard_normal(dim)).astype(np.float32).tolist() for _ in range(150)]
    return list(enumerate(rows))


@pytest.mark.parametrize("block, small", [(2048, 64), (20, 4)])
def test_against_brute_force(spark, monkeypatch, block, small):
    monkeypatch.setattr(e, "BLOCK", block)
    monkeypatch.setattr(e, "SMALL", small)
    rows = vectors()
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = sorted(map(tuple, e.find_duplicates(clashing(table, "rep", "bucket")).collect()))
    want = brute(rows)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(g == w for g, w in zip(got, want, strict=True)) >= 0.95 * len(want)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 1.0]), (8, [2.0, 2.0]),
            (9, [1.0, 1.0]), (9, [1.0, 1.0]), (None, [1.0, 1.0]), (10, [1.0, 1.0, 0.0]), (11, [3e38, 3e38])]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = sorted((tuple(r) for r in e.find_duplicates(table).collect()), key=str)
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 10)]
    linked = [(7, 4, 7, True), (8, 4, 7, False), (9, 4, 7, False), (9, 4, 7, False), (11, 4, 7, False)]
    assert got == sorted([*alone, *linked, (None, 0, None, True)], key=str)
    assert e.find_duplicates(table.limit(0)).count() == 0


def test_collision_probability():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((600, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((600, 64))
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.9 * x + np.sqrt(1 - 0.81) * z
    met = (e.buckets(x) == e.buckets(y)).any(axis=1)
    assert met.mean() > 0.96


def test_vectors_that_share_an_id(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [1.0, 0.01, 0.0]), (5, [0.0, 1.0, 0.02]), (9, [0.0, 0.0, 1.0]), (1, [0.0, 1.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in e.find_duplicates(table).collect())
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 1, 1, False), (5, 2, 1, False), (9, 0, 9, True)]
    alone = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01])], "vec_id long, embedding array<double>")
    assert sorted((r.vec_id, r.n_links) for r in e.find_duplicates(alone).collect()) == [(1, 0), (1, 1), (2, 1)]

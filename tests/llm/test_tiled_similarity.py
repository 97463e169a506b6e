from __future__ import annotations

import numpy as np
import pytest

from landfold.llm import tiled_similarity as tiled

SCHEMA = "vec_id bigint, embedding array<double>"


def brute(rows, least):
    """vec_id to (n_links, component_id, kept), comparing all rows."""
    x = [np.array(v, dtype=float) for _, v in rows]
    n = len(rows)
    link = np.zeros((n, n), dtype=bool)
    for i in range(n):
        for j in range(n):
            if i != j and len(x[i]) == len(x[j]):
                link[i, j] = (x[i] * x[j]).sum() / (np.sqrt((x[i] ** 2).sum()) * np.sqrt((x[j] ** 2).sum())) >= least
    reach = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for i in range(n):
            low = min([reach[i], *(reach[j] for j in np.nonzero(link[i])[0])])
            changed |= low < reach[i]
            reach[i] = low
    return sorted((rows[i][0], int(link[i].sum()), reach[i], reach[i] == rows[i][0]) for i in range(n))


def clustered(n, d, seed, noise=0.25):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(max(2, n // 12), d))
    x = centres[r.integers(0, len(centres), n)] + noise * r.normal(size=(n, d))
    return x * r.uniform(0.1, 9, size=(n, 1))


@pytest.mark.parametrize("d", [1, 2, 5, 24])
def test_all_links(spark, d):
    """Clusters, chains, exact copies (a third of the rows) and opposite vectors."""
    x = clustered(240, d, d)
    x[::3] = x[0]
    x[5] = -x[0]
    rows = [(int(i), v.tolist()) for i, v in zip(np.random.default_rng(9).permutation(1000), x, strict=False)]
    got = tiled.near_vectors(spark.createDataFrame(rows, SCHEMA), 0.9).collect()
    assert sorted(map(tuple, got)) == brute(rows, 0.9)


def test_many_tiles_tasks_and_entries(spark, monkeypatch):
    """Small bounds: leaves cut into tiles, visitors into tasks, copies into entries, comparison into blocks."""
    for name, value in {"TILES": 5, "VISITORS": 1, "COPIES": 40, "LEAVES": 6, "TILE": 1, "ROWS": 20}.items():
        monkeypatch.setattr(tiled, name, value)
    monkeypatch.setattr(tiled._Host, "ROWS", 16)
    monkeypatch.setattr(tiled._Host, "VISITING", 8)
    x = clustered(300, 6, 3, 0.3)
    x[:100] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = tiled.near_vectors(spark.createDataFrame(rows, SCHEMA), 0.9).collect()
    assert sorted(map(tuple, got)) == brute(rows, 0.9)


def test_boxes_out_of_reach_are_not_visited(spark):
    """Far groups: rows go to the tiles of their own group only, and nothing is lost."""
    r = np.random.default_rng(1)
    x = np.repeat(np.eye(8) * 10, 100, axis=0) + 0.2 * r.normal(size=(800, 8))
    axes = tiled.fit(x, 16)
    lead, leaf = tiled._placed(axes, 8, x)
    low = np.array([lead[leaf == k].min(axis=0) for k in range(16)])
    high = np.array([lead[leaf == k].max(axis=0) for k in range(16)])
    none = np.zeros(0)
    of = tiled.Tiles(low, high, none, none, none, none, none, {})
    assert of.reached(lead, 0.2).mean() < 0.3
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = sorted(map(tuple, tiled.near_vectors(spark.createDataFrame(rows, SCHEMA), 0.9).collect()))
    assert [c for _, _, c, _ in got] == [100 * (i // 100) for i in range(800)]


def test_the_bound_stops_no_pair_at_the_threshold():
    """Pairs just above, at and below the threshold, in the block and in the pair by pair way."""
    r = np.random.default_rng(4)
    a = r.normal(size=(200, 12))
    a /= np.linalg.norm(a, axis=1)[:, None]
    side = r.normal(size=a.shape)
    side -= (side * a).sum(axis=1)[:, None] * a
    side /= np.linalg.norm(side, axis=1)[:, None]
    c = 0.9 + r.choice([0, 1e-12, -1e-12, 1e-7, -1e-7], size=200)
    b = c[:, None] * a + np.sqrt(1 - c**2)[:, None] * side
    axes = tiled.fit(np.vstack([a, b]), 4)
    i, j = tiled.near(tiled._Vectors(a, axes), tiled._Vectors(b, axes), slice(0, 200), slice(0, 200), 0.9)
    want = [(m, n) for m in range(200) for n in range(200) if (a[m] * b[n]).sum() / (np.sqrt((a[m] ** 2).sum()) * np.sqrt((b[n] ** 2).sum())) >= 0.9]
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == want


def test_vectors_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, None), (7, []), (2, [0.0, 0.0])]
    rows += [(None, [1.0, 1.0]), (9, [2.0, 2.0]), (9, [2.0, 2.0]), (None, [1.0, -1.0]), (8, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS cls", "2 AS id", "3 AS copies", "4 AS task")
    got = sorted(map(tuple, tiled.near_vectors(df).collect()), key=repr)
    assert got == sorted(
        [(i, 0, i, True) for i in (2, 3, 4, 5, 6, 7, 8)]
        + [(9, 2, 9, True), (9, 2, 9, True), (None, 2, 9, False), (None, 0, None, True)],
        key=repr,
    )


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0])]])
def test_small_tables(spark, rows):
    got = tiled.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert list(map(tuple, got)) == [(i, 0, i, True) for i, _ in rows]

from __future__ import annotations

import numpy as np
import pytest

from landfold.llm import hard_negatives as hard

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def every(n):
    return lambda vec_id: vec_id % n == 0


def brute(rows, asks):
    rows = [(i, np.floor(256 * np.array(v)).astype(int).tolist(), k) for i, v, k in rows]
    out = []
    for i, a, label in rows:
        if i % asks:
            continue
        score = [(-sum(x * y for x, y in zip(a, b, strict=True)), j, k) for j, b, k in rows if len(a) == len(b)]
        own = sorted((s, j) for s, j, k in score if k == label and j != i)[:5]
        for p, positive in own:
            hit = sorted((s, j) for s, j, k in score if k != label and 80 * -p <= 100 * -s <= 100 * -p)[:5]
            out += [(i, positive, r, j, -p, -s) for r, (s, j) in enumerate(hit, 1)]
    return sorted(out)


def table(n, d, seed, labels=4):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(8, d))
    x = centres[r.integers(0, 8, n)] + 0.3 * r.normal(size=(n, d))
    return [(int(i), v.tolist(), int(k)) for i, v, k in zip(r.permutation(3 * n)[:n], x, r.integers(0, labels, n), strict=True)]


@pytest.mark.parametrize("d", [1, 3, 16])
def test_against_all_scores(spark, d):
    """Clusters, and a third of the rows copies of one vector, some of other labels."""
    rows = table(300, d, d)
    rows = [(i, rows[0][1] if m % 3 == 0 else v, k) for m, (i, v, k) in enumerate(rows)]
    got = hard.mine(spark.createDataFrame(rows, SCHEMA), every(6)).collect()
    assert sorted(map(tuple, got)) == brute(rows, 6) != []


def test_many_blocks_and_shards(spark, monkeypatch):
    for name, value in {"BLOCK": 6, "SHARD": 40, "SHARDS": 3, "STEP": 16}.items():
        monkeypatch.setattr(hard, name, value)
    rows = table(400, 5, 11) + [(90_000 + 6 * i, [0.1 * i, -1.0], i % 3) for i in range(40)]
    got = hard.mine(spark.createDataFrame(rows, SCHEMA), every(6)).collect()
    assert sorted(map(tuple, got)) == brute(rows, 6)


def test_large_numbers_are_exact(spark):
    """Scores beyond what a double can hold exactly."""
    r = np.random.default_rng(3)
    base = r.integers(-(2**21), 2**21, size=8).astype(float)
    rows = [(i, (base + r.integers(0, 2, size=8) / 256).tolist(), i % 3) for i in range(90)]
    got = hard.mine(spark.createDataFrame(rows, SCHEMA), every(6)).collect()
    assert sorted(map(tuple, got)) == brute(rows, 6)


def test_few_candidates_are_rescored():
    """Anchors near each other: the intervals at their parents rule most candidates out."""
    import pyarrow as pa

    r = np.random.default_rng(0)
    centre = r.normal(size=32)
    x = np.floor(256 * (centre + 0.01 * r.normal(size=(200, 32))))
    order, parent, edge = hard.spanning_tree(x)
    assert sorted(order) == list(range(200)) and parent[0] == -1 and (parent[1:] < np.arange(1, 200)).all()
    anchors = pa.table(
        {
            "anchor": order,
            "vec_id": order + 10_000,
            "label": np.zeros(200, dtype=int),
            "vector": pa.array(x[order].tolist()),
            "parent": parent,
            "edge": edge,
        }
    )
    block = hard._Block(anchors, 5, False)
    for _ in range(20):
        y = np.floor(256 * r.normal(size=(512, 32)))
        block.look(np.arange(512), np.zeros(512, dtype=int), y)
    assert block.rescored < 0.2 * block.seen


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9, 0.0], 2), (3, [0.5, 0.1], 2), (6, [-1.0, 0.0], 1)]
    bad = [(7, [1.0, 0.0], None), (8, None, 1), (9, [nan, 1.0], 2), (10, [inf, 0.0], 2), (11, [None, 1.0], 2)]
    bad += [(12, [1e200, 0.0], 2), (13, [], 2), (14, [1.0], 2), (None, [1.0, 0.0], 2)]
    df = spark.createDataFrame(good + good[:2] + bad, SCHEMA).selectExpr("*", "1 AS anchor", "2 AS node", "3 AS w")
    got = sorted(map(tuple, hard.mine(df, every(6)).collect()))
    assert got == brute(good, 6) == [(0, 1, 1, 2, 65536, 58880)]


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1)], [(0, [1.0], 1)], [(0, [0.0], 1), (1, [0.0], 1), (2, [0.0], 0)]])
def test_small_tables(spark, rows):
    got = hard.mine(spark.createDataFrame(rows, SCHEMA), every(6)).collect()
    assert sorted(map(tuple, got)) == brute(rows, 6)

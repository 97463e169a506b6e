from __future__ import annotations

import numpy as np
import pytest

from landfold.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<double>"


def every(n):
    return lambda vec_id: vec_id % n == 0


def brute(rows, asks, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=float)
    out = {}
    for i, q in zip(ids, x, strict=True):
        if i % asks == 0:
            score = (x * q).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_against_brute_force(spark):
    r = np.random.default_rng(0)
    centres = r.normal(size=(30, 16))
    x = centres[r.integers(0, 30, 3000)] + 0.4 * r.normal(size=(3000, 16))
    x *= r.uniform(0.2, 3, size=(3000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = found(neighbours.search(spark.createDataFrame(rows, SCHEMA), every(20))), brute(rows, 20, 20)
    assert got.keys() == want.keys() and all(len(g) == 20 for g in got.values())
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9
    for q, answers in got.items():
        assert answers == sorted(answers, key=lambda a: (-a[1], a[0]))
        assert all(abs(s - float((x[v] * x[q]).sum())) < 1e-12 for v, s in answers)


def test_copies_ties_and_blocks(spark, monkeypatch):
    """A third of the rows is one vector; small blocks split its leaf and its visitors."""
    monkeypatch.setattr(neighbours, "BLOCK", 8)
    r = np.random.default_rng(1)
    x = np.round(r.normal(size=(300, 4)), 1)
    x[::3] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = found(neighbours.search(spark.createDataFrame(rows, SCHEMA), every(4), 20, recall=1.0))
    want = brute(rows, 4, 20)
    assert {q: [v for v, _ in a] for q, a in got.items() if q % 3 == 0} == {q: [v for v, _ in a] for q, a in want.items() if q % 3 == 0}


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, None), (7, []), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (40, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS cls", "2 AS leaf", "3 AS ids")
    assert found(neighbours.search(df, every(20))) == {
        0: [(20, 1.0), (1, 0.5), (40, -1.0)],
        20: [(0, 1.0), (1, 0.5), (40, -1.0)],
        40: [(1, -0.5), (0, -1.0), (20, -1.0)],
    }


@pytest.mark.parametrize("rows", [[], [(1, [0.0])], [(0, [1.0])], [(1, [1.0]), (2, [2.0])]])
def test_nothing_to_find(spark, rows):
    assert neighbours.search(spark.createDataFrame(rows, SCHEMA), every(20)).collect() == []

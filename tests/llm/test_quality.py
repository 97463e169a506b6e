from __future__ import annotations

import random
import zlib

import pytest

from landfold.llm import quality


def texts(n):
    r = random.Random(3)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) for _ in range(400)]
    good = [" ".join(r.choice(words) for _ in range(r.randint(20, 200))) + "." for _ in range(n)]
    bad = [" ".join(r.choice(words).upper() + r.choice(["!!", "$$$", "&&&"]) for _ in range(r.randint(20, 200))) for _ in range(n // 4)]
    return good, bad


def test_held_out_accuracy(spark, documents):
    good, bad = texts(400)
    docs = documents(good + bad)
    labels = spark.createDataFrame(
        [(i, int(i < len(good)), 0) for i in range(len(good) + len(bad))], "doc_id bigint, quality int, toxic int"
    )
    rows = quality.classify(docs, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == (r["doc_id"] < len(good)) for r in out) / len(out) > 0.97


def test_labels_of_held_out_rows_do_not_count(spark, documents):
    good, bad = texts(120)
    docs = documents(good + bad)
    label = lambda i, turned: int(i < len(good)) ^ (turned and zlib.crc32(str(i).encode()) % 3 == 1)
    scores = [
        [
            r["score"]
            for r in quality.classify(
                docs,
                spark.createDataFrame([(i, label(i, t)) for i in range(len(good) + len(bad))], "doc_id bigint, quality int"),
            )
            .orderBy("doc_id")
            .collect()
        ]
        for t in (False, True)
    ]
    assert scores[0] == scores[1]


@pytest.mark.parametrize(("labels", "want"), [([], 0.5), ([(0, 1), (1, 1)], 0.75), ([(0, 1), (0, 0), (1, None)], 0.5)])
def test_few_labels(spark, documents, labels, want):
    docs = documents(["a", None, "", "long " * 40_000], [0, 1, 1, None])
    rows = quality.classify(docs, spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()
    assert [round(r["score"], 9) for r in rows] == [want] * 4
    assert not rows[3]["held_out"]


def test_odd_rows_and_names(spark, documents):
    good, bad = texts(120)
    docs = documents([*good, *bad, None, "", good[0], "x" * 300_000]).selectExpr("*", "7 AS score", "8 AS quality")
    labels = spark.createDataFrame([(i, int(i < len(good))) for i in range(len(good) + len(bad))], "doc_id bigint, quality int")
    rows = quality.classify(docs, labels).orderBy("doc_id").collect()
    assert len(rows) == len(good) + len(bad) + 4
    assert rows[-4]["score"] == rows[-3]["score"] and rows[-2]["score"] == rows[0]["score"]
    assert {r["quality"] for r in rows} == {8}
    assert quality.classify(documents([]), labels).collect() == []

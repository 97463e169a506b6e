from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from landfold.llm import fingerprints


def corpus():
    r = random.Random(9)
    line = lambda: " ".join(r.choice(["aé", "bcd.", "ef,", "𝒳gh", "ij!"]) for _ in range(r.randint(0, 40)))
    texts = ["\n".join(line() for _ in range(r.randint(1, 20))) for _ in range(60)]
    return [*texts, None, "", "\n", "\n\n", "  ", "ab", "é" * 100_000, "w. " * 30_000, texts[0], texts[1]]


def test_edited_text_and_likeness(documents):
    texts = corpus()
    rows = fingerprints.compare_with_next(documents(texts)).orderBy("doc_id").collect()
    assert len(rows) == len(texts)
    for i, row in enumerate(rows):
        text, after = texts[i] or "", texts[i - 1] or ""  # -1 is the last, whose id is the first in order
        n = len(text) // 3
        edited = text[: len(text) - n] + after[:n]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
        assert (row["near_edited"] == 1) >= (edited == text)
    by_text = {}
    for row, text in zip(rows, texts, strict=True):
        by_text.setdefault(text or "", set()).add(row["fingerprint"])
    assert all(len(f) == 1 for f in by_text.values())
    assert len({next(iter(f)) for f in by_text.values()}) == len(by_text)
    assert sum(r["near_edited"] for r in rows) / len(rows) > 0.4 > 0.2 > sum(r["near_next"] for r in rows[:60]) / 60


def test_order_over_several_ranges(documents, monkeypatch):
    monkeypatch.setattr(fingerprints, "ORDERED", 7)
    ids = random.Random(1).sample(range(-(10**12), 10**12), 50)
    rows = fingerprints.next_documents(documents([f"t{i}" for i in ids], ids)).collect()
    order = sorted(ids, reverse=True)
    want = dict(zip(order, [*order[1:], order[0]], strict=True))
    id_of = lambda key: int(key.split(":")[0])
    assert {id_of(r["key"]): id_of(r["next_key"]) for r in rows} == want


def test_repeated_rows_ties_and_nulls(documents):
    docs = documents(["a b", "a b", "c d", "e f", None], [2, 2, 2, None, None]).selectExpr("*", "1 AS key", "2 AS head")
    rows = fingerprints.compare_with_next(docs).collect()
    assert len(rows) == 5
    twice = [r for r in rows if r["edited_sha256"] == next(x["edited_sha256"] for x in rows if x["doc_id"] == 2)]
    assert len(twice) >= 1
    alone = fingerprints.compare_with_next(documents(["only one"], [5])).collect()
    assert (alone[0]["next_id"], alone[0]["near_next"]) == (5, 1.0)
    assert fingerprints.compare_with_next(documents([])).collect() == []


def test_edited_paragraphs_are_located(spark):
    before = "\n".join(f"paragraph {i} has its own words" for i in range(60))
    after = before.replace("paragraph 17 has", "paragraph 17 had").replace("paragraph 40 has", "paragraph 40 had")
    df = spark.createDataFrame([(before, after)], "a string, b string").select(
        fingerprints.fingerprint(F.col("a")).alias("a"), fingerprints.fingerprint(F.col("b")).alias("b")
    )
    row = df.select(
        fingerprints.edited_paragraphs(F.col("a"), F.col("b")).alias("e"),
        fingerprints.edited_paragraphs(F.col("a"), F.col("a")).alias("none"),
        (fingerprints.root(F.col("a")) == fingerprints.root(F.col("b"))).alias("same"),
        F.size(fingerprints.sections(F.col("a"))).alias("n"),
    ).first()
    assert (row["e"], row["none"], row["same"]) == ([17, 40], [], False)
    assert row["n"] > 1

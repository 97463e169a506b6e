from __future__ import annotations

import hashlib
import random

import pytest

from landfold.llm import near_duplicates as near
from landfold.llm.components import components


def shingles(text, words):
    parts = (text or "").encode().lower().split()
    if not parts:
        return frozenset()
    if len(parts) < words:
        return frozenset([tuple(parts)])
    return frozenset(tuple(parts[i : i + words]) for i in range(len(parts) - words + 1))


def brute(texts, words, percent):
    sets = [shingles(t, words) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return [(i, len(s), root(i), root(i) == i) for i, s in enumerate(sets)]


def corpus():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6)))
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(30):
        base = [word() for _ in range(r.randint(5, 300))]
        texts.append(" ".join(base))
        for _ in range(r.randint(0, 8)):
            copy = list(base)
            for _ in range(r.randint(0, 6)):
                copy[r.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += [" ".join([word() for _ in range(r.randint(0, 60))] + passage) for _ in range(60)]
    texts += [texts[0], texts[0].upper(), " " + texts[0].replace(" ", "\n\t"), "one", "one two", "ONE  two", "", None, " \n", None]
    texts += ["x " * 20_000, "y" * 100_000, "é É", "É é", " one"]
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_same_components_as_all_pairs(documents, words, percent):
    texts = corpus()
    got = near.near_duplicates(documents(texts), words, percent).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got] == brute(texts, words, percent)


def test_large_nodes_and_components_are_split(documents, monkeypatch):
    """Small limits send the same documents through branches, paths' ends and blocks."""
    monkeypatch.setattr(near, "NODE", 3)
    monkeypatch.setattr(near, "BLOCK_DOCS", 4)
    texts = corpus()
    got = near.near_duplicates(documents(texts), 3, 85).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got] == brute(texts, 3, 85)


def test_one_row_of_each_group_stays(documents):
    texts = corpus()
    kept = near.deduplicated(documents(texts), 5, 80)
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, _, _, k in brute(texts, 5, 80) if k]
    assert kept.columns == documents([]).columns


def test_repeated_and_missing_ids(documents):
    long = "one two three four five six seven eight nine ten"
    docs = documents([long, long, long, "other words of five or more", None, None, "lone text of null id here"], [3, 3, 1, 3, 7, 7, None])
    docs = docs.selectExpr("*", "doc_id AS n", "lang AS digest", "0 AS cls", "1 AS alone")
    found = near.near_duplicates(docs).collect()
    by = sorted(((r["doc_id"], r["component_id"]) for r in found), key=repr)
    assert by == [(1, 1), (3, 1), (3, 1), (3, 3), (7, 7), (7, 7), (None, None)]
    stay = near.deduplicated(docs).collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, (r["text"] or "")[:5]) for r in stay) == [
        (-1, "lone "),
        (1, "one t"),
        (3, "other"),
        (7, ""),
        (7, ""),
    ]


def test_empty_table(documents):
    assert near.near_duplicates(documents([])).collect() == []
    assert near.deduplicated(documents([None, ""])).count() == 2


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 130)]
    edges = [*chain, *star, (200, 201), (201, 200), (201, 200), (300, 300), (None, 5)]
    got = {r["v"]: r["label"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200, 300: 300}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_trees_for_recall():
    assert near.trees_for(0.85, 0.999999) == 8
    assert near.trees_for(0.8, 0.999999) == 9


def test_pairs_in_nodes_that_branch_are_found(documents, monkeypatch):
    """4000 pairs just similar enough, each in nodes that all branch to the end of their paths."""
    monkeypatch.setattr(near, "NODE", 1)
    texts = [" ".join([f"w{i}x{j}" for j in range(8)] + [f"w{i}own{side}"]) for i in range(4000) for side in "ab"]
    found = near.near_duplicates(documents(texts), 1, 80).where("kept").count()
    assert found == 4000


@pytest.mark.parametrize("percent", [50, 80, 85, 90])
def test_all_trees_keep_the_recall(percent):
    s = percent / 100
    first, more = near.all_trees_for(s, 0.999999)
    assert (1 - s) ** first + (1 - s**near.DEPTH) ** (first + more) <= 1e-6


def test_unlinked_texts_of_one_id_all_stay(documents):
    long = "one two three four five six seven eight nine ten"
    texts = [long, "quite another text of more than five words", long + " eleven", "", " \n", "", long]
    stay = near.deduplicated(documents(texts, [4, 4, 4, 4, 4, 4, 9])).collect()
    kept = sorted(r["text"] for r in stay)
    assert kept[:4] == ["", "", " \n", min(long, long + " eleven", key=lambda t: hashlib.md5(t.encode()).hexdigest())]
    assert kept[4:] == ["quite another text of more than five words"]

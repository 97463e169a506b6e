from __future__ import annotations

import random
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline as pipeline

KEY = "token = 'abcdef0123456789abcdef01'"


def corpus():
    """Plain texts, shouted ones, copies, near copies and a few with secrets."""
    r = random.Random(12)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) for _ in range(500)]
    plain = [[r.choice(words) for _ in range(r.randint(60, 200))] for _ in range(200)]
    texts = [" ".join(t) + "." for t in plain]
    bad = [" ".join(r.choice(words).upper() + "!!" for _ in range(100)) for _ in range(60)]
    near = [" ".join([*t[:50], "changed", *t[51:]]) + "." for t in plain[:20]]
    secret = [t + f" {KEY} and more" for t in (" ".join(r.choice(words) for _ in range(80)) for _ in range(5))]
    return texts, bad, near, secret


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    texts, bad, near, secret = corpus()
    path = str(tmp_path_factory.mktemp("tables"))
    every = [*texts, *bad, *near, *secret, texts[50], texts[50], None, ""]
    rows = [(i, t, "en", "hot", None if t is None else len(t), i) for i, t in enumerate(every)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest int"
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i < 200), 0) for i in range(260)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_what_each_stage_keeps(spark, folder):
    texts, bad, near, secret = corpus()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in pipeline.STAGES:
        docs = pipeline.materialise(stage(spark, docs, folder), "stage")
        kept[name] = {r["doc_id"]: r for r in docs.collect()} if name != "packing" else docs.collect()
        if name != "packing":
            assert docs.columns == columns
    junk = set(range(200, 260))
    assert len(junk & set(kept["quality classifier"])) <= 2
    assert len(set(range(200)) - set(kept["quality classifier"])) <= 2
    once = set(kept["near dedup"])
    copies = set(range(260, 280)) | {285, 286}
    assert not copies & once
    assert set(kept["quality classifier"]) - once <= copies
    scanned = kept["secret scan"]
    assert set(scanned) == once
    for i, row in scanned.items():
        assert "abcdef0123456789" not in (row["text"] or "")
        if 280 <= i < 285:
            assert "[SECRET:assign]" in row["text"] and row["text"].endswith("and more")
            assert row["n_chars"] == len(row["text"])
        else:
            assert row["text"] == kept["near dedup"][i]["text"] and row["n_chars"] == kept["near dedup"][i]["n_chars"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for p in kept["packing"]:
        pieces.setdefault(p["doc_id"], 0)
        pieces[p["doc_id"]] += p["length"]
    assert set(pieces) == once
    for i, n in pieces.items():
        assert n == len(tokenizer.encode(scanned[i]["text"] or "", add_special_tokens=False).ids) + 1


def test_run_is_its_stages_in_a_row(spark, folder):
    rows = pipeline.run(spark, folder)
    assert rows.columns[:5] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    full = {}
    for r in rows.collect():
        full[r["sequence_id"]] = full.get(r["sequence_id"], 0) + r["length"]
    assert max(full.values()) <= 4096
    assert contract.queries()["pipeline"] is pipeline.run


def test_stages_take_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, folder).collect() == []


def test_every_operator_has_a_query():
    names = [n for n in contract.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))

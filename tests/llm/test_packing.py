from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from landfold.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def corpus():
    r = random.Random(2)
    words = ["The", "don't", "naïve", "ÉCOLE", "x1y2", "a.b", "end.", "WOW!!", "3.14", " ", "é", "H̱x", "日本語", "I'LL", "<|endoftext|>", "😀.", "ab,;"]
    texts = [" ".join(r.choice(words) for _ in range(r.choice([1, 3, 30, 400, 5000]))) for _ in range(80)]
    texts += ["a<|endoftext|>b", "<|startoftext|>The end.<|endoftext|><|endoftext|>", "<|EndOfText|> <|endoftext |>", "x.<|endoftext|>"]
    return [*texts, None, "", " \n\t", "w" * 50_000, "tab\tand\x0bmore\x1cor less", "same", "same"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_every_id_in_one_piece(documents, tokenizer):
    texts = corpus()
    rows = packing.pack(documents(texts), PATH, with_ids=True).collect()
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        assert b"".join(r["ids"] for r in own) == ids.tobytes()
        at = 0
        for r in own:
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]


def test_sequences_have_no_gaps_and_little_padding(documents):
    r = random.Random(4)
    texts = ["word " * r.randint(0, 3000) for _ in range(600)]
    sequences = {}
    for row in packing.pack(documents(texts), PATH).collect():
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    full = []
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
        full.append(at)
    assert sum(full) / (4096 * len(full)) > 0.99


def test_groups_are_packed_by_themselves(documents, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 10)
    rows = packing.pack(documents(["some words here"] * 200, [None] * 200), PATH).collect()
    assert len({r["sequence_id"] >> 32 for r in rows}) > 5
    assert len(rows) == 200 and all(r["doc_id"] is None for r in rows)


def test_first_bin_with_room():
    r = random.Random(6)
    lengths = [r.randint(1, 100) for _ in range(300)]
    tree, room = packing.TournamentTree(300, 100), [100] * 300
    for n in lengths:
        first = next(i for i, left in enumerate(room) if left >= n)
        assert tree.place(n) == (first, 100 - room[first])
        room[first] -= n


def test_empty_table_and_extra_columns(documents):
    assert packing.pack(documents([]), PATH).collect() == []
    odd = documents(["a"]).selectExpr("*", "1 AS start", "2 AS `group`", "3 AS draw", "4 AS ids")
    assert [r["length"] for r in packing.pack(odd, PATH).collect()] == [2]

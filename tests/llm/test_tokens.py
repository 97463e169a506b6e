from __future__ import annotations

import base64
import hashlib
import inspect
import random

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landfold.llm import byte_bpe, token_counts

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def texts():
    r = random.Random(11)
    odd = ["don't ", "naïve", "日本語", "😀", "  ", "\n\n", "\t", " ", " ", "\x1c", "\x85", "x1", "١٢", "é", "ab" * 40, "!!", "<|endoftext|>", " the", "Ünïcödé "]
    return ["".join(r.choice(odd) for _ in range(r.randint(0, 60))) for _ in range(120)] + [None, "", " ", "a" * 30_000, "é" * 9_000, "same", "same"]


@pytest.fixture(scope="module")
def library():
    pieces = token_counts.rank_file(MULTI)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={p: i for i, p in enumerate(pieces)}, special_tokens={})


def test_ids_are_the_librarys_and_decode_to_the_text(spark, documents, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "FOLDED", 60)  # so that both ways of encoding are used
    all_texts = texts()
    coded = byte_bpe.encode(spark, documents(all_texts).selectExpr("*", "1 AS ids", "2 AS word"), MULTI, PATTERN)
    rows = coded.withColumn("raw", byte_bpe.decode(F.col("ids"), byte_bpe.Ranks(MULTI))).orderBy("doc_id").collect()
    for text, row in zip(all_texts, rows, strict=True):
        assert row["ids"] == library.encode_ordinary(text or "")
        assert bytes(row["raw"]) == (text or "").encode()
    assert byte_bpe.encode(spark, documents([]), MULTI, PATTERN).collect() == []


def test_merges_folded_by_expressions(spark, library):
    words = sorted({w for t in texts() for w in regex.findall(PATTERN, t or "") if len(w.encode()) <= 48} | {""})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    for row in df.select("word", byte_bpe.encode_words(F.col("word"), byte_bpe.Ranks(MULTI).map()).alias("ids")).collect():
        assert row["ids"] == library.encode_ordinary(row["word"]), row["word"]


def test_every_word_is_merged_by_rank_and_none_by_the_library(library):
    """Words of any length, with and without others beside them, also bytes that are no text."""
    assert "tiktoken" not in inspect.getsource(byte_bpe)
    r = random.Random(5)
    parts = [b"a", b"b", b"the", b"in", "é".encode(), "日".encode(), b"tion", b" ", b"\xff", b"1"]
    words = [b"".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(500)]
    words += [b"a" * 5000, b"", b"the", b"a", b"z" * byte_bpe.MOST_BYTES, b"z" * (byte_bpe.MOST_BYTES + 1)]
    merges = byte_bpe.Merges(token_counts.rank_file(MULTI))
    expected = [library._encode_single_piece(w) if w else [] for w in words]
    assert [list(memoryview(ids).cast("i")) for ids in merges.of(words)] == expected
    assert [list(memoryview(merges.of([w])[0]).cast("i")) for w in words[:50]] == expected[:50]
    assert merges.of([]) == []


def test_decode_leaves_out_what_it_does_not_know(spark):
    df = spark.createDataFrame([([0, None, -1, 10**6, 1],), ([],)], "ids array<int>")
    pieces = token_counts.rank_file(MULTI)
    out = [bytes(r[0]) for r in df.select(byte_bpe.decode(F.col("ids"), byte_bpe.Ranks(MULTI))).collect()]
    assert out == [pieces[0] + pieces[1], b""]


def greedy(word, vocabulary):
    at = n = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocabulary), None)
        if end is None:
            return 1
        at, n = end, n + 1
    return n


@settings(max_examples=300, deadline=None)
@given(st.sets(st.binary(min_size=0, max_size=5).map(lambda b: bytes(c % 3 for c in b)), max_size=25), st.lists(st.binary(max_size=30).map(lambda b: bytes(c % 3 for c in b)), max_size=20))
def test_longest_match_automaton(vocabulary, words):
    automaton = token_counts.build(vocabulary)
    for word in words:
        assert automaton.count(word) == greedy(word, vocabulary)


def test_counts_of_documents(spark, documents):
    vocabulary = token_counts.rank_file(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    known = set(vocabulary)
    all_texts = [t for t in texts() if t is None or len(t) < 20_000]
    docs = documents(all_texts).selectExpr("*", "1 AS n_tokens", "2 AS _counts")
    rows = token_counts.count_tokens(spark, docs, vocabulary, PATTERN).orderBy("doc_id").collect()
    for text, row in zip(all_texts, rows, strict=True):
        words = regex.findall(PATTERN, text or "")
        assert (row["n_words"], row["n_tokens"]) == (len(words), sum(greedy(w.encode(), known) for w in words))
    assert token_counts.count_tokens(spark, documents([]), vocabulary, PATTERN).collect() == []


def test_rank_file_is_the_librarys():
    pairs = dict(map(bytes.split, open(MULTI, "rb")))
    assert token_counts.rank_file(MULTI)[300] == next(base64.b64decode(a) for a, b in pairs.items() if int(b) == 300)
    assert hashlib.sha256(b"".join(token_counts.rank_file(MULTI))).hexdigest()

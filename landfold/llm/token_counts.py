"""Token counts by linear longest match.

A word is cut greedily into the longest pieces that the vocabulary has. The vocabulary is
a trie whose nodes have failure links: where no edge goes on, the pieces that are certain
by then are popped and matching goes on at the node of what is left. How many pieces a
node pops is worked out beforehand, so a word's count is one walk over its bytes, in
time linear in them, and no piece is ever built.

Inputs: null text counts as empty and has no words; a word that the vocabulary cannot
spell is one token; equal texts have equal counts; rows may repeat and ids be null; other columns pass
through unchanged.
"""

from __future__ import annotations

import base64
from collections import Counter, deque
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words whose counts a task remembers.
REMEMBERED = 400_000


@dataclass(frozen=True)
class Automaton:
    """Edges by (node << 8 | byte), failure links (-1: none) and popped pieces by node; 0 is the root."""

    edges: dict[int, int]
    fail: list[int]
    pops: list[int]

    def count(self, word: bytes) -> int:
        """Pieces of a word; 1 if it cannot be spelt."""
        edges, fail, pops = self.edges, self.fail, self.pops
        node = n = 0
        for byte in word:
            while (to := edges.get(node << 8 | byte, -1)) < 0:
                n += pops[node]
                node = fail[node]
                if node < 0:
                    return 1
            node = to
        while node:
            n += pops[node]
            node = fail[node]
            if node < 0:
                return 1
        return n


def build(vocabulary: Iterable[bytes]) -> Automaton:
    """The automaton of a vocabulary; empty pieces are left out."""
    edges: dict[int, int] = {}
    parent, byte_in, whole = [0], [0], [False]
    for piece in vocabulary:
        node = 0
        for byte in piece:
            key = node << 8 | byte
            if key not in edges:
                edges[key] = len(parent)
                parent.append(node)
                byte_in.append(byte)
                whole.append(False)
            node = edges[key]
        if node:
            whole[node] = True
    below: list[list[int]] = [[] for _ in parent]
    for node in range(1, len(parent)):
        below[parent[node]].append(node)
    fail, pops = [-1] * len(parent), [0] * len(parent)
    queue = deque(below[0])
    while queue:
        node = queue.popleft()
        queue.extend(below[node])
        if whole[node]:
            fail[node], pops[node] = 0, 1
            continue
        # What the parent leaves over, with this byte behind it.
        at, popped = fail[parent[node]], pops[parent[node]]
        while at >= 0 and (at << 8 | byte_in[node]) not in edges:
            popped += pops[at]
            at = fail[at]
        if at >= 0:
            fail[node], pops[node] = edges[at << 8 | byte_in[node]], popped
    return Automaton(edges, fail, pops)


def rank_file(path: str) -> list[bytes]:
    """The pieces of a rank file in order of rank: base64 and rank, a line each."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return [base64.b64decode(piece) for piece, _ in sorted(pairs, key=lambda p: int(p[1]))]


def count_tokens(spark: SparkSession, docs: DataFrame, vocabulary: list[bytes], pattern: str) -> DataFrame:
    """``docs`` with ``n_words`` and ``n_tokens`` of its text; words are the matches of ``pattern``.

    The automaton is broadcast; its size is that of the vocabulary, whatever the input.
    """
    built = build(vocabulary)
    shared = spark.sparkContext.broadcast((built.edges, built.fail, built.pops))

    def counts() -> Callable[[str], tuple[int, int]]:
        automaton, known = Automaton(*shared.value), {}
        find = regex.compile(pattern).findall

        def of(text: str) -> tuple[int, int]:
            words = Counter(find(text))
            if len(known) > REMEMBERED:
                known.clear()
            tokens = 0
            for word, times in words.items():
                n = known.get(word)
                if n is None:
                    n = known[word] = automaton.count(word.encode("utf-8", "surrogatepass"))
                tokens += n * times
            return words.total(), tokens

        return of

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of = counts()
        for series in texts:
            yield pd.DataFrame([of(t) for t in series], columns=["n_words", "n_tokens"])

    counted = F.pandas_udf(run, "n_words bigint, n_tokens bigint")
    kept = docs.drop(*[c for c in docs.columns if c.lower() in ("n_words", "n_tokens", "_counts")])
    return (
        kept.withColumn("_counts", counted(F.coalesce(F.col("text"), F.lit(""))))
        .select(*kept.columns, "_counts.n_words", "_counts.n_tokens")
    )

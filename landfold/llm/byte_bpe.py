"""Byte-level BPE: ranked merges folded over distinct words, and decoding by concatenation.

``encode_words`` is the encoder: an expression that folds merges over the array of a word's
bytes, at each step the adjacent pair of the lowest rank, the first of equal ones. Bytes
are written as hex digits, and the rank map is a literal.

``encode`` folds every word that way, and none more often than it must. The commonest
words of a sample of texts are folded by the expression, and tasks hold their ids. Others are
folded in tasks as they come: ``Merges.of`` takes all that are new in some texts at once,
as one array of pieces, and merges one pair of each word at each step. Which words
were folded beforehand makes no difference to the ids. ``decode`` is an expression again.

Inputs: null text counts as empty and has no ids; texts of any length are encoded whole;
equal texts have equal ids; rows may repeat and ids of documents be null; other columns
pass through unchanged. Ids outside the vocabulary, and null ones, decode to nothing.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfold.llm.shared import let, per_worker, whole_text
from landfold.llm.token_counts import rank_file

#: Texts whose words are counted, and words that are folded beforehand.
SAMPLE = 20_000
FOLDED = 100_000
#: Bytes of a word that is folded beside others; it takes a step for each. Pairs of longer words
#: are taken from a heap.
MOST_BYTES = 48
#: Other words whose ids a task remembers.
REMEMBERED = 200_000
#: Texts that a task takes at once, and characters after which it takes no more.
SLICE = 64
CHARACTERS = 2**20
_BUCKETS = 8192
_NONE = 2**31 - 1


class Ranks:
    """A vocabulary in order of rank, as literals for expressions."""

    def __init__(self, path: str):
        self.pieces = rank_file(path)

    def map(self) -> Column:
        """The rank map: an array of maps from hex digits to ranks, by their hash."""
        buckets: list[dict[str, int]] = [{} for _ in range(_BUCKETS)]
        for rank, piece in enumerate(self.pieces):
            digits = piece.hex().upper()
            buckets[zlib.crc32(digits.encode()) % _BUCKETS][digits] = rank
        return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")

    def digits(self) -> Column:
        """Hex digits of all pieces, by rank."""
        return F.split(F.lit(",".join(p.hex() for p in self.pieces)), ",")


def _rank(ranks: Column, digits: Column) -> Column:
    bucket = F.get(ranks, (F.crc32(digits.cast("binary")) % _BUCKETS).cast("int"))
    return F.coalesce(F.element_at(bucket, digits), F.lit(_NONE))


def encode_words(word: Column, ranks: Column) -> Column:
    """Ids of one word, which is not split further."""

    def pairs(pieces: Column) -> Column:
        n = F.greatest(F.size(pieces) - 1, F.lit(0))
        return F.zip_with(
            F.slice(pieces, F.lit(1), n), F.slice(pieces, F.lit(2), n), lambda a, b: _rank(ranks, F.concat(a, b))
        )

    def merged(state: Column, least: Column) -> Column:
        """Only the pairs beside the merged one get new ranks."""
        p, r = state["p"], state["r"]
        none = F.array().cast("array<int>")
        at = F.array_position(r, least).cast("int")
        return let(
            F.struct(at.alias("at"), F.concat(F.get(p, at - 1), F.get(p, at)).alias("piece")),
            lambda m: F.struct(
                F.concat(
                    F.slice(p, F.lit(1), m["at"] - 1), F.array(m["piece"]), F.slice(p, m["at"] + 2, F.size(p))
                ).alias("p"),
                F.concat(
                    F.slice(r, F.lit(1), F.greatest(m["at"] - 2, F.lit(0))),
                    F.when(m["at"] > 1, F.array(_rank(ranks, F.concat(F.get(p, m["at"] - 2), m["piece"])))).otherwise(none),
                    F.when(
                        m["at"] < F.size(r), F.array(_rank(ranks, F.concat(m["piece"], F.get(p, m["at"] + 1))))
                    ).otherwise(none),
                    F.slice(r, m["at"] + 2, F.size(r)),
                ).alias("r"),
            ),
        )

    def step(state: Column, _: Column) -> Column:
        return let(
            F.coalesce(F.array_min(state["r"]), F.lit(_NONE)),
            lambda least: F.when(least == _NONE, state).otherwise(merged(state, least)),
        )

    def folded(digits: Column) -> Column:
        return let(
            F.regexp_extract_all(digits, F.lit(".."), 0),
            lambda pieces: F.transform(
                F.aggregate(
                    F.sequence(F.lit(2), F.size(pieces)),
                    F.struct(pieces.alias("p"), pairs(pieces).alias("r")),
                    step,
                    lambda state: state["p"],
                ),
                lambda p: _rank(ranks, p),
            ),
        )

    return let(
        F.hex(F.encode(word, "utf-8")),
        lambda digits: F.when(F.length(digits) == 0, F.array().cast("array<int>"))
        .when(_rank(ranks, digits) != _NONE, F.array(_rank(ranks, digits)))
        .otherwise(folded(digits)),
    )


class Merges:
    """The merges of a vocabulary, for words in tasks: pieces are numbers, which are their ranks."""

    def __init__(self, pieces: Sequence[bytes]):
        self.ranks = {p: i for i, p in enumerate(pieces)}
        self.bytes = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)
        splits = [
            (self.ranks[p[:at]] << 32 | self.ranks[p[at:]], rank)
            for p, rank in self.ranks.items()
            for at in range(1, len(p))
            if p[:at] in self.ranks and p[at:] in self.ranks
        ]
        pairs = np.array(sorted(splits) or [(-1, _NONE)], dtype=np.int64)
        self.pairs, self.merged = pairs[:, 0].copy(), pairs[:, 1].copy()

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What pairs of pieces merge to."""
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.merged[at], _NONE)

    def of(self, words: Sequence[bytes]) -> list[bytes]:
        """The ids of each word, as the bytes of 32-bit numbers."""
        found: list[bytes | None] = [None] * len(words)
        several = []
        for i, word in enumerate(words):
            if word in self.ranks or not word:
                found[i] = np.array([self.ranks[word]] if word else [], dtype=np.int32).tobytes()
            elif len(word) > MOST_BYTES:
                found[i] = np.array(self._of_long(word), dtype=np.int32).tobytes()
            else:
                several.append(i)
        for i, ids in zip(several, self._of_several([words[i] for i in several]), strict=True):
            found[i] = ids
        return found

    def _of_several(self, words: list[bytes]) -> list[bytes]:
        """Folds merges over the pieces of all words, the first of the lowest rank in each at each step."""
        if not words:
            return []
        piece = self.bytes[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])

        def ranked(at: np.ndarray) -> np.ndarray:
            """Ranks of the pairs that begin at the given pieces; a word's last begins none."""
            inside = at + 1 < len(piece)
            after = np.where(inside, at + 1, at)
            inside &= word[after] == word[at]
            return np.where(inside, self._rank(piece[at], piece[after]), _NONE)

        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = ranked(np.arange(len(piece)))
        while len(piece):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            sizes = np.diff(starts, append=len(piece))
            least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            going = least != _NONE
            if not going.all():
                done.append((word[~going], piece[~going]))
                piece, word, rank, least = piece[going], word[going], rank[going], least[going]
            at = np.flatnonzero(rank == least)
            at = at[np.diff(word[at], prepend=-1) != 0]
            piece[at] = rank[at]
            kept = np.ones(len(piece), dtype=bool)
            kept[at + 1] = False
            piece, word, rank = piece[kept], word[kept], rank[kept]
            at -= np.arange(len(at))  # as many pieces before it are gone
            before = at[(at > 0) & (word[at - 1] == word[at])] - 1
            changed = np.concatenate([at, before])
            rank[changed] = ranked(changed)
        word = np.concatenate([w for w, _ in done])
        order = np.argsort(word, kind="stable")
        ids = np.concatenate([p for _, p in done])[order].astype(np.int32).tobytes()
        ends = np.cumsum(np.bincount(word, minlength=len(words))) * 4
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def _of_long(self, word: bytes) -> list[int]:
        """The same merges of one word, the next pair being taken from a heap."""
        n, none = len(word), _NONE
        ends, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))

        def pair(i: int) -> tuple[int, int, int]:
            end = ends[after[i]] if after[i] < n else 0
            return (self.ranks.get(word[i:end], none), i, end)

        heap = [p for p in map(pair, range(n - 1)) if p[0] != none]
        heapq.heapify(heap)
        while heap:
            least = heapq.heappop(heap)
            i = least[1]
            if not ends[i] or pair(i) != least:  # one of the two was merged since
                continue
            gone = after[i]
            ends[i], after[i] = ends[gone], after[gone]
            ends[gone] = 0
            if after[i] < n:
                before[after[i]] = i
            for j in (i, before[i]):
                if j >= 0 and (new := pair(j))[0] != none:
                    heapq.heappush(heap, new)
        return [self.ranks[word[i:end]] for i, end in enumerate(ends) if end]


def decode(ids: Column, vocabulary: Ranks) -> Column:
    """The bytes that an array of ids stands for."""
    return let(
        F.struct(ids.alias("ids"), vocabulary.digits().alias("pieces")),
        lambda s: F.unhex(
            F.array_join(F.transform(s["ids"], lambda i: F.when(i >= 0, F.get(s["pieces"], i))), "")
        ),
    )


def folded_words(docs: DataFrame, vocabulary: Ranks, pattern: str) -> DataFrame:
    """(word, ids) of the FOLDED commonest words of SAMPLE texts, drawn by a hash of the text."""
    drawn = (
        docs.select(F.xxhash64(whole_text(), F.lit("words")).alias("_h")).distinct().orderBy("_h").limit(SAMPLE)
    )
    some = docs.select(whole_text().alias("text")).join(
        F.broadcast(drawn), F.xxhash64("text", F.lit("words")) == F.col("_h"), "left_semi"
    )
    words = (
        some.select(F.explode(F.regexp_extract_all("text", F.lit(pattern), 0)).alias("word"))
        .where(F.octet_length("word") <= MOST_BYTES)
        .groupBy("word")
        .count()
        .orderBy(F.col("count").desc(), "word")
        .limit(FOLDED)
        .select("word")
        .repartition(max(1, FOLDED // 2000), "word")  # small rows, but each takes its time
    )
    return words.select("word", encode_words(F.col("word"), vocabulary.map()).alias("ids"))


def encode(
    spark: SparkSession, docs: DataFrame, path: str, pattern: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """``columns`` of ``docs``, or all, with ``ids``, an array of the ids of its text by the rank file at ``path``.

    At most FOLDED words of at most MOST_BYTES bytes are broadcast.
    """
    vocabulary = Ranks(path)
    words = folded_words(docs, vocabulary, pattern).toArrow()
    # Ids are held as the bytes of 32-bit numbers, a fraction of the size of lists of them.
    folded = {
        w: np.array(ids, dtype=np.int32).tobytes()
        for w, ids in zip(words.column("word").to_pylist(), words.column("ids").to_pylist(), strict=True)
    }
    shared = spark.sparkContext.broadcast((folded, vocabulary.pieces))
    most, characters = SLICE, CHARACTERS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        before, pieces = shared.value
        merges = per_worker(f"merges {path}", lambda: Merges(pieces))
        known = dict(before)
        find = regex.compile(pattern).findall
        room = len(before) + REMEMBERED

        def ids(texts: list[str]) -> list[bytes]:
            words = [find(t) for t in texts]
            if len(known) > room:
                known.clear()
                known.update(before)
            new = list(set().union(*words).difference(known))
            known.update(zip(new, merges.of([w.encode("utf-8", "surrogatepass") for w in new]), strict=True))
            return [b"".join(map(known.__getitem__, w)) for w in words]

        def slices(whole: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            at = held = 0
            for i, n in enumerate(pc.utf8_length(whole.column(whole.num_columns - 1)).to_pylist()):
                if i > at and (i - at == most or held + n > characters):
                    yield whole.slice(at, i - at)
                    at, held = i, 0
                held += n
            yield whole.slice(at)

        for whole in batches:
            for batch in slices(whole) if whole.num_rows else ():
                coded = ids(batch.column(batch.num_columns - 1).to_pylist())
                ends = np.cumsum([0, *(len(c) // 4 for c in coded)])
                values = pa.array(np.frombuffer(b"".join(coded), dtype=np.int32))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], lists], names=[*batch.schema.names[:-1], "ids"]
                )

    kept = [c for c in (docs.columns if columns is None else columns) if c.lower() != "ids"]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], whole_text().alias("_landfold_text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema)

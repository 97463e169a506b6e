"""Packing of tokenised documents into sequences: first-fit decreasing, in random groups.

A document's ids are cut into pieces no longer than a sequence. Pieces are dealt at
random into groups of bounded size, and each group is packed by itself, longest piece
first, into the first bin that has room. The first such bin is found in a tournament
tree, whose nodes hold the largest room left below them.

Inputs: null text counts as empty and is a document of its end id alone; repeated rows
are documents of their own; a piece's group does not depend on its id, so ids may be null
or repeat; texts of any length are whole documents; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfold.llm.shared import groups, materialise, per_worker, whole_text

#: Pieces of a group, about; what a task packs at once.
GROUP = 4096
#: Words whose ids a worker remembers, from task to task; about 200 bytes each.
REMEMBERED = 1_000_000
_SEQUENCE_BITS = 32


_MARK = re.compile(rb"(?<=[A-Za-z])([.,])(?=[\x20\n]|$)")


def _words(text: str) -> list[bytes]:
    """The text cut at white space, and before a full stop or comma that ends a word.

    The tokenizer takes such a mark for a word of its own, and letters for small ones. It
    composes accents first, so that letters stay as they are where any may follow them.
    """
    raw = text.encode("utf-8", "surrogatepass")
    if b"\xcc" not in raw and b"\xcd" not in raw:  # U+0300 to U+037F start so
        raw = raw.lower()
    # For bytes, split() knows ASCII white space only; the tokenizer drops the rest.
    return _MARK.sub(rb" \1", raw).split()


class WordEncoder:
    """Ids of whole texts, word by word, as little-endian unsigned 32-bit numbers.

    The tokenizer drops white space and no token reaches across it, so a text's ids are
    those of its words, and words that come again need no second look.
    """

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(tokenizer_path)
        special = {t.content: i for i, t in self._tokenizer.get_added_tokens_decoder().items()}
        # The literals of special tokens are found here, in their exact spelling, as words are lowered.
        self._tokenizer.encode_special_tokens = True
        self._special = re.compile("(" + "|".join(re.escape(t) for t in sorted(special, key=len, reverse=True)) + ")")
        #: A word never begins with a space, so these names are free.
        self._ids = {b" " + t.encode(): i.to_bytes(4, "little") for t, i in special.items()}
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._last = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self._last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._known: dict[bytes, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self._split(t) for t in texts]
        known = self._known
        if len(known) > REMEMBERED:
            known.clear()
        missing = set().union(*split).difference(known)
        if missing:
            self._learn(missing)
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def _split(self, text: str) -> list[bytes]:
        """The words of a text, and special tokens where their literals stand in it."""
        if not self._ids:
            return _words(text)
        parts = self._special.split(text)
        if len(parts) == 1:
            return _words(text)
        return [w for i, p in enumerate(parts) for w in ([b" " + p.encode()] if i % 2 else _words(p))]

    def _learn(self, words: set[bytes]) -> None:
        self._known.update(self._ids)
        plain, other = [], []
        for w in words.difference(self._ids):
            text = w.decode("utf-8", "replace")
            (plain if text.isalpha() else other).append((w, text))
        for at in range(0, len(plain), 2000):
            self._together(plain[at : at + 2000])
        self._apart(other)

    def _together(self, words: list[tuple[bytes, str]]) -> None:
        """Words of letters alone in one go: each ends with its only token for a word's end."""
        coded = self._tokenizer.encode_batch_fast([" ".join([t for _, t in words])], add_special_tokens=False)
        ids = np.array(coded[0].ids, dtype="<u4")
        ends = ((np.nonzero(self._last[ids])[0] + 1) * 4).tolist()
        if len(ends) != len(words):
            self._apart(words)
            return
        raw = ids.tobytes()
        self._known.update(zip([w for w, _ in words], map(raw.__getitem__, map(slice, [0, *ends], ends)), strict=True))

    def _apart(self, words: list[tuple[bytes, str]]) -> None:
        for at in range(0, len(words), 4096):
            some = words[at : at + 4096]
            coded = self._tokenizer.encode_batch_fast([t for _, t in some], add_special_tokens=False)
            for (p, _), e in zip(some, coded, strict=True):
                self._known[p] = np.array(e.ids, dtype="<u4").tobytes()


def _pieces(
    tokenizer_path: str, sequence: int, end_id: int, with_ids: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(f"words {tokenizer_path}", lambda: WordEncoder(tokenizer_path))
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                yield cut(encoder, whole.slice(at, 256))

    def cut(encoder: WordEncoder, batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {"doc_id": [], "start": [], "length": [], "ids_crc32": [], "doc_tokens": []}
        kept: list[bytes] = []
        end = end_id.to_bytes(4, "little")
        texts = batch.column("text").to_pylist()
        for doc_id, words in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
            ids = words + end
            for start in range(0, len(ids), 4 * sequence):
                piece = ids[start : start + 4 * sequence]
                out["doc_id"].append(doc_id)
                out["start"].append(start // 4)
                out["length"].append(len(piece) // 4)
                out["ids_crc32"].append(zlib.crc32(piece))
                out["doc_tokens"].append(len(ids) // 4)
                if with_ids:
                    kept.append(piece)
        columns = {k: pa.array(v, pa.int64()) for k, v in out.items()}
        if with_ids:
            columns["ids"] = pa.array(kept, pa.binary())
        return pa.RecordBatch.from_pydict(columns)

    return run


_PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def pieces(
    docs: DataFrame, tokenizer_path: str, sequence: int = 4096, end_id: int = 2, with_ids: bool = False
) -> DataFrame:
    """Pieces of each document's ids; ``ids`` (little-endian unsigned 32 bit) if asked for."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    schema = _PIECE + (", ids binary" if with_ids else "")
    return texts.mapInArrow(_pieces(tokenizer_path, sequence, end_id, with_ids), schema)


class TournamentTree:
    """Bins of equal size; finds the first with room for a piece in logarithmic time."""

    def __init__(self, bins: int, size: int):
        self._leaves = 1
        while self._leaves < bins:
            self._leaves *= 2
        self._room = [size] * (2 * self._leaves)
        self._size = size

    def place(self, length: int) -> tuple[int, int]:
        """The bin that a piece goes to and its offset there."""
        room, node = self._room, 1
        while node < self._leaves:
            node *= 2
            if room[node] < length:
                node += 1
        offset = self._size - room[node]
        at = node - self._leaves
        room[node] -= length
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return at, offset


def _packed(sequence: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, table in groups(batches, "group"):
            length = table.column("length").to_numpy()
            # Longest first; equal ones by what they are, so that a rerun packs the same.
            keys = [table.column(c).to_pandas().to_numpy() for c in ("draw", "length")]
            order = np.lexsort((keys[0], -keys[1]))
            tree = TournamentTree(len(length), sequence)
            at = np.empty(len(length), dtype=np.int64)
            offset = np.empty(len(length), dtype=np.int64)
            for i in order.tolist():
                at[i], offset[i] = tree.place(int(length[i]))
            done = table.drop_columns(["group", "draw"])
            done = done.append_column("sequence_id", pa.array((group << _SEQUENCE_BITS) + at))
            yield from done.append_column("offset", pa.array(offset)).combine_chunks().to_batches()

    return run


def pack(
    docs: DataFrame, tokenizer_path: str, sequence: int = 4096, end_id: int = 2, with_ids: bool = False
) -> DataFrame:
    """Each piece with its ``sequence_id`` and its ``offset`` there.

    Pieces of a sequence follow each other from offset 0 without gaps and are at most
    ``sequence`` ids together.
    """
    # The draw is written with the piece, so that a task run again deals the same way.
    cut = materialise(
        pieces(docs, tokenizer_path, sequence, end_id, with_ids).withColumn("draw", F.rand(20240229)), "pieces"
    )
    dealt = max(1, -(-cut.count() // GROUP))
    return (
        cut.withColumn("group", F.floor(F.col("draw") * dealt).cast("bigint"))
        .repartition("group")
        .sortWithinPartitions("group")
        .mapInArrow(
            _packed(sequence),
            _PIECE + (", ids binary" if with_ids else "") + ", sequence_id bigint, offset bigint",
        )
    )

"""Near duplicates by the chosen-path set similarity join.

A document is the set of its distinct word shingles. In each of several independent
trees a document follows a path of minwise tokens: the first token chosen splits all
documents into nodes, nodes that are still large branch again by the next token, and
documents of a small node are compared with each other. Two sets of similarity s choose
the same token with probability s, so a tree misses a pair with probability 1 - s, and
the number of trees is what the target recall needs. Where a node branches, a pair in it
must share all tokens of a path, and a tree misses it with up to 1 - s ** DEPTH. So
documents of nodes that branch go through further trees, as many as that needs: a pair
either shares no node of the first trees, or a small one, or both its documents are there.

Comparison is in two steps, so that whole sets move once, not once a tree:

* Nodes compare b-bit minhash sketches and give a spanning forest of what looks similar.
  The components of all forests together hold every link, and more.
* Within such a component the full sets are compared, each document against all that it
  is not yet connected to. The links found, again a spanning forest, are exact.

A large component is cut into blocks and each pair of blocks is one task, so no task
holds more than two blocks, and no pair within a component is left out. Texts with equal
sets are one class with one member that stands for it; copies are never paired.

Inputs: null or empty text has an empty set and is linked with nothing. A document of
fewer words than a shingle has its whole sequence as the one shingle. Rows may repeat and
ids may be shared by different texts: each row belongs to the class of its own text, and
a class is named by its least id. Rows with a null id take part only where another row
of their class has an id; else they are linked with nothing. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfold.llm.components import components
from landfold.llm.shared import groups, materialise, whole_text

#: Minwise hashes of a sketch, of which a byte each is kept.
SKETCH = 128
#: Tokens of a path: nodes branch so often at most.
DEPTH = 3
#: Documents of a node that are compared with each other; larger nodes branch.
NODE = 1024
#: Documents and bytes of sets in a block of a component.
BLOCK_DOCS = 1024
BLOCK_BYTES = 32 << 20
#: Standard deviations that a sketch may err by before a link is lost.
MARGIN = 5.0

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_MIX, _SHORT = np.uint64(0xFF51AFD7ED558CCD), 0xD6E8FEB86659FD93


def trees_for(similarity: float, recall: float) -> int:
    """Independent trees after which a pair just similar enough is missed with 1 - recall."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity)))


def all_trees_for(similarity: float, recall: float) -> tuple[int, int]:
    """Trees for all documents, and further ones for those of nodes that branch.

    A pair is missed if it shares no first token in the first trees, or no whole path in
    any tree; both together are at most 1 - recall, however many nodes branch.
    """
    first = trees_for(similarity, recall)
    if (1 - similarity) ** first > 0.9 * (1 - recall):
        first += 1  # or nothing would be left for paths
    left = 1 - recall - (1 - similarity) ** first
    paths = math.ceil(math.log(left) / math.log(1 - similarity**DEPTH))
    return first, max(0, paths - first)


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of so many words.

    Words are runs of characters that are not ASCII white space; A-Z count as a-z.
    """
    # For bytes, split() and lower() know ASCII only, which is what is asked for.
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, dtype=np.uint64)
    if len(parts) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(parts), seed=_SHORT)], dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), dtype=np.uint64, count=len(parts))
    n = len(h) - words + 1
    s = np.zeros(n, dtype=np.uint64)
    for i in range(words):
        s = s * _M1 + h[i : i + n]
        s ^= s >> np.uint64(29)
        s *= _M2
    s ^= s >> np.uint64(32)
    s *= _MIX
    s ^= s >> np.uint64(31)
    s.sort()
    return s[np.concatenate(([True], s[1:] != s[:-1]))]


def _minwise(sets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of a * h + b over a set, for each of the hash functions."""
    h = (sets >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(h), 512):
        np.minimum(least, (h[i : i + 512, None] * a + b).min(axis=0), out=least)
    return least


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.Generator(np.random.PCG64(20240229))
    a = r.integers(0, 1 << 31, n, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    return a, r.integers(0, 1 << 32, n, dtype=np.int64).astype(np.uint32)


_SKETCHED = "doc_id bigint, digest string, n bigint, cls string, sketch binary, paths binary"


def _sketches(words: int, trees: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """doc_id, size of the set, its class, its sketch and, tree by tree, the tokens of its path."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("digest", pa.string()),
            ("n", pa.int64()),
            ("cls", pa.string()),
            ("sketch", pa.binary()),
            ("paths", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _functions(SKETCH + trees * DEPTH)
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), words)
                out[0].append(len(s))
                if not len(s):
                    for column in out[1:]:
                        column.append(None)
                    continue
                out[1].append(xxhash.xxh3_128_hexdigest(s.tobytes()))
                least = _minwise(s, a, b)
                out[2].append((least[:SKETCH] >> np.uint32(7)).astype(np.uint8).tobytes())
                out[3].append(least[SKETCH:].astype("<u4").tobytes())
            new = [pa.array(c, type=f.type) for c, f in zip(out, list(schema)[2:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), *new], schema=schema
            )

    return run


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _forests(least_alike: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Spanning forests of nodes, of pairs whose sketches agree in so many places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[int] = []
        b: list[int] = []
        for _, node in groups(batches, "node"):
            ids = node.column("rep").to_numpy()
            if len(ids) < 2:
                continue
            raw = b"".join(x.as_py() for x in node.column("sketch"))
            sketch = np.frombuffer(raw, dtype=np.uint8).reshape(len(ids), SKETCH)
            left = np.arange(len(ids))
            while len(left):
                found, left = [left[0]], left[1:]
                while found and len(left):
                    at = found.pop()
                    alike = (sketch[left] == sketch[at]).sum(axis=1) >= least_alike
                    near = left[alike]
                    a.extend([int(ids[at])] * len(near))
                    b.extend(ids[near].tolist())
                    found.extend(near.tolist())
                    left = left[~alike]
            if len(a) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_EDGE)
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_EDGE)

    return run


def _sets(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("rep", pa.int64()), ("task", pa.int64()), ("hashes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            columns = [batch.column(c) for c in ("rep", "cls", "tasks", "text")]
            for rep, cls, tasks, text in zip(*columns, strict=True):
                s = shingle_set(text.as_py(), words)
                if xxhash.xxh3_128_hexdigest(s.tobytes()) != cls.as_py():
                    continue  # another text under the same id
                for task in tasks.as_py():
                    out[0].append(rep.as_py())
                    out[1].append(task)
                    out[2].append(s.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(out, schema, strict=True)], schema=schema
            )

    return run


def _links(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Spanning forests of the exact links within tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, task in groups(batches, "task"):
            a, b = _exact(task, percent)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_EDGE)

    return run


def _exact(task: pa.Table, percent: int) -> tuple[list[int], list[int]]:
    sets: dict[int, np.ndarray] = {}
    for rep, hashes in zip(task.column("rep"), task.column("hashes"), strict=True):
        sets[rep.as_py()] = np.frombuffer(hashes.as_py(), dtype=np.uint64)
    reps = list(sets)
    size = np.array([len(s) for s in sets.values()])
    if len(reps) < 2:
        return [], []
    # Numbers in place of hashes; a hash that one set alone has can be in no intersection.
    number = np.unique(np.concatenate(list(sets.values())), return_inverse=True, return_counts=True)
    shared = number[2] > 1
    start = np.concatenate(([0], np.cumsum(size)))
    inside = shared[number[1]]
    own = [number[1][start[i] : start[i + 1]][inside[start[i] : start[i + 1]]] for i in range(len(reps))]
    a: list[int] = []
    b: list[int] = []
    mark = np.zeros(len(shared), dtype=bool)
    left = np.arange(len(reps))
    left = left[np.argsort(-size, kind="stable")]
    while len(left):
        found, left = [int(left[0])], left[1:]
        while found and len(left):
            at = found.pop()
            # A set can only be like one whose size is within the same share.
            fits = (100 * np.minimum(size[left], size[at]) >= percent * np.maximum(size[left], size[at])).nonzero()[0]
            if not len(fits):
                continue
            mark[own[at]] = True
            there = left[fits]
            lengths = np.array([len(own[i]) for i in there])
            some = lengths > 0
            both = np.zeros(len(there), dtype=np.int64)
            if some.any():
                flat = np.concatenate([own[i] for i in there[some]])
                offsets = np.concatenate(([0], np.cumsum(lengths[some])[:-1]))
                both[some] = np.add.reduceat(mark[flat].astype(np.int64), offsets)
            mark[own[at]] = False
            linked = 100 * both >= percent * (size[there] + size[at] - both)
            near = there[linked]
            a.extend([reps[at]] * len(near))
            b.extend(reps[i] for i in near)
            found.extend(near.tolist())
            keep = np.ones(len(left), dtype=bool)
            keep[fits[linked]] = False
            left = left[keep]
    return a, b


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, recall: float = 0.999999
) -> DataFrame:
    """doc_id, digest, cls, n_shingles, component, component_id and kept, a row for each row of ``docs``.

    Links are pairs with 100 * intersection >= percent * union. ``component_id`` is the
    least id that links reach, the document itself included; ``kept`` marks the rows that
    have it. ``component`` is the component itself, as two may have the same least id; it is
    null where a row is linked with nothing for want of words or an id. ``cls`` is the class,
    null for an empty set; ``digest`` is of the text.
    """
    similarity = percent / 100
    trees, more = all_trees_for(similarity, recall)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    digested = texts.select("doc_id", _digest(F.col("text")).alias("digest"), "text")
    rows = materialise(digested.mapInArrow(_sketches(words, trees + more), _SKETCHED), "sketches")
    # A class is named by its least id. An id with several texts names its least class only
    # once as a vertex: vertices are numbered by class, labels are ids.
    classes = rows.where("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("first"))
    named = materialise(
        classes.where("first IS NOT NULL").withColumn("rep", F.xxhash64("cls")), "classes"
    )
    members = named.join(
        rows.select(F.col("doc_id").alias("first"), "cls", "sketch", "paths"), ["first", "cls"]
    ).dropDuplicates(["cls"])
    likely = _likely(members, trees, more, similarity)
    exact = _confirmed(texts, rows, named, likely, words, percent)
    reached = components(exact).join(named.select(F.col("rep").alias("v"), "first"), "v")
    least = reached.groupBy("label").agg(F.min("first").alias("least"))
    of_class = (
        named.join(reached.select(F.col("v").alias("rep"), "label"), "rep", "left")
        .join(least, "label", "left")
        .select("cls", F.coalesce("label", "rep").alias("component"), F.coalesce("least", "first").alias("least"))
    )
    joined = rows.select("doc_id", "digest", "n", "cls").join(of_class, "cls", "left")
    return joined.select(
        "doc_id",
        "digest",
        "cls",
        F.col("n").alias("n_shingles"),
        "component",
        F.coalesce("least", "doc_id").alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each group of near duplicates: of its least id, with all columns.

    Of the group's rows with that id the one whose text has the least digest stays, and of
    equal texts one. Rows with an empty set are linked with nothing and stay.
    """
    found = near_duplicates(docs, words, percent)
    keep = (
        found.where("kept")
        .withColumn("alone", F.col("cls").isNull())
        .groupBy("doc_id", "alone", "component", F.when(F.col("component").isNull(), F.col("digest")).alias("own"))
        .agg(F.min("digest").alias("digest"))
        .select(F.col("doc_id").alias("id"), "digest", "alone")
    )
    # The columns of docs go along in one, so that their names are no matter.
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        _digest(whole_text()).alias("digest"),
    )
    stay = rows.join(
        keep, rows["doc_id"].eqNullSafe(keep["id"]) & (rows["digest"] == keep["digest"])
    ).select("row", rows["doc_id"], rows["digest"], "alone")
    first = Window.partitionBy("doc_id", "digest").orderBy(F.xxhash64("row"))
    return stay.withColumn("n", F.row_number().over(first)).where("alone OR n = 1").select("row.*")


def _digest(text: Column) -> Column:
    return F.md5(F.encode(text, "utf-8"))


def _likely(members: DataFrame, trees: int, more: int, similarity: float) -> DataFrame:
    """(v, label): components of what sketches in some node of some tree take for similar."""
    spread = math.sqrt(similarity * (1 - similarity) / SKETCH)
    least_alike = math.floor((similarity - MARGIN * spread) * SKETCH)
    edges, branching = _grown(members, range(trees), least_alike)
    if more and branching is not None:
        again = members.join(branching.select("rep").distinct(), "rep", "left_semi")
        edges = edges.unionByName(_grown(again, range(trees, trees + more), least_alike)[0])
    return components(edges)


def _grown(members: DataFrame, trees: range, least_alike: int) -> tuple[DataFrame, DataFrame | None]:
    """(a, b): forests of the nodes of these trees; and the rows of first nodes that branch, if any."""
    at = materialise(
        members.select("rep", "sketch", F.explode(F.array(*[_keys(t) for t in trees])).alias("k")).select(
            "rep", "sketch", "k.*"
        ),
        "paths",
    )
    edges = branching = None
    rest = at
    for d in range(DEPTH):
        node = f"d{d}"
        sizes = rest.groupBy(node).agg(F.count("*").alias("size"), F.min("rep").alias("lead"))
        sized = rest.join(sizes.where("size > 1"), node)
        small = sized.where(F.col("size") <= NODE)
        forest = (
            small.select(F.col(node).alias("node"), "rep", "sketch")
            .repartition("node")
            .sortWithinPartitions("node", "rep")
            .mapInArrow(_forests(least_alike), "a bigint, b bigint")
        )
        edges = forest if edges is None else edges.unionByName(forest)
        large = sized.where(F.col("size") > NODE)
        if d + 1 < DEPTH:
            rest = materialise(large.drop("size", "lead"), "branches")
            if rest.isEmpty():
                break
            branching = rest if branching is None else branching
        else:
            # As many that share all tokens of a path go on together, compared or not.
            edges = edges.unionByName(large.select(F.col("rep").alias("a"), F.col("lead").alias("b")))
    return edges, branching


def _keys(tree: int) -> Column:
    """Keys of a tree's nodes; each holds all tokens on the way to it, and its tree."""
    token = lambda d: F.substring("paths", (tree * DEPTH) * 4 + 1, 4 * (d + 1))
    return F.struct(*[F.xxhash64(F.lit(tree), F.lit(d), token(d)).alias(f"d{d}") for d in range(DEPTH)])


def _confirmed(
    texts: DataFrame, rows: DataFrame, named: DataFrame, likely: DataFrame, words: int, percent: int
) -> DataFrame:
    """(a, b): a spanning forest of the exact links within each likely component."""
    sized = named.join(likely.select(F.col("v").alias("rep"), "label"), "rep").join(
        rows.groupBy("cls").agg(F.max("n").alias("n")), "cls"
    )
    blocks = sized.groupBy("label").agg(
        F.greatest(
            F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum(F.col("n") * 8) / BLOCK_BYTES)
        ).alias("blocks")
    )
    # Block i meets each block j in one task, named by the pair.
    own = F.pmod("rep", "blocks")
    tasks = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1),
        lambda j: F.xxhash64("label", F.least(j, own), F.greatest(j, own)),
    )
    wanted = sized.join(blocks, "label").select(
        F.col("first").alias("doc_id"), "rep", "cls", tasks.alias("tasks")
    )
    return (
        texts.join(wanted, "doc_id")
        .select("rep", "cls", "tasks", "text")
        .mapInArrow(_sets(words), "rep bigint, task bigint, hashes binary")
        .repartition("task")
        .sortWithinPartitions("task")
        .mapInArrow(_links(percent), "a bigint, b bigint")
    )

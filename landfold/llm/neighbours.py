"""Nearest neighbours by inner product, through a hierarchical k-means tree.

The tree is fitted on a bounded sample, and every vector is put into a leaf of it. A
query takes the tree's nodes from a priority queue, the nearest centre first, and visits
the leaves in the order in which they come out. How many leaves are visited is widened
until the recall over a sample of queries, whose true neighbours come from all vectors,
is what was asked for. A further coordinate makes the largest inner product the least
distance, so that the tree's centres mean something for vectors of any length.

Queries and vectors meet in shards: leaves that are neighbours in the tree, up to a bounded
number of vectors; a larger leaf is cut into several. A shard is compared with its visitors
block by block, each visitor with the leaves it visits, and gives one short list for each,
so a task's size is bounded whatever leaf is popular. Equal vectors are one entry with its
least ids, as many as an answer can need, so that copies cost nothing.

Inputs: vectors that are null, empty, zero, or hold null or non-finite numbers take no
part, nor do rows without an id; of several dimensions the commonest takes part, the
smallest of equally common ones. Rows equal in id and vector are one row; an id with
several vectors is several rows, none of which answers another of them. Ties go to the
smaller id. A table without vectors gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfold.llm.shared import groups, materialise

#: Vectors that the tree is fitted on, at most.
SAMPLE = 16_384
#: Children of a node, and vectors of a leaf as far as the sample can tell.
BRANCH = 8
LEAF = 256
#: Queries whose true neighbours set the number of leaves to visit.
CALIBRATED = 128
RECALL = 0.96
#: Vectors, and visitors, of a shard that one task compares.
BLOCK = 8192


@dataclass(frozen=True)
class Tree:
    """Nodes of a k-means tree: a node is a leaf if it has no children. Node 0 is the root."""

    centres: np.ndarray
    children: tuple[tuple[int, ...], ...]
    longest: float

    @property
    def leaves(self) -> int:
        return sum(not c for c in self.children)

    def order(self, query: np.ndarray, most: int) -> list[int]:
        """The leaves in the order of a best-bin-first traversal, so many at most."""
        apart = ((self.centres - query) ** 2).sum(axis=1)
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                out.append(node)
            for child in self.children[node]:
                heapq.heappush(queue, (float(apart[child]), child))
        return out

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf that each vector descends to."""
        at = np.zeros(len(vectors), dtype=np.int64)
        active = np.arange(len(vectors)) if self.children[0] else np.empty(0, dtype=np.int64)
        while len(active):
            for node in np.unique(at[active]):
                own = active[at[active] == node]
                child = np.array(self.children[node])
                at[own] = child[_nearest(vectors[own], self.centres[child])]
            active = active[[bool(self.children[n]) for n in at[active]]]
        return at


def lengthened(vectors: np.ndarray, longest: float) -> np.ndarray:
    """One coordinate more, after which all vectors are equally long."""
    rest = np.maximum(0.0, longest**2 - (vectors**2).sum(axis=1))
    return np.hstack([vectors, np.sqrt(rest)[:, None]])


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


def fit(sample: np.ndarray, leaf: float, longest: float) -> Tree:
    """A tree over lengthened vectors; nodes of at most ``leaf`` sampled vectors are leaves."""
    r = np.random.Generator(np.random.PCG64(20240229))
    centres, children = [sample.mean(axis=0)], [()]
    todo = [(0, np.arange(len(sample)))]
    while todo:
        node, own = todo.pop()
        if len(own) <= max(leaf, BRANCH):
            continue
        x = sample[own]
        centre = x[r.choice(len(x), BRANCH, replace=False)]
        for _ in range(12):
            to = _nearest(x, centre)
            centre = np.array([x[to == k].mean(axis=0) if (to == k).any() else centre[k] for k in range(BRANCH)])
        to = _nearest(x, centre)
        parts = [(k, own[to == k]) for k in range(BRANCH) if (to == k).any()]
        if len(parts) < 2:
            continue
        first = len(centres)
        children[node] = tuple(range(first, first + len(parts)))
        for k, part in parts:
            todo.append((len(centres), part))
            centres.append(centre[k])
            children.append(())
    return Tree(np.array(centres), tuple(children), longest)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _assigned(tree: Tree) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = lengthened(_matrix(batch.column("embedding")), tree.longest)
                yield batch.append_column("leaf", pa.array(tree.leaf_of(x)))

    return run


def _shards(tree: Tree, sizes: dict[int, int]) -> dict[int, tuple[int, int]]:
    """For each leaf its first shard and how many it is cut into; small leaves share one."""
    out: dict[int, tuple[int, int]] = {}
    shard, room = -1, 0
    todo = [0]
    while todo:
        node = todo.pop()
        todo += tree.children[node]
        size = sizes.get(node, 0)
        if tree.children[node] or not size:
            continue
        parts = -(-size // BLOCK)
        if parts > 1:
            out[node] = (shard + 1, parts)
            shard, room = shard + parts, 0
            continue
        if size > room:
            shard, room = shard + 1, BLOCK
        out[node] = (shard, 1)
        room -= size
    return out


_VISIT = "cls bigint, embedding array<double>, shard bigint, leaves array<bigint>"


def _visits(
    tree: Tree, most: int, shards: dict[int, tuple[int, int]]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row for each query and shard, with the shard's leaves that the query visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                q = _matrix(batch.column("embedding"))
                q = np.hstack([q, np.zeros((len(q), 1))])
                row, shard, leaves = [], [], []
                for i, x in enumerate(q):
                    own: dict[int, list[int]] = {}
                    for leaf in tree.order(x, most):
                        first, parts = shards.get(leaf, (0, 0))
                        for k in range(first, first + parts):
                            own.setdefault(k, []).append(leaf)
                    row += [i] * len(own)
                    shard += own
                    leaves += own.values()
                visited = batch.take(pa.array(row, pa.int64())).select(["cls", "embedding"])
                visited = visited.append_column("shard", pa.array(shard, pa.int64()))
                yield visited.append_column("leaves", pa.array(leaves, pa.list_(pa.int64())))

    return run


def _at_least(about: np.ndarray, most: int, floor: np.ndarray) -> np.ndarray:
    """By row, the ``most``-th largest number, or ``floor`` where that is larger."""
    if about.shape[1] <= most:
        return floor
    return np.maximum(floor, np.partition(about, about.shape[1] - most, axis=1)[:, about.shape[1] - most])


def _room(least: np.ndarray) -> np.ndarray:
    """What counts is worked out again, alike for equal vectors: room for rounding."""
    return np.where(np.isfinite(least), least - 1e-9 * np.maximum(1.0, np.abs(least)), least)


_FOUND = "cls bigint, vec_id bigint, score double"


def _compared(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The best ``most`` answers to each query within a task."""
    schema = pa.schema([("cls", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, task in groups(batches, "task"):
            asks = task.column("ask").to_numpy()
            vectors = task.filter(pa.array(~asks))
            queries = task.filter(pa.array(asks))
            if len(vectors) and len(queries):
                yield answers(vectors, queries)

    def answers(vectors: pa.Table, queries: pa.Table) -> pa.RecordBatch:
        x, q = _matrix(vectors.column("embedding")), _matrix(queries.column("embedding"))
        leaf = np.array([own[0] for own in vectors.column("leaves").to_pylist()])
        visited = queries.column("leaves").to_pylist()
        visitor = np.repeat(np.arange(len(visited)), [len(v) for v in visited])
        visits = np.array([n for v in visited for n in v])
        floor = np.full(len(q), -np.inf)
        pairs = []
        for node in np.unique(leaf):
            own, who = np.nonzero(leaf == node)[0], visitor[visits == node]
            for at in range(0, len(who), 1024):
                some = who[at : at + 1024]
                about = q[some] @ x[own].T
                floor[some] = _at_least(about, most, floor[some])
                i, j = np.nonzero(about >= _room(floor[some])[:, None])
                pairs.append((some[i], own[j], about[i, j]))
        i, j, about = (np.concatenate(c) for c in zip(*pairs, strict=True))
        kept = about >= _room(floor)[i]
        i, j = i[kept], j[kept]
        score = np.concatenate(
            [(q[i[at : at + 65536]] * x[j[at : at + 65536]]).sum(axis=1) for at in range(0, len(i), 65536)]
        )
        ids = vectors.column("ids").combine_chunks()
        start = ids.offsets.to_numpy().astype(np.int64)
        flat, times = ids.flatten().to_numpy(), np.diff(start)
        start -= start[0]
        # Every id of every vector kept, then the first of each query.
        i, score, first, times = (np.repeat(c, times[j]) for c in (i, score, start[:-1][j], times[j]))
        head = np.concatenate(([True], (i[1:] != i[:-1]) | (first[1:] != first[:-1])))
        step = np.arange(len(i)) - np.maximum.accumulate(np.where(head, np.arange(len(i)), 0))
        vec_id = flat[first + step]
        order = np.lexsort((vec_id, -score, i))
        i, vec_id, score = i[order], vec_id[order], score[order]
        begin = np.concatenate(([True], i[1:] != i[:-1]))
        rank = np.arange(len(i)) - np.maximum.accumulate(np.where(begin, np.arange(len(i)), 0))
        top = rank < most
        names = queries.column("cls").to_numpy()
        return pa.RecordBatch.from_arrays(
            [pa.array(names[i[top]]), pa.array(vec_id[top]), pa.array(score[top])], schema=schema
        )

    return run


def _true(names: np.ndarray, q: np.ndarray, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The best of each batch for each of a few queries, with their leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cls, leaf = batch.column("cls").to_numpy(), batch.column("leaf").to_numpy()
            about = q @ _matrix(batch.column("embedding")).T
            i, j = np.nonzero(about >= _at_least(about, most, np.full(len(q), -np.inf))[:, None])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[i]), pa.array(cls[j]), pa.array(about[i, j]), pa.array(leaf[j])],
                names=["ask", "cls", "score", "leaf"],
            )

    return run


def usable(embedding: Column) -> Column:
    """Whether a vector takes part."""
    return (
        embedding.isNotNull()
        & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(embedding, lambda x: x != 0)
    )


@dataclass(frozen=True)
class Index:
    """All distinct vectors in their leaves, and how many leaves to visit."""

    tree: Tree
    vectors: DataFrame
    visits: int
    recall: float


def _distinct(rows: DataFrame, most: int) -> DataFrame:
    """Distinct vectors with their ``most`` least ids; a task sends on so many copies of a vector at most."""
    least = Window.partitionBy("embedding").orderBy("vec_id")
    return (
        rows.withColumn("_n", F.row_number().over(least))
        .where(F.col("_n") <= most)
        .groupBy("embedding")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("cls", F.monotonically_increasing_id())
    )


def build(rows: DataFrame, asks: Callable[[Column], Column], most: int, recall: float = RECALL) -> Index | None:
    """An index of ``rows`` (vec_id, embedding); ``asks`` says by its id whether a row is a query."""
    vectors = materialise(_distinct(rows, most), "vectors")
    size = F.aggregate("embedding", F.lit(0.0), lambda n, x: n + x * x)
    n, longest = vectors.agg(F.count("*"), F.max(size)).first()
    if not n:
        return None
    longest = float(longest) ** 0.5
    drawn = vectors.orderBy(F.xxhash64("embedding"), "cls").limit(SAMPLE).select("embedding").toArrow()
    sample = lengthened(_matrix(drawn.column("embedding")), longest)
    tree = fit(sample, max(2.0, LEAF * len(sample) / n), longest)
    placed = materialise(
        vectors.mapInArrow(_assigned(tree), "embedding array<double>, ids array<bigint>, cls bigint, leaf bigint"),
        "index",
    )
    visits, reached = _calibrated(tree, placed, asks, most, recall)
    return Index(tree, placed, visits, reached)


def _calibrated(tree: Tree, placed: DataFrame, asks: Callable[[Column], Column], most: int, recall: float) -> tuple[int, float]:
    """The least number of leaves that gives the recall, over queries drawn by hash."""
    some = (
        placed.where(F.exists("ids", asks))
        .orderBy(F.xxhash64("embedding", F.lit("ask")), "cls")
        .limit(CALIBRATED)
        .select("cls", "embedding")
        .toArrow()
    )
    if not some.num_rows:
        return 1, 1.0
    names, q = some.column("cls").to_numpy(), _matrix(some.column("embedding"))
    near = placed.select("cls", "embedding", "leaf").mapInArrow(
        _true(names, q, most), "ask bigint, cls bigint, score double, leaf bigint"
    )
    first = Window.partitionBy("ask").orderBy(F.col("score").desc(), "cls")
    truth = (
        near.where("ask <> cls")
        .withColumn("_n", F.row_number().over(first))
        .where(F.col("_n") < most)
        .select("ask", "leaf")
        .collect()
    )
    if not truth:
        return 1, 1.0
    orders = {
        int(name): {leaf: i for i, leaf in enumerate(tree.order(np.append(x, 0.0), tree.leaves))}
        for name, x in zip(names, q, strict=True)
    }
    ranks = np.sort([orders[r["ask"]][r["leaf"]] for r in truth])
    visits = int(ranks[max(0, int(np.ceil(recall * len(ranks))) - 1)]) + 1
    return visits, float((ranks < visits).mean())


def search(embeddings: DataFrame, asks: Callable[[Column], Column], k: int = 20, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found to each row that ``asks`` takes for a query."""
    spark = embeddings.sparkSession
    some = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    common = some.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    rows = some.where(F.size("embedding") == (common[0]["d"] if common else 0)).distinct()
    # One more than an answer has, as a query's own row may be among them.
    most = k + 1
    index = build(rows, asks, most, recall)
    if index is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    queries = rows.where(asks(F.col("vec_id"))).join(
        index.vectors.select("embedding", "cls"), "embedding"
    ).select(F.col("vec_id").alias("query_id"), "cls")
    queries = materialise(queries, "queries")
    asked = index.vectors.select("cls", "embedding").join(queries.select("cls").distinct(), "cls", "left_semi")
    # One row a leaf; the sample that the tree is fitted on bounds how many there are.
    sizes = {r["leaf"]: r["count"] for r in index.vectors.groupBy("leaf").count().collect()}
    shards = _shards(index.tree, sizes)
    visits = materialise(asked.mapInArrow(_visits(index.tree, index.visits, shards), _VISIT), "visits")
    found = _tasks(index.vectors, visits, shards).mapInArrow(_compared(most), _FOUND)
    best = Window.partitionBy("cls").orderBy(F.col("score").desc(), "vec_id")
    answers = found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= most).drop("_n")
    own = Window.partitionBy("query_id", "cls").orderBy(F.col("score").desc(), "vec_id")
    return (
        queries.join(answers, "cls")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(own))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _tasks(vectors: DataFrame, visits: DataFrame, shards: dict[int, tuple[int, int]]) -> DataFrame:
    """Vectors and visitors of each shard, block by block of visitors together in a task."""
    places = F.broadcast(
        vectors.sparkSession.createDataFrame(
            [(leaf, first, parts) for leaf, (first, parts) in shards.items()],
            "leaf bigint, first bigint, parts bigint",
        )
    )
    blocks = visits.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    given = (
        vectors.join(places, "leaf")
        .withColumn("shard", F.col("first") + F.pmod("cls", "parts"))
        .join(blocks, "shard")
        .select(
            F.explode(
                F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda j: F.xxhash64("shard", j))
            ).alias("task"),
            F.lit(False).alias("ask"),
            "cls",
            "ids",
            F.array("leaf").alias("leaves"),
            "embedding",
        )
    )
    asked = visits.join(blocks, "shard").select(
        F.xxhash64("shard", F.pmod("cls", "blocks")).alias("task"),
        F.lit(True).alias("ask"),
        "cls",
        F.lit(None).cast("array<bigint>").alias("ids"),
        "leaves",
        "embedding",
    )
    return given.unionByName(asked).repartition("task").sortWithinPartitions("task")

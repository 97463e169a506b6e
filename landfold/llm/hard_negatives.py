"""Hard negatives of anchors: rows of other labels that score almost as high as an anchor's positives.

Vectors become integers, floor(256 x) of each component, so that scores are exact. Anchors are
put into blocks of near ones, and each block gets a minimal spanning tree. A candidate is
scored against the root; a child's score differs from its parent's by the length of the edge
times the candidate's length at most, so from what is known at the parent follows an interval
at the child. Only candidates whose interval overlaps what the child looks for are scored
again; for the others the interval is handed on. What an anchor looks for is, in the search
for positives, all that is not below the last of its list, and in the search for negatives
the windows below its positives' scores, as far as their lists are not full of better ones.

A task holds one block of anchors and streams one shard of the candidates. It returns short
lists, which are merged; blocks, shards and lists are bounded whatever label or vector is
common. Each candidate goes to each block of its dimension once.

Inputs: rows without id or label, rows whose vector is null, empty, holds null or non-finite
numbers or is so long that scores might not fit 64 bits (2 ** 31 after scaling) take no part.
Vectors of different dimensions do not meet. Rows equal in id, label and vector are one row;
an id with several vectors or labels is several rows, which are not each other's positives.
Ties go to the smaller id. A table without anchors gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfold.llm.shared import groups, materialise
from landfold.llm.tiled_similarity import Axes, fit

#: Anchors of a block, about.
BLOCK = 2048
#: Anchors that blocks are laid out by, at most.
SAMPLE = 16_384
#: Candidates of a shard, about, and shards at least, so that small tables use all cores.
SHARD = 262_144
SHARDS = 12
#: Candidates that go down the tree together.
STEP = 512

_LOWEST = -(1 << 62)
_NODE = "node int, parent int, edge double"


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A minimal spanning tree of the rows of ``x``: rows in the order of their depth, then for each
    place in that order its parent's place (-1 for the root) and the length of the edge to it."""
    n = len(x)
    root = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    best, by = ((x - x[root]) ** 2).sum(axis=1), np.full(n, root)
    out = np.zeros(n, dtype=bool)
    parent, depth, edge = np.full(n, -1), np.zeros(n, dtype=np.int64), np.zeros(n)
    out[root], best[root] = True, np.inf
    for _ in range(n - 1):
        node = int(best.argmin())
        parent[node], depth[node], edge[node] = by[node], depth[by[node]] + 1, np.sqrt(best[node])
        out[node], best[node] = True, np.inf
        apart = ((x - x[node]) ** 2).sum(axis=1)
        nearer = ~out & (apart < best)
        best[nearer], by[nearer] = apart[nearer], node
    order = np.argsort(depth, kind="stable")
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    return order, np.where(parent[order] < 0, -1, place[parent[order]]), edge[order]


class _Block:
    """Anchors of a block in the order of their depth, what each looks for, and the best found so far."""

    def __init__(self, anchors: pa.Table, most: int, negatives: bool):
        self.anchor, self.vec_id, self.label, self.parent = (
            anchors.column(k).to_numpy() for k in ("anchor", "vec_id", "label", "parent")
        )
        self.x = _matrix(anchors.column("vector"))
        self.length = np.sqrt((self.x**2).sum(axis=1))
        # Edges are a little longer than they are, for rounding.
        self.edge = anchors.column("edge").to_numpy() * (1 + 1e-9)
        self.most, self.negatives = most, negatives
        n = len(self.x)
        if negatives:
            low, high = (anchors.column(k).to_pylist() for k in ("low", "high"))
            width = max([1, *(len(w) for w in low if w)])
            self.low, self.high = np.full((n, width), -_LOWEST), np.full((n, width), _LOWEST)
            for i, (a, b) in enumerate(zip(low, high, strict=True)):
                if a:
                    self.low[i, : len(a)], self.high[i, : len(b)] = a, b
        else:
            self.low, self.high = np.full((n, 1), _LOWEST), np.full((n, 1), -_LOWEST)
        self.width = self.low.shape[1]
        depth = np.zeros(n, dtype=np.int64)
        for i in range(1, n):
            depth[i] = depth[self.parent[i]] + 1
        self.levels = np.split(np.arange(n), np.nonzero(np.diff(depth))[0] + 1)
        self.slot, self.score, self.found = (np.empty(0, dtype=np.int64) for _ in range(3))
        self.rescored = self.seen = 0

    def look(self, ids: np.ndarray, label: np.ndarray, y: np.ndarray) -> None:
        """Take candidates down the tree and keep what enters the lists."""
        length = np.sqrt((y**2).sum(axis=1))
        exact = self.length.max() * length.max(initial=0.0) < 2.0**53
        open_ = np.where(self.low <= self.high, self.low, -_LOWEST).min(axis=1).astype(float)
        close = np.where(self.low <= self.high, self.high, _LOWEST).max(axis=1).astype(float)
        hits = []
        at = room = np.empty((0, len(y)))
        before = 0
        for level in self.levels:
            own = self.x[level]
            slack = 1.0 + 1e-9 * self.length[level, None] * length[None]
            root = self.parent[level[0]] < 0
            if root:
                about, spread = own @ y.T, np.zeros((len(level), len(y))) if exact else slack
            else:
                up = self.parent[level] - before
                about, spread = at[up], room[up] + self.edge[level, None] * length[None]
            same = self.label[level, None] == label[None]
            wanted = ~same if self.negatives else same & (self.vec_id[level, None] != ids[None])
            wanted &= (about + spread + slack >= open_[level, None]) & (about - spread - slack <= close[level, None])
            self.seen += wanted.size
            if exact and not root and wanted.mean() > 0.25:  # all at once are quicker than one by one
                about, spread = own @ y.T, np.zeros(about.shape)
            i, j = np.nonzero(wanted)
            if exact and not spread.any():
                score = about[i, j]
            else:
                kind = np.float64 if exact else np.int64
                score = np.empty(len(i), dtype=kind)
                for k in range(0, len(i), 65_536):
                    part = slice(k, k + 65_536)
                    score[part] = (own[i[part]].astype(kind) * y[j[part]].astype(kind)).sum(axis=1)
                about[i, j] = score
                spread[i, j] = 0.0 if exact else slack[i, j]
            self.rescored += len(i)
            score = score.astype(np.int64)
            for w in range(self.width):
                low, high = self.low[level, w][i], self.high[level, w][i]
                kept = (score >= low) & (score <= high)
                hits.append((level[i[kept]] * self.width + w, score[kept], ids[j[kept]]))
            at, room, before = about, spread, level[0]
        self._merge(hits)

    def _merge(self, hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        slot, score, found = (np.concatenate(c) for c in zip((self.slot, self.score, self.found), *hits, strict=True))
        order = np.lexsort((found, -score, slot))
        slot, score, found = slot[order], score[order], found[order]
        begin = np.concatenate(([True], slot[1:] != slot[:-1])) if len(slot) else np.empty(0, dtype=bool)
        place = np.arange(len(slot))
        rank = place - np.maximum.accumulate(np.where(begin, place, 0)) if len(slot) else place
        top = rank < self.most
        self.slot, self.score, self.found = slot[top], score[top], found[top]
        full = rank == self.most - 1
        self.low.reshape(-1)[slot[full]] = np.maximum(self.low.reshape(-1)[slot[full]], score[full])

    def best(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.anchor[self.slot // self.width], pa.int64()),
                pa.array(self.slot % self.width, pa.int64()),
                pa.array(self.found, pa.int64()),
                pa.array(self.score, pa.int64()),
            ],
            names=["anchor", "w", "vec_id", "score"],
        )


_FOUND = "anchor bigint, w bigint, vec_id bigint, score bigint"


def _searched(most: int, negatives: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The lists of each task; a task's anchors come before its candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, block, anchors = None, None, []
        for batch in batches:
            task, node = batch.column("task").to_numpy(), batch.column("node")
            one = node.is_null().to_numpy(zero_copy_only=False)
            cuts = np.nonzero((np.diff(task) != 0) | (np.diff(one.astype(int)) != 0))[0] + 1
            for start, stop in zip([0, *cuts], [*cuts, len(task)], strict=True):
                if stop == start:
                    continue
                if task[start] != current:
                    if block is not None:
                        yield block.best()
                    current, block, anchors = task[start], None, []
                part = batch.slice(start, stop - start)
                if not one[start]:
                    anchors.append(part)
                    continue
                if block is None:
                    block = _Block(pa.Table.from_batches(anchors), most, negatives)
                for k in range(0, len(part), STEP):
                    some = part.slice(k, STEP)
                    block.look(some.column("vec_id").to_numpy(), some.column("label").to_numpy(), _matrix(some.column("vector")))
        if block is not None:
            yield block.best()

    return run


def _usable(rows: DataFrame, scale: int) -> DataFrame:
    """Distinct rows that take part, with integer vectors."""
    vector = F.col("embedding").cast("array<double>")
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # floor() of a double is a bigint; lengths are looked at before, so that it fits.
    scaled = F.transform(vector, lambda x: x * float(scale))
    length = F.aggregate(scaled, F.lit(0.0), lambda n, x: n + x * x)
    return (
        rows.select(
            F.col("vec_id").cast("bigint").alias("vec_id"),
            F.col("label").cast("bigint").alias("label"),
            F.when(whole & (F.size(vector) > 0) & (length < 2.0**61), scaled).alias("vector"),
        )
        .where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
        .withColumn("vector", F.transform("vector", lambda x: F.floor(x).cast("double")))
        .distinct()
    )


def _by_place(axes: Axes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The leaf of each anchor; anchors of other dimensions than the axes' have one leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("vector").value_lengths().to_numpy()
            leaf = np.zeros(len(size), dtype=np.int32)
            own = np.nonzero(size == axes.dimension)[0]
            if len(own):
                leaf[own] = axes.leaf_of(axes.turned(_matrix(batch.column("vector").take(pa.array(own)))))
            yield batch.append_column("leaf", pa.array(leaf))

    return run


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of each block with their place in its spanning tree."""
    for _, block in groups(batches, "block"):
        order, parent, edge = spanning_tree(_matrix(block.column("vector")))
        block = block.take(pa.array(order)).select(["anchor", "block", "vec_id", "label", "vector"])
        block = block.append_column("node", pa.array(np.arange(len(order)), pa.int32()))
        block = block.append_column("parent", pa.array(parent, pa.int32())).append_column("edge", pa.array(edge))
        yield from block.combine_chunks().to_batches()


def _forest(anchors: DataFrame) -> DataFrame:
    """anchor, block, vec_id, label, vector, node, parent, edge: spanning trees of blocks of near anchors."""
    sizes = anchors.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    d, n = sizes[0]["d"], sizes[0]["count"]
    drawn = anchors.where(F.size("vector") == d).orderBy(F.xxhash64("vector"), "anchor").limit(SAMPLE)
    axes = fit(_matrix(drawn.select("vector").toArrow().column("vector")), min(1024, -(-n // BLOCK)))
    placed = materialise(
        anchors.select("anchor", "vec_id", "label", "vector").mapInArrow(
            _by_place(axes), "anchor bigint, vec_id bigint, label bigint, vector array<double>, leaf int"
        ),
        "places",
    )
    key = F.struct(F.size("vector").alias("d"), "leaf")
    full = placed.groupBy(key.alias("key")).agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    blocks = (
        placed.withColumn("key", key)
        .join(full, "key")
        .withColumn("block", F.xxhash64("key", F.pmod(F.xxhash64("vec_id", "anchor"), "parts")))
    )
    dealt = blocks.drop("key", "parts", "leaf").repartition("block").sortWithinPartitions("block", "anchor")
    return dealt.mapInArrow(_trees, f"anchor bigint, block bigint, vec_id bigint, label bigint, vector array<double>, {_NODE}")


def _tasks(nodes: DataFrame, rows: DataFrame, blocks: DataFrame, shards: int, tasks: int) -> DataFrame:
    """Anchors for each shard, candidates for each block of their dimension, in the order of the tasks."""
    wide = nodes.join(blocks.select("block", "first"), "block").select(
        F.explode(F.sequence("first", F.col("first") + shards - 1)).alias("task"),
        *[c for c in nodes.columns if c != "block"],
    )
    firsts = blocks.groupBy("d").agg(F.collect_list("first").alias("firsts"))
    shard = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards))
    given = (
        rows.join(firsts, F.size("vector") == F.col("d"))
        .withColumn("shard", shard)
        .select(F.explode("firsts").alias("first"), "shard", "vec_id", "label", "vector")
        .select((F.col("first") + F.col("shard")).alias("task"), "vec_id", "label", "vector")
    )
    both = wide.unionByName(given, allowMissingColumns=True)
    return both.repartitionByRange(tasks, "task").sortWithinPartitions("task", F.col("node").asc_nulls_last())


def mine(
    embeddings: DataFrame,
    asks: Callable[[Column], Column],
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    most: int = 100,
    scale: int = 256,
) -> DataFrame:
    """For each anchor and positive the first negatives: anchor_id, positive_id, rank, negative_id and both scores.

    ``asks`` says by its id whether a row is an anchor. Negatives score between ``least`` and
    ``most`` hundredths of the positive's score.
    """
    spark = embeddings.sparkSession
    empty = spark.createDataFrame(
        [], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    )
    rows = materialise(_usable(embeddings, scale), "vectors")
    anchors = materialise(rows.where(asks(F.col("vec_id"))).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    if anchors.isEmpty():
        return empty
    forest = materialise(_forest(anchors), "forest")
    shards = max(SHARDS, -(-rows.count() // SHARD))
    # One row a block of anchors, numbered for its tasks.
    own = forest.groupBy("block").agg(F.size(F.first("vector")).alias("d")).orderBy("block").collect()
    blocks = spark.createDataFrame(
        [(r["block"], r["d"], k * shards) for k, r in enumerate(own)], "block bigint, d int, first bigint"
    )
    tasks = len(own) * shards
    found = _tasks(forest, rows, blocks, shards, tasks).mapInArrow(_searched(positives, False), _FOUND)
    order = [F.col("score").desc(), "vec_id"]
    first = F.row_number().over(Window.partitionBy("anchor").orderBy(*order))
    pairs = materialise(found.withColumn("rank", first).where(F.col("rank") <= positives).drop("w"), "positives")
    windows = _windows(pairs, least, most)
    nodes = forest.join(windows, "anchor", "left")
    found = _tasks(nodes, rows, blocks, shards, tasks).mapInArrow(_searched(negatives, True), _FOUND)
    rank = F.row_number().over(Window.partitionBy("anchor", "w").orderBy(*order))
    last = found.withColumn("rank", rank).where(F.col("rank") <= negatives)
    known = pairs.select("anchor", (F.col("rank") - 1).cast("bigint").alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        last.join(known, ["anchor", "w"])
        .join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )


def _windows(pairs: DataFrame, least: int, most: int) -> DataFrame:
    """anchor, low and high: the scores that its negatives may have, for each positive in order."""

    def floor(times: int) -> str:
        """The greatest whole number not above so many hundredths of the score, on integers that fit."""
        rest = f"{times} * pmod(score, 100)"
        return f"({times} * ((score - pmod(score, 100)) div 100) + ({rest} - pmod({rest}, 100)) div 100)"

    low, high = F.expr(f"-{floor(-least)}"), F.expr(floor(most))
    listed = F.sort_array(F.collect_list(F.struct("rank", low.alias("low"), high.alias("high"))))
    return pairs.groupBy("anchor").agg(listed.alias("l")).select("anchor", F.col("l.low").alias("low"), F.col("l.high").alias("high"))

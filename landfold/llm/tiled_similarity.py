"""All pairs of embeddings of a cosine of a threshold or more, by tiles in the order of principal axes.

Vectors are normalised and turned so that the leading coordinates hold most of their length
(the axes come from a bounded sample and change no result). A k-d tree over the leading
coordinates puts them into tiles. A row visits those tiles only whose box it can reach: if
two vectors have a cosine of t, they are no further apart than the root of 2 - 2t in any of
the coordinates together. Of two tiles one is the host, so each pair is compared once.

Within a task leading coordinates are multiplied first. With the lengths of what is left of
both vectors as one more coordinate, the product is an upper bound of the cosine; where that
stays below the threshold the pair is done. The others go on, section by section, until
the bound falls below or all coordinates are used. Cosines within 1e-9 of the threshold are
worked out once more from the vectors as given, in double precision.

A task holds one tile and streams its visitors. It returns a row for each vector with links:
how many, and one vector of the same component, which together connect what is connected;
pairs are never returned. Equal vectors are one entry with the list of their ids; a vector
with very many copies is several entries, so lists and groups are bounded whatever is common.

Inputs: vectors that are null, empty, zero, or hold null or non-finite numbers link with
nothing and are returned; so are rows without an id, which take part but name no component.
Vectors of different dimensions are not linked. Repeated rows are vectors like others, linked
with each other. An empty table gives no rows; other columns are ignored.

If vectors fill their space evenly, no box is out of reach of most rows: then all tiles are
compared with each other and the work grows with the square of the distinct vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfold.llm.components import components
from landfold.llm.neighbours import usable
from landfold.llm.shared import materialise

#: Vectors that axes and tree come from, at most, and leaves of the tree, at most.
SAMPLE = 16_384
LEAVES = 1024
#: Leading coordinates that boxes are made of.
LEAD = 8
#: Bytes of a tile's vectors, and the least number of tiles, so that small tables use all cores.
TILE = 32 << 20
TILES = 12
#: Vectors of a tile, however long they are.
ROWS = 1024
#: Tiles that visit a tile in one task; more come in several tasks.
VISITORS = 16
#: Copies of a vector in one entry, about.
COPIES = 100_000
#: Room for rounding.
SLACK = 1e-9


@dataclass(frozen=True)
class Axes:
    """The order in which coordinates of one dimension are taken, and a k-d tree over the first of them."""

    dimension: int
    turn: np.ndarray
    #: Per node: coordinate, value, lower child, upper child; a negative child c is leaf -1 - c.
    nodes: tuple[tuple[int, float, int, int], ...]

    def turned(self, x: np.ndarray) -> np.ndarray:
        """Vectors made one long, zero vectors aside; those of other dimensions keep their coordinates."""
        x = _unit(x)
        return x @ self.turn if x.shape[1] == self.dimension else x

    def leaf_of(self, lead: np.ndarray) -> np.ndarray:
        out = np.full(len(lead), -1)
        todo = [(0, np.arange(len(lead)))] if self.nodes else []
        while todo:
            node, own = todo.pop()
            axis, value, low, high = self.nodes[node]
            up = lead[own, axis] > value
            for child, part in ((low, own[~up]), (high, own[up])):
                if child < 0:
                    out[part] = child
                elif len(part):
                    todo.append((child, part))
        return -1 - out


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x**2).sum(axis=1))
    return x / np.where(length > 0, length, 1.0)[:, None]


def fit(sample: np.ndarray, leaves: int) -> Axes:
    """Axes of the greatest second moments of a sample, and a tree that halves its largest leaf again and again."""
    x = _unit(sample)
    _, vectors = np.linalg.eigh(x.T @ x)
    turn = np.ascontiguousarray(vectors[:, ::-1])
    lead = (x @ turn)[:, :LEAD]
    nodes: list[list[float]] = []
    queue = [(-len(lead), 0, None, np.arange(len(lead)))]
    made, count = 1, 1
    done: list[tuple[list[float] | None, int]] = []
    while queue:
        size, _, at, own = heapq.heappop(queue)
        spread = np.ptp(lead[own], axis=0)
        axis = int(spread.argmax())
        value = float(np.median(lead[own, axis]))
        up = lead[own, axis] > value
        if count >= leaves or len(own) < 2 or not up.any():
            done.append(at)
            continue
        node = [axis, value, 0, 0]
        if at is not None:
            at[0][at[1]] = len(nodes)
        nodes.append(node)
        count += 1
        for side, part in ((2, own[~up]), (3, own[up])):
            heapq.heappush(queue, (-len(part), made, (node, side), part))
            made += 1
    for leaf, at in enumerate(done):
        if at is not None:
            at[0][at[1]] = -1 - leaf
    return Axes(sample.shape[1], turn, tuple((int(a), v, int(b), int(c)) for a, v, b, c in nodes))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one dimension as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = batch.column("embedding").value_lengths().to_numpy()
    for d in np.unique(sizes):
        yield int(d), batch.filter(pa.array(sizes == d)) if (sizes != d).any() else batch


def _lead(x: np.ndarray) -> np.ndarray:
    lead = x[:, :LEAD]
    return np.hstack([lead, np.zeros((len(lead), LEAD - lead.shape[1]))]) if lead.shape[1] < LEAD else lead


def _placed(axes: Axes, d: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lead = _lead(axes.turned(x))
    return lead, axes.leaf_of(lead) if d == axes.dimension and axes.nodes else np.zeros(len(lead), dtype=np.int64)


_BOXES = "d int, leaf int, n bigint, " + ", ".join(f"lo{k} double, hi{k} double" for k in range(LEAD))


def _boxes(axes: Axes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Size and bounds of what each batch has of each leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, part in _by_dimension(batch):
                lead, leaf = _placed(axes, d, _matrix(part.column("embedding")))
                names, first = np.unique(leaf, return_inverse=True)
                rows = {"d": [d] * len(names), "leaf": names.astype(np.int32), "n": np.bincount(first)}
                for k in range(LEAD):
                    lo, hi = np.full(len(names), np.inf), np.full(len(names), -np.inf)
                    np.minimum.at(lo, first, lead[:, k])
                    np.maximum.at(hi, first, lead[:, k])
                    rows[f"lo{k}"], rows[f"hi{k}"] = lo, hi
                rows["d"] = pa.array(rows["d"], pa.int32())
                yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in rows.items()})

    return run


@dataclass(frozen=True)
class Tiles:
    """Tiles of one dimension: a leaf's box, its first tile and how many it is cut into."""

    low: np.ndarray
    high: np.ndarray
    first: np.ndarray
    parts: np.ndarray
    #: Per tile: its leaf, its first task, and into how many tasks its visitors are dealt.
    leaf: np.ndarray
    task: np.ndarray
    blocks: np.ndarray
    #: Position of a leaf in the arrays above.
    place: dict[int, int]

    def reached(self, lead: np.ndarray, far: float) -> np.ndarray:
        """By row and leaf, whether a row can have a partner in the leaf."""
        apart = np.zeros((len(lead), len(self.low)))
        for k in range(LEAD):
            x = lead[:, k, None]
            apart += np.maximum(0.0, np.maximum(self.low[None, :, k] - x, x - self.high[None, :, k])) ** 2
        return apart <= far


def _tiles(found: list, far: float, most: int) -> tuple[dict[int, Tiles], int]:
    """Tiles by dimension from the boxes of the leaves, and the number of tasks."""
    out, tasks = {}, 0
    for d in sorted({r["d"] for r in found}):
        own = sorted((r for r in found if r["d"] == d), key=lambda r: r["leaf"])
        low = np.array([[r[f"lo{k}"] for k in range(LEAD)] for r in own])
        high = np.array([[r[f"hi{k}"] for k in range(LEAD)] for r in own])
        size = np.array([r["n"] for r in own])
        parts = -(-size // max(ROWS, TILE // (8 * max(d, 1))))
        first = np.concatenate(([0], np.cumsum(parts)[:-1]))
        leaf = np.repeat(np.arange(len(own)), parts)
        # Visitors of a tile: half of what the leaves within reach hold.
        apart = np.maximum(0.0, np.maximum(low[:, None] - high[None], low[None] - high[:, None]))
        near = (apart**2).sum(axis=2) <= far
        visiting = (near * parts[None, :]).sum(axis=1) / 2
        blocks = np.maximum(1, np.ceil(visiting / most)).astype(np.int64)[leaf]
        task = tasks + np.concatenate(([0], np.cumsum(blocks)[:-1]))
        tasks += int(blocks.sum())
        out[d] = Tiles(low, high, first, parts, leaf, task, blocks, {r["leaf"]: i for i, r in enumerate(own)})
    return out, tasks


def _hosted(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether tile ``j`` is the host of tile ``i``; of two tiles just one is the other's."""
    return np.where((i + j) % 2 == 0, i < j, i > j)


def _visits(axes: Axes, tiles: dict[int, Tiles], far: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row for each task of a vector's own tile, and one for each other tile that it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                for d, part in _by_dimension(whole.slice(at, 512)):
                    yield from placed(d, part)

    def placed(d: int, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        of = tiles[d]
        lead, leaf = _placed(axes, d, _matrix(part.column("embedding")))
        cls = part.column("cls").to_numpy()
        place = np.array([of.place[k] for k in leaf])
        tile = of.first[place] + cls % of.parts[place]
        # Its own tile, in each of its tasks.
        times = of.blocks[tile]
        own = np.repeat(np.arange(len(tile)), times)
        step = np.arange(len(own)) - np.repeat(np.cumsum(times) - times, times)
        # Tiles it visits, in one of their tasks.
        others = np.arange(len(of.leaf))
        row, host = np.nonzero(of.reached(lead, far)[:, of.leaf] & _hosted(tile[:, None], others[None]))
        task = np.concatenate([of.task[tile[own]] + step, of.task[host] + cls[row] % of.blocks[host]])
        first = np.concatenate([step == 0, np.zeros(len(row), dtype=bool)])
        out = part.take(pa.array(np.concatenate([own, row]))).select(["cls", "id", "copies", "embedding"])
        out = out.append_column("task", pa.array(task))
        out = out.append_column("visitor", pa.array(np.arange(len(task)) >= len(own)))
        yield out.append_column("inner", pa.array(first))

    return run


def _cuts(d: int) -> list[int]:
    return sorted({max(1, d // 8), max(1, d // 4), max(1, d // 2), d})


class _Vectors:
    """Turned vectors with the lengths of what follows each section, and the vectors as given."""

    def __init__(self, given: np.ndarray, axes: Axes):
        self.given = given
        self.x = axes.turned(given)
        self.cuts = _cuts(given.shape[1])
        square = self.x**2
        self.rest = np.sqrt(np.maximum(0.0, np.stack([square[:, k:].sum(axis=1) for k in self.cuts], axis=1)))
        self.head = np.hstack([self.x[:, : self.cuts[0]], self.rest[:, :1]])

    def __len__(self) -> int:
        return len(self.x)


def near(a: _Vectors, b: _Vectors, some: slice, others: slice, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``some`` of ``a`` and ``others`` of ``b`` of a cosine of ``least`` or more."""
    x, y, cuts = a.x[some], b.x[others], a.cuts
    about = a.head[some] @ b.head[others].T
    i, j = np.nonzero(about >= least - SLACK)
    if len(i) * 8 > about.size:  # Most go on: all of them at once are quicker than one by one.
        about = x @ y.T
        i, j = np.nonzero(about >= least - SLACK)
        cosine = about[i, j]
    else:
        cosine = about[i, j] - a.rest[some][i, 0] * b.rest[others][j, 0]
        for section in range(1, len(cuts)):
            for at in range(0, len(i), 65_536):
                part = slice(at, at + 65_536)
                k = slice(cuts[section - 1], cuts[section])
                cosine[part] += np.einsum("ij,ij->i", x[i[part], k], y[j[part], k])
            rest = a.rest[some][i, section] * b.rest[others][j, section]
            kept = cosine + rest >= least - SLACK
            i, j, cosine = i[kept], j[kept], cosine[kept]
    for n in np.nonzero(np.abs(cosine - least) <= SLACK)[0]:
        p, q = a.given[some][i[n]], b.given[others][j[n]]
        cosine[n] = (p * q).sum() / (np.sqrt((p * p).sum()) * np.sqrt((q * q).sum()))
    kept = cosine >= least
    return i[kept], j[kept]


def _join(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the places ``a`` and ``b`` one label each; a label is the least place known to be connected."""
    while len(a):
        la, lb = labels[a], labels[b]
        apart = la != lb
        a, b = a[apart], b[apart]
        np.minimum.at(labels, np.maximum(la, lb)[apart], np.minimum(la, lb)[apart])
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


_FOUND = "cls bigint, id bigint, to_cls bigint, to_id bigint, n bigint"


class _Host:
    """A tile in a task: compared with itself where it is asked to, and with visitors as they come."""

    ROWS, VISITING = 2048, 1024

    def __init__(self, axes: Axes, least: float):
        self.axes, self.least, self.parts = axes, least, []
        self.vectors: _Vectors | None = None

    def add(self, own: pa.RecordBatch) -> None:
        self.parts.append(own)

    def ready(self) -> None:
        own = pa.Table.from_batches(self.parts).combine_chunks()
        self.parts = []
        self.cls, self.id, self.copies = (own.column(k).to_numpy() for k in ("cls", "id", "copies"))
        self.vectors = _Vectors(_matrix(own.column("embedding").combine_chunks()), self.axes)
        self.links = np.zeros(len(own), dtype=np.int64)
        self.labels = np.arange(len(own))
        if not own.column("inner")[0].as_py():
            return
        chunks = [slice(at, at + self.ROWS) for at in range(0, len(own), self.ROWS)]
        for m, some in enumerate(chunks):
            for others in chunks[m:]:
                i, j = near(self.vectors, self.vectors, some, others, self.least)
                i, j = i + some.start, j + others.start
                i, j = i[i < j], j[i < j]
                self._count(self.links, i, self.copies[j])
                self._count(self.links, j, self.copies[i])
                _join(self.labels, i, j)

    @staticmethod
    def _count(links: np.ndarray, at: np.ndarray, copies: np.ndarray) -> None:
        if len(at):
            links += np.bincount(at, weights=copies, minlength=len(links)).astype(np.int64)

    def visit(self, whole: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if self.vectors is None:
            self.ready()
        for at in range(0, whole.num_rows, self.VISITING):
            batch = whole.slice(at, self.VISITING)
            own, copies = _Vectors(_matrix(batch.column("embedding")), self.axes), batch.column("copies").to_numpy()
            links, first = np.zeros(len(own), dtype=np.int64), np.full(len(own), len(self.labels))
            for start in range(0, len(self.vectors), self.ROWS):
                i, j = near(self.vectors, own, slice(start, start + self.ROWS), slice(0, len(own)), self.least)
                i += start
                self._count(self.links, i, copies[j])
                self._count(links, j, self.copies[i])
                np.minimum.at(first, j, i)
                _join(self.labels, i, first[j])
            some = np.nonzero(links)[0]
            if len(some):
                cls, ids = batch.column("cls").to_numpy(), batch.column("id").to_numpy()
                yield self._found(cls[some], ids[some], first[some], links[some])

    def done(self) -> Iterator[pa.RecordBatch]:
        if self.vectors is None:
            self.ready()
        some = np.nonzero(self.links)[0]
        if len(some):
            yield self._found(self.cls[some], self.id[some], self.labels[some], self.links[some])

    def _found(self, cls: np.ndarray, ids: np.ndarray, to: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
        columns = [cls, ids, self.cls[to], self.id[to], links]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["cls", "id", "to_cls", "to_id", "n"]
        )


def _compared(axes: Axes, least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links of each task's vectors; a task's tile comes before its visitors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, host = None, None
        for batch in batches:
            task, visitor = batch.column("task").to_numpy(), batch.column("visitor").to_numpy(zero_copy_only=False)
            cuts = np.nonzero((np.diff(task) != 0) | (np.diff(visitor.astype(int)) != 0))[0] + 1
            for start, stop in zip([0, *cuts], [*cuts, len(task)], strict=True):
                if stop == start:
                    continue
                if task[start] != current:
                    if host is not None:
                        yield from host.done()
                    current, host = task[start], _Host(axes, least)
                part = batch.slice(start, stop - start)
                if visitor[start]:
                    yield from host.visit(part)
                else:
                    host.add(part)
        if host is not None:
            yield from host.done()

    return run


#: Stands for a missing id, after all others.
_LAST = (1 << 63) - 1


def _entries(embeddings: DataFrame) -> DataFrame:
    """Distinct vectors with the ids of their copies; many copies make several entries."""
    kind = embeddings.schema["embedding"].dataType
    real = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    some = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<float>" if real else "array<double>").alias("embedding"),
    ).where(usable(F.col("embedding")))
    salts = 1 + some.count() // COPIES
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts))
    return (
        some.withColumn("salt", salt if salts > 1 else F.lit(0))
        .groupBy("embedding", "salt")
        # Missing ids stay in the list, as collect_list leaves out nulls only.
        .agg(F.collect_list(F.struct("vec_id")).alias("ids"), F.coalesce(F.min("vec_id"), F.lit(_LAST)).alias("id"))
        .select(
            F.monotonically_increasing_id().alias("cls"),
            "id",
            F.size("ids").cast("bigint").alias("copies"),
            "ids",
            "embedding",
        )
    )


def links(entries: DataFrame, least: float) -> DataFrame:
    """(cls, id, to_cls, to_id, n): links of ``entries``, counted, and enough of them to connect what is connected."""
    spark = entries.sparkSession
    sizes = entries.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), "d").limit(1).collect()
    if not common:
        return spark.createDataFrame([], _FOUND)
    d, n = common[0]["d"], common[0]["n"]
    sample = entries.where(F.size("embedding") == d).orderBy(F.xxhash64("embedding"), "cls").limit(SAMPLE)
    drawn = sample.select("embedding").toArrow().column("embedding").combine_chunks()
    axes = fit(_matrix(drawn), min(LEAVES, max(TILES, -(-8 * d * n // TILE))))
    far = 2.0 - 2.0 * least + SLACK
    bounds = [f(f"{name}{k}").alias(f"{name}{k}") for k in range(LEAD) for f, name in ((F.min, "lo"), (F.max, "hi"))]
    some = entries.select("cls", "id", "copies", "embedding")
    boxes = some.mapInArrow(_boxes(axes), _BOXES).groupBy("d", "leaf").agg(F.sum("n").alias("n"), *bounds)
    tiles, tasks = _tiles([r.asDict() for r in boxes.collect()], far, VISITORS)
    kind = entries.schema["embedding"].dataType.simpleString()
    visits = some.mapInArrow(
        _visits(axes, tiles, far),
        f"cls bigint, id bigint, copies bigint, embedding {kind}, task bigint, visitor boolean, inner boolean",
    )
    dealt = visits.repartitionByRange(tasks, "task").sortWithinPartitions("task", "visitor")
    return dealt.mapInArrow(_compared(axes, least), _FOUND)


def near_vectors(embeddings: DataFrame, least: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row.

    ``n_links`` counts the other rows of a cosine of ``least`` or more, ``component_id`` is the
    least id that links reach, and ``kept`` says whether it is the row's own.
    """
    entries = materialise(_entries(embeddings), "entries")
    found = materialise(links(entries, least), "found")
    counts = found.groupBy(F.col("cls").alias("c")).agg(F.sum("n").alias("n"))
    # Ids come first in a vertex, so that a component's least vertex has its least id.
    edges = found.select(
        F.struct("id", "cls").alias("a"), F.struct(F.col("to_id").alias("id"), F.col("to_cls").alias("cls")).alias("b")
    )
    reached = components(edges).select(F.col("v.cls").alias("r"), F.col("label.id").alias("least"))
    linked = (
        entries.select("cls", "id", "copies", "ids")
        .join(counts, F.col("cls") == F.col("c"), "left")
        .join(reached, F.col("cls") == F.col("r"), "left")
        .select(
            F.explode("ids.vec_id").alias("vec_id"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.nullif(F.coalesce("least", "id"), F.lit(_LAST)).alias("component_id"),
        )
    )
    alone = embeddings.where(~F.coalesce(usable(F.col("embedding").cast("array<double>")), F.lit(False))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.lit(0).cast("bigint").alias("n_links"),
        F.col("vec_id").cast("bigint").alias("component_id"),
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

"""Starting and awaiting streams."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager, nullcontext

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from landfold.streaming.change_table import ChangeTable
from landfold.streaming.folder import Folder


def _started(writer: DataStreamWriter, checkpoint: str, every: str | None, name: str | None) -> StreamingQuery:
    """``every=None`` takes what has arrived and stops; else it runs on, e.g. ``"1 minute"``."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return (writer.queryName(name) if name else writer).start()


_STARTING = threading.Lock()
_CHECK = "spark.sql.streaming.unsupportedOperationCheck"


@contextmanager
def _numbers_allowed(spark: SparkSession) -> Iterator[None]:
    """Lets a stream start that has a running number.

    Spark refuses one since it begins anew with each batch; it is no matter where numbers are
    only compared within a split, which is read by one task of one batch. Spark looks when
    a stream is started and not again.
    """
    with _STARTING:
        before = spark.conf.get(_CHECK)
        spark.conf.set(_CHECK, "false")
        try:
            yield
        finally:
            spark.conf.set(_CHECK, before)


def append(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    *,
    numbered: bool = False,
    flow: str | None = None,
    partition_by: Sequence[str] = (),
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to the table at ``path``, each row exactly once.

    A table fed by one stream is that stream's output folder. When several are
    to feed it, each must name its ``flow`` and gets a folder of its own below
    the table: the sink counts batches per folder and would take one flow's
    batches for repeats of another's. ``numbered`` rows have a running number.
    """
    folder = path if flow is None else f"{path}/{flow}"
    spark = rows.sparkSession
    if Folder(spark, folder).exists("_spark_metadata") and not Folder(spark, checkpoint).exists():
        raise ValueError(f"{folder} was written by a stream with another checkpoint")
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", folder)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _numbers_allowed(spark) if numbered else nullcontext():
        return _started(writer, checkpoint, every, name)


def flow_identity(spark: SparkSession, checkpoint: str) -> str:
    """A name that lasts as long as the checkpoint does."""
    folder = Folder(spark, checkpoint)
    if not folder.exists("flow"):
        folder.publish("flow", uuid.uuid4().hex)
    return folder.read("flow")


def _count(seen: Observation) -> int | None:
    """The observed count; None if adaptive execution dropped the counting step with an empty rest."""
    try:
        return seen.get["n"]
    except (KeyError, Py4JJavaError):
        return None


def apply_batch(
    batch: DataFrame,
    table: ChangeTable,
    *,
    flow: str,
    batch_id: int,
    set_aside: Column | None = None,
    set_aside_path: str | None = None,
    refused: Column | None = None,
) -> None:
    """Apply one batch of changes, and write the rows to ``set_aside`` below ``set_aside_path``.

    Rows that are ``refused`` are not applied. Rows set aside are counted while the
    batch is folded, so a batch without any costs no second pass.
    """
    rows = batch if refused is None else batch.where(~refused)
    if set_aside is None:
        table.apply(rows, flow=flow, batch_id=batch_id)
        return
    seen = Observation()
    rows = batch.observe(seen, F.count_if(set_aside).alias("n"))
    if refused is not None:
        rows = rows.where(~refused)
    # A batch that comes again is not folded, so not counted either.
    n = _count(seen) if table.apply(rows, flow=flow, batch_id=batch_id) else None
    aside = batch.where(set_aside)
    if n or (n is None and not aside.isEmpty()):
        aside.write.mode("overwrite").parquet(f"{set_aside_path}/batch_id={batch_id}")


def apply_stream(
    changes: DataFrame,
    table: ChangeTable,
    checkpoint: str,
    *,
    flow: str = "",
    set_aside: Column | None = None,
    set_aside_path: str | None = None,
    refused: Column | None = None,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Apply a stream of changes to a keyed target, batch by batch as :func:`apply_batch` does.

    Batches are counted per checkpoint: with a new checkpoint everything is
    applied again, which changes nothing that was applied before.
    """
    counted = f"{flow}#{flow_identity(table.spark, checkpoint)}"

    def fold(batch: DataFrame, batch_id: int) -> None:
        apply_batch(
            batch, table, flow=counted, batch_id=batch_id, set_aside=set_aside,
            set_aside_path=set_aside_path, refused=refused,
        )

    return for_each_batch(changes, fold, checkpoint, every=every, name=name)


def for_each_batch(
    rows: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a stream that hands its batches over; a batch may come again after a failure."""
    return _started(rows.writeStream.foreachBatch(handle), checkpoint, every, name)


def await_all(queries: Iterable[StreamingQuery]) -> None:
    """Wait for streams side by side; if one fails, or fails to start, stop the others.

    Give a generator to have them started here.
    """
    started: list[StreamingQuery] = []
    try:
        for query in queries:
            started.append(query)
        waiting = list(started)
        while waiting:
            waiting = [query for query in waiting if not query.awaitTermination(1)]
    finally:
        for query in started:
            if query.isActive:
                query.stop()

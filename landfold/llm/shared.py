"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfold.workspace import materialise, work_folder

__all__ = ["groups", "let", "materialise", "per_worker", "table", "whole_text", "work_folder"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` refers to it.

    A column referred to inside a lambda function would be worked out for each element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def per_worker(key: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in a Python worker, whichever tasks it runs.

    Functions are sent by value, so that a module of their own would be new in each task.
    """
    held = sys.modules.setdefault("_landfold_per_worker", types.ModuleType("_landfold_per_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[Any, pa.Table]]:
    """Runs of equal ``key`` in a partition sorted by it, whatever batches they come in."""
    held: list[pa.RecordBatch] = []
    current: Any = None
    for batch in batches:
        keys = batch.column(key).to_pylist()
        start = 0
        for i, k in enumerate(keys):
            if held or i > start:
                if k != current:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    yield current, pa.Table.from_batches(held)
                    held, start = [], i
            current = k
        if len(keys) > start:
            held.append(batch.slice(start))
    if held:
        yield current, pa.Table.from_batches(held)

"""Connected components as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfold.llm.shared import materialise


def components(edges: DataFrame) -> DataFrame:
    """(v, label) for each vertex of ``edges`` (a, b): label is the least vertex it reaches.

    Each round moves every vertex to the least of its neighbours, twice, and puts the
    edges between the places moved to; components shrink to points after a few rounds.
    Only the number of edges left comes to the driver. Loops (a = a) and repeated edges
    do no harm; edges with a null end are left out.
    """
    kind = edges.schema["a"].dataType
    e = edges.where("a IS NOT NULL AND b IS NOT NULL").select(
        F.col("a").cast(kind), F.col("b").cast(kind)
    )
    e = materialise(e, "links")  # used twice, and costly to find
    labels = materialise(
        e.select(F.explode(F.array("a", "b")).alias("v")).distinct().select("v", F.col("v").alias("label")),
        "labels",
    )
    e = materialise(_tidy(e), "edges")
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = materialise(
            both.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p")), "parents"
        )
        up = parent.select(F.col("a").alias("p"), F.col("p").alias("pp"))
        jump = materialise(
            parent.join(up, "p", "left").select("a", F.coalesce("pp", "p").alias("to")), "jumps"
        )
        labels = materialise(
            labels.join(jump.select(F.col("a").alias("label"), "to"), "label", "left").select(
                "v", F.coalesce("to", "label").alias("label")
            ),
            "labels",
        )
        moved = e.join(jump.select("a", F.col("to").alias("ta")), "a").join(
            jump.select(F.col("a").alias("b"), F.col("to").alias("tb")), "b"
        )
        e = materialise(_tidy(moved.select(F.col("ta").alias("a"), F.col("tb").alias("b"))), "edges")
    return labels


def _tidy(e: DataFrame) -> DataFrame:
    """Each edge once, from the greater end to the lesser, without loops."""
    return (
        e.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )

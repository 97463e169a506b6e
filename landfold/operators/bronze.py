"""The bronze envelope and the routing of its rows to file sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfold.functions.names import SourceRule, match_source

#: Columns of every bronze row, in order.
ENVELOPE = (
    "fullFilePath",
    "datasource",
    "inputFileName",
    "ingestTime",
    "ingestDate",
    "value",
    "fileMetadata",
)


#: Rises along the lines that one task reads, so along each split of a file.
PLACE = "_place"


def running_number() -> Column:
    """A line's :data:`PLACE`, worked out where it is read. Splits have no number in common."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))


def to_bronze(rows: DataFrame, datasource: str) -> DataFrame:
    """Wrap read rows in the bronze envelope; a place, if they have one, is kept beside it.

    Typed rows have no raw line, so theirs is written back as CSV in ``value``
    and the parsed columns are kept beside it in a ``data`` struct.
    """
    placed = [PLACE] if PLACE in rows.columns else []
    typed = [c for c in rows.columns if c not in ("value", "fileMetadata", PLACE)]
    if typed:
        fields = [c for c in rows.columns if c not in ("fileMetadata", PLACE)]
        data = F.struct(*[F.col(f"`{c}`") for c in fields])
        rows = rows.select(F.to_csv(data).alias("value"), data.alias("data"), "fileMetadata", *placed)
    envelope = rows.select(
        F.col("fileMetadata.file_path").alias("fullFilePath"),
        F.lit(datasource).alias("datasource"),
        F.col("fileMetadata.file_name").alias("inputFileName"),
        F.current_timestamp().alias("ingestTime"),
        F.current_timestamp().cast("date").alias("ingestDate"),
        "value",
        "fileMetadata",
        *(["data"] if typed else []),
        *placed,
    )
    return envelope


def with_source(bronze: DataFrame, rules: Sequence[SourceRule] = ()) -> DataFrame:
    """Add the ``source`` each row belongs to, by path rules or file name."""
    return bronze.withColumn(
        "source", match_source(F.col("fullFilePath"), F.col("inputFileName"), rules)
    )


def split_source(routed: DataFrame, source: str) -> DataFrame:
    """Rows of one source. On a table partitioned by source only its folder is read."""
    return routed.where(F.col("source") == F.lit(source)).drop("source")


def landed_sources(routed: DataFrame) -> DataFrame:
    """Distinct file names that have landed, with the source they belong to."""
    if "source" not in routed.columns:
        routed = with_source(routed)
    return routed.select("inputFileName", "source").distinct()

"""Schema on read: from raw lines to typed change rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfold.operators.bronze import ENVELOPE, PLACE

#: Holds the raw line of a row that does not fit its schema, else null.
CORRUPT = "_corrupt_record"
#: Orders lines of one modification time, and so those of one file.
LINE_ID = "_line_id"
SEQUENCE = "sequence_by"
ORIGIN = "_bronze"
#: Columns of a stage that are not the source's own.
STAGE_COLUMNS = (SEQUENCE, LINE_ID, CORRUPT, ORIGIN)

MODES = ("permissive", "drop", "failfast")


def declared_schema(ddl: str | T.StructType) -> T.StructType:
    """The columns of a declaration, ``struct<a:int,…>`` or ``a int, …``."""
    if isinstance(ddl, T.StructType):
        return ddl
    return T.StructType.fromDDL(ddl.strip())


def _parsed(value: str, ddl: str | T.StructType, options: Mapping[str, str] | None) -> Column:
    schema = T.StructType(
        [*declared_schema(ddl).fields, T.StructField(CORRUPT, T.StringType(), True)]
    )
    parse = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **(options or {})}
    return F.from_csv(F.col(value), schema.simpleString(), parse)


def parse_lines(
    lines: DataFrame,
    ddl: str | T.StructType,
    *,
    value: str = "value",
    into: str = "data",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Parse CSV lines into a struct column; lines that do not fit keep their text.

    A malformed or short line gives the fields that could be read, nulls for the
    others, and the whole line in the struct's corrupt-record field.
    """
    return lines.withColumn(into, _parsed(value, ddl, options))


def _line_id(bronze: DataFrame) -> Column:
    digest = F.xxhash64("fullFilePath", "value")
    return F.struct(
        F.col("fullFilePath").alias("path"),
        F.col("fileMetadata.file_block_start").alias("split"),
        (F.coalesce(PLACE, digest) if PLACE in bronze.columns else digest).alias("place"),
    )


def stage(
    bronze: DataFrame,
    ddl: str | T.StructType,
    *,
    mode: str = "permissive",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Typed change rows of one source.

    The declared columns come first and only from the line, so a declared name
    such as ``value`` never meets the envelope's column of that name. After them:
    ``sequence_by`` (the file's modification time), ``_line_id`` (path, start of the split
    and place in it, so that of lines of one time the last one of the last path counts; rows
    without a place have a digest of their line there), the corrupt-record column, and the
    bronze row in the struct ``_bronze``.

    ``mode``: ``permissive`` keeps lines that do not fit, with nulls for what could
    not be read; ``drop`` leaves them out; ``failfast`` stops at the first one.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    declared = declared_schema(ddl)
    taken = {c.lower() for c in declared.fieldNames()} & {c.lower() for c in STAGE_COLUMNS}
    if taken:
        raise ValueError(f"declared columns have reserved names: {sorted(taken)}")
    # What is taken from the envelope is taken along with the parsing, so that
    # unused parts of the metadata are not even read.
    parsed = bronze.select(
        _parsed("value", declared, options).alias("_data"),
        F.col("fileMetadata.file_modification_time").alias(SEQUENCE),
        _line_id(bronze).alias(LINE_ID),
        F.struct(*ENVELOPE).alias(ORIGIN),
    ).select(
        *[F.col(f"_data.`{c}`").alias(c) for c in declared.fieldNames()],
        SEQUENCE,
        LINE_ID,
        F.col(f"_data.{CORRUPT}").alias(CORRUPT),
        ORIGIN,
    )
    if mode == "drop":
        return parsed.where(F.col(CORRUPT).isNull())
    if mode == "failfast":
        refused = F.raise_error(
            F.concat(F.lit("line does not fit its schema: "), F.col(CORRUPT))
        ).cast("string")
        return parsed.withColumn(
            CORRUPT, F.when(F.col(CORRUPT).isNotNull(), refused)
        ).where(F.col(CORRUPT).isNull())
    return parsed


def quarantined(
    bronze: DataFrame, ddl: str | T.StructType, *, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Bronze rows whose line does not fit the schema."""
    return (
        parse_lines(bronze, ddl, into="_data", options=options)
        .where(F.col(f"_data.{CORRUPT}").isNotNull())
        .drop("_data")
    )

"""File readers.

Every reader gives the declared columns plus ``fileMetadata``, the file's
``_metadata`` struct, and works as a stream (only files not yet seen, by
checkpoint) or as a batch (``streaming=False``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfold.functions.sizes import ANY_AGE, rate_options
from landfold.sources.skip import drop_file_heads

# Unicode noncharacters: never part of interchanged text, so a line is neither
# cut at a separator nor read as quoted.
_NO_SEPARATOR = "￿"
_NO_QUOTE = "￾"


def _load(
    spark: SparkSession,
    path: str,
    file_format: str,
    schema: str,
    streaming: bool,
    defaults: Mapping[str, object],
    max_files: int | None,
    max_bytes: int | str | None,
    options: Mapping[str, object] | None,
) -> DataFrame:
    reader = (spark.readStream if streaming else spark.read).format(file_format).schema(schema)
    merged: dict[str, object] = {"recursiveFileLookup": True, **defaults}
    if streaming:
        merged.update(ANY_AGE, **rate_options(max_files, max_bytes))
    # The caller's options come last, so they win. A rate limit among them
    # replaces ours: the source refuses two.
    given = {k.lower() for k in options or {}}
    if "maxbytespertrigger" in given:
        merged.pop("maxFilesPerTrigger", None)
    if "maxfilespertrigger" in given:
        merged.pop("maxBytesPerTrigger", None)
    merged = {k: v for k, v in merged.items() if k.lower() not in given}
    return reader.options(**merged, **(options or {})).load(path)


def read_text(
    spark: SparkSession,
    path: str,
    *,
    whole_text: bool = False,
    skip_rows: int = 0,
    max_files: int | None = 1000,
    max_bytes: int | str | None = None,
    options: Mapping[str, object] | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Files as text: one row per line, or one per file with ``whole_text``."""
    if whole_text and skip_rows:
        raise ValueError("skip_rows counts lines, so it cannot go with whole_text")
    text = _load(
        spark, path, "text", "value STRING", streaming,
        {"wholetext": whole_text}, max_files, max_bytes, options,
    ).select("value", F.col("_metadata").alias("fileMetadata"))
    return drop_file_heads(text, skip_rows, header=False) if skip_rows else text


def read_lines(
    spark: SparkSession,
    path: str,
    *,
    header: bool = True,
    skip_rows: int = 0,
    max_files: int | None = 1000,
    max_bytes: int | str | None = None,
    options: Mapping[str, object] | None = None,
    streaming: bool = True,
) -> DataFrame:
    """CSV files as raw lines: each line whole, header and blank lines dropped.

    Nothing is parsed, so quotes, separators and backslashes come through as
    they are. Files stay splittable, with the header dropped once per file.
    """
    if skip_rows:
        text = _load(
            spark, path, "text", "value STRING", streaming, {}, max_files, max_bytes, options
        ).select("value", F.col("_metadata").alias("fileMetadata"))
        text = drop_file_heads(text, skip_rows, header=header)
        # What the CSV reader takes for a blank line: nothing above a space.
        return text.where(F.col("value").rlike(r"[^\x00-\x20]"))
    lines = _load(
        spark, path, "csv", "value STRING, _raw STRING", streaming,
        {
            "sep": _NO_SEPARATOR, "quote": _NO_QUOTE, "escape": _NO_QUOTE, "header": header,
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_raw",
        },
        max_files, max_bytes, options,
    )
    # A line that does hold the separator is a "malformed" one, kept whole in _raw.
    return lines.select(
        F.coalesce("_raw", "value").alias("value"), F.col("_metadata").alias("fileMetadata")
    )


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    *,
    header: bool = True,
    delimiter: str = ",",
    skip_rows: int = 0,
    max_files: int | None = 1000,
    max_bytes: int | str | None = None,
    options: Mapping[str, object] | None = None,
    streaming: bool = True,
) -> DataFrame:
    """CSV files with a declared schema."""
    if skip_rows:
        ddl = schema if isinstance(schema, str) else schema.toDDL()
        lines = read_lines(
            spark, path, header=header, skip_rows=skip_rows, max_files=max_files,
            max_bytes=max_bytes, options=options, streaming=streaming,
        )
        parse = {"sep": delimiter, **{k: str(v) for k, v in (options or {}).items()}}
        return lines.select(F.from_csv("value", ddl, parse).alias("_row"), "fileMetadata").select(
            "_row.*", "fileMetadata"
        )
    return _load(
        spark, path, "csv", schema, streaming,
        {"header": header, "sep": delimiter}, max_files, max_bytes, options,
    ).select("*", F.col("_metadata").alias("fileMetadata"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Every file below a folder: ``path`` and base name, without reading contents."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    )
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("inputFileName"))

"""The registry of known sources: names, schemas and natural keys."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfold.functions.names import source_name, table_of_source

_KEYS = "table_name STRING, keys ARRAY<STRING>"


def load_ddl(spark: SparkSession, folder: str) -> DataFrame:
    """One row per ``<table>.ddl`` file: its name, text and file attributes."""
    return (
        spark.read.format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", "*.ddl")
        .load(folder)
        .select(
            F.regexp_replace("_metadata.file_name", r"\.ddl$", "").alias("table_name"),
            F.col("value").alias("ddl"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_modification_time").alias("modified_at"),
        )
    )


def load_keys(spark: SparkSession, source: str | Mapping[str, Sequence[str]]) -> DataFrame:
    """Natural keys by table: a mapping, or text of ``table = ["col", …]`` entries.

    An entry may go over several lines and may have comments; quotes are single or double.
    """
    if isinstance(source, Mapping):
        return spark.createDataFrame([(t, list(k)) for t, k in source.items()], _KEYS)
    entry = r"(?m)^\s*(\w+)\s*=\s*\[([^\]]*)\]"
    files = spark.read.format("text").option("wholetext", True).load(source)
    plain = F.regexp_replace("value", r"(?m)#.*$", "")
    entries = files.select(F.explode(F.regexp_extract_all(plain, F.lit(entry), 0)).alias("entry"))
    return entries.select(
        F.regexp_extract("entry", entry, 1).alias("table_name"),
        F.regexp_extract_all(
            F.regexp_extract("entry", entry, 2), F.lit("""["']([^"']*)["']"""), 1
        ).alias("keys"),
    )


def build_registry(ddl: DataFrame, keys: DataFrame) -> DataFrame:
    """Schemas and keys side by side; a table missing on either side stays, with nulls."""
    return ddl.join(keys, "table_name", "full_outer")


def unknown_sources(landed: DataFrame, registry: DataFrame, *, suffix: str = "_csv") -> DataFrame:
    """Landed sources that the registry does not describe yet."""
    known = registry.where(F.col("ddl").isNotNull()).select("table_name")
    return (
        landed.select("source")
        .distinct()
        .withColumn("table_name", table_of_source(F.col("source"), suffix))
        .join(known, "table_name", "left_anti")
        .select("source", "table_name")
    )


def _columns_of(ddl: str | None) -> tuple[list[str] | None, str | None]:
    if ddl is None:
        return None, None
    try:
        return T.StructType.fromDDL(ddl.strip()).fieldNames(), None
    except Exception as broken:  # the parser's own error types differ by connection
        return None, str(broken).splitlines()[0]


def registry_problems(
    registry: DataFrame, landed: DataFrame | None = None, *, suffix: str = "_csv"
) -> DataFrame:
    """What keeps a table of the registry from being built, one row per finding.

    The registry is hand-written metadata, one short row per table, so it is
    read on the driver, where schemas can be parsed.
    """
    findings: list[tuple[str, str, str | None]] = []
    entries = registry.select("table_name", "ddl", "keys").collect()
    times = Counter(name for name, _, _ in entries)
    findings += [(name, "registered more than once", str(n)) for name, n in times.items() if n > 1]
    for name, ddl, keys in entries:
        columns, broken = _columns_of(ddl)
        if ddl is None:
            findings.append((name, "no schema", None))
        elif broken is not None:
            findings.append((name, "schema cannot be parsed", broken))
        if not keys:
            findings.append((name, "no keys", None))
        elif columns is not None:
            missing = [k for k in keys if k.lower() not in {c.lower() for c in columns}]
            if missing:
                findings.append((name, "keys are not columns", ", ".join(missing)))
    spark = registry.sparkSession
    problems = spark.createDataFrame(
        findings, "table_name STRING, problem STRING, detail STRING"
    )
    if landed is None:
        return problems
    if "inputFileName" in landed.columns:
        # Several file names that give one name; a rule that brings files together does so on purpose.
        mixed = (
            landed.where(F.col("source") == source_name(F.col("inputFileName")))
            .groupBy("source")
            .agg(F.sort_array(F.collect_set("inputFileName")).alias("names"))
            .where(F.size("names") > 1)
        )
        problems = problems.unionByName(
            mixed.select(
                table_of_source(F.col("source"), suffix).alias("table_name"),
                F.lit("several file names give one source").alias("problem"),
                F.array_join("names", ", ").alias("detail"),
            )
        )
    seen = landed.select(table_of_source(F.col("source"), suffix).alias("table_name")).distinct()
    absent = (
        registry.where(F.col("ddl").isNotNull())
        .join(seen, "table_name", "left_anti")
        .select(
            "table_name",
            F.lit("no file has landed").alias("problem"),
            F.lit(None).cast("string").alias("detail"),
        )
    )
    return problems.unionByName(absent)

"""Naming tables in the session's catalog."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T


def sql_text(value: object) -> str:
    """A value as a SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def catalog_name(name: str) -> str:
    """A name as the catalog takes it: letters, digits and underscores."""
    return re.sub(r"[^A-Za-z0-9_]", "_", name)


def declare_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType | str,
    *,
    comment: str | None = None,
    properties: Mapping[str, object] | None = None,
    partition_by: Sequence[str] = (),
) -> str:
    """Name the files at ``path`` as an external table, with comment and properties.

    A name that is taken already gets the new path, comment and properties. Returns
    the name, which has underscores for what the catalog does not take.
    """
    name = catalog_name(name)
    known = spark.catalog.tableExists(f"`{name}`")
    columns = schema if isinstance(schema, str) else schema.toDDL()
    statement = f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet"
    if partition_by:
        statement += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})"
    statement += f" LOCATION {sql_text(path)}"
    if comment:
        statement += f" COMMENT {sql_text(comment)}"
    pairs = ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in (properties or {}).items())
    if pairs:
        statement += f" TBLPROPERTIES ({pairs})"
    spark.sql(statement)
    if not known:
        return name
    spark.sql(f"ALTER TABLE `{name}` SET LOCATION {sql_text(path)}")
    if comment:
        spark.sql(f"COMMENT ON TABLE `{name}` IS {sql_text(comment)}")
    if pairs:
        spark.sql(f"ALTER TABLE `{name}` SET TBLPROPERTIES ({pairs})")
    spark.catalog.refreshTable(f"`{name}`")
    return name

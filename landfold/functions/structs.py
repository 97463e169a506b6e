"""One-level flattening of nested columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _quoted(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def flatten(df: DataFrame, *, columns: Sequence[str] | None = None, on_collision: str = "replace") -> DataFrame:
    """Lift the fields of struct columns to top level and drop the structs.

    One level only: a struct inside a struct stays a struct. A field whose name
    is already taken replaces the earlier column (``on_collision="replace"``),
    is given the struct's name as a prefix (``"prefix"``) or is refused
    (``"error"``). All fields come out of a single projection.
    """
    if on_collision not in ("replace", "prefix", "error"):
        raise ValueError(f"unknown collision policy: {on_collision!r}")
    wanted = None if columns is None else set(columns)
    structs = {
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StructType) and (wanted is None or f.name in wanted)
    }
    if wanted is not None and wanted - structs:
        raise ValueError(f"not struct columns: {sorted(wanted - structs)}")

    # Spark resolves names without regard to case, so collisions are judged alike.
    out: dict[str, tuple[str, str]] = {}
    for field in df.schema.fields:
        if field.name not in structs:
            out[field.name.lower()] = (field.name, _quoted(field.name))
    for field in df.schema.fields:
        if field.name not in structs:
            continue
        for inner in field.dataType.fields:
            name = inner.name
            if name.lower() in out:
                if on_collision == "error":
                    raise ValueError(f"column {name!r} of {field.name!r} is already taken")
                if on_collision == "prefix":
                    name = f"{field.name}_{name}"
            out[name.lower()] = (name, _quoted(field.name, inner.name))
    return df.select(*[F.col(path).alias(name) for name, path in out.values()])


def explode_arrays(df: DataFrame, *, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per array element; an empty or null array gives one null row.

    Two array columns give every pair, as nested loops would.
    """
    arrays = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.ArrayType) and (columns is None or f.name in set(columns))
    ]
    for name in arrays:
        df = df.select(
            *[
                F.explode_outer(_quoted(c)).alias(c) if c == name else F.col(_quoted(c))
                for c in df.columns
            ]
        )
    return df


def flatten_and_explode(df: DataFrame) -> DataFrame:
    """Explode the array columns and flatten the struct columns, one level each.

    Element structs are left as they are.
    """
    structs = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StructType)]
    df = explode_arrays(df)
    return flatten(df, columns=structs) if structs else df

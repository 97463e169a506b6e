"""From landed file names to source names."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: (regular expression over the full path, source name). The name may hold
#: ``$1`` style references to groups of the expression.
SourceRule = tuple[str, str]


def source_name(file_name: Column) -> Column:
    """``encounters.csv`` -> ``encounters_csv``."""
    return F.replace(file_name, F.lit("."), F.lit("_"))


def match_source(path: Column, file_name: Column, rules: Sequence[SourceRule] = ()) -> Column:
    """Source of a file: the first rule that matches its path, else its name.

    The exact-name rule needs no regular expression, so a drop folder without
    rules costs one string replacement per row.
    """
    named = source_name(file_name)
    for pattern, name in reversed(list(rules)):
        named = F.when(path.rlike(pattern), _expanded(path, pattern, name)).otherwise(named)
    return named


def _expanded(path: Column, pattern: str, name: str) -> Column:
    """``name`` with its group references filled in from the first match."""
    parts = [p for p in re.split(r"(\$\d+)", name) if p]
    filled = [
        F.regexp_extract(path, pattern, int(p[1:])) if re.fullmatch(r"\$\d+", p) else F.lit(p)
        for p in parts
    ]
    return F.concat(*filled) if filled else F.lit("")


def table_of_source(source: Column, suffix: str = "_csv") -> Column:
    """Registry name of a source: ``encounters_csv`` -> ``encounters``."""
    if not suffix:
        return source
    return F.when(
        F.endswith(source, F.lit(suffix)),
        F.substring(source, F.lit(1), F.length(source) - F.lit(len(suffix))),
    ).otherwise(source)

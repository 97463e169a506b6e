"""File-drop ingestion and keyed change application on Spark."""

from landfold.functions import (
    explode_arrays,
    flatten,
    flatten_and_explode,
    match_source,
    parse_size,
    source_name,
)
from landfold.operators import (
    ChangeRules,
    apply_changes,
    apply_changes_history,
    build_registry,
    expect,
    landed_sources,
    load_ddl,
    load_keys,
    parse_lines,
    quarantined,
    registry_problems,
    split_source,
    stage,
    to_bronze,
    unknown_sources,
    violations,
    with_source,
)
from landfold.operators.history import HistoryRules
from landfold.plans import DropZone, Feed
from landfold.sources import list_files, read_csv, read_lines, read_table, read_text
from landfold.streaming import ChangeTable, append, apply_stream, await_all

__all__ = [
    "ChangeRules",
    "ChangeTable",
    "DropZone",
    "Feed",
    "HistoryRules",
    "append",
    "apply_changes",
    "apply_changes_history",
    "apply_stream",
    "await_all",
    "build_registry",
    "expect",
    "explode_arrays",
    "flatten",
    "flatten_and_explode",
    "landed_sources",
    "list_files",
    "load_ddl",
    "load_keys",
    "match_source",
    "parse_lines",
    "parse_size",
    "quarantined",
    "read_csv",
    "read_lines",
    "read_table",
    "read_text",
    "registry_problems",
    "source_name",
    "split_source",
    "stage",
    "to_bronze",
    "unknown_sources",
    "violations",
    "with_source",
]

"""DataFrame -> DataFrame transforms; each works on batches, most on streams too."""

from landfold.operators.bronze import ENVELOPE, landed_sources, split_source, to_bronze, with_source
from landfold.operators.changes import ChangeRules, apply_changes, unsequenced
from landfold.operators.expectations import expect, violations
from landfold.operators.history import apply_changes_history
from landfold.operators.records import quoted_records
from landfold.operators.registry import (
    build_registry,
    load_ddl,
    load_keys,
    registry_problems,
    unknown_sources,
)
from landfold.operators.stage import CORRUPT, parse_lines, quarantined, stage

__all__ = [
    "CORRUPT",
    "ChangeRules",
    "ENVELOPE",
    "apply_changes",
    "apply_changes_history",
    "build_registry",
    "expect",
    "landed_sources",
    "load_ddl",
    "load_keys",
    "parse_lines",
    "quarantined",
    "quoted_records",
    "registry_problems",
    "split_source",
    "stage",
    "to_bronze",
    "unknown_sources",
    "unsequenced",
    "violations",
    "with_source",
]

"""Byte sizes and per-trigger rate limits."""

from __future__ import annotations

import re

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def parse_size(size: int | str) -> int:
    """``"10g"`` -> bytes. The file source takes plain integers only."""
    if isinstance(size, int):
        value = size
    else:
        m = re.fullmatch(r"\s*(\d+)\s*([bkmgt]?)b?\s*", size.lower())
        if m is None:
            raise ValueError(f"not a byte size: {size!r}")
        value = int(m.group(1)) * _UNITS[m.group(2)]
    if value <= 0:
        raise ValueError(f"a byte size must be positive: {size!r}")
    return value


#: By default the file source passes over a file that is a week older than the
#: newest one it has seen. A late file is a change like any other, so none is.
ANY_AGE = {"maxFileAge": "36500d"}


def rate_options(max_files: int | None, max_bytes: int | str | None) -> dict[str, str]:
    """Rate-limit options of the file source.

    The source takes one limit, so two are refused here as well: neither would
    be silently without effect. Limits only pace the micro-batches; every file
    is still read.
    """
    if max_files is not None and max_bytes is not None:
        raise ValueError("give max_files or max_bytes, not both (max_files=None turns its default off)")
    if max_files is not None:
        if max_files <= 0:
            raise ValueError("max_files must be positive")
        return {"maxFilesPerTrigger": str(max_files)}
    if max_bytes is not None:
        return {"maxBytesPerTrigger": str(parse_size(max_bytes))}
    return {}

"""Streams into appended tables and into keyed targets."""

from landfold.streaming.change_table import ChangeTable
from landfold.streaming.flows import append, apply_stream, await_all

__all__ = ["ChangeTable", "append", "apply_stream", "await_all"]

"""Readers for dropped files and for the tables built from them."""

from landfold.sources.files import list_files, read_csv, read_lines, read_text
from landfold.sources.tables import read_table

__all__ = ["list_files", "read_csv", "read_lines", "read_table", "read_text"]

"""Column and schema helpers shared by the operators."""

from landfold.functions.names import match_source, source_name, table_of_source
from landfold.functions.sizes import parse_size, rate_options
from landfold.functions.structs import explode_arrays, flatten, flatten_and_explode

__all__ = [
    "explode_arrays",
    "flatten",
    "flatten_and_explode",
    "match_source",
    "parse_size",
    "rate_options",
    "source_name",
    "table_of_source",
]

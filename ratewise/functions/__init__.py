"""Column-expression helpers (all JVM built-ins, no Python on the data path)."""

from .expressions import (
    blank_or_null,
    checked_cast,
    field,
    flag_names_array,
    optional_field,
    raise_when,
    split_delimited,
    split_whitespace,
    strict_cast,
)

__all__ = [
    "blank_or_null", "checked_cast", "field", "flag_names_array", "optional_field",
    "raise_when", "split_delimited", "split_whitespace", "strict_cast",
]

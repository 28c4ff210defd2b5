"""Scalar expressions shared by the parsers, cleaners and reshapers.

Each helper returns a ``Column`` built only from Spark built-ins, so it stays
inside whole-stage code generation.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_delimited(col: Column | str, delimiter: str = "|") -> Column:
    """Split on a literal delimiter, keeping empty and trailing fields
    (``'a||'`` gives three fields), like Python's ``str.split(sep)``."""
    return F.split(col, re.escape(delimiter), -1)


def split_whitespace(col: Column | str) -> Column:
    """Split on runs of any whitespace and drop leading/trailing blanks, like
    Python's ``str.split()`` (``trim`` alone strips spaces only, not tabs).

    Whitespace runs are first collapsed to one space (``regexp_replace``
    compiles its pattern once), so the split itself is on a literal space,
    which needs no regular expression per row."""
    single = F.trim(F.regexp_replace(col, r"\s+", " "))
    return F.when(single == "", F.array().cast("array<string>")).otherwise(
        F.split(single, " ", -1))


def raise_when(bad: Column, message: Column | str) -> Column:
    """True, or an error on the executor where ``bad`` holds.  Used as a filter,
    it is evaluated for every row whatever columns a query goes on to read, and
    it does not depend on the session's ANSI setting."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(F.coalesce(bad, F.lit(False)), F.raise_error(text).cast("boolean")).otherwise(F.lit(True))


def field(parts: Column, index: int) -> Column:
    """Required field: a line too short to have it fails the job."""
    return F.when(F.size(parts) > index, F.get(parts, index)).otherwise(
        F.raise_error(F.lit(f"line has no field {index}")).cast("string"))


def optional_field(parts: Column, index: int) -> Column:
    """Optional field: ``NULL`` when the line is too short."""
    return F.get(parts, index)


def strict_cast(col: Column, dtype: str, lenient: bool = False) -> Column:
    """String to number, tolerating surrounding whitespace like Python's
    ``int()``.  Strict mode fails the job on malformed text, lenient mode yields
    ``NULL``; neither depends on the session's ANSI setting."""
    return col.try_cast(dtype) if lenient else checked_cast(col, dtype)


def checked_cast(col: Column, dtype: str) -> Column:
    """Cast that fails the job on a value the type cannot hold (it never wraps
    or turns it into ``NULL``), with or without ANSI mode."""
    value = col.try_cast(dtype)
    return F.when(col.isNull() | value.isNotNull(), value).otherwise(F.raise_error(
        F.concat(F.lit(f"not a valid {dtype}: '"), col.cast("string"), F.lit("'"))).cast(dtype))


def blank_or_null(col: Column | str) -> Column:
    """Missing-value test for strings: ``NULL`` or only spaces (tabs count as
    content, as with ``trim``)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNull() | (F.trim(c) == "")


def flag_names_array(flags: Sequence[tuple[str, Column]]) -> Column:
    """``[(name, flag_column), ...]`` -> array of the names whose flag is 1, in
    the given (vocabulary) order.  A null flag counts as not set."""
    if not flags:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(flag == 1, F.lit(name)) for name, flag in flags]))

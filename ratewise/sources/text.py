"""Line-oriented text sources and their parsers.

``spark.read.text`` gives one ``value`` row per line on the executors; the
parsers are column expressions over it (split + indexed access + cast), so no
Python worker touches the data.  The CSV reader is deliberately not used: it
turns blank fields into NULL, interprets quote marks and rejects extra fields,
none of which the line format allows.

Failure policy (``lenient=False``, the default): a line with too few required
fields or unreadable text in a numeric field fails the job, whatever columns a
query reads.  ``lenient=True`` rejects such a line as a whole, never a part of
it; :func:`rejected_lines` returns the rejects as they stood in the file, with the
file.  Where the lines carry their origin (``scan_text_lines(..., origin=True)``) a
strict failure names it too.  The check does not depend on the session's ANSI setting.  Extra trailing fields are
ignored in every parser; a short item line lacks its last flags.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import (
    flag_names_array,
    optional_field,
    raise_when,
    split_delimited,
    split_whitespace,
)

# Required fields of a line, in order, and the type of the numeric ones.
USER_FIELDS = (("user_id", "bigint"), ("age", "int"), ("gender", "string"),
               ("occupation", "string"), ("zip_code", "string"))
RATING_FIELDS = (("user_id", "bigint"), ("movie_id", "bigint"), ("rating", "int"),
                 ("timestamp", "bigint"))
ITEM_FIELDS = (("movie_id", "bigint"), ("movie_title", "string"), ("release_date", "string"),
               ("video_release_date", "string"), ("imdb_url", "string"))


# Where a line comes from: its file, and where the block that a task reads begins.
ORIGIN = ("file", "block_start")


def scan_text_lines(spark: SparkSession, path: str | Sequence[str], origin: bool = False) -> DataFrame:
    """path(s) -> ``(value string)``, one row per line.  Any Hadoop file
    system URI works (``file:``, ``hdfs:``, object stores), so choosing the
    storage is just the path.  With ``origin`` each line also says its ``file`` and the
    ``block_start`` of the read, from the scan's own metadata: constants of a file,
    so nothing more is read."""
    paths = [path] if isinstance(path, str) else list(path)
    lines = spark.read.text(paths)
    return lines if not origin else lines.select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"))


def write_text_lines(lines: DataFrame, path: str, column: str = "value") -> str:
    """Write one string column as text lines (the executors write in parallel)."""
    lines.select(F.col(column).alias("value")).write.mode("overwrite").text(path)
    return path


def _origin(lines: DataFrame) -> list[str]:
    return [c for c in ORIGIN if c in lines.columns]


def _split_once(lines: DataFrame, parts: Column) -> DataFrame:
    """One row per line holding the split fields as ``_parts``.

    The split comes out of a generator: Catalyst pushes a later filter on a
    parsed field (such as a cleaner's key check) below a projection by
    substituting the expression, so the split would run once more per filtered
    field; it does not push such a filter below a generator, so the split runs
    once per line."""
    return lines.select(*_origin(lines), F.explode(F.array(parts)).alias("_parts"))


Fields = Sequence[tuple[str, str]]


def _unreadable(parts: Column, fields: Fields, n_flags: int = 0) -> Column:
    """The line lacks a required field, or a numeric field or a present flag
    does not read as its type."""
    bad = F.size(parts) < len(fields)
    for i, (_, dtype) in enumerate(fields):
        if dtype != "string":
            bad = bad | F.get(parts, i).try_cast(dtype).isNull()
    if n_flags:
        flags = F.slice(parts, schemas.ITEM_FLAG_OFFSET + 1, n_flags)
        bad = bad | F.exists(flags, lambda x: x.try_cast("int").isNull())
    return F.coalesce(bad, F.lit(True))


def _checked(lines: DataFrame, parts: Column, fields: Fields, lenient: bool,
             n_flags: int = 0) -> DataFrame:
    """Split lines, without the unreadable ones (lenient) or failing on them."""
    bad = _unreadable(F.col("_parts"), fields, n_flags)
    where = F.concat(F.lit(" in "), F.col("file")) if "file" in lines.columns else F.lit("")
    fail = raise_when(bad, F.concat(F.lit("unreadable line"), where, F.lit(", fields: "),
                                    F.to_json(F.col("_parts"))))
    return _split_once(lines, parts).where(~bad if lenient else fail)


def _columns(fields: Fields) -> list[Column]:
    parts = F.col("_parts")
    return [(F.get(parts, i) if dtype == "string" else F.get(parts, i).try_cast(dtype)).alias(name)
            for i, (name, dtype) in enumerate(fields)]


def parse_pipe_users(lines: DataFrame, delimiter: str = "|", lenient: bool = False) -> DataFrame:
    """``user_id|age|gender|occupation|zip_code`` -> users schema.
    Blank text fields stay blank strings (not NULL); zip codes stay strings."""
    split = _checked(lines, split_delimited(F.col("value"), delimiter), USER_FIELDS, lenient)
    return split.select(*_columns(USER_FIELDS))


def parse_ws_ratings(lines: DataFrame, lenient: bool = False) -> DataFrame:
    """S3: ``user movie rating timestamp`` separated by any whitespace run
    (tabs or spaces, leading/trailing blanks ignored) -> ratings schema."""
    split = _checked(lines, split_whitespace(F.col("value")), RATING_FIELDS, lenient)
    return split.select(*_columns(RATING_FIELDS))


def _item_split(lines: DataFrame, vocabulary: Sequence[str], delimiter: str,
                lenient: bool) -> tuple[DataFrame, list[tuple[str, Column]]]:
    split = _checked(lines, split_delimited(F.col("value"), delimiter), ITEM_FIELDS, lenient,
                     len(vocabulary))
    flags = [(name, optional_field(F.col("_parts"), schemas.ITEM_FLAG_OFFSET + i).try_cast("int"))
             for i, name in enumerate(vocabulary)]
    return split, flags


def parse_item_wide(lines: DataFrame, vocabulary: Sequence[str] = schemas.DEFAULT_GENRES,
                    delimiter: str = "|", lenient: bool = False) -> DataFrame:
    """Item line -> five descriptive columns + one int flag column per
    vocabulary name (flag i is field 5 + i)."""
    split, flags = _item_split(lines, vocabulary, delimiter, lenient)
    return split.select(*_columns(ITEM_FIELDS), *[c.alias(n) for n, c in flags])


def parse_item_genres(lines: DataFrame, vocabulary: Sequence[str] = schemas.DEFAULT_GENRES,
                      delimiter: str = "|", lenient: bool = False) -> DataFrame:
    """Item line -> document form: descriptive columns + ``genres``, the
    names whose flag is 1, in vocabulary order."""
    split, flags = _item_split(lines, vocabulary, delimiter, lenient)
    return split.select(*_columns(ITEM_FIELDS), flag_names_array(flags).alias("genres"))


def rejected_lines(lines: DataFrame, kind: str, delimiter: str = "|",
                   vocabulary: Sequence[str] = schemas.DEFAULT_GENRES) -> DataFrame:
    """The lines that the lenient parser of ``kind`` (``users``, ``ratings`` or
    ``movies``) rejects, unchanged: ``(value)``, or ``(value, file, block_start)`` of
    lines that carry their origin, so equal lines of two files stay apart."""
    value = F.col("value")
    parts, fields, n_flags = {
        "users": (split_delimited(value, delimiter), USER_FIELDS, 0),
        "ratings": (split_whitespace(value), RATING_FIELDS, 0),
        "movies": (split_delimited(value, delimiter), ITEM_FIELDS, len(vocabulary)),
    }[kind]
    split = lines.select("value", *_origin(lines), F.explode(F.array(parts)).alias("_parts"))
    return split.where(_unreadable(F.col("_parts"), fields, n_flags)).select("value", *_origin(lines))

"""Readers for stored tables and documents (the read side of the sinks)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import raise_when
from ..sinks.versions import names_in, split_path, table_entry, table_folders


def read_table_projected(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                         fmt: str = "parquet", options: Mapping[str, str] | None = None,
                         schema: T.StructType | None = None) -> DataFrame:
    """Read a stored table as of its last commit (or a plain folder), keeping only
    ``columns``.  The projection is declared on the DataFrame; Catalyst prunes the scan
    to those columns (``ReadSchema``) and any later filter is pushed into it."""
    reader = spark.read.format(fmt).options(**(options or {}))
    entry = table_entry(spark, path)
    if entry is not None and "keyed" in entry:  # knows its schema, and may hold no file
        from ..sinks.keyed import read_keyed_table
        df = read_keyed_table(spark, path)
    else:
        df = (reader if schema is None else reader.schema(schema)).load(table_folders(spark, path))
    return df.select(*columns) if columns else df


def read_documents_defaulted(spark: SparkSession, path: str, fmt: str = "json",
                             schema: T.StructType = schemas.MOVIES,
                             options: Mapping[str, str] | None = None) -> DataFrame:
    """Read documents with a fixed schema.  A missing field reads as NULL,
    a missing or null ``genres`` becomes ``[]``, and ``movie_id`` is required:
    in JSON it is read as text and cast strictly, so ``2`` and ``"2"`` both
    give 2, while a document without it, or with a non-numeric one, fails the
    job."""
    id_type = schema["movie_id"].dataType
    # JSON may hold the id as a number or as text: read it as text, cast below.
    # Typed formats (parquet, orc) are read with the declared type.
    read_schema = T.StructType([
        T.StructField(f.name, T.StringType(), True) if f.name == "movie_id" else f
        for f in schema.fields]) if fmt == "json" else schema
    df = spark.read.format(fmt).options(**(options or {})).schema(read_schema).load(
        table_folders(spark, path))
    movie_id = F.col("movie_id").try_cast(id_type)
    # A filter, so that every read enforces it, also one that never reads the id.
    df = df.where(raise_when(movie_id.isNull(), F.concat(
        F.lit("document without a readable movie_id: "),
        F.coalesce(F.col("movie_id").cast("string"), F.lit("null")))))
    cols = []
    for f in schema.fields:
        if f.name == "movie_id":
            cols.append(movie_id.alias("movie_id"))
        elif f.name == "genres":
            cols.append(F.coalesce(F.col("genres"), F.array().cast(f.dataType)).alias("genres"))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def select_all_limit(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """Read-back sample, ``SELECT * ... LIMIT n``.  With ``order_by`` (the
    key) the sample is stable; Spark plans it as a per-partition top-n
    (``TakeOrderedAndProject``), never a full sort."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)


def first_rows(spark: SparkSession, path: str, n: int = 5, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    """S8 on a range-clustered table: its first ``n`` rows in the order of its ranges.
    Files are numbered by range, so only the first ones are opened: one, and twice as
    many again while they hold fewer rows (counted from their footers)."""
    entry = table_entry(spark, path)
    if entry is None or "ranges" not in entry:
        raise ValueError(f"no range-clustered table at {path}")
    folder = f"{split_path(path)[0]}/{entry['folders'][0]}"
    files = sorted(f"{folder}/{f}" for f in names_in(spark, folder) if f.startswith("part-"))
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    some = 1
    while some < len(files) and reader.load(files[:some]).count() < n:
        some *= 2
    return reader.load(files[:some] or folder).orderBy(*entry["ranges"]).limit(n)

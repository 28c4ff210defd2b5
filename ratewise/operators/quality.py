"""Data-quality profiling and cleaning (Q1-Q7).

All of these are single declarative plans.  The profile is one pass with one
conditional sum per column; the duplicate check counts total and distinct rows
from one grouped aggregate (map-side combined, so even a group of copies holding
a third of all rows collapses before the shuffle); ``profile_summary`` gives
both from that one grouped pass.  The key-wise dedup keeps the first row per
key in a total order, also as a map-side combined aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import blank_or_null


def missing_values_profile(df: DataFrame) -> DataFrame:
    """Q1: one row, one ``bigint`` per column counting missing values.  String
    columns: NULL or blank (spaces only); other types: NULL only.  Over an
    empty input every count is NULL (a SUM over no rows)."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        missing = blank_or_null(c) if isinstance(f.dataType, T.StringType) else c.isNull()
        exprs.append(F.sum(missing.cast("bigint")).alias(f.name))
    return df.select(*exprs)


_SCALAR = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType,
           T.TimestampNTZType)
_MASK_BITS = 62


def _encoded(name: str, dtype: T.DataType) -> Column:
    """A value as text that no other value shares: NULL apart from everything,
    the length before the text, and floats as grouping compares them (-0.0 is 0.0,
    all NaN are one)."""
    c = F.col(f"`{name}`")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        text = F.when(c == 0, F.lit("0")).otherwise(c.cast("string"))
    elif isinstance(dtype, T.BinaryType):
        text = F.hex(c)
    else:
        text = c.cast("string")
    return F.when(c.isNull(), F.lit("n")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _missing(f: T.StructField) -> Column:
    c = F.col(f"`{f.name}`")
    return blank_or_null(c) if isinstance(f.dataType, T.StringType) else c.isNull()


# Bytes of the fixed-width types; rows of these up to DIGEST_BYTES are their own key.
_WIDTHS = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
           T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8}
DIGEST_BYTES = 32


def _narrow(df: DataFrame) -> bool:
    """Whether a whole row is no wider than its digest would be."""
    widths = [_WIDTHS.get(type(f.dataType)) for f in df.schema.fields]
    return bool(widths) and None not in widths and sum(widths) <= DIGEST_BYTES


def _masks(df: DataFrame) -> list[Column]:
    """The missing flags of a row as bit masks."""
    out = []
    for k in range(0, len(df.schema.fields), _MASK_BITS):
        mask = F.lit(0).cast("long")
        for i, f in enumerate(df.schema.fields[k:k + _MASK_BITS]):
            mask = mask + F.when(_missing(f), F.lit(1 << i)).otherwise(F.lit(0))
        out.append(mask.alias(f"_mask{k // _MASK_BITS}"))
    return out


def _copies(df: DataFrame, with_masks: bool) -> DataFrame:
    """One row per distinct row: its missing flags as bit masks, and the number of
    copies.

    The schema chooses the grouping key.  A row of few fixed-width columns (a rating is
    28 bytes) is grouped by its columns, and the masks come from them afterwards.  Any
    other row is grouped by a 256-bit digest of its scalar columns and its masks, so the
    exchange carries some 40 bytes instead of whole texts; columns of other types stay
    grouping columns."""
    copies = F.count(F.lit(1)).alias("_copies")
    if _narrow(df):
        grouped = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(copies)
        return grouped.select("_copies", *(_masks(df) if with_masks else []))
    scalar = [f for f in df.schema.fields if isinstance(f.dataType, _SCALAR)]
    other = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, _SCALAR)]
    keys = list(other)
    if scalar:
        keys.append(F.unhex(F.sha2(F.concat(*[_encoded(f.name, f.dataType) for f in scalar]), 256))
                    .alias("_digest"))
    return df.groupBy(*keys, *(_masks(df) if with_masks else [])).agg(copies)


def duplicate_check(df: DataFrame) -> DataFrame:
    """Q2: ``(total_rows, distinct_rows, duplicate_rows)`` in one aggregate."""
    return _copies(df, False).agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_rows"),
    ).withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows"))


def profile_summary(df: DataFrame) -> DataFrame:
    """Q1 + Q2 in one pass, long form ``(metric, column_name, value)``: the
    missing count of every column (metric ``missing``) and ``total_rows`` /
    ``distinct_rows`` / ``duplicate_rows``.  Rows are grouped once (:func:`_copies`,
    map-side combined); the missing counts are sums over the
    distinct rows weighted by their copies, so the input is scanned a single
    time and no text is shuffled.  Missing counts of an empty input are NULL, as
    in the one-row profile."""
    grouped = _copies(df, True)
    sums = []
    for i in range(len(df.schema.fields)):
        bit = F.col(f"_mask{i // _MASK_BITS}").bitwiseAND(F.lit(1 << (i % _MASK_BITS))) != 0
        sums.append(F.sum(F.when(bit, F.col("_copies")).otherwise(0)).cast("bigint").alias(f"_m{i}"))
    row = grouped.agg(*sums,
                      F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("_total"),
                      F.count(F.lit(1)).cast("bigint").alias("_distinct"))

    def entry(metric: str, column: str | None, value: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"),
                        F.lit(column).cast("string").alias("column_name"),
                        value.alias("value"))

    entries = [entry("missing", f.name, F.col(f"_m{i}")) for i, f in enumerate(df.schema.fields)]
    entries += [entry("total_rows", None, F.col("_total")),
                entry("distinct_rows", None, F.col("_distinct")),
                entry("duplicate_rows", None, F.col("_total") - F.col("_distinct"))]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def record_counts(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Q3: ``(dataset, row_count)``, one row per named DataFrame."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
             .select(F.lit(name).alias("dataset"), "row_count")
             for name, df in datasets.items()]
    if not parts:
        raise ValueError("record_counts needs at least one dataset")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dedup_by_key(df: DataFrame, keys: Sequence[str],
                 order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """Q4: keep one row per key.  The kept row is the first in ``order_by``;
    by default the first by every non-key column ascending, NULLs first, so the
    choice is deterministic (a plain drop-duplicates keeps any row).

    The default order is computed as a grouped minimum, so rows of one key are
    combined on the map side before the shuffle (a key holding a third of all
    rows arrives as one row per map task): ``min`` of the single other column
    (NULL if any is NULL) runs as a hash aggregate; ``min`` over a struct of
    several columns compares them left to right with NULLs first.  A custom
    ``order_by`` uses a row-number window, which Spark plans as a two-phase
    top-1 (``WindowGroupLimit`` before and after the exchange)."""
    keys = list(keys)
    if order_by is not None:
        return _dedup_window(df, keys, order_by)
    others = [c for c in df.columns if c not in keys]
    key_cols = [F.col(f"`{k}`") for k in keys]
    if not others:
        return df.select(*key_cols).distinct()
    if len(others) == 1:
        c = F.col(f"`{others[0]}`")
        first = F.when(F.max(c.isNull()), F.lit(None)).otherwise(F.min(c))
        out = df.groupBy(*key_cols).agg(first.cast(df.schema[others[0]].dataType).alias(others[0]))
    else:
        packed = F.min(F.struct(*[F.col(f"`{c}`") for c in others])).alias("_first")
        out = df.groupBy(*key_cols).agg(packed).select(
            *key_cols, *[F.col("_first").getField(c).alias(c) for c in others])
    return out.select(*[F.col(f"`{c}`") for c in df.columns])


def _dedup_window(df: DataFrame, keys: list[str], order_by: Sequence[Column | str]) -> DataFrame:
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*(order_by or [F.lit(1)]))
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


# Validity rules applied after the key-wise dedup: columns that must be set,
# and an inclusive integer range for one column.
CLEANING_RULES: dict[str, tuple[tuple[str, ...], tuple[str, ...], tuple[str, int, int] | None]] = {
    #           dedup key                              required                      range
    "users": (("user_id",), ("user_id",), ("age", 1, 100)),
    "ratings": (("user_id", "movie_id", "timestamp"), ("user_id", "movie_id"), ("rating", 1, 5)),
    "movies": (("movie_id",), ("movie_id", "movie_title"), None),
}


def clean(df: DataFrame, keys: Sequence[str], required: Sequence[str] = (),
          int_range: tuple[str, int, int] | None = None) -> DataFrame:
    """Dedup on ``keys``, then keep rows whose ``required`` columns are set and
    whose ``int_range`` column lies in ``[lo, hi]``.  The dedup comes first, so
    when the kept copy of a key is invalid the key is gone even if another copy
    was valid."""
    checks = [F.col(c).isNotNull() for c in required]
    if int_range is not None:
        name, lo, hi = int_range
        checks.append(F.col(name).between(lo, hi))
    kept = dedup_by_key(df, keys)
    if not checks:
        return kept
    valid = checks[0]
    for c in checks[1:]:
        valid = valid & c
    return kept.where(valid)


def _rule_range(table: str, lo: int | None, hi: int | None) -> tuple[str, int, int] | None:
    rng = CLEANING_RULES[table][2]
    if rng is None:
        return None
    name, default_lo, default_hi = rng
    return (name, default_lo if lo is None else lo, default_hi if hi is None else hi)


def clean_users(users: DataFrame, min_age_exclusive: int | None = None,
                max_age: int | None = None) -> DataFrame:
    """Q5: dedup on ``user_id`` -> id set -> ``min < age <= max`` (default
    ``0 < age <= 100``)."""
    keys, required, _ = CLEANING_RULES["users"]
    lo = None if min_age_exclusive is None else min_age_exclusive + 1
    return clean(users, keys, required, _rule_range("users", lo, max_age))


def clean_ratings(ratings: DataFrame, min_rating: int | None = None,
                  max_rating: int | None = None) -> DataFrame:
    """Q6: dedup on ``(user_id, movie_id, timestamp)`` -> both ids set ->
    ``min <= rating <= max`` (default 1..5)."""
    keys, required, _ = CLEANING_RULES["ratings"]
    return clean(ratings, keys, required, _rule_range("ratings", min_rating, max_rating))


def clean_movies(movies: DataFrame) -> DataFrame:
    """Q7: dedup on ``movie_id`` -> id and title set.  Works for the wide
    (flag columns) and the document (``genres`` array) form alike."""
    keys, required, rng = CLEANING_RULES["movies"]
    return clean(movies, keys, required, rng)

"""Equi-joins of the ratings fact with its dimensions (J1-J3), and the size
check that decides whether a dimension side is broadcast.

A dimension side (movies, titles, exploded genres) is broadcast only after its
size has been measured: one aggregate over that side computes its exact
payload (8 bytes per fixed-width value, the bytes of every string, and of every
array element).  At most ``max_bytes`` -> broadcast hint; above it -> a
sort-merge hint, so an optimistic estimate cannot broadcast it either, and AQE
can still split a skewed partition.  The measuring job reads only the
dimension, never the ratings.  Sides derived from the ratings (active users)
are left to the planner: measuring them would cost a pass over the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest measured payload that is broadcast to every executor.
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024

_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _value_bytes(col: Column, dtype: T.DataType) -> Column | None:
    if isinstance(dtype, _FIXED):
        return F.lit(8)
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0)) + 8
    if isinstance(dtype, T.ArrayType):
        inner = dtype.elementType
        if isinstance(inner, _FIXED):
            return F.coalesce(F.size(col), F.lit(0)) * 8 + 16
        if isinstance(inner, (T.StringType, T.BinaryType)):
            return F.coalesce(F.aggregate(col, F.lit(0).cast("long"),
                                          lambda acc, x: acc + F.coalesce(F.octet_length(x), F.lit(0)) + 8),
                              F.lit(0)) + 16
    return None


def measured_bytes(df: DataFrame) -> int | None:
    """Exact payload size of ``df`` (one aggregate job), or ``None`` when a
    column type has no measure here (then nothing is claimed)."""
    parts = []
    for f in df.schema.fields:
        b = _value_bytes(F.col(f"`{f.name}`"), f.dataType)
        if b is None:
            return None
        parts.append(b.cast("long"))
    row_bytes = sum(parts[1:], parts[0]) if parts else F.lit(0).cast("long")
    total = df.agg(F.sum(row_bytes + 8).alias("b")).first()["b"]
    return int(total or 0)


def sized_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its measured size is at most
    ``max_bytes``, else (or if it cannot be measured) with a sort-merge hint."""
    size = measured_bytes(df)
    return F.broadcast(df) if size is not None and size <= max_bytes else df.hint("merge")


def join_ratings_movies(ratings: DataFrame, movies: DataFrame,
                        max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Inner join on ``movie_id``; unmatched rows on both sides drop."""
    return ratings.join(sized_broadcast(movies, max_broadcast_bytes), "movie_id", "inner")


def join_ratings_active_users(ratings: DataFrame, active_users: DataFrame) -> DataFrame:
    """Ratings of users present in ``active_users`` (one row per user), as a
    left-semi join: a rating never fans out and only the key is read.  The
    active users derive from the ratings, so the planner (and AQE, with the
    measured size) picks the strategy."""
    return ratings.join(active_users.select("user_id"), "user_id", "left_semi")


def join_ratings_movie_genres(ratings: DataFrame, movie_genres: DataFrame,
                              max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Inner join with the exploded genres; a rating fans out to one row per
    genre of its movie."""
    return ratings.join(sized_broadcast(movie_genres, max_broadcast_bytes), "movie_id", "inner")

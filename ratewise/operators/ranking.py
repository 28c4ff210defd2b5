"""Ranked results: favourite genre per user (W1), sorted previews (L2) and the
top-N movies with a position rank (L3 + W2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def favourite_genre_per_user(user_genre_counts: DataFrame, ordered: bool = False) -> DataFrame:
    """W1 (Task 3): per user, the genre with the highest count; ties go to the
    smaller genre name in binary string order.  Row-number = 1 is planned as a
    top-1 group limit; the window needs no exchange of its own, since its
    input is already partitioned by ``user_id``, and a user's partition is at
    most one row per genre however many ratings the user has."""
    w = Window.partitionBy("user_id").orderBy(
        F.col("genre_rating_count").desc(), F.col("genre").asc_nulls_first())
    out = (user_genre_counts
           .withColumn("genre_rank", F.row_number().over(w))
           .filter(F.col("genre_rank") == 1)
           .select("user_id", F.col("genre").alias("favourite_genre"), "genre_rating_count"))
    return out.orderBy("user_id") if ordered else out


def user_genre_counts_sorted(user_genre_counts: DataFrame, n: int = 30) -> DataFrame:
    """L2: ``user_id`` ascending, count descending (then genre), first ``n``."""
    return (user_genre_counts
            .orderBy(F.col("user_id").asc(), F.col("genre_rating_count").desc(),
                     F.col("genre").asc())
            .limit(n))


def _top_order():
    return (F.col("average_rating").desc(), F.col("rating_count").desc(), F.col("movie_id").asc())


def top_n_movies(average_ratings: DataFrame, n: int = 10, min_count: int = 0) -> DataFrame:
    """L3 (Task 2): the ``n`` movies with the highest (already rounded) average,
    then the most ratings, then the smaller id; ``rank`` is the position 1..n.

    The order+limit is a per-partition top-n merged on one task
    (``TakeOrderedAndProject``); the rank window then runs over those ``n``
    rows only.  ``n`` is a report size: those ``n`` rows meet on one task, so
    it is meant to stay small (the reports use 10).  ``min_count`` (default 0 =
    no minimum) can drop movies with few ratings."""
    src = average_ratings
    if min_count:
        src = src.filter(F.col("rating_count") >= min_count)
    top = src.orderBy(*_top_order()).limit(n)
    rank = F.row_number().over(Window.orderBy(*_top_order())).cast("int")
    return top.select(rank.alias("rank"), "movie_id", "movie_title", "average_rating",
                      "rating_count")

"""Grouped aggregates over the ratings fact (A1-A3).

Spark does not move an aggregate below a join by itself, so these operators do
it where the result is provably the same: ratings are reduced per join key
(map-side partial aggregation, then one shuffle of the partial rows) before
they meet a dimension.  The big fact is then never shuffled row by row, and a
key that holds a third of all rows is folded on the map side instead of landing
whole in one reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import DEFAULT_MAX_BROADCAST_BYTES, sized_broadcast


def average_rating_per_movie(ratings: DataFrame, movies: DataFrame, ordered: bool = False,
                             digits: int = 3,
                             max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """A1 (Task 1): per ``(movie_id, movie_title)`` of the inner join of ratings
    and movies: ``round(avg(rating), 3)`` and ``count(rating)``.

    Computed as sum/count per ``movie_id`` first, joined to the titles, then
    summed per ``(movie_id, movie_title)``; this equals aggregating the joined
    rows even when a movie row repeats.  ``ordered`` adds the preview order by
    ``movie_id``.  The titles are broadcast only if their measured size
    allows (:func:`~ratewise.operators.joins.sized_broadcast`)."""
    per_movie = ratings.groupBy("movie_id").agg(
        F.sum("rating").alias("_sum"), F.count("rating").alias("_cnt"))
    titles = sized_broadcast(movies.select("movie_id", "movie_title"), max_broadcast_bytes)
    titled = per_movie.join(titles, "movie_id", "inner")
    out = (titled.groupBy("movie_id", "movie_title")
           .agg(F.sum("_sum").alias("_sum"), F.sum("_cnt").alias("_cnt"))
           .select(
               "movie_id", "movie_title",
               F.round(F.when(F.col("_cnt") > 0, F.col("_sum") / F.col("_cnt")), digits)
                .alias("average_rating"),
               F.col("_cnt").cast("bigint").alias("rating_count")))
    return out.orderBy("movie_id") if ordered else out


def active_users(ratings: DataFrame, min_ratings: int = 50, ordered: bool = False) -> DataFrame:
    """A2: users with at least ``min_ratings`` ratings (``count(movie_id)``, so a
    re-rating at another time counts again) -> ``(user_id, total_ratings)``."""
    out = (ratings.groupBy("user_id")
           .agg(F.count("movie_id").alias("total_ratings"))
           .filter(F.col("total_ratings") >= min_ratings))
    return out.orderBy("user_id") if ordered else out


def user_genre_counts(ratings: DataFrame, movie_genres: DataFrame, active: DataFrame,
                      max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """A3: for active users, ``count(*)`` of ratings per ``(user_id, genre)``
    over ratings ⋈ active users ⋈ exploded genres.

    The active-user restriction only filters on ``user_id``, which is a grouping
    key, so it is applied to the (user, genre) counts rather than to the raw
    ratings: the ratings are shuffled once (by ``movie_id`` for the genre join,
    or not at all when the genre side's measured size allows a broadcast) and
    never by ``user_id``."""
    genres = sized_broadcast(movie_genres.select("movie_id", "genre"), max_broadcast_bytes)
    pairs = ratings.select("user_id", "movie_id").join(genres, "movie_id", "inner")
    counts = pairs.groupBy("user_id", "genre").agg(
        F.count(F.lit(1)).alias("genre_rating_count"))
    return counts.join(active.select("user_id"), "user_id", "left_semi")

"""Session views and the SQL-text form of the analytics (K6).

``register_views`` names DataFrames as temporary views, so the same tasks can
be run as Spark SQL.  The SQL below is ours: it states the same semantics as
the DataFrame operators and gets the same physical plan shape (ratings are
aggregated per movie before meeting the titles; the active-user restriction is
applied to the per-(user, genre) counts; the favourite genre is a grouped
``min_by``, which needs no window).  The dimension joins carry a BROADCAST or MERGE hint chosen from
the measured size of the dimension side, as in the DataFrame operators.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import DEFAULT_MAX_BROADCAST_BYTES, measured_bytes


def register_views(views: Mapping[str, DataFrame]) -> list[str]:
    """K6: ``createOrReplaceTempView`` for each ``name -> DataFrame``."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def register_movie_genres(spark: SparkSession, movies_view: str = "movies",
                          name: str = "movie_genres") -> str:
    """The exploded ``(movie_id, movie_title, genre)`` view over a movies view."""
    spark.sql(f"SELECT movie_id, movie_title, explode(genres) AS genre FROM {movies_view}") \
        .createOrReplaceTempView(name)
    return name


# Task 1: views ratings(movie_id, rating), movies(movie_id, movie_title).
AVERAGE_RATING_SQL = """
SELECT /*+ {hint}(m) */ m.movie_id, m.movie_title,
       ROUND(CASE WHEN SUM(r.n) > 0 THEN SUM(r.total) / SUM(r.n) END, {digits}) AS average_rating,
       CAST(SUM(r.n) AS BIGINT) AS rating_count
FROM (SELECT movie_id, SUM(rating) AS total, COUNT(rating) AS n
      FROM ratings GROUP BY movie_id) r
JOIN movies m ON r.movie_id = m.movie_id
GROUP BY m.movie_id, m.movie_title
"""

# Task 2: view average_movie_ratings.
TOP_MOVIES_SQL = """
SELECT CAST(row_number() OVER (ORDER BY average_rating DESC, rating_count DESC, movie_id ASC)
            AS INT) AS rank,
       movie_id, movie_title, average_rating, rating_count
FROM (SELECT * FROM average_movie_ratings
      ORDER BY average_rating DESC, rating_count DESC, movie_id ASC
      LIMIT {n}) top
"""

# Task 3 step 1: view ratings(user_id, movie_id).
ACTIVE_USERS_SQL = """
SELECT user_id, total_ratings
FROM (SELECT user_id, count(movie_id) AS total_ratings FROM ratings GROUP BY user_id) per_user
WHERE total_ratings >= {min_ratings}
"""

# Task 3 step 2: views ratings, movie_genres, active_users.
USER_GENRE_COUNTS_SQL = """
SELECT c.user_id, c.genre, c.genre_rating_count
FROM (SELECT /*+ {hint}(g) */ r.user_id, g.genre, COUNT(*) AS genre_rating_count
      FROM ratings r JOIN movie_genres g ON r.movie_id = g.movie_id
      GROUP BY r.user_id, g.genre) c
LEFT SEMI JOIN active_users a ON c.user_id = a.user_id
"""

# Task 3 step 3: view user_genre_counts.  The favourite is the genre with the
# largest count, the smaller name on ties: the minimum of (-count, genre).
FAVOURITE_GENRE_SQL = """
SELECT user_id,
       min_by(genre, named_struct('neg_count', -genre_rating_count, 'genre', genre))
         AS favourite_genre,
       max(genre_rating_count) AS genre_rating_count
FROM user_genre_counts
GROUP BY user_id
"""


def _join_hint(df: DataFrame, max_bytes: int) -> str:
    """BROADCAST if the side's measured size allows it, else MERGE."""
    size = measured_bytes(df)
    return "BROADCAST" if size is not None and size <= max_bytes else "MERGE"


def average_rating_sql(spark: SparkSession, digits: int = 3,
                       max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    hint = _join_hint(spark.table("movies").select("movie_id", "movie_title"), max_broadcast_bytes)
    return spark.sql(AVERAGE_RATING_SQL.format(digits=int(digits), hint=hint))


def top_movies_sql(spark: SparkSession, n: int = 10) -> DataFrame:
    return spark.sql(TOP_MOVIES_SQL.format(n=int(n)))


def favourite_genre_sql(spark: SparkSession, min_ratings: int = 50,
                        max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Task 3 as SQL over the views ``ratings`` and ``movies``; registers the
    intermediate views ``movie_genres``, ``active_users``, ``user_genre_counts``."""
    register_movie_genres(spark)
    spark.sql(ACTIVE_USERS_SQL.format(min_ratings=int(min_ratings))) \
        .createOrReplaceTempView("active_users")
    hint = _join_hint(spark.table("movie_genres").select("movie_id", "genre"), max_broadcast_bytes)
    spark.sql(USER_GENRE_COUNTS_SQL.format(hint=hint)).createOrReplaceTempView("user_genre_counts")
    return spark.sql(FAVOURITE_GENRE_SQL)

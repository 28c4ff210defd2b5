"""Entity schemas, table keys and the category vocabulary.

Every reader and sink takes its schema from here, so an empty input still
yields a DataFrame of the right shape and no job is spent on inference.

Type policy: inside Spark, ids and epoch seconds are ``bigint`` (what the
line parsers would infer, and wide enough for ids at any scale); ages,
ratings and flags are ``int``; counts stay ``bigint``.  The stored result
tables keep the same types, except that ``rank`` is ``int``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# The default category vocabulary of the item file, in file order: flag i of an
# item line (field 5 + i) belongs to name i.  These must equal the source data
# layout for correct results.
DEFAULT_GENRES: tuple[str, ...] = (
    "unknown", "Action", "Adventure", "Animation", "Children", "Comedy",
    "Crime", "Documentary", "Drama", "Fantasy", "Film_Noir", "Horror",
    "Musical", "Mystery", "Romance", "Sci_Fi", "Thriller", "War", "Western",
)
# Number of descriptive fields before the first flag on an item line.
ITEM_FLAG_OFFSET = 5
# ---------------------------------------------------------------------------

L, I, D, S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


USERS = _struct(("user_id", L), ("age", I), ("gender", S), ("occupation", S), ("zip_code", S))
RATINGS = _struct(("user_id", L), ("movie_id", L), ("rating", I), ("timestamp", L))
MOVIE_DESCRIPTIVE = (
    ("movie_id", L), ("movie_title", S), ("release_date", S),
    ("video_release_date", S), ("imdb_url", S),
)
MOVIES = _struct(*MOVIE_DESCRIPTIVE, ("genres", T.ArrayType(S, True)))


def movies_wide(vocabulary=DEFAULT_GENRES) -> T.StructType:
    """Descriptive fields followed by one ``int`` flag column per category."""
    return _struct(*MOVIE_DESCRIPTIVE, *((name, I) for name in vocabulary))


MOVIE_GENRES = _struct(("movie_id", L), ("movie_title", S), ("genre", S))
AVERAGE_MOVIE_RATINGS = _struct(
    ("movie_id", L), ("movie_title", S), ("average_rating", D), ("rating_count", L))
TOP_MOVIES = _struct(
    ("rank", I), ("movie_id", L), ("movie_title", S), ("average_rating", D), ("rating_count", L))
ACTIVE_USERS = _struct(("user_id", L), ("total_ratings", L))
USER_GENRE_COUNTS = _struct(("user_id", L), ("genre", S), ("genre_rating_count", L))
USER_FAVOURITE_GENRES = _struct(
    ("user_id", L), ("favourite_genre", S), ("genre_rating_count", L))

# Primary keys: a later row with an equal key replaces the earlier one.
KEYS: dict[str, tuple[str, ...]] = {
    "users": ("user_id",),
    "ratings": ("user_id", "movie_id", "timestamp"),
    "movies": ("movie_id",),
    "average_movie_ratings": ("movie_id",),
    "top_10_movies": ("rank",),
    "user_favourite_genres": ("user_id",),
    "young_users": ("user_id",),
    "scientist_users": ("user_id",),
}

# Order of a users table that is read by segments; it ends with the key.
SEGMENT_ORDER = ("occupation", "age", "user_id")

# Stored tables (base and results) and their schemas.
TABLES: dict[str, T.StructType] = {
    "users": USERS,
    "ratings": RATINGS,
    "average_movie_ratings": AVERAGE_MOVIE_RATINGS,
    "top_10_movies": TOP_MOVIES,
    "user_favourite_genres": USER_FAVOURITE_GENRES,
    "young_users": USERS,
    "scientist_users": USERS,
}

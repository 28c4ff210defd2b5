"""Relational operators of the ratings domain; each is DataFrame -> DataFrame."""

from .aggregates import active_users, average_rating_per_movie, user_genre_counts
from .filters import project_columns, users_by_occupation_and_age, users_younger_than
from .joins import (
    join_ratings_active_users,
    join_ratings_movie_genres,
    join_ratings_movies,
    measured_bytes,
    sized_broadcast,
)
from .quality import (
    CLEANING_RULES,
    clean,
    clean_movies,
    clean_ratings,
    clean_users,
    dedup_by_key,
    duplicate_check,
    missing_values_profile,
    profile_summary,
    record_counts,
)
from .ranking import favourite_genre_per_user, top_n_movies, user_genre_counts_sorted
from .reshape import explode_genres, flags_to_array

__all__ = [
    "CLEANING_RULES", "clean", "active_users", "average_rating_per_movie", "clean_movies", "clean_ratings",
    "clean_users", "dedup_by_key", "duplicate_check", "explode_genres",
    "favourite_genre_per_user", "flags_to_array", "join_ratings_active_users",
    "join_ratings_movie_genres", "join_ratings_movies", "measured_bytes", "missing_values_profile",
    "profile_summary", "project_columns", "record_counts", "sized_broadcast", "top_n_movies", "user_genre_counts",
    "user_genre_counts_sorted", "users_by_occupation_and_age", "users_younger_than",
]

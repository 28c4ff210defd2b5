"""Composite jobs and plan inspection."""

from .inspect import count_operator, plan_text
from .jobs import (
    Store,
    favourite_genre_report,
    ingest_clean_store,
    profile_raw,
    ratings_report,
    user_filter_report,
    validate_store,
)
from .views import (
    average_rating_sql,
    favourite_genre_sql,
    register_movie_genres,
    register_views,
    top_movies_sql,
)

__all__ = [
    "average_rating_sql", "favourite_genre_sql", "register_movie_genres", "register_views",
    "top_movies_sql",
    "Store", "count_operator", "favourite_genre_report", "ingest_clean_store", "plan_text",
    "profile_raw", "ratings_report", "user_filter_report", "validate_store",
]

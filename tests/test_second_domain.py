"""The Task 3 operators on a second domain (FIXTURES.md): users' events, each
event an item with one category.  Checked against DuckDB on sf0.01."""

import duckdb
from pyspark.sql import functions as F

from ratewise import fixtures as fx
from ratewise.operators import active_users, favourite_genre_per_user, user_genre_counts
from tests.conftest import SF_MID

SQL = f"""
WITH e AS (SELECT user_id, event_id, event_type FROM read_parquet('{SF_MID}/events.parquet')),
active AS (SELECT user_id FROM e GROUP BY user_id HAVING COUNT(event_id) >= 50),
counts AS (SELECT user_id, event_type AS genre, COUNT(*) AS n FROM e
           WHERE user_id IN (SELECT user_id FROM active) GROUP BY user_id, event_type),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, genre) AS rk FROM counts)
SELECT user_id, genre, n FROM ranked WHERE rk = 1
"""


def test_favourite_category_on_events(spark):
    events = fx.table(spark, SF_MID, "events")
    acts = events.select(F.col("user_id"), F.col("event_id").alias("movie_id"))
    categories = events.select(F.col("event_id").alias("movie_id"), F.col("event_type").alias("genre"))
    active = active_users(acts, 50)
    assert active.count() == 149  # FIXTURES.md: 149 of 150 users have >= 50 events
    fav = favourite_genre_per_user(user_genre_counts(acts, categories, active))
    got = sorted(tuple(r) for r in fav.collect())
    want = sorted(duckdb.sql(SQL).fetchall())
    assert got == want and len(got) == 149

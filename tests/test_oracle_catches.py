"""Broken variants of operators must not match the oracles: the fixtures hold the
cases that tell them apart."""

import pytest
from pyspark.sql import functions as F

from ratewise import fixtures as fx
from ratewise import registry
from ratewise.operators import clean_ratings, dedup_by_key
from tests.conftest import SF_SMALL
from tools.check_oracle import digest, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def matches(con, name, df):
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(registry.ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    return digest(df.columns, rows) == digest(cols, cur.fetchall())


def users(spark):
    return fx.users(spark, SF_SMALL)


def ratings(spark):
    return fx.ratings(spark, SF_SMALL)


def movies(spark):
    return fx.movies(spark, SF_SMALL)


def valid_users(df):
    return df.where("user_id IS NOT NULL AND age > 0 AND age <= 100")


def joined(df):
    return registry.joined(df)


BROKEN = {
    "movies are not cleaned": ("clean_movies", lambda s: fx.movies_dirty(s, SF_SMALL)),
    "movies lose no null titles": ("clean_movies", lambda s: dedup_by_key(
        fx.movies_dirty(s, SF_SMALL).where("movie_title IS NOT NULL"), ["movie_id"])),
    "users are not deduplicated": ("clean_users", lambda s: valid_users(users(s))),
    "users are checked before the dedup": ("clean_users", lambda s: dedup_by_key(
        valid_users(users(s)), ["user_id"])),
    "ratings join keeps ratings without a movie": ("join_ratings_movies", lambda s: joined(
        ratings(s).join(movies(s), "movie_id", "left"))),
    "ratings join keeps movies without a rating": ("join_ratings_movies", lambda s: joined(
        ratings(s).join(movies(s), "movie_id", "right"))),
    "genre join keeps ratings without a movie": ("join_ratings_movie_genres", lambda s: ratings(s).join(
        movies(s).select("movie_id", "movie_title", F.explode("genres").alias("genre")), "movie_id", "left")),
    "explode keeps movies without a genre": ("explode_genres", lambda s: movies(s).select(
        "movie_id", "movie_title", F.explode_outer("genres").alias("genre"))),
    "missing genres stay null": ("read_documents_defaulted", lambda s: fx.movies_without_genres(s, SF_SMALL)
                                 .withColumn("genres", F.array_join("genres", "|"))),
    "the stream ignores its first arrival": ("incremental_ingest_ratings", lambda s: clean_ratings(
        ratings(s).where("movie_id % 2 = 0"))),
    "the stream ignores its second arrival": ("incremental_ingest_ratings", lambda s: clean_ratings(
        fx.ratings_dirty(s, SF_SMALL))),
    "null keys never match": ("upsert_null_keys", lambda s: dedup_by_key(
        fx.ratings_null_keys(s, SF_SMALL).where("rating >= 3"), ["user_id", "movie_id", "timestamp"]).unionByName(
        dedup_by_key(fx.ratings_null_keys(s, SF_SMALL).where("rating <= 3"), ["user_id", "movie_id", "timestamp"]).join(
            fx.ratings_null_keys(s, SF_SMALL).where("rating >= 3"), ["user_id", "movie_id", "timestamp"], "left_anti"))),
}


@pytest.mark.parametrize("what", BROKEN)
def test_the_oracle_catches(spark, con, what):
    name, broken = BROKEN[what]
    assert not matches(con, name, broken(spark)), what


def test_counts_that_differ_are_reported(con):
    rows = con.execute(registry.ORACLE["validate_stored_counts"]).fetchall()
    assert sorted(r[-1] for r in rows) == [False, False, True, True]
    assert any(r[1] == r[2] and r[3] is False for r in rows)  # only the checksum differs

"""Registered queries: one per operator/job of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the adapter views, plus the matching
DuckDB text (``ORACLE``).

Array results are flattened to ``|``-joined strings so both engines hash them
alike.  Queries that exercise a sink or a text source first write the derived
data below the session's checkpoint folder (a fresh path per call) and then
return the read-back DataFrame.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from . import oracle as o
from . import schemas
from .operators import (
    active_users,
    average_rating_per_movie,
    clean_movies,
    clean_ratings,
    clean_users,
    dedup_by_key,
    duplicate_check,
    explode_genres,
    favourite_genre_per_user,
    flags_to_array,
    join_ratings_active_users,
    join_ratings_movie_genres,
    join_ratings_movies,
    missing_values_profile,
    project_columns,
    record_counts,
    top_n_movies,
    user_genre_counts,
    user_genre_counts_sorted,
    users_by_occupation_and_age,
    users_younger_than,
)
from .plans.jobs import (
    Store,
    favourite_genre_report,
    ingest_clean_store,
    profile_raw,
    ratings_report,
    user_filter_report,
    validate_store,
    write_together,
)
from .plans.views import average_rating_sql, favourite_genre_sql, register_views, top_movies_sql
from .session import scratch_path
from .streaming import compact_ratings, read_keyed_ratings, start_ratings_ingest
from .sinks import (
    conform,
    create_result_tables,
    load_documents_overwrite,
    load_table_overwrite,
    rows_of_key,
    table_folders,
    upsert_by_key,
    write_clustered_by_key,
    write_keyed_table,
)
from .sources import (
    first_rows,
    parse_item_genres,
    parse_item_wide,
    parse_pipe_users,
    parse_ws_ratings,
    read_documents_defaulted,
    read_table_projected,
    rejected_lines,
    scan_text_lines,
    select_all_limit,
    write_text_lines,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def joined(df: DataFrame, column: str = "genres", sep: str = "|") -> DataFrame:
    """Replace an array column by its ``sep``-joined string (same name)."""
    return df.withColumn(column, F.array_join(column, sep))


MOVIE_DOC_COLS = "movie_id, movie_title, release_date, video_release_date, imdb_url"
MOVIES_JOINED = (f"SELECT {MOVIE_DOC_COLS}, array_to_string(genres, '|') AS genres FROM movies")
USER_COLS = "user_id, age, gender, occupation, zip_code"
RATING_COLS = 'user_id, movie_id, rating, "timestamp"'
W = o.with_

# --- shared building blocks ---------------------------------------------------


def _average(spark: SparkSession, sf: str) -> DataFrame:
    return average_rating_per_movie(fx.ratings(spark, sf), fx.movies(spark, sf))


def _genre_counts(spark: SparkSession, sf: str) -> DataFrame:
    r = fx.ratings(spark, sf)
    return user_genre_counts(r, explode_genres(fx.movies(spark, sf)), active_users(r, 50))


def _stage_lines(spark: SparkSession, sf: str) -> dict[str, str]:
    """Render the fixture views as raw text files; returns their paths."""
    root = scratch_path(spark, "lines")
    paths = write_together(
        lambda: write_text_lines(fx.user_lines(spark, sf), f"{root}/user_lines"),
        lambda: write_text_lines(fx.rating_lines(spark, sf), f"{root}/rating_lines"),
        lambda: write_text_lines(fx.item_lines(spark, sf), f"{root}/item_lines"))
    return dict(zip(("users", "ratings", "items"), paths))


def _stage_store(spark: SparkSession, sf: str) -> Store:
    """A store holding the fixture base tables (users cleaned, as stored)."""
    store = Store(scratch_path(spark, "store"))
    entries = write_together(lambda: store.stage_segments(clean_users(fx.users(spark, sf)), "users"),
                             lambda: store.stage(fx.ratings(spark, sf), "ratings"),
                             lambda: store.stage_movies(fx.movies(spark, sf)))
    store.commit(spark, dict(zip(("users", "ratings", "movies"), entries)))
    return store


# --- S: sources ---------------------------------------------------------------

@register("scan_text_lines",
          W(o.USERS, o.RATINGS, o.movies_wide())
          + o.lines_users() + " UNION ALL " + o.lines_ratings() + " UNION ALL " + o.lines_items())
def q_scan_text_lines(spark, sf):
    paths = _stage_lines(spark, sf)
    return scan_text_lines(spark, [paths["users"], paths["ratings"], paths["items"]])


@register("parse_pipe_users", W(o.USERS) + f"SELECT {USER_COLS} FROM users")
def q_parse_pipe_users(spark, sf):
    path = write_text_lines(fx.user_lines(spark, sf), scratch_path(spark, "user_lines"))
    return parse_pipe_users(scan_text_lines(spark, path))


@register("parse_ws_ratings", W(o.RATINGS) + f"SELECT {RATING_COLS} FROM ratings")
def q_parse_ws_ratings(spark, sf):
    path = write_text_lines(fx.rating_lines(spark, sf), scratch_path(spark, "rating_lines"))
    return parse_ws_ratings(scan_text_lines(spark, path))


MIXED = """lines AS (
  SELECT user_id, rating,
         concat_ws(chr(9), CAST(user_id AS VARCHAR), CAST(movie_id AS VARCHAR), CAST(rating AS VARCHAR),
           CASE WHEN user_id % 3 = 0 AND rating = 2 THEN 'x' || CAST("timestamp" AS VARCHAR)
                WHEN user_id % 5 = 0 AND rating = 4 THEN NULL
                ELSE CAST("timestamp" AS VARCHAR) END) AS value,
         (user_id % 3 = 0 AND rating = 2) OR (user_id % 5 = 0 AND rating = 4) AS rejected
  FROM ratings)"""


@register("reject_bad_lines",
          W(o.RATINGS, MIXED)
          + """SELECT value, rejected, CASE WHEN rejected THEN 'monday' ELSE '' END AS arrival FROM lines
               UNION ALL SELECT value, true, 'tuesday' FROM lines WHERE user_id % 6 = 0 AND rating = 2""")
def q_reject_bad_lines(spark, sf):
    """Two arrivals; the second repeats some bad lines of the first.  Readable lines, parsed
    and rendered again, and the rejects as they stood, each with the folder of its file."""
    root = scratch_path(spark, "rating_lines")
    write_together(
        lambda: write_text_lines(fx.rating_lines_mixed(spark, sf), f"{root}/monday"),
        lambda: write_text_lines(fx.rating_lines_mixed(spark, sf, again=True), f"{root}/tuesday"))
    lines = scan_text_lines(spark, [f"{root}/monday", f"{root}/tuesday"], origin=True)
    good = parse_ws_ratings(lines, lenient=True)
    rendered = good.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in good.columns]).alias("value"),
                           F.lit(False).alias("rejected"), F.lit("").alias("arrival"))
    bad = rejected_lines(lines, "ratings")
    return rendered.unionByName(bad.select(
        "value", F.lit(True).alias("rejected"),
        F.regexp_extract("file", "([^/]+)/[^/]+$", 1).alias("arrival")))


@register("parse_item_wide", W(o.movies_wide()) + "SELECT * FROM movies_wide")
def q_parse_item_wide(spark, sf):
    path = write_text_lines(fx.item_lines(spark, sf), scratch_path(spark, "item_lines"))
    return parse_item_wide(scan_text_lines(spark, path), fx.FIXTURE_GENRES)


@register("parse_item_genres", W(o.movies()) + MOVIES_JOINED)
def q_parse_item_genres(spark, sf):
    path = write_text_lines(fx.item_lines(spark, sf), scratch_path(spark, "item_lines"))
    return joined(parse_item_genres(scan_text_lines(spark, path), fx.FIXTURE_GENRES))


@register("read_table_projected",
          W(o.RATINGS) + "SELECT movie_id, rating FROM ratings")
def q_read_table_projected(spark, sf):
    path = load_table_overwrite(fx.ratings(spark, sf), scratch_path(spark, "ratings"),
                                schemas.RATINGS)
    return read_table_projected(spark, path, ["movie_id", "rating"])


@register("read_documents_defaulted",
          W(o.movies()) + MOVIES_JOINED.replace(
              "array_to_string(genres, '|')",
              "CASE WHEN movie_id % 5 = 0 THEN '' ELSE array_to_string(genres, '|') END"))
def q_read_documents_defaulted(spark, sf):
    """Documents of which every fifth has no ``genres`` field."""
    path = load_documents_overwrite(fx.movies_without_genres(spark, sf), scratch_path(spark, "movies"))
    return joined(read_documents_defaulted(spark, path))


@register("select_all_limit",
          W(o.USERS, o.CLEAN_USERS)
          + f"SELECT {USER_COLS} FROM clean_users ORDER BY user_id LIMIT 5")
def q_select_all_limit(spark, sf):
    path = load_table_overwrite(clean_users(fx.users(spark, sf)), scratch_path(spark, "users"),
                                schemas.USERS)
    return select_all_limit(read_table_projected(spark, path), 5, ["user_id"])


# --- Q: quality and cleaning ----------------------------------------------------

PROFILE_COLS = [("o_orderkey", False), ("o_custkey", False), ("o_orderstatus", True),
                ("o_orderpriority", True), ("o_totalprice", False)]


@register("missing_values_profile",
          W(o.PROFILE_INPUT) + "SELECT " + ", ".join(
              f"CAST(SUM(CASE WHEN {c} IS NULL" + (f" OR trim({c}) = ''" if s else "")
              + f" THEN 1 ELSE 0 END) AS BIGINT) AS {c}" for c, s in PROFILE_COLS)
          + " FROM profile_input")
def q_missing_values_profile(spark, sf):
    return missing_values_profile(fx.profile_input(spark, sf))


@register("duplicate_check",
          W(o.RATINGS_DIRTY)
          + ", distinct_rows AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT * FROM ratings_dirty) x)\n"
          + "SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, "
          + "CAST((SELECT n FROM distinct_rows) AS BIGINT) AS distinct_rows, "
          + "CAST(COUNT(*) - (SELECT n FROM distinct_rows) AS BIGINT) AS duplicate_rows "
          + "FROM ratings_dirty")
def q_duplicate_check(spark, sf):
    return duplicate_check(fx.ratings_dirty(spark, sf))


@register("record_counts",
          W(o.USERS, o.CLEAN_USERS, o.RATINGS_DIRTY, o.CLEAN_RATINGS, o.movies_wide(), o.MOVIES_DIRTY)
          + " UNION ALL ".join(
              f"SELECT '{n}' AS dataset, CAST(COUNT(*) AS BIGINT) AS row_count FROM {t}"
              for n, t in (("users_raw", "users"), ("users_clean", "clean_users"),
                           ("ratings_raw", "ratings_dirty"), ("ratings_clean", "clean_ratings"),
                           ("movies_raw", "movies_dirty"), ("movies_clean", "clean_movies"))))
def q_record_counts(spark, sf):
    users, ratings, movies = fx.users(spark, sf), fx.ratings_dirty(spark, sf), fx.movies_dirty(spark, sf)
    return record_counts({
        "users_raw": users, "users_clean": clean_users(users),
        "ratings_raw": ratings, "ratings_clean": clean_ratings(ratings),
        "movies_raw": movies, "movies_clean": clean_movies(movies)})


@register("dedup_by_key",
          W(o.RATINGS_DIRTY) + f"""SELECT {RATING_COLS} FROM (
              SELECT *, row_number() OVER (PARTITION BY user_id, movie_id, "timestamp"
                                          ORDER BY rating ASC NULLS FIRST) AS rn
              FROM ratings_dirty) d WHERE rn = 1""")
def q_dedup_by_key(spark, sf):
    return dedup_by_key(fx.ratings_dirty(spark, sf), schemas.KEYS["ratings"])


@register("clean_users", W(o.USERS, o.CLEAN_USERS) + "SELECT * FROM clean_users")
def q_clean_users(spark, sf):
    return clean_users(fx.users(spark, sf))


@register("clean_ratings", W(o.RATINGS_DIRTY, o.CLEAN_RATINGS) + "SELECT * FROM clean_ratings")
def q_clean_ratings(spark, sf):
    return clean_ratings(fx.ratings_dirty(spark, sf))


@register("clean_movies", W(o.movies_wide(), o.MOVIES_DIRTY) + "SELECT * FROM clean_movies")
def q_clean_movies(spark, sf):
    return clean_movies(fx.movies_dirty(spark, sf))


# --- P: projections and filters -------------------------------------------------

@register("project_columns", W(o.movies_wide()) + "SELECT movie_id, movie_title, imdb_url FROM movies_wide")
def q_project_columns(spark, sf):
    return project_columns(fx.movies_wide(spark, sf), ["movie_id", "movie_title", "imdb_url"])


@register("users_younger_than", W(o.USERS, o.CLEAN_USERS, o.YOUNG) + "SELECT * FROM young_users")
def q_users_younger_than(spark, sf):
    return users_younger_than(clean_users(fx.users(spark, sf)), 20)


@register("users_by_occupation_and_age",
          W(o.USERS, o.CLEAN_USERS, o.SCIENTIST) + "SELECT * FROM scientist_users")
def q_users_by_occupation_and_age(spark, sf):
    return users_by_occupation_and_age(clean_users(fx.users(spark, sf)),
                                       fx.FIXTURE_OCCUPATION, 30, 40)


# --- J: joins --------------------------------------------------------------------

@register("join_ratings_movies",
          W(o.RATINGS, o.movies())
          + f"""SELECT r.movie_id, r.user_id, r.rating, r."timestamp", m.movie_title,
                       m.release_date, m.video_release_date, m.imdb_url,
                       array_to_string(m.genres, '|') AS genres
                FROM ratings r JOIN movies m ON r.movie_id = m.movie_id""")
def q_join_ratings_movies(spark, sf):
    return joined(join_ratings_movies(fx.ratings(spark, sf), fx.movies(spark, sf)))


@register("join_ratings_active_users",
          W(o.RATINGS, o.ACTIVE)
          + f"SELECT {RATING_COLS} FROM ratings WHERE user_id IN (SELECT user_id FROM active_users)")
def q_join_ratings_active_users(spark, sf):
    r = fx.ratings(spark, sf)
    return join_ratings_active_users(r, active_users(r, 50))


@register("join_ratings_movie_genres",
          W(o.RATINGS, o.movies(), o.MOVIE_GENRES)
          + """SELECT r.movie_id, r.user_id, r.rating, r."timestamp", g.movie_title, g.genre
               FROM ratings r JOIN movie_genres g ON r.movie_id = g.movie_id""")
def q_join_ratings_movie_genres(spark, sf):
    return join_ratings_movie_genres(fx.ratings(spark, sf), explode_genres(fx.movies(spark, sf)))


# --- A / W / L: analytics (Tasks 1-3) ---------------------------------------------

@register("average_rating_per_movie",
          W(o.RATINGS, o.movies(), o.AVERAGE) + "SELECT * FROM average_movie_ratings")
def q_average_rating_per_movie(spark, sf):
    return _average(spark, sf)


@register("top_n_movies", W(o.RATINGS, o.movies(), o.AVERAGE, o.TOP10) + "SELECT * FROM top_10_movies")
def q_top_n_movies(spark, sf):
    return top_n_movies(_average(spark, sf), 10)


@register("active_users", W(o.RATINGS, o.ACTIVE) + "SELECT * FROM active_users")
def q_active_users(spark, sf):
    return active_users(fx.ratings(spark, sf), 50)


@register("user_genre_counts",
          W(o.RATINGS, o.movies(), o.MOVIE_GENRES, o.ACTIVE, o.GENRE_COUNTS)
          + "SELECT * FROM user_genre_counts")
def q_user_genre_counts(spark, sf):
    return _genre_counts(spark, sf)


@register("user_genre_counts_sorted",
          W(o.RATINGS, o.movies(), o.MOVIE_GENRES, o.ACTIVE, o.GENRE_COUNTS)
          + """SELECT * FROM user_genre_counts
               ORDER BY user_id ASC, genre_rating_count DESC, genre ASC LIMIT 30""")
def q_user_genre_counts_sorted(spark, sf):
    return user_genre_counts_sorted(_genre_counts(spark, sf), 30)


@register("favourite_genre_per_user",
          W(o.RATINGS, o.movies(), o.MOVIE_GENRES, o.ACTIVE, o.GENRE_COUNTS, o.FAVOURITE)
          + "SELECT * FROM user_favourite_genres")
def q_favourite_genre_per_user(spark, sf):
    return favourite_genre_per_user(_genre_counts(spark, sf))


# --- K6: the same tasks as Spark SQL over session views ------------------------------

def _views(spark: SparkSession, sf: str) -> None:
    register_views({"ratings": fx.ratings(spark, sf), "movies": fx.movies(spark, sf)})


@register("average_rating_per_movie_sql",
          W(o.RATINGS, o.movies(), o.AVERAGE) + "SELECT * FROM average_movie_ratings")
def q_average_rating_per_movie_sql(spark, sf):
    _views(spark, sf)
    return average_rating_sql(spark)


@register("top_n_movies_sql",
          W(o.RATINGS, o.movies(), o.AVERAGE, o.TOP10) + "SELECT * FROM top_10_movies")
def q_top_n_movies_sql(spark, sf):
    _views(spark, sf)
    register_views({"average_movie_ratings": average_rating_sql(spark)})
    return top_movies_sql(spark, 10)


@register("favourite_genre_per_user_sql",
          W(o.RATINGS, o.movies(), o.MOVIE_GENRES, o.ACTIVE, o.GENRE_COUNTS, o.FAVOURITE)
          + "SELECT * FROM user_favourite_genres")
def q_favourite_genre_per_user_sql(spark, sf):
    _views(spark, sf)
    return favourite_genre_sql(spark, 50)


# --- R: reshape --------------------------------------------------------------------

@register("flags_to_array", W(o.movies()) + MOVIES_JOINED)
def q_flags_to_array(spark, sf):
    return joined(flags_to_array(fx.movies_wide(spark, sf), fx.FIXTURE_GENRES))


@register("explode_genres", W(o.movies(), o.MOVIE_GENRES) + "SELECT * FROM movie_genres")
def q_explode_genres(spark, sf):
    return explode_genres(fx.movies(spark, sf))


# --- K: sinks ------------------------------------------------------------------------

@register("load_table_overwrite", W(o.USERS, o.CLEAN_USERS) + "SELECT * FROM clean_users")
def q_load_table_overwrite(spark, sf):
    path = scratch_path(spark, "users")
    # Overwrite twice: the second load must fully replace the first.
    load_table_overwrite(fx.users(spark, sf), path, schemas.USERS)
    load_table_overwrite(clean_users(fx.users(spark, sf)), path, schemas.USERS)
    return read_table_projected(spark, path)


UPSERT_UPDATES = """updates AS (
  SELECT user_id, movie_id, rating, "timestamp" FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, movie_id, "timestamp"
                                 ORDER BY rating ASC NULLS FIRST) AS rn
    FROM ratings WHERE rating = 5) d WHERE rn = 1)"""


@register("upsert_by_key",
          W(o.RATINGS, o.RATINGS_DIRTY, o.CLEAN_RATINGS, UPSERT_UPDATES)
          + f"""SELECT {RATING_COLS} FROM clean_ratings c WHERE NOT EXISTS (
                  SELECT 1 FROM updates u WHERE u.user_id = c.user_id
                    AND u.movie_id = c.movie_id AND u."timestamp" = c."timestamp")
                UNION ALL SELECT {RATING_COLS} FROM updates""")
def q_upsert_by_key(spark, sf):
    """Stored in hash partitions: the cleaned dirty ratings.  Update batch: every five-star
    rating of the clean ratings, replacing equal keys and adding new ones, in place."""
    keys = schemas.KEYS["ratings"]
    path = write_keyed_table(clean_ratings(fx.ratings_dirty(spark, sf)), scratch_path(spark, "ratings"),
                             keys, parts=16, schema=schemas.RATINGS)
    upsert_by_key(spark, path, fx.ratings(spark, sf).filter(F.col("rating") == 5), keys)
    return read_table_projected(spark, path)


@register("upsert_other_table",
          W(o.RATINGS, o.RATINGS_DIRTY, o.CLEAN_RATINGS, UPSERT_UPDATES)
          + f"""SELECT {RATING_COLS} FROM clean_ratings c WHERE NOT EXISTS (
                  SELECT 1 FROM updates u WHERE u.user_id = c.user_id
                    AND u.movie_id = c.movie_id AND u."timestamp" = c."timestamp")
                UNION ALL SELECT {RATING_COLS} FROM updates""")
def q_upsert_other_table(spark, sf):
    """The same merge of a table without partitions, into a second table."""
    current = load_table_overwrite(clean_ratings(fx.ratings_dirty(spark, sf)),
                                   scratch_path(spark, "ratings"), schemas.RATINGS)
    updates = fx.ratings(spark, sf).filter(F.col("rating") == 5)
    merged = upsert_by_key(spark, current, updates, schemas.KEYS["ratings"],
                           scratch_path(spark, "ratings"), schema=schemas.RATINGS)
    return read_table_projected(spark, merged)


@register("load_documents_overwrite", W(o.movies()) + MOVIES_JOINED)
def q_load_documents_overwrite(spark, sf):
    path = load_documents_overwrite(fx.movies(spark, sf), scratch_path(spark, "movies"))
    (folder,) = table_folders(spark, path)
    return joined(spark.read.schema(schemas.MOVIES).json(folder))


@register("write_clustered_by_key", W(o.RATINGS) + f"SELECT {RATING_COLS} FROM ratings")
def q_write_clustered_by_key(spark, sf):
    """The files of the bucketed table; its catalog entry goes again."""
    name, path = f"ratewise_ratings_{uuid.uuid4().hex[:10]}", scratch_path(spark, "ratings_bucketed")
    write_clustered_by_key(conform(fx.ratings(spark, sf), schemas.RATINGS), name, path, buckets=8)
    spark.sql(f"DROP TABLE {name}")
    return read_table_projected(spark, path, schema=schemas.RATINGS)


NULL_KEYS = """null_keys AS (
  SELECT user_id, CASE WHEN movie_id % 10 <> 0 THEN movie_id END AS movie_id, rating, "timestamp"
  FROM ratings),
batch AS (
  SELECT user_id, movie_id, min(rating) AS rating, "timestamp" FROM null_keys
  WHERE rating >= 3 GROUP BY ALL),
base AS (
  SELECT user_id, movie_id, min(rating) AS rating, "timestamp" FROM null_keys
  WHERE rating <= 3 GROUP BY ALL)"""


@register("upsert_null_keys",
          W(o.RATINGS, NULL_KEYS)
          + f"""SELECT {RATING_COLS} FROM batch UNION ALL
                SELECT {RATING_COLS} FROM base b WHERE NOT EXISTS (
                  SELECT 1 FROM batch n WHERE n.user_id = b.user_id AND n."timestamp" = b."timestamp"
                    AND n.movie_id IS NOT DISTINCT FROM b.movie_id)""")
def q_upsert_null_keys(spark, sf):
    """The same batch twice, into the table itself; NULL movies are equal keys."""
    rows = fx.ratings_null_keys(spark, sf)
    keys = schemas.KEYS["ratings"]
    path = write_keyed_table(dedup_by_key(rows.where("rating <= 3"), keys), scratch_path(spark, "ratings"),
                             keys, parts=8, by=["movie_id"], schema=schemas.RATINGS)
    for _ in range(2):
        upsert_by_key(spark, path, rows.where("rating >= 3"), keys)
    return read_table_projected(spark, path)


ONE_USER = f"SELECT {RATING_COLS} FROM ratings WHERE user_id = (SELECT max(user_id) FROM ratings)"


@register("rows_of_key", W(o.RATINGS, "batch AS (" + ONE_USER + ")") + f"""
          SELECT user_id, movie_id, min(rating) AS rating, "timestamp" FROM batch GROUP BY ALL""")
def q_rows_of_key(spark, sf):
    """A user's ratings from a table in hash partitions of users."""
    rows = fx.ratings(spark, sf)
    path = write_keyed_table(dedup_by_key(rows, schemas.KEYS["ratings"]), scratch_path(spark, "ratings"),
                             schemas.KEYS["ratings"], parts=16, by=["user_id"], schema=schemas.RATINGS)
    return rows_of_key(spark, path, user_id=rows.agg(F.max("user_id")).first()[0])


def _clustered_store(spark: SparkSession, sf: str) -> Store:
    """Ratings bucketed by user, hot users apart, registered in the catalog."""
    store = Store(scratch_path(spark, "store"), table_prefix=f"ratewise_{uuid.uuid4().hex[:8]}_")
    write_clustered_by_key(conform(fx.ratings(spark, sf), schemas.RATINGS), f"{store.table_prefix}ratings",
                           store.path("ratings"), buckets=8, split_hot=True)
    return store


@register("user_ratings_lookup",
          W(o.RATINGS) + ONE_USER.replace("WHERE", "WHERE movie_id BETWEEN 100 AND 1500 AND"))
def q_user_ratings_lookup(spark, sf):
    """A user's ratings of a range of movies, from one bucket of the clustered table."""
    store = _clustered_store(spark, sf)
    user = store.read(spark, "ratings", ["user_id"]).agg(F.max("user_id")).first()[0]
    out = store.ratings_of_user(spark, user, 100, 1500)
    out.schema  # planned through the catalog, whose entry may go now: it is external
    spark.sql(f"DROP TABLE {store.table_prefix}ratings")
    return out


@register("active_users_clustered", W(o.RATINGS, o.ACTIVE) + "SELECT * FROM active_users")
def q_active_users_clustered(spark, sf):
    """Active users from the clustered table: the buckets without an exchange, the users
    stored apart as partial counts."""
    store = _clustered_store(spark, sf)
    out = store.per_key(spark, "ratings", ["user_id", "movie_id"], lambda r: active_users(r, 50))
    out.schema
    spark.sql(f"DROP TABLE {store.table_prefix}ratings")
    return out


@register("first_rows_by_range",
          W(o.USERS, o.CLEAN_USERS)
          + f"SELECT {USER_COLS} FROM clean_users ORDER BY occupation, age, user_id LIMIT 20")
def q_first_rows_by_range(spark, sf):
    """The first rows of the users in segment order, from the first files of the table."""
    store = Store(scratch_path(spark, "store"))
    store.commit(spark, {"users": store.stage_segments(clean_users(fx.users(spark, sf)), "users")})
    return first_rows(spark, store.path("users"), 20, schema=schemas.USERS)


@register("create_result_tables",
          W(o.USERS) + " UNION ALL ".join(
              f"SELECT '{n}' AS dataset, CAST(COUNT(*) AS BIGINT) AS row_count FROM users WHERE false"
              for n in schemas.TABLES))
def q_create_result_tables(spark, sf):
    """Create over old rows: every table is there and empty."""
    root, prefix = scratch_path(spark, "created"), f"ratewise_{uuid.uuid4().hex[:8]}_"
    load_table_overwrite(fx.users(spark, sf), f"{root}/users", schemas.USERS)
    for name in create_result_tables(spark, root, prefix=prefix):
        spark.sql(f"DROP TABLE {name}")  # external: the files are what is counted
    return record_counts({n: read_table_projected(spark, f"{root}/{n}", schema=t)
                          for n, t in schemas.TABLES.items()})


@register("validate_stored_counts",
          W(o.USERS, o.CLEAN_USERS, o.YOUNG, o.RATINGS_DIRTY, o.CLEAN_RATINGS, o.movies_wide(),
            o.MOVIES_DIRTY)
          + " UNION ALL ".join(
              f"""SELECT '{n}' AS table_name, CAST(e.n AS BIGINT) AS expected_rows,
                         CAST(a.n AS BIGINT) AS actual_rows, {same} AS checksum_ok, {same} AS ok
                  FROM (SELECT COUNT(*) AS n FROM {exp}) e, (SELECT COUNT(*) AS n FROM {act}) a"""
              for n, exp, act, same in (
                  ("users", "clean_users", "clean_users", "true"),
                  ("ratings", "ratings_dirty", "clean_ratings", "false"),
                  ("movies", "clean_movies", "clean_movies", "true"),
                  ("young_users", "young_users", "young_users",
                   "(SELECT count(*) = 0 FROM young_users WHERE age + 1 <> age)"))))
def q_validate_stored_counts(spark, sf):
    """Users and movies as stored; the ratings are held against the uncleaned
    rows, which they must not match, and the young users against as many rows with
    other ages, which only the checksum tells."""
    store = Store(scratch_path(spark, "store"))
    users, ratings = clean_users(fx.users(spark, sf)), fx.ratings_dirty(spark, sf)
    movies = flags_to_array(clean_movies(fx.movies_dirty(spark, sf)), fx.FIXTURE_GENRES)
    young = users_younger_than(users, 20)
    write_together(lambda: store.write(users, "users"),
                   lambda: store.write(young, "young_users"),
                   lambda: store.write(clean_ratings(ratings), "ratings"),
                   lambda: store.write_movies(movies))
    return validate_store(spark, store, {"users": users, "ratings": ratings, "movies": movies,
                                         "young_users": young.withColumn("age", F.col("age") + 1)})


# --- streaming: the incremental ratings load ------------------------------------------

@register("incremental_ingest_ratings",
          W(o.RATINGS, o.RATINGS_DIRTY, o.CLEAN_RATINGS)
          + f"""SELECT user_id, movie_id, min(rating) AS rating, "timestamp" FROM ratings
                WHERE movie_id % 2 = 0 GROUP BY user_id, movie_id, "timestamp"
                UNION ALL SELECT {RATING_COLS} FROM clean_ratings WHERE movie_id % 2 <> 0""")
def q_incremental_ingest_ratings(spark, sf):
    """Two arrivals through the stream: the dirty rating lines, then clean ones
    for the movies with even ids, which win their keys; then the batches are
    compacted."""
    src, table, ckpt = (scratch_path(spark, n) for n in ("incoming", "ratings", "ckpt"))
    write_text_lines(fx.rating_lines(spark, sf, dirty=True), f"{src}/arrival-1")
    start_ratings_ingest(spark, src, table, ckpt).awaitTermination()
    even = F.split("value", "\t")[1].cast("bigint") % 2 == 0
    write_text_lines(fx.rating_lines(spark, sf).where(even), f"{src}/arrival-2")
    start_ratings_ingest(spark, src, table, ckpt).awaitTermination()
    compact_ratings(spark, table)
    return read_keyed_ratings(spark, table)


# --- C: composite jobs ---------------------------------------------------------------

@register("ingest_clean_store",
          W(o.USERS, o.CLEAN_USERS, o.RATINGS_DIRTY, o.CLEAN_RATINGS, o.movies_wide())
          + " UNION ALL ".join(
              f"""SELECT '{n}' AS table_name, CAST(r.n AS BIGINT) AS raw_rows, CAST(c.n AS BIGINT) AS expected_rows,
                         CAST(c.n AS BIGINT) AS actual_rows, true AS checksum_ok, true AS ok
                  FROM (SELECT COUNT(*) AS n FROM {raw}) r, (SELECT COUNT(*) AS n FROM {clean}) c"""
              for n, raw, clean in (("users", "users", "clean_users"),
                                    ("ratings", "ratings_dirty", "clean_ratings"),
                                    ("movies", "movies_wide", "movies_wide"))))
def q_ingest_clean_store(spark, sf):
    root = scratch_path(spark, "raw")
    users, ratings, items = write_together(
        lambda: write_text_lines(fx.user_lines(spark, sf), f"{root}/user_lines"),
        lambda: write_text_lines(fx.rating_lines(spark, sf, dirty=True), f"{root}/rating_lines"),
        lambda: write_text_lines(fx.item_lines(spark, sf), f"{root}/item_lines"))
    return ingest_clean_store(spark, users, ratings, items, Store(scratch_path(spark, "store")),
                              fx.FIXTURE_GENRES)


@register("ratings_report",
          W(o.RATINGS, o.movies(), o.AVERAGE, o.TOP10) + "SELECT * FROM top_10_movies")
def q_ratings_report(spark, sf):
    """Runs Tasks 1+2 against a store; returns the stored top-10 table."""
    store = _stage_store(spark, sf)
    ratings_report(spark, store, 10)  # writes both results; the report stays lazy
    return store.read(spark, "top_10_movies")


@register("favourite_genre_report",
          W(o.RATINGS, o.movies(), o.MOVIE_GENRES, o.ACTIVE, o.GENRE_COUNTS, o.FAVOURITE)
          + "SELECT * FROM user_favourite_genres")
def q_favourite_genre_report(spark, sf):
    store = _stage_store(spark, sf)
    favourite_genre_report(spark, store, 50)
    return store.read(spark, "user_favourite_genres")


@register("user_filter_report",
          W(o.USERS, o.CLEAN_USERS, o.YOUNG, o.SCIENTIST)
          + f"SELECT 'young_users' AS segment, {USER_COLS} FROM young_users UNION ALL "
          + f"SELECT 'scientist_users' AS segment, {USER_COLS} FROM scientist_users")
def q_user_filter_report(spark, sf):
    store = _stage_store(spark, sf)
    user_filter_report(spark, store, 20, fx.FIXTURE_OCCUPATION, 30, 40)
    return (store.read(spark, "young_users").select(F.lit("young_users").alias("segment"), "*")
            .unionByName(store.read(spark, "scientist_users")
                         .select(F.lit("scientist_users").alias("segment"), "*")))


_PROFILE_SETS = {
    "users": ("users", [("user_id", False), ("age", False), ("gender", True),
                        ("occupation", True), ("zip_code", True)]),
    "ratings": ("ratings_dirty", [("user_id", False), ("movie_id", False), ("rating", False),
                                  ("timestamp", False)]),
    "movies": ("movies_wide", [("movie_id", False), ("movie_title", True),
                               ("release_date", True), ("video_release_date", True),
                               ("imdb_url", True)] + [(g, False) for g in fx.FIXTURE_GENRES]),
    "orders": ("profile_input", PROFILE_COLS),
    "documents": ("documents", [("text", True)]),
}


@register("profile_raw",
          W(o.USERS, o.RATINGS_DIRTY, o.movies_wide(), o.PROFILE_INPUT)
          + "\nUNION ALL\n".join(o.profile(name, src, cols)
                                 for name, (src, cols) in _PROFILE_SETS.items()))
def q_profile_raw(spark, sf):
    return profile_raw({
        "users": fx.users(spark, sf),
        "ratings": fx.ratings_dirty(spark, sf),
        "movies": fx.movies_wide(spark, sf),
        "orders": fx.profile_input(spark, sf),
        "documents": fx.document_texts(spark, sf),
    })

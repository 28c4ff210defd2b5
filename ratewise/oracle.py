"""DuckDB text of the adapter views and of every registered query.

Independent of the Spark code: each query here is written from the operator's
specification, over the driver's tables (pre-registered as views), and is what
the Spark result is compared with.  Conventions that keep the engines equal:
integer sums are cast to BIGINT, array results are joined to strings, NULL
ordering is spelled out, and averages are rounded half-up with exact integer
arithmetic (DuckDB's ROUND on a double can land on the other side of a half).
"""

from __future__ import annotations

from collections.abc import Sequence

from .fixtures import FIXTURE_GENRES, FIXTURE_OCCUPATION, FIXTURE_RELEASE_DATE, FIXTURE_URL_PREFIX


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


USERS = """users AS (
  SELECT CAST(c_custkey AS BIGINT) AS user_id,
         CAST(floor(c_acctbal / 100) - 30 * k AS INTEGER) AS age,
         CASE WHEN k = 1 THEN 'X' WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         lower(c_mktsegment) AS occupation,
         lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS zip_code
  FROM customer JOIN (VALUES (0), (1)) c(k) ON k = 0 OR c_custkey % 10 = 0)"""

RATINGS = """ratings AS (
  SELECT CAST(o.o_custkey AS BIGINT) AS user_id,
         CAST(CASE WHEN l.l_partkey % 13 = 0 THEN -l.l_partkey ELSE l.l_partkey END AS BIGINT) AS movie_id,
         CAST(ceil(l.l_quantity / 10) AS INTEGER) AS rating,
         CAST(epoch(l.l_shipdate) AS BIGINT) AS "timestamp"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

RATINGS_DIRTY = """ratings_base AS (
  SELECT CAST(o.o_custkey AS BIGINT) AS user_id,
         CAST(CASE WHEN l.l_partkey % 13 = 0 THEN -l.l_partkey ELSE l.l_partkey END AS BIGINT) AS movie_id,
         CAST(CAST(l.l_quantity AS INTEGER) % 7 AS INTEGER) AS rating,
         CAST(epoch(l.l_shipdate) AS BIGINT) AS "timestamp",
         l.l_linenumber
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
ratings_dirty AS (
  SELECT user_id, movie_id, rating, "timestamp" FROM ratings_base
  UNION ALL
  SELECT user_id, movie_id, rating, "timestamp" FROM ratings_base WHERE l_linenumber = 1)"""


def _word_test(word: str) -> str:
    return f"list_contains(string_split(p_name, ' '), {_q(word)})"


def movies_wide(vocabulary: Sequence[str] = FIXTURE_GENRES) -> str:
    flags = ",\n         ".join(
        f"CAST({_word_test(w)} AS INTEGER) AS {w}" for w in vocabulary)
    return f"""movies_wide AS (
  SELECT CAST(CASE WHEN p_partkey % 11 = 0 THEN -p_partkey ELSE p_partkey END AS BIGINT) AS movie_id,
         p_name AS movie_title,
         {_q(FIXTURE_RELEASE_DATE)} AS release_date,
         '' AS video_release_date,
         {_q(FIXTURE_URL_PREFIX)} || CAST(p_partkey AS VARCHAR) AS imdb_url,
         {flags}
  FROM part)"""


def movies(vocabulary: Sequence[str] = FIXTURE_GENRES) -> str:
    cases = ", ".join(f"CASE WHEN {_word_test(w)} THEN {_q(w)} END" for w in vocabulary)
    return f"""movies AS (
  SELECT CAST(CASE WHEN p_partkey % 11 = 0 THEN -p_partkey ELSE p_partkey END AS BIGINT) AS movie_id,
         p_name AS movie_title,
         {_q(FIXTURE_RELEASE_DATE)} AS release_date,
         '' AS video_release_date,
         {_q(FIXTURE_URL_PREFIX)} || CAST(p_partkey AS VARCHAR) AS imdb_url,
         list_filter([{cases}], lambda x: x IS NOT NULL) AS genres
  FROM part)"""


MOVIE_GENRES = """movie_genres AS (
  SELECT movie_id, movie_title, unnest(genres) AS genre FROM movies)"""

CLEAN_USERS = """clean_users AS (
  SELECT user_id, age, gender, occupation, zip_code FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id
        ORDER BY age ASC NULLS FIRST, gender ASC NULLS FIRST,
                 occupation ASC NULLS FIRST, zip_code ASC NULLS FIRST) AS rn
    FROM users) d
  WHERE rn = 1 AND user_id IS NOT NULL AND age > 0 AND age <= 100)"""

CLEAN_RATINGS = """clean_ratings AS (
  SELECT user_id, movie_id, rating, "timestamp" FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, movie_id, "timestamp"
        ORDER BY rating ASC NULLS FIRST) AS rn
    FROM ratings_dirty) d
  WHERE rn = 1 AND user_id IS NOT NULL AND movie_id IS NOT NULL
    AND rating >= 1 AND rating <= 5)"""

PROFILE_INPUT = """profile_input AS (
  SELECT o_orderkey, o_custkey,
         nullif(o_orderstatus, 'P') AS o_orderstatus,
         CASE WHEN o_orderpriority = '5-LOW' THEN ' ' ELSE o_orderpriority END AS o_orderpriority,
         o_totalprice
  FROM orders)"""

# From the definitions: rounding half-up in whole numbers, an average as the sum
# of a movie's stars over their number, taken before titles are looked up.
AVERAGE = """stars AS (
  SELECT movie_id, CAST(sum(rating) AS BIGINT) AS total, count(rating) AS n
  FROM ratings GROUP BY movie_id),
average_movie_ratings AS (
  SELECT movie_id, movie_title,
         ((sum(total) * 2000 + sum(n)) // (2 * sum(n))) / CAST(1000 AS DOUBLE) AS average_rating,
         CAST(sum(n) AS BIGINT) AS rating_count
  FROM movies INNER JOIN stars USING (movie_id)
  GROUP BY ALL)"""

ACTIVE = """active_users AS (
  SELECT DISTINCT user_id, n AS total_ratings
  FROM (SELECT user_id, count(movie_id) OVER (PARTITION BY user_id) AS n FROM ratings) per_rating
  WHERE n >= 50)"""

# How often a user rated a movie, times the movie's categories.
GENRE_COUNTS = """user_genre_counts AS (
  SELECT user_id, genre, CAST(sum(times) AS BIGINT) AS genre_rating_count
  FROM (SELECT user_id, movie_id, count(*) AS times FROM ratings
        WHERE user_id IN (SELECT user_id FROM active_users) GROUP BY ALL) seen
       INNER JOIN movie_genres USING (movie_id)
  GROUP BY ALL)"""

# The least of (minus the count, the name) of each user.
FAVOURITE = """user_favourite_genres AS (
  SELECT user_id, best.g AS favourite_genre, -best.c AS genre_rating_count
  FROM (SELECT user_id, min({'c': -genre_rating_count, 'g': genre}) AS best
        FROM user_genre_counts GROUP BY user_id) least)"""

MOVIES_DIRTY = """movies_dirty AS (
  SELECT m.* REPLACE (CASE k WHEN 0 THEN movie_title WHEN 1 THEN 'a ' || movie_title END AS movie_title)
  FROM movies_wide m JOIN (VALUES (0), (1), (2)) c(k)
    ON k = 0 OR (k = 2 AND movie_id % 7 = 0) OR (k = 1 AND movie_id % 9 = 0 AND movie_id % 7 <> 0)),
clean_movies AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY movie_title NULLS FIRST) AS rn
    FROM movies_dirty) d
  WHERE rn = 1 AND movie_id IS NOT NULL AND movie_title IS NOT NULL)"""

TOP10 = """top_10_movies AS (
  SELECT CAST(row_number() OVER (ORDER BY average_rating DESC, rating_count DESC, movie_id ASC)
              AS INTEGER) AS rank,
         movie_id, movie_title, average_rating, rating_count
  FROM (SELECT * FROM average_movie_ratings
        ORDER BY average_rating DESC, rating_count DESC, movie_id ASC LIMIT 10) t)"""

YOUNG = """young_users AS (
  SELECT user_id, age, gender, occupation, zip_code FROM clean_users WHERE age < 20)"""

SCIENTIST = f"""scientist_users AS (
  SELECT user_id, age, gender, occupation, zip_code FROM clean_users
  WHERE occupation = {_q(FIXTURE_OCCUPATION)} AND age >= 30 AND age <= 40)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def lines_users() -> str:
    return """SELECT concat_ws('|', CAST(user_id AS VARCHAR), CAST(age AS VARCHAR), gender,
                        occupation, zip_code) AS value FROM users"""


def lines_ratings(source: str = "ratings") -> str:
    return f"""SELECT concat_ws(chr(9), CAST(user_id AS VARCHAR), CAST(movie_id AS VARCHAR),
                        CAST(rating AS VARCHAR), CAST("timestamp" AS VARCHAR)) AS value
               FROM {source}"""


def lines_items(vocabulary: Sequence[str] = FIXTURE_GENRES) -> str:
    flags = ", ".join(f"CAST({w} AS VARCHAR)" for w in vocabulary)
    return f"""SELECT concat_ws('|', CAST(movie_id AS VARCHAR), movie_title, release_date,
                        video_release_date, imdb_url, {flags}) AS value FROM movies_wide"""


def profile(dataset: str, source: str, columns: Sequence[tuple[str, bool]]) -> str:
    """Missing counts per column plus total/distinct/duplicate rows, long form."""
    parts = []
    for col, is_string in columns:
        cond = f'"{col}" IS NULL' + (f" OR trim(\"{col}\") = ''" if is_string else "")
        parts.append(
            f"SELECT {_q(dataset)} AS dataset, 'missing' AS metric, {_q(col)} AS column_name, "
            f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS value FROM {source}")
    names = ", ".join(f'"{c}"' for c, _ in columns)
    dup = (f"(SELECT CAST(COUNT(*) AS BIGINT) AS t, "
           f"(SELECT CAST(COUNT(*) AS BIGINT) FROM (SELECT DISTINCT {names} FROM {source}) x) AS d "
           f"FROM {source})")
    for metric, expr in (("total_rows", "t"), ("distinct_rows", "d"),
                         ("duplicate_rows", "t - d")):
        parts.append(f"SELECT {_q(dataset)} AS dataset, {_q(metric)} AS metric, "
                     f"CAST(NULL AS VARCHAR) AS column_name, CAST({expr} AS BIGINT) AS value "
                     f"FROM {dup} s")
    return "\nUNION ALL\n".join(parts)

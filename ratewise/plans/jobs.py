"""Composite jobs (C1-C5): ingest, the three reports, and the raw profile.

Each job is a function of ``(spark, store, parameters)``: read with explicit
schemas, apply the operators, write every target once, and return a small
report DataFrame built from what was read back.  Where a job writes two results
from one intermediate (Tasks 1 and 2), the second is built from the stored
first one, which cuts the lineage without caching.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import (
    active_users,
    average_rating_per_movie,
    clean_movies,
    clean_ratings,
    clean_users,
    explode_genres,
    favourite_genre_per_user,
    profile_summary,
    record_counts,
    top_n_movies,
    user_genre_counts,
    users_by_occupation_and_age,
    users_younger_than,
)
from ..sinks import (
    Written,
    conform,
    even_buckets,
    own_table,
    point_table,
    publish,
    register_clustered,
    stage_clustered,
    stage_documents,
    stage_range_clustered,
    stage_table,
    table_entry,
    validate_stored_counts,
)
from ..sources import (
    parse_item_genres,
    parse_pipe_users,
    parse_ws_ratings,
    read_documents_defaulted,
    read_table_projected,
    scan_text_lines,
)


@dataclass(frozen=True)
class Store:
    """Where the base and result tables live: ``root/<table>``.  Formats are
    parameters, so another connector can be named by configuration.

    With ``table_prefix`` set, a table registered in the session catalog as
    ``<prefix><name>`` (the bucketed ratings of the ingest) is read through the
    catalog, which keeps its bucket spec: a later per-user aggregate or join
    then reads it without an exchange.  Otherwise tables are read by path."""

    root: str
    table_format: str = "parquet"
    document_format: str = "json"
    table_prefix: str | None = None

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    # Writing: a stage makes files, a commit makes them the tables.

    def stage(self, df: DataFrame, name: str, partition_by: Sequence[str] | None = None,
              observation: Observation | None = None) -> dict:
        return stage_table(df, self.path(name), schema=schemas.TABLES.get(name),
                           fmt=self.table_format, partition_by=partition_by,
                           observation=observation)

    def stage_segments(self, df: DataFrame, name: str, by: Sequence[str] = schemas.SEGMENT_ORDER,
                       observation: Observation | None = None,
                       row_group_bytes: int | None = None) -> dict:
        """A table laid out for reads of a range of ``by``."""
        return stage_range_clustered(df, self.path(name), by, schemas.TABLES.get(name),
                                     self.table_format, observation, row_group_bytes)

    def stage_movies(self, movies: DataFrame, observation: Observation | None = None) -> dict:
        return stage_documents(movies, self.path("movies"), fmt=self.document_format,
                               observation=observation)

    def commit(self, spark: SparkSession, entries: Mapping[str, dict]) -> None:
        """Make the staged entries the store's tables, all at once.  Catalog tables of
        this store follow."""
        publish(spark, self.root.rstrip("/"), entries)
        if self.table_prefix is None:
            return
        for name, entry in entries.items():
            full = self.table_prefix + name
            if not spark.catalog.tableExists(full) or spark.catalog.getTable(full).isTemporary:
                continue
            own_table(spark, full, self.path(name))
            if "clustered" in entry:
                register_clustered(spark, full, self.path(name), schemas.TABLES[name], entry,
                                   self.table_format)
            else:
                point_table(spark, full, f"{self.root.rstrip('/')}/{entry['folders'][0]}")

    def write(self, df: DataFrame, name: str, partition_by: Sequence[str] | None = None,
              observation: Observation | None = None) -> str:
        self.commit(df.sparkSession, {name: self.stage(df, name, partition_by, observation)})
        return self.path(name)

    def write_movies(self, movies: DataFrame, observation: Observation | None = None) -> str:
        self.commit(movies.sparkSession, {"movies": self.stage_movies(movies, observation)})
        return self.path("movies")

    # Reading.

    def parts(self, spark: SparkSession, name: str,
              columns: Sequence[str] | None = None) -> list[DataFrame]:
        """The table as frames that share no clustering key: the buckets, through the
        catalog if they are registered there, and the keys stored apart, if any.  Any
        other table is one frame."""
        entry = table_entry(spark, self.path(name))
        folders = [f"{self.root.rstrip('/')}/{f}" for f in entry["folders"]] if entry else []
        if entry is None or "clustered" not in entry:
            # the stored schema is known: no inference job over the files' footers
            schema = schemas.TABLES.get(name)
            known = schema if self.table_format in ("parquet", "orc", "json") else None
            return [read_table_projected(spark, self.path(name), columns, fmt=self.table_format,
                                         schema=known)]
        out = []
        for i, folder in enumerate(folders):
            full = None if self.table_prefix is None else self.table_prefix + name
            if (i == 0 and full is not None and spark.catalog.tableExists(full)
                    and not spark.catalog.getTable(full).isTemporary  # a stored table, not a view
                    and (len(folders) > 1 or even_buckets(spark, self.path(name)))):
                df = spark.table(full)
            else:
                df = spark.read.format(self.table_format).schema(schemas.TABLES[name]).load(folder)
            out.append(df.select(*columns) if columns else df)
        return out

    def read(self, spark: SparkSession, name: str,
             columns: Sequence[str] | None = None) -> DataFrame:
        first, *others = self.parts(spark, name, columns)
        for df in others:
            first = first.unionByName(df)
        return first

    def per_key(self, spark: SparkSession, name: str, columns: Sequence[str] | None,
                work: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``work`` on every part: for work on the rows of one clustering key at a time,
        whose results are then whole.  The buckets keep their layout (no exchange)."""
        first, *others = [work(df) for df in self.parts(spark, name, columns)]
        for df in others:
            first = first.unionByName(df)
        return first

    def ratings_of_user(self, spark: SparkSession, user_id: int, first_movie: int | None = None,
                        last_movie: int | None = None) -> DataFrame:
        """A user's ratings, of a range of movies, in key order.  On the clustered table one
        bucket is read, and of it the row groups whose statistics hold the user and
        the movies."""
        def wanted(df: DataFrame) -> DataFrame:
            df = df.where(F.col("user_id") == user_id)
            if first_movie is not None:
                df = df.where(F.col("movie_id") >= first_movie)
            return df if last_movie is None else df.where(F.col("movie_id") <= last_movie)
        return self.per_key(spark, "ratings", None, wanted).orderBy("movie_id", "timestamp")

    def read_movies(self, spark: SparkSession) -> DataFrame:
        return read_documents_defaulted(spark, self.path("movies"), fmt=self.document_format)


def write_together(*writes: Callable[[], object]) -> list[object]:
    """Submit independent writes of one job at the same time (one driver
    thread each, one Spark job each).  A small table's write then uses slots
    that a big write leaves free, instead of waiting for it; the first error
    is raised after all have finished."""
    with ThreadPoolExecutor(max_workers=max(1, len(writes))) as pool:
        futures = [pool.submit(w) for w in writes]
    return [f.result() for f in futures]


def counted(write: Callable[[Observation], object]) -> Written:
    """Run a write and return the rows it wrote and their checksum, observed in the stage
    that wrote them (each partition once, however often a task is retried)."""
    seen = Observation()
    write(seen)
    return Written(int(seen.get["rows"]), seen.get["checksum"])


def staged(stage: Callable[[Observation], dict]) -> tuple[dict, Written]:
    """Run a stage; its entry for the commit and what was observed."""
    entries: list[dict] = []
    seen = counted(lambda o: entries.append(stage(o)))
    return entries[0], seen


def ingest_clean_store(spark: SparkSession, user_path: str, rating_path: str, item_path: str,
                       store: Store, vocabulary: Sequence[str] = schemas.DEFAULT_GENRES,
                       lenient: bool = False, rating_buckets: int | None = None,
                       table_prefix: str | None = None) -> DataFrame:
    """Raw lines -> parse -> clean -> store (users and ratings as tables,
    movies as documents) -> read back: ``(table_name, raw_rows, expected_rows,
    actual_rows, checksum_ok, ok)`` with the raw lines, the cleaned rows as the writers
    observed them, and the rows of the stored tables.

    The three are written side by side and become the store's tables in one commit: a
    reader sees all of the old or all of the new.  Users are laid out for the segment
    reads (by occupation and age).

    With ``rating_buckets`` the ratings table is written clustered by user
    (K4, hot users apart) and registered as ``<prefix>ratings``; a prefix
    (``table_prefix``, else the store's) is then required, so that no unrelated table is
    replaced.  A store with that prefix reads it back through the catalog.

    The raw line counts are one extra scan of the text files: counting them
    while parsing would be in a map stage, whose metrics a lost executor can
    count twice."""
    prefix = table_prefix if table_prefix is not None else (store.table_prefix or "")
    if rating_buckets and not prefix:
        raise ValueError("bucketed ratings are registered in the catalog: give a table prefix")
    raw = {"users": scan_text_lines(spark, user_path, origin=True),
           "ratings": scan_text_lines(spark, rating_path, origin=True),
           "movies": scan_text_lines(spark, item_path, origin=True)}
    users = clean_users(parse_pipe_users(raw["users"], lenient=lenient))
    ratings = clean_ratings(parse_ws_ratings(raw["ratings"], lenient=lenient))
    movies = clean_movies(parse_item_genres(raw["movies"], vocabulary, lenient=lenient))
    if rating_buckets:
        own_table(spark, f"{prefix}ratings", store.path("ratings"))

    def stage_ratings(seen: Observation) -> dict:
        if rating_buckets:
            return stage_clustered(conform(ratings, schemas.RATINGS), store.path("ratings"),
                                   buckets=rating_buckets, fmt=store.table_format,
                                   observation=seen, split_hot=True)
        return store.stage(ratings, "ratings", observation=seen)

    names = ("users", "ratings", "movies")
    done = dict(zip(names, write_together(
        lambda: staged(lambda seen: store.stage_segments(users, "users", observation=seen)),
        lambda: staged(stage_ratings),
        lambda: staged(lambda seen: store.stage_movies(movies, seen)))))
    entries = {name: entry for name, (entry, _) in done.items()}
    store.commit(spark, entries)
    if rating_buckets:
        register_clustered(spark, f"{prefix}ratings", store.path("ratings"), schemas.RATINGS,
                           entries["ratings"], store.table_format)
    report = validate_store(spark, store, {name: seen for name, (_, seen) in done.items()})
    lines = record_counts(raw).select(F.col("dataset").alias("table_name"),
                                      F.col("row_count").alias("raw_rows"))
    return lines.join(report, "table_name")


def ratings_report(spark: SparkSession, store: Store, n: int = 10,
                   min_count: int = 0) -> DataFrame:
    """C2 (Tasks 1 and 2): per-movie averages, then the top ``n`` built from
    the stored averages; returns the validation of both stored results."""
    ratings = store.read(spark, "ratings", ["movie_id", "rating"])
    movies = store.read_movies(spark).select("movie_id", "movie_title")
    averages = counted(lambda rows: store.write(
        average_rating_per_movie(ratings, movies), "average_movie_ratings", observation=rows))
    stored_avg = store.read(spark, "average_movie_ratings")
    top = counted(lambda rows: store.write(
        top_n_movies(stored_avg, n, min_count), "top_10_movies", observation=rows))
    return validate_store(spark, store, {"average_movie_ratings": averages, "top_10_movies": top})


def favourite_genre_report(spark: SparkSession, store: Store, min_ratings: int = 50) -> DataFrame:
    """C3 (Task 3): favourite genre of every active user; returns the
    validation of the stored result."""
    genres = explode_genres(store.read_movies(spark))
    fav = store.per_key(spark, "ratings", ["user_id", "movie_id"], lambda ratings: favourite_genre_per_user(
        user_genre_counts(ratings, genres, active_users(ratings, min_ratings))))
    rows = counted(lambda o: store.write(fav, "user_favourite_genres", observation=o))
    return validate_store(spark, store, {"user_favourite_genres": rows})


def user_filter_report(spark: SparkSession, store: Store, max_age_exclusive: int = 20,
                       occupation: str = "scientist", min_age: int = 30,
                       max_age: int = 40) -> DataFrame:
    """C4 (Tasks 4 and 5): two user segments from the stored users, validated."""
    users = store.read(spark, "users")
    young, scientists = write_together(
        lambda: counted(lambda rows: store.write(
            users_younger_than(users, max_age_exclusive), "young_users", observation=rows)),
        lambda: counted(lambda rows: store.write(
            users_by_occupation_and_age(users, occupation, min_age, max_age), "scientist_users",
            observation=rows)))
    return validate_store(spark, store, {"young_users": young, "scientist_users": scientists})


def validate_store(spark: SparkSession, store: Store,
                   expected: Mapping[str, DataFrame | Written | int]) -> DataFrame:
    """K7 over a store: read each named table back and compare its rows."""
    stored = {n: (store.read_movies(spark) if n == "movies" else store.read(spark, n))
              for n in expected}
    return validate_stored_counts(stored, expected)


def profile_raw(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """For every dataset, missing values per column and total / distinct /
    duplicate rows, as ``(dataset, metric, column_name, value)`` rows; one
    scan of each dataset."""
    parts = [profile_summary(df).select(F.lit(name).alias("dataset"), "metric",
                                        "column_name", "value")
             for name, df in datasets.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

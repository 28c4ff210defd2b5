"""Plan-shape checks: the physical strategies the operators are meant to get."""

from ratewise import fixtures as fx
from ratewise import registry, schemas
from ratewise.operators import clean_ratings, clean_users, dedup_by_key, users_by_occupation_and_age
from ratewise.plans import count_operator, plan_text
from ratewise.sinks import conform, load_table_overwrite, write_clustered_by_key
from ratewise.sources import read_table_projected
from tests.conftest import SF_SMALL

PYTHON_OPS = ("BatchEvalPython", "ArrowEvalPython", "PythonRDD", "FlatMapGroupsInPandas",
              "MapInPandas")


def test_no_python_on_any_query_plan(spark):
    # Every registered query that is lazily planned (no writes) stays in the JVM.
    for name in ("average_rating_per_movie", "top_n_movies", "favourite_genre_per_user",
                 "clean_ratings", "profile_raw", "flags_to_array", "join_ratings_movies",
                 "missing_values_profile", "record_counts"):
        plan = plan_text(registry.QUERIES[name](spark, SF_SMALL))
        assert not any(op in plan for op in PYTHON_OPS), name


def test_top_n_is_take_ordered(spark):
    plan = plan_text(registry.QUERIES["top_n_movies"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan


def test_average_aggregates_before_the_join(spark):
    df = registry.QUERIES["average_rating_per_movie"](spark, SF_SMALL)
    tree = plan_text(df, "simple")
    # The partial aggregate over ratings sits below the join with the titles.
    join_line = next(i for i, l in enumerate(tree.splitlines()) if "Join" in l)
    below = "\n".join(tree.splitlines()[join_line:])
    assert "partial_sum" in below and "partial_count" in below


def test_favourite_genre_uses_group_limit(spark):
    plan = plan_text(registry.QUERIES["favourite_genre_per_user"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan
    assert "LeftSemi" in plan


def test_dedup_combines_before_the_shuffle(spark):
    plan = plan_text(clean_ratings(fx.ratings_dirty(spark, SF_SMALL)), "simple")
    assert "HashAggregate" in plan and "partial_min(rating" in plan
    assert "Window" not in plan
    users = plan_text(clean_users(fx.users(spark, SF_SMALL)), "simple")
    assert "partial_min(struct(" in users


def test_custom_order_dedup_is_two_phase_group_limit(spark):
    from pyspark.sql import functions as F
    df = dedup_by_key(fx.ratings_dirty(spark, SF_SMALL), ["user_id", "movie_id"],
                      order_by=[F.col("timestamp").desc()])
    assert plan_text(df, "simple").count("WindowGroupLimit") == 2


def test_partitioned_layout_prunes(spark, tmp_uri):
    path = load_table_overwrite(fx.users(spark, SF_SMALL), tmp_uri("users"), schemas.USERS,
                                partition_by=["occupation"])
    df = users_by_occupation_and_age(read_table_projected(spark, path), "building", 30, 40)
    plan = plan_text(df)
    assert "PartitionFilters: [isnotnull(occupation" in plan and "(occupation" in plan
    assert "PushedFilters: [IsNotNull(age), GreaterThanOrEqual(age,30), LessThanOrEqual(age,40)]" in plan


def test_bucketed_ratings_aggregate_without_exchange(spark, tmp_uri):
    import uuid
    name = f"t_{uuid.uuid4().hex[:8]}"
    t = write_clustered_by_key(conform(fx.ratings(spark, SF_SMALL), schemas.RATINGS), name,
                               tmp_uri("bucketed"), buckets=4)
    per_user = t.groupBy("user_id").count()
    assert count_operator(per_user, "Exchange") == 0
    # The same files read as a plain folder (no bucket spec) need the shuffle.
    unbucketed = read_table_projected(spark, t.inputFiles()[0].rsplit("/", 1)[0])
    assert count_operator(unbucketed.groupBy("user_id").count(), "Exchange") == 1


def test_sql_forms_keep_the_plan_shape(spark):
    avg = plan_text(registry.QUERIES["average_rating_per_movie_sql"](spark, SF_SMALL), "simple")
    join_line = next(i for i, l in enumerate(avg.splitlines()) if "Join" in l)
    assert "partial_sum" in "\n".join(avg.splitlines()[join_line:])
    fav = plan_text(registry.QUERIES["favourite_genre_per_user_sql"](spark, SF_SMALL))
    assert "min_by" in fav and "LeftSemi" in fav
    assert "TakeOrderedAndProject" in plan_text(registry.QUERIES["top_n_movies_sql"](spark, SF_SMALL))


def test_sized_broadcast_measures_and_chooses(spark):
    from ratewise.operators import join_ratings_movie_genres, measured_bytes, sized_broadcast
    genres = spark.createDataFrame([(1, "ab"), (2, "cde"), (3, None)], "movie_id long, genre string")
    # per row: 8 (id) + bytes of the string + 8, plus 8 row overhead
    assert measured_bytes(genres) == (8 + 2 + 8 + 8) + (8 + 3 + 8 + 8) + (8 + 0 + 8 + 8)
    arr = spark.createDataFrame([(1, ["a", "bb"])], "movie_id long, genres array<string>")
    assert measured_bytes(arr) == 8 + (16 + (1 + 8) + (2 + 8)) + 8
    assert measured_bytes(spark.createDataFrame([], "movie_id long")) == 0
    ratings = fx.ratings(spark, SF_SMALL)
    small = plan_text(join_ratings_movie_genres(ratings, genres))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    big = plan_text(join_ratings_movie_genres(ratings, genres, max_broadcast_bytes=10))
    assert "SortMergeJoin" in big
    mapped = spark.createDataFrame([(1, {"a": 1})], "movie_id long, m map<string,int>")
    assert measured_bytes(mapped) is None  # then joined by sorting, as in the SQL form
    assert "SortMergeJoin" in plan_text(ratings.join(sized_broadcast(mapped), "movie_id"))


READ_ONLY = ("average_rating_per_movie", "top_n_movies", "active_users", "user_genre_counts",
             "favourite_genre_per_user", "join_ratings_active_users", "join_ratings_movie_genres",
             "join_ratings_movies", "clean_users", "clean_ratings", "clean_movies", "dedup_by_key",
             "duplicate_check", "missing_values_profile", "record_counts", "project_columns",
             "users_younger_than", "users_by_occupation_and_age", "flags_to_array",
             "explode_genres", "profile_raw", "user_genre_counts_sorted")


def test_scans_read_only_needed_columns(spark):
    """Column pruning reaches every parquet scan: no query reads a driver table
    whole (none needs every column)."""
    import re

    from ratewise import fixtures
    widths = {t: len(fixtures.table(spark, SF_SMALL, t).columns)
              for t in ("lineitem", "orders", "customer", "part", "documents")}
    for name in READ_ONLY:
        plan = plan_text(registry.QUERIES[name](spark, SF_SMALL))
        for m in re.finditer(r"Location: InMemoryFileIndex \[[^\]]*/(\w+)\.parquet\]"
                             r"(?:.|\n)*?ReadSchema: struct<([^>]*)>", plan):
            table, schema = m.group(1), m.group(2)
            read = len(re.findall(r"\w+:", schema))
            assert read < widths[table], (name, table, schema)


def test_ratings_are_only_shuffled_as_aggregates(spark):
    """Tasks 1 and 3: every shuffle by user or movie carries aggregated rows
    (an aggregate, partial or final, directly below the exchange), never raw
    rating rows; with the genre side broadcast, no rating is shuffled row by
    row."""
    for name in ("average_rating_per_movie", "favourite_genre_per_user", "user_genre_counts"):
        lines = plan_text(registry.QUERIES[name](spark, SF_SMALL), "simple").splitlines()
        exchanges = [i for i, l in enumerate(lines)
                     if "Exchange hashpartitioning(user_id" in l
                     or "Exchange hashpartitioning(movie_id" in l]
        assert exchanges, name
        for i in exchanges:
            below = lines[i + 1].strip().lstrip(":+- ")
            assert below.split("(")[0].endswith("HashAggregate"), (name, lines[i], below)

"""Composite jobs end to end on the smallest fixture."""

import pytest

from ratewise import fixtures as fx
from ratewise.plans import Store, favourite_genre_report, ingest_clean_store, profile_raw, \
    ratings_report, user_filter_report
from ratewise.sources import write_text_lines
from tests.conftest import SF_SMALL


def test_ingest_then_reports(spark, tmp_uri):
    root = tmp_uri("raw")
    u = write_text_lines(fx.user_lines(spark, SF_SMALL), f"{root}/user_lines")
    r = write_text_lines(fx.rating_lines(spark, SF_SMALL, dirty=True), f"{root}/rating_lines")
    i = write_text_lines(fx.item_lines(spark, SF_SMALL), f"{root}/item_lines")
    store = Store(tmp_uri("store"))
    rows = {r.table_name: r for r in ingest_clean_store(spark, u, r, i, store, fx.FIXTURE_GENRES).collect()}
    assert all(r.ok and r.expected_rows == r.actual_rows for r in rows.values())
    assert rows["users"].raw_rows == fx.users(spark, SF_SMALL).count() > rows["users"].actual_rows > 0
    assert rows["movies"].raw_rows == rows["movies"].actual_rows == fx.movies(spark, SF_SMALL).count()
    assert rows["ratings"].actual_rows < rows["ratings"].raw_rows

    rep = report(ratings_report(spark, store))
    assert rep["top_10_movies"] == 10 and rep["average_movie_ratings"] <= 200
    top = store.read(spark, "top_10_movies").orderBy("rank").collect()
    assert [t["rank"] for t in top] == list(range(1, 11))
    keys = [(-t.average_rating, -t.rating_count, t.movie_id) for t in top]
    assert keys == sorted(keys)

    assert report(favourite_genre_report(spark, store, 10))["user_favourite_genres"] > 0
    users = store.read(spark, "users")
    assert report(user_filter_report(spark, store, 20, fx.FIXTURE_OCCUPATION, 30, 40)) == {
        "young_users": users.where("age < 20").count(),
        "scientist_users": users.where(f"occupation = '{fx.FIXTURE_OCCUPATION}' AND age BETWEEN 30 AND 40").count()}


def report(df):
    rows = df.collect()
    assert all(r.ok and r.expected_rows == r.actual_rows for r in rows)
    return {r.table_name: r.actual_rows for r in rows}


def test_a_short_write_is_noticed(spark, tmp_uri):
    """Rows that are lost after the writer counted them."""
    store = Store(tmp_uri("store"))
    store.write(fx.users(spark, SF_SMALL).where("age > 0"), "users")

    class Lossy(Store):
        def read(self, spark, name, columns=None):
            df = Store.read(self, spark, name, columns)
            return df.limit(2) if name == "young_users" else df
    rows = {r.table_name: r for r in user_filter_report(
        spark, Lossy(store.root), 20, fx.FIXTURE_OCCUPATION, 30, 40).collect()}
    assert rows["young_users"].ok is False and rows["young_users"].expected_rows > 2
    assert rows["scientist_users"].ok


def test_written_rows_are_counted_once_over_retries(spark, tmp_uri):
    from ratewise.plans.jobs import counted
    from ratewise.sinks import load_table_overwrite
    df = spark.range(1000, numPartitions=4).hint("rebalance", "id")
    n = counted(lambda rows: load_table_overwrite(df, tmp_uri("t"), observation=rows))
    assert n.rows == 1000
    assert counted(lambda rows: load_table_overwrite(df.limit(0), tmp_uri("t"), observation=rows)) == (0, "0")


def test_ingest_clustered_ratings(spark, tmp_uri):
    import uuid
    root = tmp_uri("raw")
    u = write_text_lines(fx.user_lines(spark, SF_SMALL), f"{root}/user_lines")
    r = write_text_lines(fx.rating_lines(spark, SF_SMALL), f"{root}/rating_lines")
    i = write_text_lines(fx.item_lines(spark, SF_SMALL), f"{root}/item_lines")
    store = Store(tmp_uri("store"))
    prefix = f"c{uuid.uuid4().hex[:6]}_"
    with pytest.raises(ValueError, match="prefix"):
        ingest_clean_store(spark, u, r, i, store, fx.FIXTURE_GENRES, rating_buckets=4)
    counts = report(ingest_clean_store(
        spark, u, r, i, store, fx.FIXTURE_GENRES, rating_buckets=4, table_prefix=prefix))
    assert spark.table(f"{prefix}ratings").count() == counts["ratings"] > 5000


def test_profile_raw_shape(spark):
    out = profile_raw({"users": fx.users(spark, SF_SMALL), "orders": fx.profile_input(spark, SF_SMALL)})
    rows = out.collect()
    metrics = {(r.dataset, r.metric, r.column_name): r.value for r in rows}
    assert metrics[("users", "total_rows", None)] == 165
    assert metrics[("users", "duplicate_rows", None)] == 0
    assert metrics[("orders", "missing", "o_orderstatus")] > 0
    assert metrics[("orders", "missing", "o_orderpriority")] > 0


def test_bucketed_store_is_read_through_the_catalog(spark, tmp_uri):
    import uuid

    from ratewise.operators import active_users
    from ratewise.plans import count_operator
    root = tmp_uri("raw")
    u = write_text_lines(fx.user_lines(spark, SF_SMALL), f"{root}/users")
    r = write_text_lines(fx.rating_lines(spark, SF_SMALL), f"{root}/ratings")
    i = write_text_lines(fx.item_lines(spark, SF_SMALL), f"{root}/items")
    store = Store(tmp_uri("store"), table_prefix=f"b{uuid.uuid4().hex[:6]}_")
    ingest_clean_store(spark, u, r, i, store, fx.FIXTURE_GENRES, rating_buckets=4).collect()
    even, hot = store.parts(spark, "ratings", ["user_id", "movie_id"])  # hot users lie apart
    assert count_operator(active_users(even, 10), "Exchange") == 0
    assert even.join(hot, "user_id").count() == 0
    ratings = store.read(spark, "ratings", ["user_id", "movie_id"])
    by_path = Store(store.root).read(spark, "ratings", ["user_id", "movie_id"])
    assert count_operator(active_users(Store(store.root).parts(spark, "ratings")[0], 10), "Exchange") == 1
    assert sorted(map(tuple, active_users(ratings, 10).collect())) == \
        sorted(map(tuple, active_users(by_path, 10).collect()))
    assert report(favourite_genre_report(spark, store, 10))["user_favourite_genres"] > 0


def test_store_ignores_temporary_views_of_the_same_name(spark, tmp_uri):
    from ratewise import schemas
    store = Store(tmp_uri("store"), table_prefix="")
    store.write(spark.createDataFrame([(1, 1, 3, 1)], schemas.RATINGS), "ratings")
    spark.createDataFrame([(9, 9, 9, 9)], schemas.RATINGS).createOrReplaceTempView("ratings")
    try:
        assert [tuple(r) for r in store.read(spark, "ratings").collect()] == [(1, 1, 3, 1)]
    finally:
        spark.catalog.dropTempView("ratings")

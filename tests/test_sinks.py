"""Stored tables and documents: write -> read identity, upsert, DDL, validation."""

import pytest
from pyspark.errors import PySparkException

from ratewise import schemas
from ratewise.plans import Store
from ratewise.sinks import (
    create_result_tables,
    load_documents_overwrite,
    load_table_overwrite,
    table_folders,
    upsert_by_key,
    validate_stored_counts,
)
from ratewise.sources import read_documents_defaulted, read_table_projected


def test_overwrite_replaces_and_round_trips(spark, tmp_uri):
    path = tmp_uri("users")
    first = spark.createDataFrame([(1, 20, "M", "a", "01234"), (2, 30, "F", "b", "T8H1N")], schemas.USERS)
    second = spark.createDataFrame([(3, 40, "F", "", "00001")], schemas.USERS)
    load_table_overwrite(first, path, schemas.USERS)
    assert read_table_projected(spark, path).count() == 2
    load_table_overwrite(second, path, schemas.USERS)
    assert [tuple(r) for r in read_table_projected(spark, path).collect()] == [(3, 40, "F", "", "00001")]


def test_sink_narrowing_raises_on_overflow(spark, tmp_uri):
    df = spark.createDataFrame([(1, 1, 2**40, 1)], "user_id long, movie_id long, rating long, timestamp long")
    with pytest.raises(PySparkException):
        load_table_overwrite(df, tmp_uri("r"), schemas.RATINGS)


def test_upsert_new_wins_and_inserts(spark, tmp_uri):
    current = load_table_overwrite(
        spark.createDataFrame([(1, 1, 3, 10), (1, 2, 4, 10), (2, 1, 5, 10)], schemas.RATINGS),
        tmp_uri("cur"), schemas.RATINGS)
    updates = spark.createDataFrame([(1, 2, 1, 10), (1, 2, 2, 10), (3, 3, 3, 3)], schemas.RATINGS)
    out = upsert_by_key(spark, current, updates, schemas.KEYS["ratings"], tmp_uri("new"),
                        schema=schemas.RATINGS)
    got = sorted(tuple(r) for r in read_table_projected(spark, out).collect())
    # Equal key (1,2,10): update wins (first in order among the batch's copies).
    assert got == [(1, 1, 3, 10), (1, 2, 1, 10), (2, 1, 5, 10), (3, 3, 3, 3)]
    # The old table is untouched.
    assert read_table_projected(spark, current).count() == 3


def test_documents_round_trip_and_empty(spark, tmp_uri):
    path = tmp_uri("movies")
    docs = spark.createDataFrame([(1, "A", "d", "", "u", ["Drama", "War"]), (2, "B", None, None, None, [])],
                                 schemas.MOVIES)
    load_documents_overwrite(docs, path)
    got = {r.movie_id: r for r in read_documents_defaulted(spark, path).collect()}
    assert got[1].genres == ["Drama", "War"] and got[1].video_release_date == ""
    assert got[2].genres == [] and got[2].release_date is None
    load_documents_overwrite(spark.createDataFrame([], schemas.MOVIES), path)
    assert read_documents_defaulted(spark, path).count() == 0


def test_create_result_tables(spark, tmp_uri):
    root = tmp_uri("ddl")
    names = create_result_tables(spark, root, prefix="t_ddl_")
    assert len(names) == len(schemas.TABLES)
    for name, schema in schemas.TABLES.items():
        t = spark.table(f"t_ddl_{name}")
        assert [f.name for f in t.schema.fields] == schema.names
        assert t.count() == 0
    # Re-running drops and re-creates without error.
    create_result_tables(spark, root, prefix="t_ddl_")


def test_validate_counts(spark):
    report = validate_stored_counts({"a": spark.range(3), "b": spark.range(2), "c": spark.range(2)},
                                    {"a": 3, "b": spark.range(5), "c": spark.range(2)})
    got = sorted(tuple(r) for r in report.collect())
    assert got == [("a", 3, 3, None, True), ("b", 5, 2, False, False), ("c", 2, 2, True, True)]


def test_a_changed_value_at_equal_count_is_noticed(spark):
    def frame(*rows):
        return spark.createDataFrame(list(rows), "id long, x double, s string, a array<string>")
    one, two = (1, 0.5, "a", ["p", None]), (2, None, None, [])
    same = frame(two, one).repartition(3)
    for changed in (frame(one, (2, None, "", [])), frame(one, one), frame(one, (2, 0.0, None, [])),
                    frame((1, None, "a", ["p", None]), (2, 0.5, None, [])),
                    frame((1, 0.5, "a", ["p"]), two)):
        rows = {r["table_name"]: r for r in validate_stored_counts(
            {"same": same, "changed": changed},
            {"same": frame(one, two), "changed": frame(one, two)}).collect()}
        assert rows["same"]["ok"] and rows["same"]["checksum_ok"]
        assert rows["changed"]["expected_rows"] == rows["changed"]["actual_rows"]
        assert rows["changed"]["checksum_ok"] is False and rows["changed"]["ok"] is False


def test_partitioned_write_rebalances_and_prunes(spark, tmp_uri):
    import glob
    import os

    from ratewise import fixtures as fx
    from ratewise.session import local_path
    from tests.conftest import SF_SMALL
    users = fx.users(spark, SF_SMALL)
    path = load_table_overwrite(users, tmp_uri("users"), schemas.USERS, partition_by=["occupation"])
    (data,) = map(local_path, table_folders(spark, path))
    folders = [d for d in os.listdir(data) if d.startswith("occupation=")]
    assert len(folders) == 5
    for d in folders:  # a few files per value, not one per writer task
        assert len(glob.glob(os.path.join(data, d, "*.parquet"))) <= 2
    back = read_table_projected(spark, path)
    assert sorted(map(tuple, back.select(*schemas.USERS.names).collect())) == \
        sorted(map(tuple, users.collect()))


def test_clustered_write_splits_a_hot_bucket(spark, tmp_uri):
    import glob
    import os
    import uuid

    from pyspark.sql import functions as F

    from ratewise.plans import count_operator
    from ratewise.session import local_path
    from ratewise.sinks import write_clustered_by_key
    n = 300_000  # user 7 holds a third of all rows
    df = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("user_id"),
        (F.col("id") % 977).alias("movie_id"), F.lit(3).cast("int").alias("rating"),
        F.col("id").alias("timestamp"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        path = tmp_uri("hot")
        t = write_clustered_by_key(df, f"hot_{uuid.uuid4().hex[:8]}", path, buckets=4)
    finally:
        spark.conf.set(key, old)
    hot_bucket = spark.range(1).select(F.pmod(F.hash(F.lit(7).cast("long")), F.lit(4))).first()[0]
    (data,) = map(local_path, table_folders(spark, path))
    files = glob.glob(os.path.join(data, f"*_{hot_bucket:05d}.c000*.parquet"))
    assert len(files) > 1  # the hot bucket was written by several tasks
    assert t.count() == n and count_operator(t.groupBy("user_id").count(), "Exchange") == 0
    assert t.filter("user_id = 7").count() == df.filter("user_id = 7").count()


def test_failed_overwrite_keeps_the_old_rows(spark, tmp_uri):
    import glob

    from pyspark.sql import functions as F

    from ratewise.session import local_path
    path = tmp_uri("users")
    old = spark.createDataFrame([(1, 20, "M", "a", "01234")], schemas.USERS)
    load_table_overwrite(old, path, schemas.USERS)
    broken = old.withColumn("age", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(PySparkException):
        load_table_overwrite(broken, path, schemas.USERS)
    assert read_table_projected(spark, path).count() == 1
    docs = tmp_uri("movies")
    load_documents_overwrite(spark.createDataFrame([(1, "A", "d", "", "u", [])], schemas.MOVIES), docs)
    with pytest.raises(PySparkException):
        load_documents_overwrite(read_documents_defaulted(spark, docs).withColumn(
            "movie_title", F.raise_error(F.lit("no")).cast("string")), docs)
    assert read_documents_defaulted(spark, docs).count() == 1
    root, name = path.rsplit("/", 1)
    assert len(glob.glob(f"{local_path(root)}/_versions/{name}/*")) == 1


def test_a_table_may_be_overwritten_from_itself(spark, tmp_uri):
    path = load_table_overwrite(spark.range(10).withColumnRenamed("id", "user_id"), tmp_uri("t"))
    load_table_overwrite(read_table_projected(spark, path).where("user_id < 3"), path)
    assert read_table_projected(spark, path).count() == 3


def test_narrowing_raises_without_ansi_mode(spark, tmp_uri):
    df = spark.createDataFrame([(1, 5_000_000_000, "M", "a", "z")],
                               "user_id long, age long, gender string, occupation string, zip_code string")
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException, match="not a valid int"):
            load_table_overwrite(df, tmp_uri("u"), schemas.USERS)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_upserting_a_batch_with_null_keys_twice(spark, tmp_uri):
    current = load_table_overwrite(spark.createDataFrame([(1, 1, 3, 10), (2, None, 4, 10)], schemas.RATINGS),
                                   tmp_uri("cur"), schemas.RATINGS)
    batch = spark.createDataFrame([(2, None, 1, 10), (3, None, 2, None)], schemas.RATINGS)
    for _ in range(2):
        upsert_by_key(spark, current, batch, schemas.KEYS["ratings"], current, schema=schemas.RATINGS)
    got = sorted((tuple(r) for r in read_table_projected(spark, current).collect()), key=str)
    assert got == [(1, 1, 3, 10), (2, None, 1, 10), (3, None, 2, None)]


def test_created_tables_are_empty_over_old_files(spark, tmp_uri):
    root = tmp_uri("it's ddl; here")
    load_table_overwrite(spark.createDataFrame([(1, 20, "M", "a", "z")], schemas.USERS), f"{root}/users")
    create_result_tables(spark, root, prefix="t_old_")
    assert spark.table("t_old_users").count() == 0
    store = Store(root, table_prefix="t_old_")
    store.write(spark.createDataFrame([(1, 20, "M", "a", "z")], schemas.USERS), "users")
    assert spark.table("t_old_users").count() == store.read(spark, "users").count() == 1


def test_a_table_elsewhere_is_not_replaced(spark, tmp_uri):
    from ratewise.sinks import write_clustered_by_key
    rows = spark.createDataFrame([(1, 1, 3, 10)], schemas.RATINGS)
    write_clustered_by_key(rows, "t_here_ratings", tmp_uri("a"), buckets=2)
    with pytest.raises(ValueError, match="exists at"):
        write_clustered_by_key(rows, "t_here_ratings", tmp_uri("b"), buckets=2)
    spark.sql("DROP TABLE t_here_ratings")


def test_uneven_buckets_are_noticed(spark, tmp_uri):
    from pyspark.sql import functions as F

    from ratewise.plans import count_operator
    from ratewise.sinks import even_buckets, write_clustered_by_key
    n = 60_000  # one user holds a third of all rows

    def ratings(user):
        return spark.range(n).select(user.alias("user_id"), (F.col("id") % 977).alias("movie_id"),
                                     F.lit(3).cast("int").alias("rating"), F.hash("id").cast("long").alias("timestamp"))
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).cast("long")
    for user, even in ((hot, False), ((F.col("id") % 5000).cast("long"), True)):
        store = Store(tmp_uri("store"), table_prefix=f"even_{str(even).lower()}_")
        write_clustered_by_key(ratings(user), f"{store.table_prefix}ratings", store.path("ratings"), buckets=8)
        assert even_buckets(spark, store.path("ratings")) is even
        counts = store.read(spark, "ratings", ["user_id"]).groupBy("user_id").count()
        assert count_operator(counts, "Exchange") == (0 if even else 1)
        assert counts.agg(F.sum("count")).first()[0] == n
        spark.sql(f"DROP TABLE {store.table_prefix}ratings")

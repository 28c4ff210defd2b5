"""The commit point: readers, crashes, conflicts; keyed tables and clustered layouts."""

import glob
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from ratewise import fixtures as fx
from ratewise import schemas
from ratewise.operators import active_users, users_by_occupation_and_age
from ratewise.plans import Store, count_operator, ingest_clean_store, plan_text
from ratewise.session import local_path
from ratewise.sinks import (
    ConflictError,
    bucket_bytes,
    latest,
    load_table_overwrite,
    publish,
    read_keyed_table,
    rows_of_key,
    stage_clustered,
    stage_range_clustered,
    stage_table,
    table_entry,
    table_folders,
    upsert_by_key,
    upsert_keyed_table,
    vacuum,
    versions,
    write_keyed_table,
)
from ratewise.sources import first_rows, read_table_projected, write_text_lines
from tests.conftest import SF_SMALL

KEYS = schemas.KEYS["ratings"]


def users(spark, *ids):
    return spark.createDataFrame([(i, 20, "M", "a", "z") for i in ids], schemas.USERS)


def ids(df):
    return sorted(r["user_id"] for r in df.collect())


def files(spark, path):
    return {f for d in table_folders(spark, path)
            for f in glob.glob(f"{local_path(d)}/**/*.parquet", recursive=True)}


@pytest.fixture()
def small_tasks(spark):
    """Small tables over several tasks, as large ones are."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, old)


def rows_read(df):
    """Rows that the scans of a query gave, from their metrics."""
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


# --- commits --------------------------------------------------------------------

def test_a_reader_keeps_the_commit_it_began_with(spark, tmp_uri):
    path = load_table_overwrite(users(spark, 1, 2), f"{tmp_uri('s')}/users")
    before = read_table_projected(spark, path)
    entry = stage_table(users(spark, 3), path)
    assert ids(read_table_projected(spark, path)) == [1, 2]  # staged, not yet committed
    publish(spark, path.rsplit("/", 1)[0], {"users": entry})
    assert ids(read_table_projected(spark, path)) == [3]
    assert ids(before) == [1, 2]  # its files are still there


@pytest.mark.parametrize("step", ["_write_draft", "_claim"])
def test_a_crash_at_any_step_leaves_the_old_tables(spark, tmp_uri, monkeypatch, step):
    store = Store(tmp_uri("s"))
    store.write(users(spark, 1), "users")

    class Crash(BaseException):
        pass

    def crash(*args, **kwargs):
        raise Crash
    with monkeypatch.context() as m:
        m.setattr(versions, step, crash)
        with pytest.raises(Crash):
            store.write(users(spark, 2), "users")
    assert ids(store.read(spark, "users")) == [1]
    # half a draft, too, is nothing to a reader
    draft = f"{local_path(store.root)}/_commits/_draft-x"
    with open(draft, "w") as f:
        f.write('{"users": {"fol')
    assert ids(store.read(spark, "users")) == [1]
    store.write(users(spark, 3), "users")
    assert ids(store.read(spark, "users")) == [3]
    assert vacuum(spark, store.root) == []  # too young to be given up
    gone = vacuum(spark, store.root, idle_seconds=0)
    assert "_commits/_draft-x" in gone and len([g for g in gone if g.startswith("_versions/users/")]) == 2
    assert ids(store.read(spark, "users")) == [3]
    assert len(os.listdir(f"{local_path(store.root)}/_versions/users")) == 1


def test_of_two_writers_both_commit_and_a_stale_merge_does_not(spark, tmp_uri, monkeypatch):
    root = tmp_uri("s")
    write_keyed_table(users(spark, 1), f"{root}/users", ["user_id"], parts=4)
    read = table_entry(spark, f"{root}/users")
    other = stage_table(users(spark, 9), f"{root}/others")
    real, late = versions._write_draft, [True]

    def another_first(*args):
        if late:
            late.clear()
            publish(spark, root, {"first": other})
        real(*args)
    monkeypatch.setattr(versions, "_write_draft", another_first)
    assert publish(spark, root, {"others": other}) == 3
    assert set(latest(spark, root)[1]) == {"users", "first", "others"}
    load_table_overwrite(users(spark, 5), f"{root}/users")
    with pytest.raises(ConflictError, match="changed by another"):
        publish(spark, root, {"users": other}, read={"users": read})
    assert ids(read_table_projected(spark, f"{root}/users")) == [5]


def test_the_tables_of_an_ingest_change_together(spark, tmp_uri, monkeypatch):
    def lines(name, of, n):
        return write_text_lines(of.limit(n), f"{tmp_uri(name)}/lines")

    def ingest(n):
        return ingest_clean_store(spark, lines("u", fx.user_lines(spark, SF_SMALL), n),
                                  lines("r", fx.rating_lines(spark, SF_SMALL), n),
                                  lines("i", fx.item_lines(spark, SF_SMALL), n), store, fx.FIXTURE_GENRES)

    def counts():
        return {"users": store.read(spark, "users").count(), "ratings": store.read(spark, "ratings").count(),
                "movies": store.read_movies(spark).count()}
    store = Store(tmp_uri("store"))
    assert all(r["ok"] and r["checksum_ok"] for r in ingest(20).collect())
    old, number = counts(), latest(spark, store.root)[0]
    with monkeypatch.context() as m:
        m.setattr(versions, "_claim", lambda *a: (_ for _ in ()).throw(OSError("crash")))
        with pytest.raises(OSError):
            ingest(90)
    assert counts() == old
    ingest(90)
    new = counts()
    assert all(new[t] > old[t] for t in new) and latest(spark, store.root)[0] == number + 1


# --- keyed tables ---------------------------------------------------------------------

def ratings(spark, rows):
    return spark.createDataFrame(rows, schemas.RATINGS)


def test_an_upsert_leaves_other_partitions_alone(spark, tmp_uri):
    base = [(u, m, 3, 1) for u in range(400) for m in range(3)]
    path = write_keyed_table(ratings(spark, base), f"{tmp_uri('s')}/ratings", KEYS, parts=64, by=["user_id"],
                             schema=schemas.RATINGS)
    before = {p: files(spark, path) for p in [path]}[path]
    assert len(table_folders(spark, path)) == 64
    batch = [(7, 1, 5, 1), (7, 1, 4, 1), (7, 9, 2, 2), (8, 0, 1, 1)]  # 7, 1, 1 twice: the least row counts
    touched = upsert_keyed_table(spark, path, ratings(spark, batch))
    assert 1 <= len(touched) <= 2
    after = files(spark, path)
    changed = {f for f in before ^ after}
    assert all(any(f"_part={p}/" in f for p in touched) for f in changed)
    assert len({f.split("_part=")[1].split("/")[0] for f in before & after}) == 64 - len(touched)
    want = {r[:2] + r[3:]: r[2] for r in base} | {(7, 1, 1): 4, (7, 9, 2): 2, (8, 0, 1): 1}
    got = {(r[0], r[1], r[3]): r[2] for r in map(tuple, read_keyed_table(spark, path).collect())}
    assert got == want
    # through the general entry, and again: nothing changes
    upsert_by_key(spark, path, ratings(spark, batch), KEYS)
    assert sorted(map(tuple, read_table_projected(spark, path).collect())) == sorted(
        (*k[:2], v, k[2]) for k, v in want.items())
    # vacuum takes the replaced parts only
    vacuum(spark, path.rsplit("/", 1)[0], idle_seconds=0)
    assert read_keyed_table(spark, path).count() == len(want)


def test_keyed_reads_open_one_partition(spark, tmp_uri):
    path = write_keyed_table(ratings(spark, [(u, u % 7, 3, 1) for u in range(3000)]),
                             f"{tmp_uri('s')}/ratings", KEYS, parts=32, by=["user_id"])
    one = rows_of_key(spark, path, user_id=77)
    assert [tuple(r) for r in one.collect()] == [(77, 0, 3, 1)]
    assert rows_read(one) < 3000 / 8
    assert rows_of_key(spark, path, movie_id=3).count() == len([u for u in range(3000) if u % 7 == 3])


def test_keyed_tables_with_nulls_and_without_rows(spark, tmp_uri):
    path = write_keyed_table(ratings(spark, []), f"{tmp_uri('s')}/ratings", KEYS, parts=8, schema=schemas.RATINGS)
    assert read_keyed_table(spark, path).count() == 0
    assert upsert_keyed_table(spark, path, ratings(spark, [])) == []
    batch = ratings(spark, [(None, 1, 2, None), (None, None, 5, 5), (1, 1, 1, 1)])
    for _ in range(2):
        upsert_keyed_table(spark, path, batch)
    assert read_keyed_table(spark, path).count() == 3
    assert rows_of_key(spark, path, user_id=None, movie_id=1, timestamp=None).first()["rating"] == 2
    with pytest.raises(ValueError, match="key columns"):
        write_keyed_table(batch, f"{tmp_uri('s')}/x", KEYS, by=["rating"])


# --- clustered and range-clustered layouts ----------------------------------------------

def hot_ratings(spark, n=200_000):
    """One user holds a third of all rows, a second one a tenth."""
    user = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.lit(8)).otherwise(
        F.col("id") % 5000)
    return spark.range(n, numPartitions=8).select(
        user.cast("long").alias("user_id"), (F.hash("id") % 977).cast("long").alias("movie_id"),
        (F.col("id") % 5 + 1).cast("int").alias("rating"), F.col("id").alias("timestamp"))


def test_hot_users_do_not_make_a_bucket_uneven(spark, tmp_uri, small_tasks):
    df = hot_ratings(spark)
    store = Store(tmp_uri("store"), table_prefix=f"h{uuid.uuid4().hex[:6]}_")
    entry = stage_clustered(df, store.path("ratings"), buckets=8, split_hot=True)
    store.commit(spark, {"ratings": entry})
    from ratewise.sinks import register_clustered
    register_clustered(spark, f"{store.table_prefix}ratings", store.path("ratings"), schemas.RATINGS, entry)
    even, hot = store.parts(spark, "ratings")
    assert {r[0] for r in hot.select("user_id").distinct().collect()} == {7, 8}
    assert even.where("user_id IN (7, 8)").count() == 0
    sizes = sorted(bucket_bytes(spark, store.path("ratings")).values())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    spread = [r["count"] for r in hot.groupBy(F.input_file_name()).count().collect()]
    assert len(spread) > 2 and max(spread) <= 2 * sorted(spread)[len(spread) // 2]
    # every user of the buckets without an exchange; the few hot ones as partial sums
    assert count_operator(active_users(even, 10), "Exchange") == 0
    per_user = store.per_key(spark, "ratings", ["user_id", "movie_id"], lambda r: active_users(r, 10))
    assert count_operator(per_user, "Exchange") == 1
    assert sorted(map(tuple, per_user.collect())) == sorted(map(tuple, active_users(df, 10).collect()))
    assert store.read(spark, "ratings").exceptAll(df).count() == 0 and store.read(spark, "ratings").count() == df.count()
    # the layout is replaced in one step, also in the catalog
    again = stage_clustered(df.where("user_id < 50"), store.path("ratings"), buckets=8, split_hot=True)
    store.commit(spark, {"ratings": again})
    assert spark.table(f"{store.table_prefix}ratings").where("user_id >= 50").count() == 0
    spark.sql(f"DROP TABLE {store.table_prefix}ratings")


def test_a_users_ratings_are_read_from_one_bucket(spark, tmp_uri, small_tasks):
    df = hot_ratings(spark).where("user_id <> 8")
    store = Store(tmp_uri("store"), table_prefix=f"l{uuid.uuid4().hex[:6]}_")
    entry = stage_clustered(df, store.path("ratings"), buckets=8, split_hot=True, row_group_bytes=16_384)
    store.commit(spark, {"ratings": entry})
    from ratewise.sinks import register_clustered
    register_clustered(spark, f"{store.table_prefix}ratings", store.path("ratings"), schemas.RATINGS, entry)
    for user in (7, 1234):
        got = store.ratings_of_user(spark, user, 100, 110)
        want = df.where(f"user_id = {user} AND movie_id BETWEEN 100 AND 110")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        whole = store.ratings_of_user(spark, user)
        assert whole.count() == df.where(f"user_id = {user}").count()
        # told in the plan only of a scan by buckets; the other kind prunes alike
        key = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
        spark.conf.set(key, "false")
        assert "SelectedBucketsCount: 1 out of 8" in plan_text(store.ratings_of_user(spark, user))
        spark.conf.unset(key)
    total = df.count()
    assert rows_read(store.ratings_of_user(spark, 1234)) < total / 10
    assert rows_read(store.ratings_of_user(spark, 7, 100, 110)) < total / 10  # a third of the rows are user 7's
    spark.sql(f"DROP TABLE {store.table_prefix}ratings")


def test_segments_skip_row_groups(spark, tmp_uri, small_tasks):
    n = 120_000
    df = spark.range(n, numPartitions=8).select(
        F.col("id").alias("user_id"), (F.hash("id") % 50 + 50).cast("int").alias("age"), F.lit("M").alias("gender"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("job"), (F.hash("id") % 20).cast("string"))).alias("occupation"),
        F.col("id").cast("string").alias("zip_code"))
    store = Store(tmp_uri("store"))
    store.commit(spark, {"users": store.stage_segments(df, "users", row_group_bytes=16_384)})
    stored = store.read(spark, "users")
    for job, low, high in (("job3", 30, 40), ("hot", 30, 33)):
        got = users_by_occupation_and_age(stored, job, low, high)
        want = users_by_occupation_and_age(df, job, low, high)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert "PushedFilters: [IsNotNull(occupation), IsNotNull(age), EqualTo(occupation,%s)" % job in plan_text(got)
        assert rows_read(got) < n / 8
    spread = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert max(spread) < 2 * n / len(spread)  # the hot occupation is spread over files
    head = first_rows(spark, store.path("users"), 7)
    assert [tuple(r) for r in head.collect()] == [
        tuple(r) for r in df.orderBy(*schemas.SEGMENT_ORDER).limit(7).select(*head.columns).collect()]
    assert rows_read(head) < n / 4


def test_first_rows_of_small_tables(spark, tmp_uri):
    path = f"{tmp_uri('s')}/users"
    for rows in (users(spark), users(spark, 4, 2)):
        publish(spark, path.rsplit("/", 1)[0], {"users": stage_range_clustered(rows, path, ["user_id"])})
        assert ids(first_rows(spark, path, 5, schema=schemas.USERS)) == ids(rows)
    with pytest.raises(ValueError, match="range-clustered"):
        first_rows(spark, load_table_overwrite(rows, f"{tmp_uri('s')}/t"))


def test_commit_files_are_plain_json(spark, tmp_uri):
    root = tmp_uri("s")
    load_table_overwrite(users(spark, 1), f"{root}/users")
    (name,) = [f for f in os.listdir(f"{local_path(root)}/_commits") if f.endswith(".json")]
    with open(f"{local_path(root)}/_commits/{name}") as f:
        state = json.load(f)
    assert list(state) == ["users"] and state["users"]["folders"][0].startswith("_versions/users/")

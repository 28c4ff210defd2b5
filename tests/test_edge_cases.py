"""Edge cases of sinks, readers and jobs not covered elsewhere."""

import uuid

from pyspark.sql import functions as F

from ratewise import schemas
from ratewise.operators import record_counts
from ratewise.plans import Store, validate_store
from ratewise.sinks import (
    conform,
    load_table_overwrite,
    upsert_by_key,
    upsert_frames,
    write_clustered_by_key,
)
from ratewise.sources import (
    parse_ws_ratings,
    read_documents_defaulted,
    read_table_projected,
    write_text_lines,
)


def ratings(spark, rows):
    return spark.createDataFrame(rows, schemas.RATINGS)


def test_upsert_with_empty_batch_keeps_everything(spark, tmp_uri):
    cur = load_table_overwrite(ratings(spark, [(1, 1, 3, 1), (2, 2, 4, 2)]), tmp_uri("c"), schemas.RATINGS)
    out = upsert_by_key(spark, cur, ratings(spark, []), schemas.KEYS["ratings"], tmp_uri("n"),
                        schema=schemas.RATINGS)
    assert sorted(map(tuple, read_table_projected(spark, out).collect())) == [(1, 1, 3, 1), (2, 2, 4, 2)]


def test_upsert_into_empty_table(spark):
    merged = upsert_frames(ratings(spark, []), ratings(spark, [(1, 1, 3, 1), (1, 1, 2, 1)]),
                           schemas.KEYS["ratings"])
    assert sorted(map(tuple, merged.collect())) == [(1, 1, 2, 1)]


def test_clustered_rewrite_replaces_table(spark, tmp_uri):
    name, path = f"t_{uuid.uuid4().hex[:8]}", tmp_uri("b")
    write_clustered_by_key(ratings(spark, [(1, 1, 3, 1), (2, 1, 3, 1)]), name, path, buckets=2)
    t = write_clustered_by_key(ratings(spark, [(3, 3, 3, 3)]), name, path, buckets=2)
    assert [tuple(r) for r in t.collect()] == [(3, 3, 3, 3)]


def test_documents_with_extra_fields_and_null_elements(spark, tmp_uri):
    path = tmp_uri("docs")
    docs = spark.createDataFrame([
        ('{"movie_id": 1, "movie_title": "A", "genres": ["Drama", null], "rating": 5, "x": {"y": 1}}',),
        ('{"movie_id": "2", "movie_title": "B", "genres": []}',),
    ], "value string")
    write_text_lines(docs, path)
    got = {r.movie_id: r for r in read_documents_defaulted(spark, path).collect()}
    assert got[1].genres == ["Drama", None] and got[2].movie_title == "B"
    assert read_documents_defaulted(spark, path).columns == schemas.MOVIES.names


def test_rating_lines_with_extra_fields_are_truncated(spark):
    df = parse_ws_ratings(spark.createDataFrame([("1 2 3 4 5 6",)], "value string"))
    assert [tuple(r) for r in df.collect()] == [(1, 2, 3, 4)]


def test_record_counts_of_empty_inputs(spark):
    out = record_counts({"empty": ratings(spark, [])})
    assert [tuple(r) for r in out.collect()] == [("empty", 0)]


def test_validate_store_reports_mismatch(spark, tmp_uri):
    store = Store(tmp_uri("store"))
    df = ratings(spark, [(1, 1, 3, 1), (2, 2, 4, 2)])
    store.write(df, "ratings")
    report = {r.table_name: (r.expected_rows, r.actual_rows, r.ok)
              for r in validate_store(spark, store, {"ratings": df.filter(F.col("rating") > 3)}).collect()}
    assert report == {"ratings": (1, 2, False)}


def test_conform_orders_and_casts_by_name(spark):
    df = spark.createDataFrame([(4, 3, 2, 1)], "timestamp long, rating long, movie_id long, user_id long")
    out = conform(df, schemas.RATINGS)
    assert out.schema == schemas.RATINGS and tuple(out.collect()[0]) == (1, 2, 3, 4)


def test_document_with_non_numeric_id_fails(spark, tmp_uri):
    import pytest
    from pyspark.errors import PySparkException
    path = tmp_uri("docs")
    write_text_lines(spark.createDataFrame([('{"movie_id": "x1", "movie_title": "A"}',)], "value string"), path)
    with pytest.raises(PySparkException):
        read_documents_defaulted(spark, path).collect()


def test_store_in_another_format(spark, tmp_uri):
    store = Store(tmp_uri("orc"), table_format="orc")
    df = ratings(spark, [(1, 1, 3, 1), (2, 2, 4, 2)])
    store.write(df, "ratings")
    back = store.read(spark, "ratings", ["movie_id", "rating"])
    assert sorted(map(tuple, back.collect())) == [(1, 3), (2, 4)]


def test_documents_in_parquet(spark, tmp_uri):
    store = Store(tmp_uri("docs"), document_format="parquet")
    docs = spark.createDataFrame([(1, "A", "d", "", "u", ["War"]), (2, "B", None, None, None, None)],
                                 schemas.MOVIES)
    store.write_movies(docs)
    got = {r.movie_id: r.genres for r in store.read_movies(spark).collect()}
    assert got == {1: ["War"], 2: []}

"""Incremental ratings ingest: two arrivals of files, upsert by key."""

from ratewise.sources import write_text_lines
from ratewise.streaming import compact_ratings, read_keyed_ratings, read_rejects, \
    start_ratings_ingest


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_two_arrivals_upsert(spark, tmp_uri):
    src, table, ckpt, bad = (tmp_uri(n) for n in ("incoming", "ratings", "ckpt", "rejects"))
    write_text_lines(lines(spark, "1\t10\t3\t100", "1\t11\t9\t100", "2\t10\t4\t100", "bad line"),
                     f"{src}/a")
    q = start_ratings_ingest(spark, src, table, ckpt, bad)
    q.awaitTermination(120)
    first = sorted(tuple(r) for r in read_keyed_ratings(spark, table).collect())
    assert first == [(1, 10, 3, 100), (2, 10, 4, 100)]
    assert [(r.value, r.batch_id) for r in read_rejects(spark, bad).collect()] == [("bad line", 0)]

    # Second arrival: a new rating for an existing key, and a new key.
    write_text_lines(lines(spark, "1 10 5 100", "3 12 1 200"), f"{src}/b")
    q = start_ratings_ingest(spark, src, table, ckpt, bad)
    q.awaitTermination(120)
    second = sorted(tuple(r) for r in read_keyed_ratings(spark, table).collect())
    assert second == [(1, 10, 5, 100), (2, 10, 4, 100), (3, 12, 1, 200)]

    # A restart with nothing new changes nothing.
    q = start_ratings_ingest(spark, src, table, ckpt, bad)
    q.awaitTermination(120)
    assert sorted(tuple(r) for r in read_keyed_ratings(spark, table).collect()) == second

    # Compaction keeps the rows, as one batch; doing it again changes nothing.
    for _ in range(2):
        compact_ratings(spark, table)
        assert sorted(tuple(r) for r in read_keyed_ratings(spark, table).collect()) == second
        assert spark.read.parquet(table).count() == len(second)


def test_strict_by_default(spark, tmp_uri):
    import pytest
    from pyspark.errors import StreamingQueryException
    src = tmp_uri("incoming")
    write_text_lines(lines(spark, "1 10 5 100", "bad line"), f"{src}/a")
    with pytest.raises(StreamingQueryException, match="unreadable line"):
        start_ratings_ingest(spark, src, tmp_uri("ratings"), tmp_uri("ckpt")).awaitTermination(120)

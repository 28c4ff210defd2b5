"""Incremental form of the ratings load: new rating files are parsed, cleaned
and merged into the keyed ratings table as they arrive.

This is the same work as the ratings part of the batch ingest (S3 -> Q6 ->
K2), driven by Structured Streaming's file source instead of one batch run:

* each micro-batch is parsed and cleaned (dedup on the key, range checks);
* it is written as its own ``batch_id=<n>`` partition of the table folder with
  dynamic partition overwrite, so a micro-batch that is re-run after a failure
  replaces its own output instead of duplicating it;
* :func:`read_keyed_ratings` reads the folder as the keyed table: for each key
  the row of the latest batch wins, which is the upsert rule of the store.

Progress (which files were consumed) lives in the query's checkpoint
location, which must be on the shared file system.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.quality import clean_ratings, dedup_by_key
from ..sinks.tables import conform, replace_folder
from ..sources.text import parse_ws_ratings, rejected_lines

BATCH_COLUMN = "batch_id"


def start_ratings_ingest(spark: SparkSession, lines_dir: str, table_dir: str,
                         checkpoint_location: str, rejects_dir: str | None = None,
                         available_now: bool = True,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream over the text files below ``lines_dir`` (subfolders
    included: each arrival may be its own folder).  ``available_now``
    processes what is there and stops (a scheduled incremental job); otherwise
    it keeps polling.

    Parsing is strict, as in the batch job: an unreadable line fails the query.
    With ``rejects_dir`` such lines are kept instead, unchanged, in that folder's
    ``batch_id=<n>`` partition (:func:`read_rejects` reads and counts them), and
    the readable ones go on."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))

    def write_batch(rows: DataFrame, batch_id: int, path: str) -> None:
        (rows.withColumn(BATCH_COLUMN, F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH_COLUMN).parquet(path))

    def merge(batch: DataFrame, batch_id: int) -> None:
        ratings = clean_ratings(parse_ws_ratings(batch, lenient=rejects_dir is not None))
        write_batch(conform(ratings, schemas.RATINGS), batch_id, table_dir)
        if rejects_dir is not None:
            write_batch(rejected_lines(batch, "ratings"), batch_id, rejects_dir)

    parsed = reader.load(lines_dir)
    writer = (parsed.writeStream.foreachBatch(merge)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def read_keyed_ratings(spark: SparkSession, table_dir: str) -> DataFrame:
    """The ratings table as of the last completed batch: one row per key, from
    the latest batch that wrote the key."""
    schema = T.StructType(list(schemas.RATINGS.fields) + [T.StructField(BATCH_COLUMN, T.LongType())])
    df = spark.read.schema(schema).parquet(table_dir)
    keys = list(schemas.KEYS["ratings"])
    # First by the other columns ascending = latest batch (negated id), then
    # the smaller rating: the map-side-combined form of the dedup.
    ranked = df.select(*keys, (-F.col(BATCH_COLUMN)).alias("_neg_batch"), "rating")
    latest = dedup_by_key(ranked, keys)
    return latest.select(*schemas.RATINGS.names)


def read_rejects(spark: SparkSession, rejects_dir: str) -> DataFrame:
    """The lines kept as unreadable, ``(value, batch_id)``."""
    schema = T.StructType([T.StructField("value", T.StringType()),
                           T.StructField(BATCH_COLUMN, T.LongType())])
    return spark.read.schema(schema).parquet(rejects_dir)


def compact_ratings(spark: SparkSession, table_dir: str) -> str:
    """Fold all batches into one: afterwards the folder holds one row per key, as
    the latest batch's partition.  Staged and then switched; doing it again
    changes nothing.  Run it between two runs of the stream, not during one."""
    last = spark.read.parquet(table_dir).agg(F.max(BATCH_COLUMN)).first()[0]
    if last is None:
        return table_dir
    rows = read_keyed_ratings(spark, table_dir).withColumn(BATCH_COLUMN, F.lit(last).cast("bigint"))
    return replace_folder(spark, table_dir, lambda staged: rows.write.partitionBy(BATCH_COLUMN).parquet(staged))

"""Stored tables: overwrite, key-wise upsert, clustered layouts, DDL (K1, K2,
K4, K5).

Executors write their own partitions; nothing passes through the driver.  A write
makes new folders and then one commit (:mod:`ratewise.sinks.versions`); a table may
also be registered in the session catalog, at the folder of its last commit.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import checked_cast
from ..operators.quality import dedup_by_key
from .versions import (
    file_system,
    fresh_folder,
    publish,
    relative,
    remove,
    split_path,
    table_folders,
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name and cast to the stored types; a value
    that does not fit raises rather than wrapping, with or without ANSI mode."""
    def column(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if df.schema[f.name].dataType == f.dataType:
            return c.alias(f.name)
        if isinstance(f.dataType, (T.NumericType, T.BooleanType)):
            return checked_cast(c, f.dataType.simpleString()).alias(f.name)
        return c.cast(f.dataType).alias(f.name)
    return df.select(*[column(f) for f in schema.fields])


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], object]) -> str:
    """``write`` a complete folder beside ``path`` and rename it into its place: for
    folders whose layout a streaming sink prescribes.  A reader may find no folder
    between the renames, so run it while nothing reads; tables are committed instead."""
    fs, fs_path = file_system(spark, path)
    parent, name = split_path(path)
    staged, old = (f"{parent}/_{kind}-{name}-{uuid.uuid4().hex[:12]}" for kind in ("staged", "replaced"))
    try:
        write(staged)
    except BaseException:
        remove(spark, staged)
        raise
    had = fs.exists(fs_path(path))
    if had and not fs.rename(fs_path(path), fs_path(old)):
        raise OSError(f"cannot replace {path}")
    if not fs.rename(fs_path(staged), fs_path(path)):
        if had:
            fs.rename(fs_path(old), fs_path(path))
        raise OSError(f"cannot move {staged} to {path}")
    if had:
        fs.delete(fs_path(old), True)
    return path


def stage(spark: SparkSession, path: str, write: Callable[[str], object]) -> dict:
    """``write`` a new folder for the table at ``path``; returns the table's entry for a
    commit.  A write that fails leaves nothing."""
    folder = fresh_folder(path)
    try:
        write(folder)
    except BaseException:
        remove(spark, folder)
        raise
    return {"folders": [relative(split_path(path)[0], folder)]}


def commit(spark: SparkSession, path: str, entry: dict) -> str:
    """Make a staged entry the table at ``path``."""
    root, name = split_path(path)
    publish(spark, root, {name: entry})
    return path


def observed(df: DataFrame, observation: Observation | None) -> DataFrame:
    """Count the rows (``rows``) and add up their hashes (``checksum``) in the stage
    that goes on with ``df``, each partition once."""
    if observation is None:
        return df
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), checksum(df).alias("checksum"))


def checksum(df: DataFrame) -> Column:
    """An order-free checksum of the rows: the sum of a 64-bit hash of each, NULLs apart
    from any value.  Two frames of one schema with the same rows, in any order, agree;
    a changed, lost or doubled row shows."""
    values: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        values.append(c.isNull())
        if isinstance(f.dataType, T.ArrayType) and not isinstance(
                f.dataType.elementType, (T.ArrayType, T.StructType, T.MapType)):
            values += [F.transform(c, lambda x: x.isNull()), c]  # a hash skips null elements
        elif isinstance(f.dataType, (T.ArrayType, T.StructType)):
            values.append(F.to_json(c, {"ignoreNullFields": "false"}))
        else:
            values.append(c)
    row = F.xxhash64(*values) if values else F.lit(0)
    return F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0)).cast("string")


def stage_table(df: DataFrame, path: str, schema: T.StructType | None = None,
                fmt: str = "parquet", partition_by: Sequence[str] | None = None,
                options: Mapping[str, str] | None = None,
                observation: Observation | None = None) -> dict:
    """The first half of K1: write ``df`` to a new folder of the table at ``path``."""
    out = conform(df, schema) if schema is not None else df
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    writer = observed(out, observation).write.format(fmt).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return stage(df.sparkSession, path, writer.save)


def load_table_overwrite(df: DataFrame, path: str, schema: T.StructType | None = None,
                         fmt: str = "parquet", partition_by: Sequence[str] | None = None,
                         options: Mapping[str, str] | None = None,
                         observation: Observation | None = None) -> str:
    """K1: replace the table at ``path`` with ``df`` (truncate + load): written beside the
    old one, then committed, so the frame may read the very table that it replaces and a
    write that fails leaves the old table.  With ``partition_by`` the files are laid out
    by those columns, so a later equality filter on them prunes whole folders
    (``PartitionFilters``).

    A partitioned write first rebalances rows on the partition columns: each
    folder then gets a few large files instead of one small file per writer
    task, and AQE still splits a value that holds a large share of the rows
    over several tasks.  ``observation`` gets ``rows`` and ``checksum`` of what is
    written (see :func:`observed`)."""
    return commit(df.sparkSession, path,
                  stage_table(df, path, schema, fmt, partition_by, options, observation))


def _anti_join(current: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``current`` whose key (NULLs equal) is not in ``fresh``."""
    taken = fresh.select(*[F.col(f"`{k}`").alias(f"_new_{i}") for i, k in enumerate(keys)])
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & current[k].eqNullSafe(taken[f"_new_{i}"])
    return current.join(taken, match, "left_anti")


def upsert_frames(current: DataFrame, updates: DataFrame, keys: Sequence[str],
                  fresh: DataFrame | None = None) -> DataFrame:
    """K2 as a plan: rows of ``updates`` win over ``current`` rows with an equal
    key (a NULL key equals a NULL key); within ``updates`` one row per key is
    kept (the first in a total order).  When the planner estimates the update
    batch under the broadcast threshold, the anti-join broadcasts it and the
    stored side is only scanned; otherwise both sides are hash-partitioned on
    the key (keys are unique, so no key is hot) and AQE may still switch to a
    broadcast once the batch's size is measured.  ``fresh`` is the batch
    already reduced to one row per key, if the caller has it."""
    keys = list(keys)
    if fresh is None:
        fresh = dedup_by_key(updates.select(*current.columns), keys)
    return _anti_join(current, fresh, keys).unionByName(fresh)


def upsert_by_key(spark: SparkSession, current_path: str, updates: DataFrame,
                  keys: Sequence[str], out_path: str | None = None, fmt: str = "parquet",
                  schema: T.StructType | None = None) -> str:
    """K2: merge ``updates`` into the table at ``current_path``.

    A keyed table (:mod:`ratewise.sinks.keyed`) with these keys is updated in place, only
    the partitions that the batch touches.  Any other table, or with another
    ``out_path``, is written whole; the batch is planned and shuffled once: its rows, one
    per key, are staged and read twice from there, then removed."""
    from .keyed import keyed_layout, upsert_keyed_table
    out_path = out_path or current_path
    layout = keyed_layout(spark, current_path)
    if layout is not None and out_path == current_path and list(keys) == layout["keys"]:
        upsert_keyed_table(spark, current_path, updates)
        return out_path
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    current = reader.load(table_folders(spark, current_path))
    batch = f"{fresh_folder(out_path)}-batch"
    one = dedup_by_key(updates.select(*current.columns), list(keys))
    one = conform(one, current.schema)
    try:
        one.write.format(fmt).save(batch)
        merged = upsert_frames(current, updates, keys,
                               spark.read.format(fmt).schema(current.schema).load(batch))
        return load_table_overwrite(merged, out_path, schema=schema, fmt=fmt)
    finally:
        remove(spark, batch)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _location(spark: SparkSession, table: str) -> str | None:
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_name(table)}").where(
        "col_name = 'Location'").select("data_type").collect()
    return rows[0][0] if rows else ""


def _plain_path(path: str) -> str:
    return re.sub(r"^file:/*", "/", path).rstrip("/")


def _same_table(spark: SparkSession, table: str, schema: T.StructType, bucket_by: str,
                sort_by: Sequence[str], buckets: int) -> bool:
    """Whether the catalog's table has this schema and bucket spec."""
    if [(f.name, f.dataType) for f in spark.table(table).schema] != [(f.name, f.dataType) for f in schema]:
        return False
    told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_name(table)}").collect()}
    columns = lambda k: re.findall(r"`([^`]*)`", told.get(k, ""))
    return (told.get("Num Buckets") == str(buckets) and columns("Bucket Columns") == [bucket_by]
            and columns("Sort Columns") == list(sort_by))


def point_table(spark: SparkSession, table: str, folder: str) -> None:
    """Move a catalog table to another folder, in one catalog change."""
    spark.sql(f"ALTER TABLE {_name(table)} SET LOCATION {_literal(folder)}")
    spark.catalog.refreshTable(table)


def _is_at(location: str, path: str) -> bool:
    """Whether a catalog location is the table at ``path`` or one of its folders."""
    root, name = split_path(_plain_path(path))
    at = _plain_path(location)
    return at == f"{root}/{name}" or at.startswith(f"{root}/_versions/{name}/")


def hot_keys(df: DataFrame, key: str, buckets: int, share: int = 16) -> DataFrame:
    """The values of ``key`` with more than 1/``share`` of an average bucket's rows.
    Fewer than ``share * buckets`` values can have that many, so they may be
    broadcast.  Rows are counted map-side first."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    limit = counts.agg((F.sum("_n") / (share * buckets)).alias("_limit"))
    total = limit.first()["_limit"]
    return counts.where(F.col("_n") > F.lit(float(total or 0))).select(key)


def stage_clustered(df: DataFrame, path: str, bucket_by: str = "user_id", buckets: int = 64,
                    sort_by: Sequence[str] = ("user_id", "movie_id", "timestamp"),
                    fmt: str = "parquet", observation: Observation | None = None,
                    split_hot: bool = False, row_group_bytes: int | None = None) -> dict:
    """Write the files of :func:`write_clustered_by_key`; returns the entry for a commit.

    With ``split_hot``, keys that would make a bucket uneven (:func:`hot_keys`) go to a
    folder of their own, in files of equal size by range of the sort columns, however
    many rows one key has.  A key is in the buckets or there, never in both."""
    spark, (root, _) = df.sparkSession, split_path(path)
    options = {"parquet.block.size": str(row_group_bytes)} if row_group_bytes else {}
    folder, staged_table = fresh_folder(path), f"ratewise_staged_{uuid.uuid4().hex[:12]}"
    hot, rows_folder = None, None
    if not split_hot:
        even = observed(df.hint("rebalance", buckets, bucket_by), observation)
    else:
        # both parts are written from one stored copy, counted as it is written
        rows_folder = f"{fresh_folder(path)}-rows"
        observed(df, observation).write.format(fmt).save(rows_folder)
        source = spark.read.format(fmt).schema(df.schema).load(rows_folder)
        keys = F.broadcast(hot_keys(source, bucket_by, buckets))
        same = source[bucket_by].eqNullSafe(keys[bucket_by])
        even = source.join(keys, same, "left_anti").hint("rebalance", buckets, bucket_by)
        hot = source.join(keys, same, "left_semi")
    written = [folder]
    try:
        (even.write.format(fmt).options(**options)
         .bucketBy(buckets, bucket_by).sortBy(*sort_by)
         .option("path", folder).saveAsTable(staged_table))
        if hot is not None:
            written.append(fresh_folder(path))
            (hot.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
             .write.format(fmt).options(**options).save(written[1]))
    except BaseException:
        for f in written:
            remove(spark, f)
        raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {_name(staged_table)}")  # external: the files stay
        if rows_folder:
            remove(spark, rows_folder)
    return {"folders": [relative(root, f) for f in written],
            "clustered": {"by": bucket_by, "buckets": buckets, "sort": list(sort_by)}}


def register_clustered(spark: SparkSession, table_name: str, path: str, schema: T.StructType,
                       entry: Mapping, fmt: str = "parquet") -> None:
    """Put the bucketed folder of a committed entry into the catalog as ``table_name``:
    one change of its location if the table is there with the same columns and
    buckets, else it is created anew."""
    folder = f"{split_path(path)[0]}/{entry['folders'][0]}"
    c = entry["clustered"]
    if _location(spark, table_name) is not None:
        if _same_table(spark, table_name, schema, c["by"], c["sort"], c["buckets"]):
            point_table(spark, table_name, folder)
            return
        spark.sql(f"DROP TABLE {_name(table_name)}")
    cols = ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {_name(table_name)} ({cols}) USING {fmt} CLUSTERED BY ({_name(c['by'])}) "
              f"SORTED BY ({', '.join(map(_name, c['sort']))}) INTO {c['buckets']} BUCKETS "
              f"LOCATION {_literal(folder)}")


def own_table(spark: SparkSession, table_name: str, path: str) -> None:
    """Raise unless ``table_name`` is free or already the table at ``path``."""
    at = _location(spark, table_name)
    if at is not None and not _is_at(at, path):
        raise ValueError(f"table {table_name} exists at {at or 'no location'}, not at {path}")


def write_clustered_by_key(df: DataFrame, table_name: str, path: str,
                           bucket_by: str = "user_id", buckets: int = 64,
                           sort_by: Sequence[str] = ("user_id", "movie_id", "timestamp"),
                           fmt: str = "parquet", observation: Observation | None = None,
                           split_hot: bool = False, row_group_bytes: int | None = None) -> DataFrame:
    """K4: partition key + clustering order.  Rows are hash-bucketed by
    ``bucket_by`` and sorted by ``sort_by`` inside each bucket file; the table
    is committed at ``path`` and registered as ``table_name``.  A later aggregate or
    join on ``bucket_by`` reads it without an exchange; a look-up of one key reads one
    bucket, and of that the row groups whose statistics hold the key.

    Before writing, rows are rebalanced on the bucket key into ``buckets``
    partitions (the same hash as the bucket id, so normally one file per
    bucket).  Unlike a plain repartition, a rebalance lets AQE split a
    partition that one hot key makes too large: that bucket is then written by
    several tasks, as several files.  A bucket is still read by one task, so with
    ``split_hot`` hot keys are stored apart (:func:`stage_clustered`) and the catalog's
    table holds the others; ``plans.Store`` reads both.  Size ``buckets`` so an ordinary
    bucket stays well under a task's memory at the target scale.

    A table of that name at another location is never replaced."""
    spark = df.sparkSession
    own_table(spark, table_name, path)
    entry = stage_clustered(df, path, bucket_by, buckets, sort_by, fmt, observation, split_hot,
                            row_group_bytes)
    commit(spark, path, entry)
    register_clustered(spark, table_name, path, df.schema, entry, fmt)
    return spark.table(table_name)


def stage_range_clustered(df: DataFrame, path: str, by: Sequence[str],
                          schema: T.StructType | None = None, fmt: str = "parquet",
                          observation: Observation | None = None,
                          row_group_bytes: int | None = None) -> dict:
    """Write ``df`` in ranges of ``by``, each file sorted by it: a filter on leading columns
    of ``by`` then reads only the row groups whose statistics allow a match.  End ``by``
    with the table's key, so that one value of the leading columns, however many rows
    have it, is spread over several files."""
    out = conform(df, schema) if schema is not None else df
    options = {"parquet.block.size": str(row_group_bytes)} if row_group_bytes else {}
    # counted after the exchange: its boundaries are sampled from the rows below it
    ranged = observed(out.repartitionByRange(*by).sortWithinPartitions(*by), observation)
    entry = stage(df.sparkSession, path, ranged.write.format(fmt).options(**options).save)
    return {**entry, "ranges": list(by)}


def bucket_bytes(spark: SparkSession, path: str) -> dict[int, int]:
    """Bytes of every bucket of a bucketed table's folder (one listing)."""
    fs, fs_path = file_system(spark, path)
    sizes: dict[int, int] = {}
    for status in fs.listStatus(fs_path(table_folders(spark, path)[0])):
        m = re.search(r"_(\d{5})(?:\.|$)", status.getPath().getName())
        if m:
            sizes[int(m[1])] = sizes.get(int(m[1]), 0) + status.getLen()
    return sizes


def even_buckets(spark: SparkSession, path: str, factor: float = 2.0) -> bool:
    """Whether no bucket holds more than ``factor`` times the median one.  A
    bucketed scan is one task a bucket, which adaptive execution cannot split,
    so an uneven table is better read by path."""
    sizes = sorted(bucket_bytes(spark, path).values())
    return not sizes or sizes[-1] <= factor * sizes[len(sizes) // 2]


def result_table_statements(root: str, tables: Mapping[str, T.StructType] = schemas.TABLES,
                            fmt: str = "parquet", prefix: str = "") -> list[str]:
    """The Spark SQL statements that drop and create every table at
    ``root/<name>``."""
    out = []
    for name, schema in tables.items():
        cols = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        out += [f"DROP TABLE IF EXISTS {_name(prefix + name)}",
                f"CREATE TABLE {_name(prefix + name)} (\n  {cols}\n) USING {fmt} "
                f"LOCATION {_literal(root.rstrip('/') + '/' + name)}"]
    return out


def result_tables_ddl(root: str, tables: Mapping[str, T.StructType] = schemas.TABLES,
                      fmt: str = "parquet", prefix: str = "") -> str:
    """The statements as one text (to keep as a ``.sql`` file)."""
    lines = [s + ";" for s in result_table_statements(root, tables, fmt, prefix)]
    return "\n\n".join("\n".join(lines[i:i + 2]) for i in range(0, len(lines), 2)) + "\n"


def create_result_tables(spark: SparkSession, root: str,
                         tables: Mapping[str, T.StructType] = schemas.TABLES,
                         fmt: str = "parquet", prefix: str = "") -> list[str]:
    """K5: drop-if-exists and create each table (empty, fixed schema); rows that an
    earlier table of ``root`` had are gone, for all tables in one commit.  Returns the
    catalog names."""
    for statement in result_table_statements(root, tables, fmt, prefix):
        spark.sql(statement)
    root = root.rstrip("/")
    entries = {name: stage_table(spark.createDataFrame([], schema), f"{root}/{name}", fmt=fmt)
               for name, schema in tables.items()}
    publish(spark, root, entries)
    for name, entry in entries.items():
        point_table(spark, prefix + name, f"{root}/{entry['folders'][0]}")
    return [f"{prefix}{name}" for name in tables]

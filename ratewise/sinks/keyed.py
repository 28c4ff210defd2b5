"""Keyed tables in hash partitions (K2): an upsert replaces only the partitions
that its batch touches.

Rows lie in folders ``_part=<k>`` by a hash of some key columns (``by``).  An upsert
writes its batch, one row per key, in the same layout, so the batch's folders name the
touched partitions without another pass; it reads those partitions of the table alone,
merges, writes them to a new folder and commits a list of folders in which all other
partitions are the old files.  Readers see the old or the new list.

``by`` all key columns spreads rows evenly.  Fewer columns keep rows together that
arrive together (all ratings of a user), so a batch touches fewer partitions and
:func:`rows_of_key` reads one of them; a hot value then makes its partition large, but
a partition is any number of files, read, merged and written by many tasks.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import dedup_by_key
from .tables import conform, upsert_frames
from .versions import fresh_folder, names_in, publish, relative, remove, split_path, table_entry

PART = "_part"


def part_of(by: Sequence[str], parts: int) -> Column:
    """The partition of a row; NULLs hash like any value."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in by]), F.lit(parts)).cast("int")


def _write_parts(rows: DataFrame, folder: str, by: Sequence[str], parts: int, fmt: str) -> dict[str, str]:
    """Write by partition, each to a few files (a large one by several tasks);
    returns the folder of every partition that has rows."""
    out = rows.withColumn(PART, part_of(by, parts)).hint("rebalance", PART)
    out.write.format(fmt).partitionBy(PART).save(folder)
    prefix = f"{PART}="
    return {n[len(prefix):]: f"{folder}/{n}" for n in names_in(rows.sparkSession, folder)
            if n.startswith(prefix)}


def _entry(root: str, folders: Mapping[str, str], layout: Mapping[str, object]) -> dict:
    places = {k: f if not f.startswith(root) else relative(root, f) for k, f in folders.items()}
    return {"folders": [places[k] for k in sorted(places, key=int)],
            "keyed": {**layout, "places": places}}


def write_keyed_table(df: DataFrame, path: str, keys: Sequence[str], parts: int = 64,
                      by: Sequence[str] | None = None, schema: T.StructType | None = None,
                      fmt: str = "parquet") -> str:
    """Replace the table at ``path`` by ``df`` in hash partitions.  ``df`` holds one row
    per key.  Size ``parts`` so that a partition is a few files' worth."""
    spark, (root, name) = df.sparkSession, split_path(path)
    out = conform(df, schema) if schema is not None else df
    by = list(by or keys)
    if not set(by) <= set(keys):
        raise ValueError("a table is partitioned by some of its key columns")
    layout = {"keys": list(keys), "by": by, "parts": parts, "format": fmt, "schema": out.schema.json()}
    folders = _write_parts(out, fresh_folder(path), by, parts, fmt)
    publish(spark, root, {name: _entry(root, folders, layout)})
    return path


def _read(spark: SparkSession, root: str, layout: Mapping, places: Sequence[str]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(layout["schema"]))
    if not places:
        return spark.createDataFrame([], schema)
    return spark.read.format(layout["format"]).schema(schema).load([f"{root}/{p}" for p in places])


def keyed_layout(spark: SparkSession, path: str) -> dict | None:
    """The layout of a keyed table, None for any other."""
    return (table_entry(spark, path) or {}).get("keyed")


def read_keyed_table(spark: SparkSession, path: str) -> DataFrame:
    layout = keyed_layout(spark, path)
    if layout is None:
        raise ValueError(f"no keyed table at {path}")
    return _read(spark, split_path(path)[0], layout, list(layout["places"].values()))


def rows_of_key(spark: SparkSession, path: str, **values) -> DataFrame:
    """The rows whose columns have these values.  If all partitioning columns are given,
    only the files of one partition are read."""
    layout = keyed_layout(spark, path)
    if layout is None:
        raise ValueError(f"no keyed table at {path}")
    schema = T.StructType.fromJson(json.loads(layout["schema"]))
    places = layout["places"]
    if set(layout["by"]) <= set(values):
        row = spark.range(1).select(*[F.lit(values[c]).cast(schema[c].dataType).alias(c)
                                      for c in layout["by"]])
        part = row.select(part_of(layout["by"], layout["parts"])).first()[0]
        places = {k: p for k, p in places.items() if k == str(part)}
    rows = _read(spark, split_path(path)[0], layout, list(places.values()))
    for name, value in values.items():
        rows = rows.where(F.col(f"`{name}`").eqNullSafe(F.lit(value).cast(schema[name].dataType)))
    return rows


def upsert_keyed_table(spark: SparkSession, path: str, updates: DataFrame) -> list[int]:
    """K2 in place: rows of ``updates`` replace rows of an equal key (NULLs equal), other
    keys are added; of several updates to a key the first in a total order counts.
    Returns the partitions that were replaced."""
    root, name = split_path(path)
    entry = table_entry(spark, path)
    layout = (entry or {}).get("keyed")
    if layout is None:
        raise ValueError(f"no keyed table at {path}")
    keys, by, parts, fmt = layout["keys"], layout["by"], layout["parts"], layout["format"]
    schema = T.StructType.fromJson(json.loads(layout["schema"]))
    batch = f"{fresh_folder(path)}-batch"
    try:
        one = conform(dedup_by_key(updates.select(*schema.names), keys), schema)
        arrived = _write_parts(one, batch, by, parts, fmt)
        if not arrived:
            return []
        fresh = spark.read.format(fmt).schema(schema).load(list(arrived.values()))
        current = _read(spark, root, layout, [p for k, p in layout["places"].items() if k in arrived])
        folder = fresh_folder(path)
        replaced = _write_parts(upsert_frames(current, fresh, keys, fresh), folder, by, parts, fmt)
        publish(spark, root, {name: _entry(root, {**layout["places"], **replaced}, {
            k: v for k, v in layout.items() if k != "places"})}, read={name: entry})
        return sorted(int(k) for k in replaced)
    finally:
        remove(spark, batch)

"""Helpers shared by the training-data operators: stored intermediates, text
batches, word hashing in numpy, group runs and connected components."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

#: Rows per Arrow batch for whole texts: bounds a Python worker's memory when
#: every text of a batch is long.
TEXT_BATCH_ROWS = 1000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_noted: list[list[str]] = []


@contextmanager
def noting() -> Iterator[list[str]]:
    """The paths that :func:`stored` writes meanwhile, so that they can be removed when
    what is made from them has been written."""
    made: list[str] = []
    _noted.append(made)
    try:
        yield made
    finally:
        _noted.remove(made)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts
    the lineage so that a lost executor costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    for made in _noted:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove stored tables that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


_kept: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """``make()``, kept in this Python worker for its later tasks, in place of what was
    kept under another key."""
    if key not in _kept:
        let_go()
        _kept[key] = make()
    return _kept[key]


def let_go() -> None:
    """Drop what an operator kept in this Python worker.  Spark hands the workers on from
    stage to stage, so without this a table that only one operator reads would stay in the
    executor's memory through all that run after it."""
    _kept.clear()


#: Tables of at most so many bytes are broadcast to a join.
BROADCAST_BYTES = 64 << 20
_ROW_BYTES, _VALUE_BYTES, _ELEMENT_BYTES = 16, 8, 16


def sized(table: DataFrame) -> DataFrame:
    """A stored table of numbers, or short lists or maps of them, with a broadcast hint
    up to BROADCAST_BYTES (counted, not estimated) and a sort-merge hint beyond."""
    size = F.lit(_ROW_BYTES + _VALUE_BYTES * len(table.columns)).cast("long")
    for f in table.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType)):
            size = size + _ELEMENT_BYTES * F.greatest(F.size(f"`{f.name}`"), F.lit(0))
    total = table.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(table) if total <= BROADCAST_BYTES else table.hint("merge")


def small_batches(spark: SparkSession, rows: int = TEXT_BATCH_ROWS) -> None:
    """Lower the session's Arrow batch size to ``rows`` (never raises it)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def uniform(*columns) -> Column:
    """A number in [0, 1) from a hash of the columns: the same on every run.  A
    sample of about ``k`` of ``n`` rows first keeps ``uniform * n <= 3 * k``, so that
    its sort and its way to the driver do not grow with the number of tasks."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) / F.lit(float(1 << 40))


def plain(df: DataFrame, **columns: str) -> DataFrame:
    """Only the needed columns, cast; a duplicated or extra column of the input
    never reaches the operator (``plain(df, doc_id="long", text="string")``)."""
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in columns.items()])


# --- numpy hashing -------------------------------------------------------------

_U = np.uint64
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> _U(30))
    x = x * _M1
    x = x ^ (x >> _U(27))
    x = x * _M2
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    if n > 1:
        out[1:] = _U(base)
        np.multiply.accumulate(out, out=out)
    return out


_TABLES: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _TABLES or len(_TABLES["p"]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        _TABLES["p"], _TABLES["i"] = _powers(_P, size), _powers(_P_INV, size)
    return _TABLES["p"], _TABLES["i"]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all texts, A-Z
    lower-cased, and per text the number of words.  Whole texts, vectorised."""
    data = b"\n".join([t.encode("utf-8", "surrogatepass") for t in texts])
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    lengths = np.fromiter((len(t.encode("utf-8", "surrogatepass")) if not t.isascii() else len(t)
                           for t in texts), np.int64, len(texts))
    first = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    space = _SPACE[b]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    power, inverse = _power_tables(len(b) + 1)
    total = np.empty(len(b) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[_LOWER[b]] * power[:len(b)], out=total[1:])
    h = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    counts = np.diff(np.concatenate((np.searchsorted(starts, first), [len(starts)])))
    return h, counts


def shingle_sets(texts: list[str | None], words: int, block: int = 1 << 18
                 ) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Yields ``(first index, sorted distinct shingle hashes per text)`` in
    blocks of about ``block`` characters, which take up to 55 bytes each, 32 of them (the
    powers) for good.  Fewer than ``words`` words: the whole sequence as one shingle; no
    word: the empty set."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size < block):
            size += len(texts[j] or "")
            j += 1
        part = [t or "" for t in texts[i:j]]
        h, counts = word_hashes(part)
        n = len(h)
        s = np.zeros(max(0, n - words + 1), np.uint64)
        for k in range(words):
            s = mix(s + h[k:k + len(s)] * _U(2 * k + 3)) if len(s) else s
        at = np.concatenate(([0], np.cumsum(counts)))
        out = []
        for a, b in zip(at[:-1], at[1:]):
            if b - a >= words:
                out.append(np.unique(s[a:b - words + 1]))
            elif b > a:
                one = _U(b - a)
                for x in h[a:b]:
                    one = mix(np.array([one], np.uint64) * _M1 + x)[0]
                out.append(np.array([one], np.uint64))
            else:
                out.append(np.empty(0, np.uint64))
        yield i, out
        i = j


def runs(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of equal ``keys`` of batches that come sorted by them; a group
    may span batches, so callers bound the size of a group."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        if held:
            pdf = pd.concat([*held, pdf], ignore_index=True)
        change = np.zeros(len(pdf) - 1, bool)
        for k in keys:
            v = pdf[k].to_numpy()
            change |= v[1:] != v[:-1]
        cuts = np.concatenate(([0], np.flatnonzero(change) + 1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield pdf.iloc[a:b]
        held = [pdf.iloc[cuts[-1]:]]
    if held:
        yield held[0]


class Forest:
    """Union-find over positions 0..n-1, for groups of bounded size."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


# --- connected components ---------------------------------------------------------

def _starred(e: DataFrame) -> bool:
    """Whether every edge ``(u, v)`` leads from a leaf to the centre of its star."""
    ends = e.select(F.col("u").alias("n"), F.lit(1).alias("leaf")).unionAll(
        e.select(F.col("v").alias("n"), F.lit(0).alias("leaf")))
    seen = ends.groupBy("n").agg(F.sum("leaf").alias("up"), F.max(1 - F.col("leaf")).alias("centre"))
    return not seen.where("up > 1 OR (up = 1 AND centre = 1)").limit(1).count()


#: Edges that one task connects by itself: 32 MB of them.
LOCAL_EDGES = 1 << 21


def _hooked(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Components of all the edges ``(u, v)``: every node takes the least name among its
    neighbours', and names are followed to their own, until nothing changes."""
    parts = [pdf for pdf in batches if len(pdf)]
    if not parts:
        return
    u, v = (np.concatenate([p[c].to_numpy() for p in parts]) for c in ("u", "v"))
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    u, v = at[:len(u)], at[len(u):]
    name = np.arange(len(nodes))  # positions are in the order of the nodes
    while True:
        least = np.minimum(name[u], name[v])
        new = name.copy()
        for ends in (u, v, name[u], name[v]):
            np.minimum.at(new, ends, least)
        while (new[new] != new).any():
            new = new[new]
        if (new == name).all():
            break
        name = new
    for i in range(0, len(nodes), 1 << 18):
        yield pd.DataFrame({"node": nodes[i:i + (1 << 18)], "component": nodes[name[i:i + (1 << 18)]]})


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows ``(node, component)``, the
    component named by its smallest node; nodes without an edge to another node
    are left out.

    Up to LOCAL_EDGES distinct edges (counted; 16 bytes each) one task hooks them
    together.  More take alternating large-star and small-star steps over stored edge
    tables, until every component is a star around its smallest node: each step is a
    grouped minimum (combined map-side) and a join of two stored tables (AQE splits a
    hot star).  Nothing but a count reaches the driver."""
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"),
                                            F.least("a", "b").alias("v")).distinct(), "edges")
    if e.count() <= LOCAL_EDGES:
        return stored(e.coalesce(1).mapInPandas(_hooked, "node long, component long"), "components")
    while not _starred(e):
        # large star: every larger neighbour of a node moves to the node's minimum
        low = stored(e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
                     .groupBy("u").agg(F.min("v").alias("m"))
                     .select(F.col("u").alias("v"), F.least("u", "m").alias("m")), "low")
        large = stored(e.join(low, "v").select("u", F.col("m").alias("v")).where("u <> v"), "large")
        # small star: smaller neighbours of a node, and the node, move to its minimum
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"),
                                                              F.col("m").alias("v"))
        e = stored(moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component")))

"""Embedding near-duplicates: a pivot-permutation index.

Vectors are described by their ``PREFIX`` nearest reference points (pivots), in
order.  Each pivot has an inverted list of the vectors that name it; two vectors
are compared if they share at least ``SHARED`` pivots, which is counted in the
list of their smallest shared one, so that a pair is met once; then the cosine
is verified in double precision.  Lists longer than ``CHUNK`` are compared in
pairs of chunks.

Pivots come from a bounded sample of twice their number, chosen by a hash of the
id; there are ``2 * sqrt(n)`` of them, between ``MIN_PIVOTS`` and ``MAX_PIVOTS``, if
so many are apart.  Every vector is indexed.  Lists then hold about
``PREFIX * sqrt(n) / 2`` vectors.  Encoders often crowd their vectors into a narrow
cone, where all would name the same few pivots; so pivots are chosen and ranked as
seen from the sample's centre.  Recall against brute force is measured in the tests
(at least 0.9 by contract; 0.99 and more on the given tables, 0.97 and more in cones
of mean cosine 0.8).  In a cone of mean cosine above ``1 - 4 * (1 - threshold)`` the
centre is not used: few pivots are apart then, so lists are long.

Equal vectors form a class and are indexed once.  Each block of a list returns a
number of links per vector and edges of a spanning forest, so a group of
thousands of near copies does not become all its pairs.

Cases: vectors that are null, empty, zero, or hold a null or non-finite component
link with nothing; vectors of different lengths are never linked; repeated ids
are one vector per row; rows without an id are dropped; an empty table gives no
rows; labels and other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Forest, components, read, runs, small_batches, stored, uniform

PREFIX, SHARED, CHUNK = 8, 2, 1024
MIN_PIVOTS, MAX_PIVOTS = 64, 4096
#: Sampled vectors this close to an earlier one, as seen from the centre, are not pivots.
PIVOT_COSINE = 0.7


def _unit(v) -> np.ndarray | None:
    """The vector at length one, in double precision; None if it links with nothing."""
    if v is None:
        return None
    try:
        x = np.asarray(v, np.float64)
    except (TypeError, ValueError):
        return None
    if not len(x) or not np.isfinite(x).all() or not x.any():
        return None
    x = x / np.abs(x).max()
    return x / np.sqrt(x @ x)


def vector_classes(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, digest, dim, unit)``; the last three are null for vectors that
    link with nothing.  Equal vectors have equal digests."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            units = [_unit(v) for v in pdf["embedding"]]
            raw = [None if u is None else (np.asarray(v, np.float64) + 0.0).tobytes()
                   for u, v in zip(units, pdf["embedding"])]
            yield pd.DataFrame({
                "vec_id": pdf["vec_id"],
                "digest": [None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw],
                "dim": pd.array([None if u is None else len(u) for u in units], dtype="Int32"),
                "unit": [None if u is None else u.tobytes() for u in units]})

    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where("vec_id IS NOT NULL").mapInPandas(
        run, "vec_id long, digest binary, dim int, unit binary")


def _matrix(units) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)


def apart(vectors: np.ndarray, limit: float = PIVOT_COSINE) -> np.ndarray:
    """The vectors, in order, without those at a cosine of ``limit`` or more to an
    earlier one."""
    keep = np.empty_like(vectors)
    n = 0
    for v in vectors:
        if not n or (keep[:n] @ v).max() < limit:
            keep[n] = v
            n += 1
    return keep[:n]


def reference_points(sample: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Centre and pivots, unit vectors as seen from the centre, of a sample.

    Near copies are thinned out before the mean is taken, so that a group of them
    neither draws the centre to itself nor crowds the prefixes.  Seen from the
    centre, a pair at the threshold must keep a cosine of 3/4 on average; where
    vectors lie too close around it for that, the centre is the origin."""
    gap = 1 - threshold
    thin = apart(sample, max(PIVOT_COSINE, 1 - 2 * gap))
    centre = thin.mean(0)
    if 1 - centre @ centre < 4 * gap:
        centre = np.zeros_like(centre)
    seen = thin - centre
    length = np.sqrt((seen * seen).sum(1))
    far = length > 1e-6
    return centre, apart(seen[far] / length[far, None])


def index(reps: DataFrame, pivots: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """The inverted lists: ``(dim, pivot, rep, size, prefix, unit)``; ``pivots`` are
    centre and reference points by vector length."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                if dim in pivots:
                    centre, points = pivots[dim]
                    near = (_matrix(list(part["unit"])) - centre) @ points.T
                    k = min(PREFIX, near.shape[1])
                    prefix = np.argpartition(-near, k - 1, axis=1)[:, :k]
                    order = np.argsort(-np.take_along_axis(near, prefix, 1), axis=1, kind="stable")
                    prefix = np.take_along_axis(prefix, order, 1).astype(np.int16)
                else:  # no pivot has this length: one list
                    prefix = np.zeros((len(part), 1), np.int16)
                k = prefix.shape[1]
                at = np.repeat(np.arange(len(part)), k)
                packed = np.array([p.tobytes() for p in prefix], object)
                yield pd.DataFrame({"dim": np.int32(dim), "pivot": prefix.ravel().astype(np.int32),
                                    "rep": part["rep"].to_numpy()[at], "size": part["size"].to_numpy()[at],
                                    "prefix": packed[at], "unit": part["unit"].to_numpy()[at]})
    return reps.mapInPandas(run, "dim int, pivot int, rep long, size long, prefix binary, unit binary")


def compare(lists: DataFrame, threshold: float) -> DataFrame:
    """Verified links of all lists: rows ``(a, b, weight)``; with ``b`` an edge of
    a spanning forest, without it the number of vectors linked to ``a``."""
    sizes = stored(lists.groupBy("dim", "pivot").agg(F.count("*").alias("n")), "lists")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    dealt = lists.join(sizes.where("n > 1"), ["dim", "pivot"]).withColumn("k", chunks).withColumn(
        "c", F.pmod(F.xxhash64("rep"), F.col("k")).cast("int"))
    blocks = dealt.withColumn("d", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select(
        "dim", "pivot", F.least("c", "d").alias("i"), F.greatest("c", "d").alias("j"),
        "rep", "size", "c", "prefix", "unit")
    keys = ["dim", "pivot", "i", "j"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in runs(batches, keys):
            if len(g) < 2:
                continue
            pivot, across = g["pivot"].iloc[0], g["i"].iloc[0] != g["j"].iloc[0]
            prefix = np.frombuffer(b"".join(g["prefix"]), np.int16).reshape(len(g), -1)
            c, rep, size = (g[x].to_numpy() for x in ("c", "rep", "size"))
            need = min(SHARED, prefix.shape[1])
            same = np.zeros((len(g), len(g)), np.int8)
            for a in range(prefix.shape[1]):
                for b in range(prefix.shape[1]):
                    same += prefix[:, a, None] == prefix[None, :, b]
            ok = np.triu(same >= need, 1)
            if across:
                ok &= c[:, None] != c[None, :]
            i, j = np.nonzero(ok)
            if len(i):
                x = _matrix(list(g["unit"]))
                cosine = x @ x.T  # of the whole block: one product
                close = cosine[i, j] >= threshold
                i, j = i[close], j[close]
            if len(i):  # met in the list of the smallest shared pivot alone
                low = np.where(prefix < pivot, prefix, -1)
                lower = np.zeros(len(i), bool)
                for a in range(prefix.shape[1]):
                    for b in range(prefix.shape[1]):
                        lower |= (low[i, a] >= 0) & (low[i, a] == prefix[j, b])
                i, j = i[~lower], j[~lower]
            if not len(i):
                continue
            weight = np.bincount(i, size[j], len(g)) + np.bincount(j, size[i], len(g))
            forest = Forest(len(g))
            edges = [(int(rep[p]), int(rep[q]), 0) for p, q in zip(i.tolist(), j.tolist())
                     if forest.join(p, q)]
            counts = [(int(rep[p]), None, int(weight[p])) for p in np.flatnonzero(weight)]
            out = pd.DataFrame(edges + counts, columns=["a", "b", "weight"])
            yield out.astype({"a": "int64", "b": "Int64", "weight": "int64"})

    return blocks.repartition(*keys).sortWithinPartitions(*keys, "rep").mapInPandas(
        run, "a long, b long, weight long")


def near_vectors(embeddings: DataFrame, threshold: float = 0.95) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every vector."""
    small_batches(embeddings.sparkSession, 4000)
    vectors = stored(vector_classes(embeddings), "vectors")
    full = vectors.where("digest IS NOT NULL")
    classes = stored(full.groupBy("digest").agg(F.min("vec_id").alias("rep"),
                                                F.count("*").alias("size")), "classes")
    reps = stored(full.join(classes.withColumnRenamed("rep", "vec_id"), ["digest", "vec_id"])
                  .select(F.col("vec_id").alias("rep"), "size", "dim", "unit")
                  .dropDuplicates(["rep", "unit"]), "reps")
    n = reps.count()
    wanted = int(min(MAX_PIVOTS, max(MIN_PIVOTS, 2 * n ** 0.5)))
    # a bounded sample
    u = uniform("rep")
    sample = reps.where(u * float(n) <= 3 * wanted).orderBy(u, "rep").limit(2 * wanted).select(
        "dim", "unit").collect()
    pivots: dict[int, list[bytes]] = {}
    for dim, unit in sample:
        pivots.setdefault(dim, []).append(bytes(unit))

    def points(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        centre, found = reference_points(_matrix(units), threshold)
        return centre, found[:wanted]

    lists = stored(index(reps, {d: points(u) for d, u in pivots.items()}), "lists")
    found = stored(compare(lists, threshold), "links")
    linked = stored(found.where("b IS NULL").groupBy("a").agg(F.sum("weight").alias("w")), "linked")
    parts = stored(components(found.where("b IS NOT NULL").select("a", "b")), "components")
    named = stored(
        classes.join(linked.withColumnRenamed("a", "rep"), "rep", "left")
        .join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(
            "digest", (F.col("size") - 1 + F.coalesce("w", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id")), "named")
    return vectors.select("vec_id", "digest").join(named, "digest", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id") == F.col("component_id"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))


#: Exact: every pair of vectors of one length.
OP5_SQL = """
WITH RECURSIVE vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v
  FROM embeddings WHERE vec_id IS NOT NULL
), usable AS MATERIALIZED (
  SELECT r, vec_id, v FROM vectors
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b
  FROM usable a JOIN usable b ON len(a.v) = len(b.v) AND a.r <> b.r
  WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) >= 0.95 END
), reach AS (
  SELECT r AS a, r AS b FROM usable
  UNION
  SELECT x.a, l.b FROM reach x JOIN links l ON x.b = l.a
), component AS (
  SELECT x.a AS r, min(u.vec_id) AS component_id FROM reach x JOIN usable u ON u.r = x.b GROUP BY x.a
), counted AS (
  SELECT a AS r, count(*) AS n_links FROM links GROUP BY a
)
SELECT v.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links,
       coalesce(c.component_id, v.vec_id) AS component_id,
       v.vec_id = coalesce(c.component_id, v.vec_id) AS kept
FROM vectors v LEFT JOIN component c USING (r) LEFT JOIN counted n USING (r)
"""

import math

import numpy as np
import pytest

from ratewise.llm import embeddings
from tests.conftest import SF_MID

SCHEMA = "vec_id long, embedding array<float>, label int, unit string, size int"


def brute(rows):
    ids, ok = [r[0] for r in rows], []
    for _, v in rows:
        good = v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
        x = np.array(v, np.float32).astype(float) if good else None
        ok.append(None if x is None else x / np.linalg.norm(x))
    near = [[j for j, y in enumerate(ok) if j != i and x is not None and y is not None and len(x) == len(y)
             and x @ y >= 0.95] for i, x in enumerate(ok)]
    comp = list(ids)
    while True:
        new = [min([comp[i], *(comp[j] for j in near[i])]) for i in range(len(ids))]
        if new == comp:
            return sorted((ids[i], len(near[i]), comp[i]) for i in range(len(ids)))
        comp = new


def run(spark, rows):
    df = spark.createDataFrame([(i, v, 1, "u", 3) for i, v in rows], SCHEMA)
    got = embeddings.near_vectors(df).collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    return sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got)


def planted(rng, n, dim):
    rows = []
    for i in range(n):
        v = rng.normal(size=dim)
        rows.append((3 * i + 1, v.tolist()))
        for k in range(rng.integers(0, 3)):  # cosines on both sides of the threshold
            u = v + rng.normal(size=dim) * rng.choice([0.05, 0.2, 0.3, 0.36])
            rows.append((3 * i + 5000 * (k + 1), (u * rng.choice([1, 3])).tolist()))
    return rows


def test_links_equal_brute_force(spark):
    rows = planted(np.random.default_rng(6), 150, 32)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("chunk", [7, 1024])
def test_copies_and_near_copies_of_one_vector(spark, monkeypatch, chunk):
    monkeypatch.setattr(embeddings, "CHUNK", chunk)
    rng = np.random.default_rng(7)
    v = rng.normal(size=16)
    rows = [(i, v.tolist()) for i in range(20)] + [
        (100 + i, (v + rng.normal(size=16) * 0.02).tolist()) for i in range(30)] + planted(rng, 20, 16)
    rows = [(i if i < 200 else i + 1000, u) for i, u in rows[:50]] + [(i + 10000, u) for i, u in rows[50:]]
    assert run(spark, rows) == brute(rows)


def test_unusable_vectors_link_with_nothing(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [1.0, float("inf")]),
            (6, [1.0, None]), (7, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [1.0, 2.0, 0.0]), (10, [1e-30, 2e-30]),
            (11, [-1.0, -2.0])]
    assert run(spark, rows) == brute(rows)
    assert embeddings.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_recall_at_the_threshold():
    rng = np.random.default_rng(0)
    v = rng.normal(size=(4000, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    u = rng.normal(size=v.shape)
    u -= (u * v).sum(1)[:, None] * v
    u /= np.linalg.norm(u, axis=1)[:, None]
    y = 0.95 * v + math.sqrt(1 - 0.95 ** 2) * u
    for m in (embeddings.MIN_PIVOTS, 512):
        a, b = (np.argsort(-(x[m:] @ v[:m].T), 1)[:, :embeddings.PREFIX] for x in (v, y))
        shared = (a[:, :, None] == b[:, None, :]).sum((1, 2))
        assert (shared >= embeddings.SHARED).mean() >= 0.99


def _unit_rows(x):
    return x / np.linalg.norm(x, axis=1)[:, None]


def _beside(rng, x):
    """A vector beside each row, at cosines from 0.951 to 0.97."""
    u = rng.normal(size=x.shape)
    u = _unit_rows(u - (u * x).sum(1)[:, None] * x)
    c = rng.uniform(0.951, 0.97, (len(x), 1))
    return c * x + np.sqrt(1 - c * c) * u


def _cone(rng, n, dim, clusters=0):
    """Vectors of mean cosine 0.8, or more within clusters."""
    axis = _unit_rows(rng.normal(size=(1, dim)))
    off = _unit_rows(rng.normal(size=(n, dim)))
    if clusters:
        off = _unit_rows(_unit_rows(rng.normal(size=(clusters, dim)))[rng.integers(0, clusters, n)] + 0.7 * off)
    return _unit_rows(math.sqrt(0.8) * axis + math.sqrt(0.2) * off)


def _hot(rng, n, dim, share):
    """So large a share of near copies of one vector, the rest anywhere."""
    x = _unit_rows(rng.normal(size=(n, dim)))
    m = int(share * n)
    x[:m] = _beside(rng, np.repeat(x[:1], m, 0))
    return x[rng.permutation(n)]


@pytest.mark.parametrize("dim", [64, 256])
@pytest.mark.parametrize("kind", ["anywhere", "cone", "clustered cone", "hot third", "hot most"])
def test_recall_and_lists_in_crowded_spaces(dim, kind):
    rng = np.random.default_rng(4)
    x = {"anywhere": lambda: _unit_rows(rng.normal(size=(3000, dim))),
         "cone": lambda: _cone(rng, 3000, dim),
         "clustered cone": lambda: _cone(rng, 3000, dim, 30),
         "hot third": lambda: _hot(rng, 3000, dim, 1 / 3),
         "hot most": lambda: _hot(rng, 3000, dim, 0.8)}[kind]()
    x = np.vstack([x, _beside(rng, x[::3])])
    wanted = int(2 * len(x) ** 0.5)
    centre, points = embeddings.reference_points(x[rng.permutation(len(x))[:2 * wanted]], 0.95)
    points = points[:wanted]
    near = np.argsort(-((x - centre) @ points.T), 1)[:, :embeddings.PREFIX]
    named = np.zeros((len(x), len(points)), np.float32)
    np.put_along_axis(named, near, 1, 1)
    links = np.triu(x @ x.T >= 0.95, 1)
    met = named @ named.T >= embeddings.SHARED
    assert (links & met).sum() >= 0.97 * links.sum()
    if not kind.startswith("hot"):
        lists = named.sum(0)
        assert lists.max() <= 4 * np.median(lists[lists > 0])
        assert len(points) >= 30  # one a cluster at least


def test_cone_equals_brute_force(spark):
    rng = np.random.default_rng(12)
    x = _cone(rng, 300, 48, 6)
    x = np.vstack([x, x[:40], _beside(rng, x[40:50])])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    assert run(spark, rows) == brute(rows)


def test_given_embeddings(spark):
    table = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in table.collect()]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in embeddings.near_vectors(table).collect())
    assert got == brute(rows)

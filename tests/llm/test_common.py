import random
import re
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from ratewise.llm import common
from ratewise.llm.common import components, runs, shingle_sets, word_hashes


def forest(edges):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


@pytest.mark.parametrize("local", [0, 1 << 21])  # by tables, and by one task
def test_components_of_random_path_and_star_graphs(spark, monkeypatch, local):
    monkeypatch.setattr(common, "LOCAL_EDGES", local)
    rng = random.Random(5)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(30)]
    edges += [(1000 + i, 1001 + i) for i in range(40)]          # a sorted path
    edges += [(3000 + 7 * i % 101, 3000) for i in range(1, 90)]  # a star
    edges += [(5, 5), (9000, 9000)]                              # loops
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    want = forest([e for e in edges if e[0] != e[1]])
    assert got == want


def test_components_of_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_follow_the_words():
    texts = ["Aa b\tC", "", "aA\x0bb c ", " é É", "\n\n"]
    h, counts = word_hashes(texts)
    assert counts.tolist() == [3, 0, 3, 2, 0]
    assert h[:3].tolist() == h[3:6].tolist()     # case and white space aside
    assert h[6] != h[7]                          # only A-Z is lower-cased


def test_shingle_sets_count_distinct_shingles():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 40))) for _ in range(200)] + [None]
    got = [s for _, part in shingle_sets(texts, 3, block=500) for s in part]
    for t, s in zip(texts, got):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        want = {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())
        assert len(s) == len(want)
        assert (np.sort(s) == s).all()


def test_shingle_sets_hold_little_of_a_long_batch(monkeypatch):
    monkeypatch.setattr(common, "_TABLES", {})
    texts = ["one two three four five six seven eight nine ten " * 40] * 2000  # 4 MB
    tracemalloc.start()
    try:
        for _, part in shingle_sets(texts, 5):
            assert all(len(s) == 10 for s in part)
        left, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert peak < 24 << 20 and left < 10 << 20


def test_what_a_worker_keeps_goes_when_another_table_comes():
    a = common.kept("a", lambda: [1])
    assert common.kept("a", lambda: [2]) is a
    assert common.kept("b", lambda: [3]) == [3] and common.kept("a", lambda: [4]) == [4]
    common.let_go()
    assert common.kept("a", lambda: [5]) == [5]
    common.let_go()


def test_runs_join_groups_over_batches():
    frames = [pd.DataFrame({"k": [1, 1, 2]}), pd.DataFrame({"k": []}), pd.DataFrame({"k": [2, 2]}),
              pd.DataFrame({"k": [3]})]
    assert [(g["k"].iloc[0], len(g)) for g in runs(frames, ["k"])] == [(1, 2), (2, 3), (3, 1)]

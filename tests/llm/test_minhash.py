import random
import re
import string

import pytest

from ratewise.llm import common, minhash
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, rep string, digest int, component string"


def word(rng):
    return "".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 8)))


def shingles(text, k):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(docs, k, num, den):
    sets = [(d, shingles(t, k)) for d, t in docs]
    up = {d: d for d, _ in docs}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            shared = len(x & y)
            if x and y and den * shared >= num * (len(x) + len(y) - shared):
                p, q = root(a), root(b)
                up[max(p, q)] = min(p, q)
    return {d: (len(s), root(d)) for d, s in sets}


def run(spark, docs, k=3, num=85, den=100):
    df = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in docs], SCHEMA)
    return minhash.near_duplicates(df, k, num, den).collect()


def corpus(rng):
    docs = []
    add = lambda t: docs.append((7 * len(docs) + 3, t))
    for _ in range(40):
        base = [word(rng) for _ in range(rng.randint(5, 150))]
        add(" ".join(base))
        for _ in range(rng.randint(0, 4)):  # copies at all distances
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                copy[rng.randrange(len(copy))] = word(rng)
            add(rng.choice((" ", "\n", "\t")).join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    for t in (None, "", " \n\t ", "one", "ONE", "one two", "one  two", "é È", "é è", "a b c", "a b c a b c"):
        add(t)
    rng.shuffle(docs)
    return docs


def test_components_equal_brute_force(spark):
    docs = corpus(random.Random(12))
    want = brute(docs, 3, 85, 100)
    rows = run(spark, docs)
    assert len(rows) == len(docs)
    for r in rows:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_given_documents_equal_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    for k, num in ((3, 85), (5, 80)):
        want = brute(docs, k, num, 100)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in run(spark, docs, k, num)} == want


@pytest.fixture()
def small_blocks(monkeypatch):
    """Bounds so small that every way beyond them is taken."""
    for name, value in (("NODE", 4), ("DEPTH", 2), ("CHUNK", 6), ("SAME", 2.0)):
        monkeypatch.setattr(minhash, name, value)


def test_large_groups_are_split_and_stay_whole(spark, small_blocks):
    rng = random.Random(3)
    base = [word(rng) for _ in range(60)]
    docs = []
    for i in range(50):  # a chain: each differs from the one before in a word
        base[rng.randrange(60)] = word(rng)
        docs.append((100 - i, " ".join(base)))
    docs += [(500 + i, " ".join(word(rng) for _ in range(20))) for i in range(30)]
    want = brute(docs, 3, 85, 100)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in run(spark, docs)} == want


def test_leaders_thin_out_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(minhash, "NODE", 8)
    rng = random.Random(4)
    base = [word(rng) for _ in range(400)]
    docs = []
    for i in range(60):  # nearly equal to each other
        copy = list(base)
        copy[rng.randrange(400)] = word(rng)
        docs.append((i, " ".join(copy)))
    assert {r["component_id"] for r in run(spark, docs)} == {0}


def test_edges_and_nodes_grow_with_the_group_alone(spark, monkeypatch):
    """Near copies (a word of 60 changed) give a constant number of candidate edges a
    member, and few of their nodes branch."""
    monkeypatch.setattr(minhash, "LED", 128)
    rng = random.Random(7)
    base = [word(rng) for _ in range(60)]
    made = {}
    for n in (300, 900):
        copies = []
        for i in range(n):
            copy = list(base)
            copy[rng.randrange(60)] = word(rng)
            copies.append((i, " ".join(copy)))
        df = spark.createDataFrame(copies, "doc_id long, text string")
        sets = minhash.document_sets(df, 5).selectExpr("doc_id AS rep", "sketch")
        with common.noting() as tables:
            edges = minhash.candidate_edges(common.stored(sets, "reps"), 0.8)
            pairs = [(r["a"], r["b"]) for r in edges.collect()]
        nodes = sum(spark.read.parquet(t).count() for t in tables if "llm-nodes" in t)
        made[n] = (len(pairs) / n, nodes / n)
        up = list(range(n))

        def root(x):
            while up[x] != x:
                x = up[x]
            return x
        for a, b in pairs:
            up[max(root(a), root(b))] = min(root(a), root(b))
        assert {root(i) for i in range(n)} == {0}
    assert made[900][0] <= 1.5 * made[300][0] < 60 and made[900][1] <= 1.5 * made[300][1] < 60


def test_a_common_line_gathers_few_documents(spark, monkeypatch):
    """Documents of one common line and words of their own seldom share a node, so that
    few rows meet on a path; near copies among them are found."""
    monkeypatch.setattr(minhash, "NODE", 16)
    monkeypatch.setattr(minhash, "FEW", 32)
    rng = random.Random(8)
    line = [word(rng) for _ in range(10)]
    docs = [line + [word(rng) for _ in range(25)] for _ in range(600)]
    for i in range(20):
        docs.append(docs[i][:-1] + [word(rng)])
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    sets = minhash.document_sets(df, 3).selectExpr("doc_id AS rep", "sketch")
    with common.noting() as tables:
        edges = minhash.candidate_edges(common.stored(sets, "reps"), 0.85)
        pairs = {(min(r), max(r)) for r in edges.collect()}
    assert {(i, 600 + i) for i in range(20)} <= pairs and len(pairs) < 40
    rows = sum(spark.read.parquet(t).count() for t in tables if "llm-nodes" in t)
    assert rows < 2 * len(docs)


def test_repeated_rows_and_empty_table(spark):
    rows = run(spark, [(5, "a b c d"), (5, "a b c d"), (2, "A B C D"), (None, "a b c d")])
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in rows) == [
        (2, 2, True), (5, 2, False), (5, 2, False)]
    assert run(spark, []) == []


def test_one_of_each_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "k"), (1, "a b c d e f", "k"), (2, "a b c d e f", "l"),
                                (3, "other words here now yes", "m")], "doc_id long, text string, sketch string")
    out = minhash.one_of_each(df)
    assert out.columns == df.columns
    assert sorted(tuple(r) for r in out.collect()) == [
        (1, "a b c d e f", "k"), (3, "other words here now yes", "m")]

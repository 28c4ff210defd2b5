import random
import zlib
from collections import Counter
import re

from ratewise.llm.spelling import LONG, counted_runs, group_variants, near_words, roots


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def by_definition(counts, factor=10):
    form, n_near = {}, {}
    for w, n in counts.items():
        others = [u for u in counts if u != w and near(u, w)]
        n_near[w] = len(others)
        best = min(others, key=lambda u: (-counts[u], u), default=None)
        form[w] = best if best is not None and counts[best] >= factor * n else None
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n, n_near[w], counts[form[w]] if form[w] else None))
    return rows


def words(spark, counts):
    return spark.createDataFrame([(w, n, "clash") for w, n in counts.items()],
                                 "word string, n long, form string")


def test_neighbours_and_forms_equal_brute_force(spark):
    rng = random.Random(7)
    counts = {}
    for _ in range(60):  # few letters: runs of equal ones, many neighbours
        base = "".join(rng.choice("abé") for _ in range(rng.randint(3, 6)))
        counts[base] = rng.choice([2, 3, 20, 40, 400, 5000])
    counts |= {"a": 2, "": 5, "zebra": 9}
    got = {tuple(r) for r in group_variants(words(spark, counts)).collect()}
    assert got == by_definition(counts)
    assert any(r[1] and r[2] != r[1] for r in got)  # a chain of forms


def test_long_words(spark):
    rng = random.Random(8)
    counts = {}
    for size in (LONG - 1, LONG, LONG + 1, 900):
        base = "".join(rng.choice("ab") for _ in range(size))
        counts[base] = 200
        for _ in range(4):
            at = rng.randrange(size)
            counts.setdefault(base[:at] + base[at + 1:], 3)
            counts.setdefault(base[:at] + "c" + base[at:], 7)
            counts.setdefault(base[:at] + "d" + base[at + 1:], 2)
    counts |= {"a" * LONG: 2, "a" * (LONG + 1): 90, "q" * 5000: 2, "q" * 5001: 50}
    assert {tuple(r) for r in group_variants(words(spark, counts)).collect()} == by_definition(counts)


def test_a_large_range_gives_one_row_a_member(spark):
    counts = {f"prefix{chr(0x4e00 + i)}suffix": i + 2 for i in range(400)}
    got = near_words(words(spark, counts).select("word", "n")).collect()
    assert {r["n_near"] for r in got} == {399}


def test_roots_of_long_chains(spark):
    links = spark.createDataFrame([(f"w{i:02}", f"w{i + 1:02}") for i in range(40)], "word string, form string")
    assert {r["root"] for r in roots(links).collect()} == {"w40"}


def test_counted_runs_of_whole_texts(spark):
    rng = random.Random(2)
    vocabulary = ["Étudiant", "straße×x", "COMPUTER", "abcdefg", "short", "éééééééé", "needles"]
    docs = [(d, " ".join(rng.choice(vocabulary) for _ in range(40)), "clash") for d in range(50)]
    docs += [(60, None, "x"), (61, "", "x"), (None, "computer computer1computer", "x"),
             (62, "longest " * 30_000, "x")]
    want = Counter()
    for doc_id, text, _ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            want[run] += 1
    want = {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}
    frame = spark.createDataFrame(docs, "doc_id long, text string, word string")
    assert {r["word"]: r["n"] for r in counted_runs(frame).collect()} == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert group_variants(counted_runs(docs)).count() == 0
    assert group_variants(words(spark, {"a\0b": 3, "ab": 2, "abc": 5}), 2).where(
        "word = 'a\0b'").first()["n_near"] == 0

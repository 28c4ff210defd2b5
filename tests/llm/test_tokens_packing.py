import itertools
import random
import time
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ratewise.llm import langid, minhash, packing, tokens
from ratewise.llm.queries import QUERIES
from tests.conftest import SF_MID, SF_SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, length long, n_tokens long"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def hostile():
    rng = random.Random(4)
    chars = "ab'st re ll\n\t é1²ß一.  \x1c\x85😀½"
    return (["".join(rng.choice([*chars, "<|endoftext|>"]) for _ in range(rng.randint(0, 60)))
             for _ in range(600)] + ["x" * 4000, " " * 2000, "<|endoftext|>" * 3, "", "ab " * 3000])


def test_counts_equal_the_library(library):
    known = tokens.counter(PATH)
    for text in hostile():
        assert known.text(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


def test_ids_equal_the_library(library):
    ids = packing._Ids(PATH)
    assert ids.by_word
    texts = hostile()
    for some in (texts, texts[:1], []):
        assert ids.texts(some) == [
            np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in some]


@pytest.mark.parametrize("entries, joined", [(40, 3), (400_000, 256)])
def test_ids_of_any_table_size_equal_the_library(library, monkeypatch, entries, joined):
    monkeypatch.setattr(packing, "CACHE_ENTRIES", entries)
    monkeypatch.setattr(packing, "JOINED", joined)
    ids, rng = packing._Ids(PATH), np.random.default_rng(8)
    words = ["the", "Straße", "été", "naïve", "日本語", "привет", "don't", "x" * 60, "<|endoftext|>", "42",
             "a_b", "--", "ſ", "ªº", "\u0301", "\u1c89", "e\u0301", *("w" + c * 3 for c in "abcdefghijklm")]
    texts = ["".join(str(w) + str(rng.choice(["", " ", "  ", "\n"])) for w in rng.choice(words, 30))
             for _ in range(60)]
    for _ in range(2):  # again from what was remembered
        for block in (texts[:20], texts[20:40], texts[40:]):
            assert ids.texts(block) == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
                                        for t in block]


def test_every_code_point_splits_alike(library):
    known = [c for c in range(1, 0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    for i in range(0, len(known), 64):
        text = "".join(f"a{chr(c)}b {chr(c)}1{chr(c)} " for c in known[i:i + 64])
        assert tokens.pre_tokens(text) == [
            text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_letters_newer_than_these_tables_count_alike(library):
    newer = [c for c in range(0x80, 0x20000) if unicodedata.category(chr(c)) == "Cn"]
    counts, ids = tokens.counter(PATH), packing._Ids(PATH)
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", "\u1c89", " ", "1", "\ua7cb", "\U000105c0", "é", chr(rng.choice(newer))])
                     for _ in range(rng.randint(1, 20))) for _ in range(3000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [counts.text(t) for t in texts] == [len(x) for x in want]
    assert ids.texts(texts) == [np.array(x, "<u4").tobytes() for x in want]


def test_token_counts_of_nulls_and_repeats(spark):
    df = spark.createDataFrame([(1, None, 0, 0), (1, "", 0, 0), (2, "é a", 0, 0), (None, "b", 0, 0)], SCHEMA)
    rows = sorted((r["doc_id"] is None, r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"])
                  for r in tokens.token_counts(df, PATH, 1).collect())
    assert rows[0] == (False, 1, 0, 0, False) and rows[1] == (False, 1, 0, 0, False)
    assert rows[2][2] == 4 and rows[2][4]
    assert len(rows) == 4
    assert tokens.token_counts(df.limit(0), PATH).count() == 0


def check_packing(rows, size):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in by.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_packing_of_the_given_documents(spark, library):
    rows = QUERIES["op6_best_fit_packing"](spark, SF_SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    docs = {}
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
    assert set(docs) == set(texts)
    for doc_id, parts in docs.items():
        ids = np.array(library.encode(texts[doc_id], add_special_tokens=False).ids + [2], "<u4")
        parts.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(len(parts)))
        assert [r["start"] for r in parts] == np.concatenate(([0], np.cumsum([r["length"] for r in parts])[:-1])).tolist()
        assert sum(r["length"] for r in parts) == len(ids)
        assert all(r["length"] == 1024 for r in parts[1:])
        for r in parts:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
    used = check_packing(rows, 1024)
    assert used <= 1.02 * -(-sum(r["length"] for r in rows) // 1024) + 1


def test_packing_of_nulls_repeats_and_nothing(spark):
    df = spark.createDataFrame([(1, None, 9, 9), (1, None, 9, 9), (2, "a b c d e f g h i", 9, 9), (None, "a", 9, 9)], SCHEMA)
    rows = packing.pack_documents(df, PATH, size=4).collect()
    assert sum(r["doc_id"] == 1 for r in rows) == 2
    assert [r["length"] for r in sorted(rows, key=lambda r: r["piece"]) if r["doc_id"] == 2] == [2, 4, 4]
    check_packing(rows, 4)
    assert packing.pack_documents(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("follows", [
    lambda docs: langid.predict_language(docs, None), lambda docs: minhash.document_sets(docs, 5)])
def test_workers_drop_the_ids_when_another_operator_begins(spark, follows):
    def held(batches):
        import gc
        for _ in batches:
            time.sleep(0.05)  # so that every worker has its turn
            yield pd.DataFrame({"n": [sum(type(x).__name__ == "_Ids" for x in gc.get_objects())]})

    def workers_that_hold():
        return spark.range(0, 32, 1, 32).mapInPandas(held, "n long").where("n > 0").count()

    docs = spark.range(0, 64, 1, 64).selectExpr("id AS doc_id", "concat('some words ', id) AS text")
    assert packing.pieces(docs, PATH).agg(F.sum("length")).first()[0] > 0
    assert workers_that_hold()
    assert follows(docs).collect()
    assert not workers_that_hold()


def test_plans_use_every_piece_once():
    rng = random.Random(8)
    for size in (10, 64, 200):
        histogram = {}
        for _ in range(3000):
            n = min(size, max(1, int(rng.lognormvariate(2.5, 1))))
            histogram[n] = histogram.get(n, 0) + 1
        patterns = packing.plan(histogram, size)
        used = {}
        for pattern, n in patterns:
            assert sum(k * v for k, v in pattern.items()) <= size
            for k, v in pattern.items():
                used[k] = used.get(k, 0) + n * v
        assert used == histogram
        least = -(-sum(k * v for k, v in histogram.items()) // size)
        assert sum(n for _, n in patterns) <= 1.05 * least + 1


def test_gaps_are_filled_by_singles_pairs_and_triples():
    shape = lambda plan: sorted((sorted(p.elements()), n) for p, n in plan)
    assert shape(packing.plan({70: 3, 30: 3}, 100)) == [([30, 70], 3)]
    assert shape(packing.plan({60: 4, 25: 4, 15: 4}, 100)) == [([15, 25, 60], 4)]
    assert shape(packing.plan({55: 2, 20: 2, 14: 2, 11: 2}, 100)) == [([11, 14, 20, 55], 2)]
    assert shape(packing.plan({60: 1, 20: 2}, 100)) == [([20, 20, 60], 1)]  # a length twice
    assert shape(packing.plan({60: 1, 20: 1}, 100)) == [([20, 60], 1)]      # but not without a second


def test_the_index_of_sums_follows_the_counts():
    rng = random.Random(4)
    size = 40
    left = packing._Lengths({n: rng.randint(1, 3) for n in rng.sample(range(1, size + 1), 15)}, size)
    while left.count.any():
        n = int(rng.choice(np.flatnonzero(left.count)))
        left.take(Counter((n,)), 1)
        have = np.flatnonzero(left.count)
        pair, triple = np.zeros(size + 1, int), np.zeros(size + 1, int)
        for a, b in itertools.product(have, have):
            if a + b <= size:
                pair[a + b] += 1
                for c in have[have <= size - a - b]:
                    triple[a + b + c] += 1
        assert (left.pair == pair).all() and (left.triple == triple).all()


def test_plan_of_the_given_documents_is_near_the_bound_and_uses_pairs_and_triples():
    ids = packing._Ids(PATH)
    texts = pq.read_table(f"{SF_MID}/documents.parquet", columns=["text"]).column("text").to_pylist()
    histogram = Counter(length for x in ids.texts([t or "" for t in texts])
                        for _, length in packing.cut(len(x) // 4 + 1, 1024))
    patterns = packing.plan(histogram, 1024)
    least = -(-sum(k * n for k, n in histogram.items()) // 1024)
    assert sum(n for _, n in patterns) <= least + 2
    assert {2, 3} <= {sum(p.values()) for p, _ in patterns}


def test_merge_count_keeps_the_leftmost_of_equal_ranks():
    ranks, merged, of_byte, _ = tokens.load_merges(PATH)
    assert tokens.merge_count(b"", ranks, merged, of_byte) == 0
    assert tokens.merge_count(b"aaa", ranks, merged, of_byte) == len(
        Tokenizer.from_file(PATH).encode("aaa").ids)

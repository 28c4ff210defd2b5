import re

import pytest

import corpus_pipeline
from ratewise.llm.common import read, stored
from tests.conftest import SF_SMALL
from tests.llm.test_decontam_lines import brute as leaks
from tests.llm.test_minhash import brute as groups
from tests.llm.test_tokens_packing import check_packing


@pytest.fixture(scope="module")
def stages(spark):
    docs = read(spark, SF_SMALL, "documents")
    out = [("documents", docs.collect())]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_SMALL), name)
        out.append((name, docs.collect()))
    return out


def rows(stages, k):
    return {r["doc_id"]: r for r in stages[k][1]}


def test_stages_in_order_and_their_columns(spark, stages):
    assert [n for n, _ in stages[1:]] == ["language_id", "line_dedup", "minhash_dedup", "decontamination",
                                          "best_fit_packing"]
    for _, part in stages[1:-1]:
        assert part[0].asDict().keys() == stages[0][1][0].asDict().keys()


def test_language_id_keeps_clean_documents(stages):
    before, after = rows(stages, 0), rows(stages, 1)
    assert {d for d in before if re.search(r"[^\W\d_]{3}", before[d]["text"])} >= set(after)
    assert len(after) >= 0.98 * len(before)


def test_line_dedup_leaves_one_occurrence(stages):
    before, after = rows(stages, 1), rows(stages, 2)
    long = lambda r: {x for x in r["text"].split("\n") if len(x.split(" ")) >= 15}
    for r in after.values():
        assert r["n_chars"] == len(r["text"]) > 0
    first = {}
    for d in sorted(before):
        for x in long(before[d]):
            first.setdefault(x, d)
    assert {x: d for d in after for x in long(after[d])} == first


def test_near_duplicates_leave_one_of_each(stages):
    before, after = rows(stages, 2), rows(stages, 3)
    want = groups([(d, r["text"]) for d, r in before.items()], 5, 80, 100)
    assert set(after) == {d for d, (_, c) in want.items() if c == d}


def test_no_benchmark_item_is_left(spark, stages):
    items = [(r["item_id"], r["text"]) for r in read(spark, SF_SMALL, "benchmark").collect()]
    before, after = rows(stages, 3), rows(stages, 4)
    short = [(d, r["text"]) for d, r in before.items() if len(r["text"]) < 1000]  # the reference is quadratic
    bad = {d for d, _ in leaks(short, items)}
    assert bad.isdisjoint(after)
    assert {d for d, _ in short} - bad <= set(after)


def test_everything_left_is_packed(spark, stages):
    packed = stages[5][1]
    assert {r["doc_id"] for r in packed} == set(rows(stages, 4))
    check_packing(packed, 1024)

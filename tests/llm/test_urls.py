import numpy as np
from pyspark.sql import functions as F

from ratewise.llm.urls import (
    RULES,
    Rule,
    bloom_filter,
    canonical,
    judge_urls,
    listed_by_name,
    probe,
)


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)],
                                 "page_id long, url string, verdict string")


def listed(spark, urls):
    return spark.createDataFrame([(u,) for u in urls], "url string")


def verdicts(spark, urls, entries, rules=()):
    rows = judge_urls(pages(spark, urls), listed(spark, entries), rules).orderBy("page_id").collect()
    assert len(rows) == len(urls)
    return [(r["host"], r["path"], r["rule"], r["verdict"]) for r in rows]


def test_canonical_form(spark):
    cases = {
        "HTTP://u:p@Www.Example.ORG.:80/a/b//?z=1&utm_source=x&a=2#top": "www.example.org/a/b?a=2&z=1",
        "https://example.org": "example.org/", "https://example.org/?ref=x": "example.org/",
        "https://example.org/A": "example.org/A", "https://example.org?refs=1": "example.org/?refs=1",
        "no scheme": None, "://": None, "x://?q": None, None: None}
    got = pages(spark, list(cases)).select(canonical(F.col("url")).alias("c")).collect()
    assert [r["c"] for r in got] == list(cases.values())


def test_rules_of_the_contract(spark):
    urls = ["http://a.example.org/es/1", "http://example.org/en/12?x", "http://example.org/en/2",
            "http://notexample.org/es/", "http://example.com/fr/", "http://x.com/de/1#a", "http://com/de/",
            "http://x.com/en/", "http://a.example.org", "http://EXAMPLE.org/es/", None, "", "x.org/es/"]
    got = verdicts(spark, urls, [], RULES)
    assert [(r[2], r[3]) for r in got] == [
        ("example.org/es/", "block"), ("example.org/en/1", "block"), ("org/", "allow"), ("org/", "allow"),
        ("com/fr/", "allow"), ("com/de/", "block"), ("com/de/", "block"), (None, "allow"), (None, "allow"),
        ("example.org/es/", "block"), (None, "allow"), (None, "allow"), (None, "allow")]
    assert got[1][:2] == ("example.org", "/en/12") and got[9][0] == "example.org"
    assert [r[:2] for r in got[-3:]] == [("", "")] * 3 and got[8][:2] == ("a.example.org", "")


def test_listed_hosts_and_urls(spark):
    entries = ["http://bad.net/", "https://fine.net/one?b=2&a=1&utm_x=9", "http://deep.a.b.io", "junk", None]
    urls = ["http://bad.net/x/y", "http://m.bad.net", "http://notbad.net/", "https://fine.net/one/?a=1&b=2#z",
            "https://fine.net/one", "https://fine.net/", "http://b.io/", "http://x.deep.a.b.io/?q",
            "http://" + "l." * 3000 + "bad.net/", "http://fine.net/one?" + "a=1&" * 5 + "b=2", "http://bad.net/x/y"]
    assert [r[3] for r in verdicts(spark, urls, entries)] == [
        "block", "block", "allow", "block", "allow", "allow", "allow", "block", "block", "allow", "block"]
    # a rule comes before the list
    assert verdicts(spark, ["http://m.bad.net/"], entries, [Rule("allow", "net", "/")])[0][3] == "allow"


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("host/"), F.col("id").cast("string")).alias("key"))
    blocks = bloom_filter(keys, 20_000)
    hashes = lambda prefix: np.array([r[0] for r in spark.range(20_000).select(F.xxhash64(
        F.concat(F.lit(prefix), F.col("id").cast("string")))).collect()], np.int64)
    assert probe(blocks, hashes("host/")).all()
    assert probe(blocks, hashes("other/")).mean() < 0.01


def test_false_positives_are_removed_exactly(spark, monkeypatch):
    """A filter of one block, full of bits, passes nearly all: the join decides."""
    monkeypatch.setattr("ratewise.llm.urls.MAX_BLOCKS", 1)
    urls = [f"http://h{i % 40}.net/{i}" for i in range(400)]
    entries = [u for i, u in enumerate(urls) if i % 3 == 0] + ["http://h7.net"]
    want = ["block" if i % 3 == 0 or i % 40 == 7 else "allow" for i in range(400)]
    assert [r[3] for r in verdicts(spark, urls, entries)] == want


def test_list_by_name_repeated_rows_and_empty_tables(spark):
    urls = ["http://m.free-bets.io/1", "http://bets@fine.io/", "http://alphabets.io/"] * 2
    got = listed_by_name(pages(spark, urls))
    assert {r[0] for r in got.collect()} == {"http://m.free-bets.io/1", "http://m.free-bets.io"}
    rows = judge_urls(pages(spark, urls), got).collect()
    assert sorted(r["verdict"] for r in rows) == ["allow"] * 4 + ["block"] * 2
    assert judge_urls(pages(spark, []), got).count() == 0
    assert listed_by_name(pages(spark, [])).count() == 0

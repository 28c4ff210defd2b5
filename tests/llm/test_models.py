import random

import numpy as np
import pytest

from ratewise.llm import html, langid, quality
from ratewise.llm.queries import QUERIES
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}


def test_language_of_held_out_documents(spark, documents):
    import zlib
    rows = QUERIES["op8_language_id"](spark, SF_MID).collect()
    assert {r["doc_id"] for r in rows} == set(documents) and len(rows) == len(documents)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == documents[r["doc_id"]]["lang"] for r in held]) >= 0.97


def test_language_of_odd_texts(spark):
    known = [(i, "the of and that with " * 20 if i % 2 else "der die und ist nicht " * 20,
              "en" if i % 2 else "de", "s", 1.0) for i in range(200)]
    odd = [(1000, None, "en", "s", 1.0), (1001, "", None, "s", 1.0), (1002, "123 !! 4", "de", "s", 1.0),
           (1003, "der", None, "s", 1.0), (1004, "the of and that with " * 4000, None, "s", 1.0),
           (None, "die und ist", None, "s", 1.0), (1005, "的 是", None, "s", 1.0)]
    df = spark.createDataFrame(known + odd, "doc_id long, text string, lang string, lang_pred string, score double")
    out = {r["doc_id"]: r for r in langid.identify(df).collect()}
    assert [out[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3
    assert out[1004]["lang_pred"] == "en" and out[1003]["lang_pred"] == "de"
    assert out[None]["held_out"] is False
    kept = langid.identified(df, 0.3)
    assert kept.schema == df.schema and kept.where("doc_id IN (1000, 1001, 1002)").count() == 0
    none = langid.identify(df.where("lang IS NULL"))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}
    assert langid.identify(df.limit(0)).count() == 0


def test_every_label_is_learnt(spark):
    rows = [(100 * k + i, f"word{k} " * 5, f"l{k:02}") for k in range(70) for i in range(3 if k else 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.train(df).languages == [f"l{k:02}" for k in range(70)]


def test_windows_cover_the_whole_text():
    rng = random.Random(0)
    for n in (0, 1, 127, 128, 129, 256, 1000):
        text = "".join(rng.choice("abc") for _ in range(n))
        w = langid.windows(text)
        flat = w.tobytes()
        assert flat[:n - n % 128].decode() == text[:n - n % 128]
        assert flat.rstrip(b"\0").decode().endswith(text[-128:])


def test_quality_keeps_clean_and_catches_toxic(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op7_quality_classifier"](spark, SF_MID).collect()}
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").collect()
    clean = [rows[r["doc_id"]]["kept"] for r in labels if r["quality"] == 1 and not r["toxic"]]
    junk = [rows[r["doc_id"]]["kept"] for r in labels if r["quality"] == 0]
    toxic = [rows[r["doc_id"]]["kept"] for r in labels if r["toxic"]]
    assert np.mean(clean) >= 0.95 and np.mean(junk) <= 0.1
    # 51 toxic labels in four languages, two of which have no known insult
    assert np.mean(toxic) <= 0.25


def test_quality_of_documents_whose_labels_are_held_out(spark):
    import zlib
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    held = [r for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    seen = labels.where("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 <> 0")
    rows = {r["doc_id"]: r for r in quality.classify(docs, seen).collect()}
    share = lambda test: np.mean([rows[r["doc_id"]]["kept"] for r in held if test(r)])
    clean, junk, toxic = (share(lambda r: r["quality"] == 1 and not r["toxic"]),
                          share(lambda r: r["quality"] == 0), share(lambda r: r["toxic"]))
    assert clean >= 0.95 and junk <= 0.1 and toxic <= 0.25, (len(held), clean, junk, toxic)


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (2, "", 1), (None, "some words", 1), (3, "word " * 20000, 1)],
                                 "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(1, None, None), (3, 0, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.classify(docs, labels).count() == 5
    assert quality.classify(docs, labels.limit(0)).count() == 5
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_few_distinct_words_of_long_texts_are_seen_wherever_they_stand():
    sale = " ".join(f"buy now cheap x{i}" for i in range(400))
    fresh = " ".join(f"w{i}" for i in range(1600))
    few = lambda text: quality.shape(text)[1][4]
    assert abs(few(sale) - few("one " + sale)) < 0.01 and 0.7 < few(sale) < 0.8
    assert few(fresh) == 0
    for at in range(4):  # words that one stride would pass over
        w = fresh.split()
        w[at + 4::4] = ["same"] * len(w[at + 4::4])
        assert 0.2 < few(" ".join(w)) < 0.3
    assert few("a b a c") == 0.25


def test_expectation_maximisation_recovers_the_truth():
    rng = np.random.default_rng(2)
    truth = rng.random(20000) < 0.2
    right = np.array([0.9, 0.8, 0.75, 0.85])
    votes = np.where(rng.random((20000, 4)) < right, truth[:, None], ~truth[:, None]).astype(int) + 1
    votes[rng.random(votes.shape) < 0.2] = quality.ABSTAIN
    keys = ["".join(map(str, v)) for v in votes]
    counts = {k: keys.count(k) for k in set(keys)}
    p = quality.posteriors(counts)
    assert np.mean([(p[k] > 0.5) == t for k, t in zip(keys, truth)]) >= 0.9
    assert abs(np.mean([p[k] for k in keys]) - 0.2) < 0.05


@pytest.fixture(scope="module")
def model(spark):
    pages = spark.read.parquet(f"{SF_MID}/pages.parquet").select("page_id", "html")
    return html.train(pages)


def article_of(page):
    """The blocks of the given pages' article element, by its plain structure."""
    import re
    from html import unescape
    inside = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|h2|ul|li|div|table|tr|td|blockquote)[^>]*>", inside)
    texts = [" ".join(unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_given_pages_are_extracted_exactly(spark):
    rows = QUERIES["op10_html_extraction"](spark, SF_MID).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    right = [r["text"] == article_of(pages[r["page_id"]]) for r in rows]
    assert np.mean(right) >= 0.99
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_other_layouts(model):
    text = ["A first paragraph that says something about the weather, and more.",
            "A second one, &amp; it goes on for a while so that it reads like prose."]
    body = f"<div class='entry-content'><h1>A title</h1><p>{text[0]}</p><p>{text[1]}\n  twice</div>"
    want = "A title\n\n" + text[0] + "\n\n" + text[1].replace("&amp;", "&") + " twice"
    page = (f"<html><body><div id=menu><ul><li><a href=/>Home</a><li><a href=/b>About us</a></ul></div>"
            f"<div class='cookie-banner'><p>We use cookies to make this site better.</p><button>OK</button></div>{body}"
            "<div class=sidebar><h3>Related</h3><ul><li><a href=/1>One more story</a></ul></div>"
            "<div id=comments><h3>2 comments</h3><div class=comment><p>I do not agree with this at all.</p></div></div>"
            "<form class=newsletter><label>Your mail</label><input><button>Subscribe</button></form>"
            "<footer>&copy; 2020 Example</footer><script>var x='<p>no</p>'</script></body></html>")
    assert html.extract([page], model)[0] == want


def test_odd_pages(model):
    got = html.extract([None, "", "<p></p>", "plain  text &lt;b&gt;", "<!-- only a comment", "<script>x",
                        "<div><p>unclosed <b>bold", "<p>" + "word " * 50000 + "</p>"], model)
    assert got[:3] == ["", "", ""] and got[3] == "plain text <b>" and got[4:6] == ["", ""]
    assert len(got[7]) == 249999


def test_place_and_neighbours_among_many_siblings():
    for n in (10, 65, 200):
        nodes, _ = html.parse("<div>" + "".join(f"<p>{'x' * (1 + k)}</p>" for k in range(n)) + "</div>")
        x, k = html.features(nodes)[2:], html.N_TAGS * 2 + html.N_GROUPS * 2
        total = n * (n + 1) / 2
        assert np.allclose(x[:, k + 12], np.arange(n) / n)
        assert np.allclose(x[:, k + 17], [(i + 2 if i + 1 < n else i) / total for i in range(n)])


def test_decoding_never_keeps_below_a_dropped_node():
    rng = np.random.default_rng(5)
    nodes, _ = html.parse("<div><div><p>a</p><p>b</p></div><div><ul><li>c<li>d</ul></div></div>" * 8)
    for _ in range(50):
        keep = html.decode(nodes, rng.normal(size=len(nodes)) * 4)
        assert all(keep[n.parent] or not keep[i] for i, n in enumerate(nodes) if i)


def test_html_query_of_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (1, "u", "<p>hello there</p>", "x"), (None, "u", "", "x")],
                               "page_id long, url string, html string, text string")
    assert html.main_texts(df).count() == 3
    assert html.main_texts(df.limit(0)).count() == 0

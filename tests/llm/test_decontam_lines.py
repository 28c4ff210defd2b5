import random
import re
import string
from collections import Counter

from pyspark.sql import functions as F

from ratewise.llm import decontam, lines
from tests.conftest import SF_SMALL


def word(rng):
    return "".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 8)))


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def bag(w, k=5):
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else Counter([tuple(w)] if w else [])


def brute(docs, items):
    """Best similarity of any window of an item's length, if 0.8 or more."""
    out = {}
    for d, text in docs:
        w = words(text)
        held = {k: set(bag(w, k)) for k in range(1, 6)}
        for i, t in items:
            item = words(t)
            want = bag(item)
            best = 0
            if not held[min(5, len(item) or 5)] & want.keys():
                continue  # no window shares a shingle
            for p in range(len(w)):
                x = bag(w[p:p + len(item)])
                both = sum((x & want).values())
                best = max(best, both / (sum(x.values()) + sum(want.values()) - both))
            if best >= 0.8:
                out[d, i] = best
    return out


def run(spark, docs, items):
    df = spark.createDataFrame([(d, t, 1, "s") for d, t in docs], "doc_id long, text string, item_id int, win string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    return {(r["doc_id"], r["item_id"]): r for r in decontam.contaminated(df, bench).collect()}


def test_items_are_found_whole_edited_and_short(spark):
    rng = random.Random(9)
    prose = lambda n: [word(rng) for _ in range(n)]
    items = [(i, " ".join(prose(n))) for i, n in enumerate((12, 30, 55, 90, 150, 3, 1))]
    docs = []
    for k, (i, t) in enumerate(items):
        w = t.split()
        docs.append((10 * k, " ".join(prose(40) + [x.upper() for x in w] + prose(30))))
        docs.append((10 * k + 1, "\n".join(w)))
        if len(w) > 50:  # one word replaced, one dropped
            edited = list(w)
            edited[len(w) // 2] = word(rng)
            docs.append((10 * k + 2, " ".join(prose(9) + edited + prose(9))))
            docs.append((10 * k + 3, " ".join(prose(9) + w[:20] + w[21:] + prose(9))))
        docs.append((10 * k + 4, " ".join(w[:len(w) // 2] + prose(20))))  # half: clean
    docs += [(900, None), (901, ""), (902, " ".join(prose(100))), (903, "..!")]
    got, want = run(spark, docs, items), brute(docs, items)
    assert set(got) == set(want)
    for key, r in got.items():
        assert abs(r["similarity"] - want[key]) < 1e-9


def test_given_tables_equal_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got, want = run(spark, docs, items), brute(docs, items)
    assert set(got) == set(want)
    assert all(abs(r["similarity"] - want[key]) < 1e-9 for key, r in got.items())


def test_passages_in_another_order_and_repeats_are_found(spark):
    rng = random.Random(21)
    prose = lambda n: [word(rng) for _ in range(n)]
    items = [(i, " ".join(prose(n))) for i, n in enumerate((120, 60, 200))]
    refrain = prose(8)
    items.append((7, " ".join(refrain * 6 + prose(12))))  # repeated sentences
    docs = []
    for i, t in items:
        w = t.split()
        h, q = len(w) // 2, len(w) // 4
        docs.append((10 * i, " ".join(w[h:] + w[:h])))                       # halves swapped, at both ends
        docs.append((10 * i + 1, " ".join(prose(500) + w[h:] + w[:h] + prose(300))))
        docs.append((10 * i + 2, " ".join(prose(30) + w[q:] + prose(30))))   # three quarters: clean
        docs.append((10 * i + 3, " ".join(prose(30) + w[:-max(2, len(w) // 30)])))  # cut at the end
        docs.append((10 * i + 4, " ".join(w * 3)))
    docs.append((900, " ".join(refrain * 80)))
    got, want = run(spark, docs, items), brute(docs, items)
    assert set(got) == set(want) and (0, 0) in got and (1, 0) in got
    assert all(abs(r["similarity"] - want[key]) < 1e-9 for key, r in got.items())


def test_very_long_texts_and_rows_of_one_id(spark):
    rng = random.Random(22)
    item = [word(rng) for _ in range(70)]
    filler = [word(rng) for _ in range(150_000)]
    docs = [(1, " ".join(filler + item + filler[:20])), (2, " ".join(filler)),
            (3, " ".join(item * 400)), (4, "nothing here"), (4, " ".join(item)), (4, " ".join(item))]
    got = run(spark, docs, [(5, " ".join(item))])
    assert set(got) == {(1, 5), (3, 5), (4, 5)}
    assert got[1, 5]["start_word"] == len(filler) and got[3, 5]["start_word"] == 0


def test_fingerprints_are_simhashes_of_weighted_shingles(spark):
    rng = random.Random(23)
    bags = {k: {rng.getrandbits(64) - (1 << 63): rng.randint(1, 4) for _ in range(rng.randint(1, 40))}
            for k in range(30)}
    rows = [(k, sh, tf) for k, b in bags.items() for sh, tf in b.items()]
    df = spark.createDataFrame(rows, "item long, sh long, tf long")
    for r in decontam._fingerprints(df, "item").collect():
        b = bags[r["item"]]
        want = sum((2 * sum(tf for sh, tf in b.items() if sh >> j & 1) > sum(b.values())) << j for j in range(64))
        assert r["fp"] & (1 << 64) - 1 == want and r["total"] == sum(b.values())


def test_block_index_finds_all_within_the_radius(spark):
    rng = random.Random(1)
    fps = [rng.getrandbits(64) - (1 << 63) for _ in range(60)]
    other = []
    for f in fps:
        for _ in range(rng.randint(0, decontam.RADIUS)):
            f ^= 1 << rng.randrange(63)
        other.append(f)
    df = spark.createDataFrame(list(zip(range(60), fps, other)), "i long, a long, b long")
    found = df.select("i", F.explode(decontam._near_blocks(df.a)).alias("e")).join(
        df.select("i", "a", "b", F.explode(decontam._blocks(df.b)).alias("e")), ["i", "e"])
    once = found.where(decontam._first_block(F.col("a"), F.col("b")) == F.col("e.block"))
    assert sorted(r["i"] for r in once.select("i").collect()) == list(range(60))


def test_every_window_at_the_threshold_is_found(spark):
    rng = random.Random(12)
    items = [(i, " ".join(word(rng) for _ in range(50))) for i in range(600)]
    edited = lambda t: " ".join([*t.split()[:25], "replaced", *t.split()[26:]])
    got = run(spark, [(i, edited(t)) for i, t in items], items)  # 41 shingles of 51 are shared
    assert set(got) == {(i, i) for i, _ in items}
    assert all(abs(r["similarity"] - 41 / 51) < 1e-9 for r in got.values())


def test_decontamination_without_rows(spark):
    docs = spark.createDataFrame([(1, "some words stand here today")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(docs, none).count() == 0
    assert decontam.contaminated(docs.limit(0), none).count() == 0
    kept = decontam.drop_contaminated(docs, spark.createDataFrame([(1, "words stand here today")], "item_id long, text string"))
    assert kept.count() == 0 and kept.columns == docs.columns


def test_repeated_passages_are_cut_but_for_the_first(spark):
    rng = random.Random(5)
    line = lambda n: " ".join(word(rng) for _ in range(n))
    passage = "\n".join(line(n) for n in (20, 9, 16, 30))
    docs = [(i, "\n".join([line(25), line(7), line(3), passage, line(6), line(40)])) for i in range(6)]
    docs += [(50, line(60)), (51, None), (52, ""), (53, "short line\nshort line"), (54, "short line")]
    rows = [(d, t, "clash", 3) for d, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, chunk string, doc int")
    out = {r["doc_id"]: r for r in lines.drop_repeated_lines(df).collect()}
    assert len(out) == len(docs) and lines.drop_repeated_lines(df).columns == df.columns
    long = [x for x in passage.split("\n") if len(x.split()) >= lines.LINE_WORDS]
    assert out[0]["text"] == docs[0][1]                        # the first occurrence stays
    assert all(x not in out[i]["text"] for x in long for i in range(1, 6))
    for d, t in docs[6:]:
        assert out[d]["text"] == t                             # clean ones are left alone
    for i, t in docs[1:6]:                                     # and so are a document's own lines
        assert t.split("\n")[0] in out[i]["text"] and t.split("\n")[-1] in out[i]["text"]


def test_repeats_inside_a_document_copies_and_nothing(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(2, text), (1, text + "\n" + text), (3, text + "\n")], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in lines.drop_repeated_lines(df).collect()}
    assert out == {1: text, 2: "", 3: ""} or out == {1: text, 2: "", 3: text + "\n"}
    assert lines.drop_repeated_lines(df.limit(0)).count() == 0


def test_chunks_are_the_same_wherever_a_passage_stands(spark):
    rng = random.Random(6)
    line = lambda: " ".join(word(rng) for _ in range(rng.randint(2, 12)))
    passage = [line() for _ in range(40)]
    texts = ["\n".join([line() for _ in range(k)] + passage + [line()]) for k in (0, 1, 7)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{c["text"] for c in r["c"]} for r in df.select("doc_id", lines.chunks(df.text).alias("c")).collect()]
    assert len(sets[0] & sets[1] & sets[2]) >= 8
    for r, t in zip(df.select(lines.chunks(df.text).alias("c")).collect(), texts):
        assert "\n".join(c["text"] for c in r["c"]) == t


def test_repeated_passages_of_short_lines_are_cut(spark):
    rng = random.Random(8)
    line = lambda n: " ".join(word(rng) for _ in range(n))
    for n in (3, 6, 8):
        passage = [line(n) for _ in range(60)]
        docs = [(i, "\n".join([line(25), *passage, line(25), "read more", line(30)])) for i in range(4)]
        df = spark.createDataFrame(docs, "doc_id long, text string")
        out = {r["doc_id"]: r["text"].split("\n") for r in lines.drop_repeated_lines(df).collect()}
        assert "\n".join(out[0]) == docs[0][1]
        for i, t in docs[1:]:
            own = [t.split("\n")[k] for k in (0, -3, -2, -1)]
            left = out[i][1:-3]
            assert [out[i][0], *out[i][-3:]] == own  # a short repeat alone stays
            assert left == passage[:len(left)] and len(left) <= 8  # where its first chunk ends, the line before decides

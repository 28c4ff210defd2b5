"""Benchmark decontamination by SimHashes of item-sized windows [native].

A document holds an item if one of its windows of the item's length has an exact
weighted-shingle similarity to it of at least ``num / den``: the sum of the smaller
over the sum of the larger number of occurrences of every word shingle.

1. *Windows.*  Every start counts.  Left out are only windows that cannot pass: both
   sides have the same length, so at least ``2 num / (num + den)`` of a window's
   shingles (0.889 at 0.8) must be shingles of items of that length.  The documents'
   shingles are looked up in the items', and the starts with enough hits follow from
   the sorted places of the hits.  A window at the end of its text may be cut short;
   the bound follows its size.
2. *Fingerprints.*  64-bit SimHash of a window's and an item's shingles, each weighted
   by its occurrences: bit counts of two bits share a long, so they are 32 grouped sums.
3. *Block index.*  A fingerprint has BLOCKS blocks.  Two that differ in at most RADIUS
   bits differ in at most FLIPS bits in some block, for RADIUS < BLOCKS * (FLIPS + 1).
   An item is entered under all values within FLIPS bits of each of its blocks, with its
   length; a window looks up its own.  This finds all pairs within the radius, each
   once (at the first block that agrees).
4. *Beyond the radius*, where chance puts some pairs near the threshold: windows and
   items of equal length that share one of the item's rarest shingles and whose
   fingerprints differ in more than RADIUS bits.  The shingles left out, the item's
   commonest, are together less than ``num / den`` of it, so a window that shares no
   others cannot pass.
5. *Verification* of all candidates by the exact similarity.

So no pair is lost, whatever its order of parts.  Words are runs of letters and
digits, lower case.  Built from DataFrame functions alone.

Cases: null or empty texts and items match nothing; an item with fewer words than
a shingle is one shingle of all its words and is found where a window of its
length holds the same words; repeated items are each reported, and so are documents
(rows of one id together, their texts apart); null ids are dropped; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import plain, read, sized, stored

WORDS = 5
#: The block index of SimHashes.  At a similarity of 0.8 about ten bits differ; more
#: than 23 do in less than one pair of 10,000.
BITS, BLOCKS, FLIPS = 64, 8, 2
RADIUS = BLOCKS * (FLIPS + 1) - 1
_BLOCK_BITS = BITS // BLOCKS
#: Tables made of the items are broadcast up to this many bytes, joined beyond.
BROADCAST_BYTES, _ROW_BYTES = 32 << 20, 96
#: Shingles of the windows that one row holds before they are dealt to rows of their own.
_ROW_SHINGLES = 1 << 16


def word_array(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def _shingles(words: Column, k: int) -> Column:
    """Hashes of the ``k``-word shingles, in order; fewer words: one of all."""
    once = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))
    return once(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.when(
        F.size(h) >= k, F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - k, F.lit(0))),
                                    lambda i: F.xxhash64(*[F.get(h, i + d) for d in range(k)])))
        .when(F.size(h) > 0, F.array(F.xxhash64(F.array_join(F.transform(h, lambda x: x.cast("string")), " "))))
        .otherwise(F.array().cast("array<bigint>")))


def _small(table: DataFrame) -> DataFrame:
    """A stored table of the items' with a broadcast hint, up to BROADCAST_BYTES."""
    return F.broadcast(table) if table.count() * _ROW_BYTES <= BROADCAST_BYTES else table.hint("merge")


def _block(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, i * _BLOCK_BITS).bitwiseAND(F.lit((1 << _BLOCK_BITS) - 1))


def _blocks(fp: Column) -> Column:
    """Array of ``(block, value)``: the blocks of a fingerprint."""
    return F.array(*[F.struct(F.lit(i).alias("block"), _block(fp, i).alias("value"))
                     for i in range(BLOCKS)])


def _near_blocks(fp: Column) -> Column:
    """Array of ``(block, value)``: all values within FLIPS bits of each block."""
    masks = [sum(1 << b for b in bits) for n in range(FLIPS + 1)
             for bits in combinations(range(_BLOCK_BITS), n)]
    flips = F.array(*[F.lit(m).cast("long") for m in masks])
    return F.flatten(F.transform(_blocks(fp), lambda b: F.transform(flips, lambda m: F.struct(
        b["block"].alias("block"), b["value"].bitwiseXOR(m).alias("value")))))


def _first_block(a: Column, b: Column) -> Column:
    """The first block in which two fingerprints differ in at most FLIPS bits, or null."""
    x = a.bitwiseXOR(b)
    return F.coalesce(*[F.when(F.bit_count(_block(x, i)) <= FLIPS, F.lit(i)) for i in range(BLOCKS)])


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _fingerprints(counted: DataFrame, key: str) -> DataFrame:
    """``(key, total, fp)`` from ``(key, sh, tf)``: the number of shingles and their
    SimHash.  Bits ``j`` and ``j + 32`` are counted in the halves of one long."""
    half = BITS // 2
    sums = counted.groupBy(key).agg(F.sum("tf").alias("total"), *[
        F.sum(F.shiftrightunsigned("sh", j).bitwiseAND(F.lit(1 << half | 1)) * F.col("tf")).alias(f"c{j}")
        for j in range(half)])
    fp = F.lit(0).cast("long")
    for j in range(half):
        for ones, at in ((F.col(f"c{j}").bitwiseAND(F.lit((1 << half) - 1)), j),
                         (F.shiftrightunsigned(f"c{j}", half), j + half)):
            mask = 1 << at if at < BITS - 1 else -(1 << at)
            fp = fp.bitwiseOR(F.when(2 * ones > F.col("total"), F.lit(mask).cast("long")).otherwise(
                F.lit(0).cast("long")))
    return sums.select(key, "total", fp.alias("fp"))


def _starts(at: Column, m: Column, total: Column, num: int, den: int) -> Column:
    """The starts of windows of ``m`` shingles that hold enough of the sorted places
    ``at``, in a text of ``total`` shingles: a start belongs to the first place that is
    not before it, and each place has an interval of starts (two at the text's end)."""
    both = num + den
    need = F.expr(f"(2 * {num} * m + {both - 1}) div {both}").cast("int")
    n = F.size(at)

    def interval(low: Column, high: Column) -> Column:
        return F.struct(low.cast("int").alias("low"), high.cast("int").alias("high"))

    def whole(i: Column) -> Column:
        return interval(F.greatest(F.coalesce(F.get(at, i - 1) + 1, F.lit(0)),
                                   F.get(at, i + need - 1) - m + 1),
                        F.least(F.get(at, i), total - m))

    def cut(i: Column) -> Column:
        reach = F.floor((n - i) * both / F.lit(num))
        return interval(F.greatest(F.coalesce(F.get(at, i - 1) + 1, F.lit(0)), total - m + 1,
                                   total + m - reach), F.get(at, i))

    places = F.sequence(F.lit(0), n - 1)
    told = F.concat(F.transform(F.filter(places, lambda i: i + need <= n), whole),
                    F.transform(F.filter(places, lambda i: F.get(at, i) > total - m), cut))
    return F.flatten(F.transform(F.filter(told, lambda x: x["low"] <= x["high"]),
                                 lambda x: F.sequence(x["low"], x["high"])))


def _counted(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key, "sh").agg(F.count("*").alias("tf"))


def _rarest(item_sh: DataFrame, num: int, den: int) -> DataFrame:
    """``(item, sh)`` without each item's commonest shingles, by the number of items
    that have them, as long as these are less than ``num / den`` of the item."""
    shared = item_sh.join(item_sh.groupBy("sh").agg(F.count("*").alias("items")), "sh")
    item = Window.partitionBy("item")
    common = F.sum("tf").over(item.orderBy(F.desc("items"), "sh").rowsBetween(Window.unboundedPreceding, 0))
    return shared.select("item", "sh", common.alias("common"), F.sum("tf").over(item).alias("total")).where(
        den * F.col("common") >= num * F.col("total")).select("item", "sh")


def _windows(docs: DataFrame, shingled: Callable[[Column], Column], anchors: DataFrame, words: int,
             num: int, den: int) -> DataFrame:
    """``(doc_id, start, n_words, s)``: the windows of ``docs(doc_id, digest, text)`` of
    the lengths of ``anchors(n_words, sh)`` that hold enough of their shingles."""
    shingles = shingled(word_array(F.col("text"))).alias("s")
    places = docs.select("doc_id", "digest", shingles).select(
        "doc_id", "digest", F.size("s").alias("total"), F.posexplode("s").alias("p", "sh"))
    found = places.join(_small(anchors), "sh").groupBy("doc_id", "digest", "total", "n_words").agg(
        F.array_sort(F.collect_set("p")).alias("at"))
    m = F.col("m")
    starts = stored(found.withColumn("m", F.greatest(F.col("n_words") - (words - 1), F.lit(1))).select(
        "doc_id", "digest", "n_words", "m",
        _starts(F.col("at"), m, F.col("total"), num, den).alias("starts")).where("size(starts) > 0"), "starts")
    # a row holds some starts and the stretch of the text that their windows cover
    step = F.greatest(F.floor(F.lit(_ROW_SHINGLES) / m), F.lit(1)).cast("int")
    chunk = F.transform(F.sequence(F.lit(1), F.size("starts"), step),
                        lambda i: F.slice("starts", i, step))
    keys = stored(starts.select("doc_id", "digest").distinct(), "holders")
    held = docs.join(sized(keys), ["doc_id", "digest"], "left_semi")  # others are not shuffled
    parts = held.join(starts.withColumn("c", chunk).drop("starts"), ["doc_id", "digest"]).withColumn(
        "s", shingles).select("doc_id", "n_words", "m", F.explode(F.transform("c", lambda c: F.struct(
            c.alias("starts"), F.slice("s", F.get(c, F.lit(0)) + 1, F.get(c, F.size(c) - 1) - F.get(c, F.lit(0)) + m)
            .alias("s")))).alias("c"))
    return parts.select("doc_id", "n_words", F.explode(F.transform("c.starts", lambda p: F.struct(
        p.alias("start"), F.slice("c.s", p - F.get("c.starts", F.lit(0)) + 1, m).alias("s")))).alias("x")).select(
        "doc_id", F.col("x.start").alias("start"), "n_words", F.col("x.s").alias("s"))


def contaminated(documents: DataFrame, benchmark: DataFrame, words: int = WORDS, num: int = 80,
                 den: int = 100) -> DataFrame:
    """``(doc_id, item_id, similarity, start_word, n_words)``: every document that
    holds an item, with its most similar window (the first of equals)."""
    texts = plain(benchmark, item_id="long", text="string").where("item_id IS NOT NULL")
    items = stored(texts.withColumn("w", word_array(F.col("text"))).where("size(w) > 0").select(
        F.monotonically_increasing_id().alias("item"), "item_id", F.size("w").alias("n_words"),
        _shingles(F.col("w"), words).alias("s")), "items")
    at = stored(items.select("n_words", F.explode("s").alias("sh")).distinct(), "anchors")
    lengths = [n for n in range(1, words) if items.where(F.col("n_words") == n).limit(1).count()]
    docs = plain(documents, doc_id="long", text="string").where("doc_id IS NOT NULL AND text <> ''").select(
        "doc_id", F.xxhash64("text").alias("digest"), "text")
    windows = _windows(docs, lambda w: _shingles(w, words), at.where(F.col("n_words") >= words), words, num, den)
    for n in lengths:  # items shorter than a shingle
        windows = windows.unionAll(_windows(docs, lambda w, n=n: _grams(w, n),
                                            at.where(F.col("n_words") == n), n, num, den))
    windows = stored(windows.select(F.monotonically_increasing_id().alias("win"), "*"), "windows")

    item_sh = stored(_counted(items.select("item", F.explode("s").alias("sh")), "item"), "item-shingles")
    win_sh = stored(_counted(windows.select("win", F.explode("s").alias("sh")), "win"), "win-shingles")
    item_fp = stored(_fingerprints(item_sh, "item").join(items.select("item", "n_words"), "item").select(
        "item", "n_words", F.col("fp").alias("item_fp"), F.col("total").alias("item_total")), "item-fp")
    win_fp = stored(_fingerprints(win_sh, "win").join(windows.select("win", "n_words"), "win").select(
        "win", "n_words", "fp", F.col("total").alias("win_total")), "win-fp")

    index = stored(item_fp.withColumn("b", F.explode(_near_blocks(F.col("item_fp")))).select(
        "*", "b.block", "b.value").drop("b"), "blocks")
    within = win_fp.withColumn("b", F.explode(_blocks(F.col("fp")))).select(
        "*", "b.block", "b.value").drop("b").join(_small(index), ["n_words", "block", "value"]).where(
        (_distance(F.col("fp"), F.col("item_fp")) <= RADIUS)
        & (_first_block(F.col("fp"), F.col("item_fp")) == F.col("block")))
    rare = stored(_rarest(item_sh, num, den), "rare")
    beyond = win_sh.join(_small(rare), "sh").select("win", "item").distinct().join(
        win_fp, "win").join(_small(item_fp), ["item", "n_words"]).where(
        _distance(F.col("fp"), F.col("item_fp")) > RADIUS)
    pair = ["win", "item", "win_total", "item_total"]
    near = stored(within.select(*pair).unionAll(beyond.select(*pair)), "candidates")

    joined = near.join(win_sh.withColumnRenamed("tf", "wt"), "win").join(
        item_sh.withColumnRenamed("tf", "it"), ["item", "sh"]).groupBy(*pair).agg(
        F.sum(F.least("wt", "it")).alias("both")).withColumn(
        "any", F.col("win_total") + F.col("item_total") - F.col("both")).where(
        den * F.col("both") >= num * F.col("any"))
    told = joined.join(windows.select("win", "doc_id", "start", "n_words"), "win").join(
        items.select("item", "item_id"), "item")
    similarity = F.col("both") / F.col("any")
    best = told.groupBy("doc_id", "item_id").agg(F.min(F.struct(
        (-similarity).alias("s"), F.col("start").alias("start_word"), "n_words")).alias("b"))
    return best.select("doc_id", "item_id", (-F.col("b.s")).alias("similarity"),
                       F.col("b.start_word").cast("long").alias("start_word"),
                       F.col("b.n_words").cast("long").alias("n_words"))


def _grams(w: Column, n: int) -> Column:
    """Hashes of the ``n``-word runs, as :func:`_shingles` hashes ``n`` words that
    are fewer than a shingle."""
    h = lambda x: F.xxhash64(x).cast("string")
    return F.when(F.size(w) >= n, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0))),
        lambda i: F.xxhash64(F.array_join(F.transform(F.slice(w, i + 1, n), h), " ")))).otherwise(
        F.array().cast("array<bigint>"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without those that hold a benchmark item."""
    found = stored(contaminated(documents, benchmark).select("doc_id").distinct(), "leaks")
    return documents.join(found.withColumnRenamed("doc_id", "__llm_leak"),
                          F.col("doc_id").cast("long") == F.col("__llm_leak"), "left_anti")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_SQL_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"

#: Every window that shares a shingle with an item, compared exactly.
OP1_SQL = f"""
WITH items AS (
  SELECT row_number() OVER () AS it, item_id, w, len(w) AS n, least(5, len(w)) AS k
  FROM (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL)
  WHERE len(w) > 0),
item_sh AS (
  SELECT it, item_id, n, k, n - k + 1 AS m, sh, count(*) AS tf
  FROM (SELECT *, unnest(list_transform(range(0, n - k + 1), lambda i: array_to_string(w[i + 1:i + k], ' '))) AS sh
        FROM items) GROUP BY ALL),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS w
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
doc_sh AS (
  SELECT r, doc_id, k, len(w) - k + 1 AS total, unnest(range(0, len(w) - k + 1)) AS p,
    unnest(list_transform(range(0, len(w) - k + 1), lambda i: array_to_string(w[i + 1:i + k], ' '))) AS sh
  FROM docs, (SELECT DISTINCT k FROM items) WHERE len(w) >= k),
hits AS (SELECT r, doc_id, total, p, it, item_id, n, m, sh, tf FROM doc_sh JOIN item_sh USING (k, sh)),
starts AS (
  SELECT DISTINCT r, doc_id, total, it, item_id, n, m, unnest(range(greatest(0, p - m + 1), p + 1)) AS s
  FROM hits),
shared AS (
  SELECT a.r, a.doc_id, a.it, a.item_id, a.n, a.s, a.m + least(a.m, a.total - a.s) AS sizes, h.sh,
    least(count(*), any_value(h.tf)) AS c
  FROM starts a JOIN hits h ON a.r = h.r AND a.it = h.it AND h.p >= a.s AND h.p < a.s + a.m
  GROUP BY ALL),
windows AS (
  SELECT doc_id, item_id, n, s, CAST(sum(c) AS BIGINT) AS same, sizes - CAST(sum(c) AS BIGINT) AS any_of
  FROM shared GROUP BY r, doc_id, it, item_id, n, s, sizes)
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(item_id AS BIGINT) AS item_id,
  CAST(same AS DOUBLE) / any_of AS similarity, CAST(s AS BIGINT) AS start_word, CAST(n AS BIGINT) AS n_words
FROM windows WHERE 100 * same >= 80 * any_of
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY CAST(same AS DOUBLE) / any_of DESC, s, n) = 1
"""

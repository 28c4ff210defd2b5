"""Spelling variant grouping by permuterm rotations.

Every word gets a terminator, and all rotations of the marked words are sorted.
Rotated so that the edited character comes last, a word ``a c b`` reads ``b $ a c``:
whatever shares the prefix ``b $ a`` differs from it by one replaced character, and
the word ``a b``, whose whole rotation is that prefix, by one missing character.  So
a replacement or an indel is a prefix range that skips the edited character.  The
rotations are range-partitioned and sorted by ``(prefix, character)``, whole
rotations first in their range, and each range is scanned once.

A range holds at most one row per letter of the alphabet and one whole rotation, so
it is bounded, and its words come out of prefix and character: rows carry no word.
The scan gives each member one row, the number of its neighbours in the range and
the best of them, not all pairs.  A deletion inside a run of equal letters gives the
same word at each place, so only the run's first letter counts: no pair is counted
twice.

Words over ``LONG`` letters would make quadratic text; their ranges are named by two
rolling hashes (linear), their pairs, few, are confirmed by edit distance.

Forms: a word's form is its near word of largest count (ties: least in code-point
order) if that has at least ``factor`` times its own count.  Counts then grow along
a chain of forms, so with a factor of two or more a chain has fewer than 64 links
and six doubling steps reach every root.

Cases: null text has no words; a null ``doc_id`` is an empty one; words with U+0000
(the terminator) have no near words; repeated rows count; a word without near words
is its own root; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import plain, read, stored

TERMINATOR = "\0"
LONG = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed values of the query's contract.
LETTERS = "[A-Za-zÀ-ÿ]"
LEAST_LENGTH, LEAST_COUNT, FACTOR, DROP_ONE_IN = 7, 2, 10, 31

Best = "struct<n:bigint,word:string>"  # n is negated, so that the least is the best


def rotations(words: DataFrame) -> DataFrame:
    """``(prefix, letter, first, n)``: for every place of a word the rotation that ends
    in its letter, and for every gap the whole rotation with an empty letter.
    ``first`` is 1 unless the letter before is the same."""
    size = F.length("word")
    at = F.col("at")
    letter = F.when(at <= size, F.substr("word", at, F.lit(1))).otherwise(F.lit(""))
    # places 1..size end in their letter; places size+1..2*size+1 are the gaps 0..size
    gap = at - size - 1
    before = F.when(at <= size, at - 1).otherwise(gap)
    after = F.when(at <= size, at + 1).otherwise(gap + 1)
    first = (at <= size) & ((at == 1) | (F.substr("word", at - 1, F.lit(1)) != letter))
    return words.select("word", "n", F.explode(F.sequence(F.lit(1), 2 * size + 1)).alias("at")).select(
        F.concat(F.substr("word", after), F.lit(TERMINATOR),
                 F.substr("word", F.lit(1), before)).alias("prefix"),
        letter.alias("letter"), first.cast("long").alias("first"), "n")


def _word(prefix: Column, letter: Column) -> Column:
    at = F.instr(prefix, TERMINATOR)
    return F.concat(F.substr(prefix, at + 1), letter, F.substr(prefix, F.lit(1), at - 1))


def scan_ranges(sorted_rotations: DataFrame) -> DataFrame:
    """``(word, n_near, best)`` for every member of a prefix range of two or more."""
    same = Window.partitionBy("prefix")
    order = same.orderBy("letter")
    me = F.struct((-F.col("n")).alias("n"), F.col("word").alias("word"))
    whole = F.col("letter") == ""
    ranges = sorted_rotations.withColumn("word", _word(F.col("prefix"), F.col("letter")))
    seen = ranges.select(
        "word", "first", whole.alias("whole"),
        F.count(F.lit(1)).over(same).alias("size"),
        F.sum("first").over(same).alias("firsts"),
        F.max(whole.cast("long")).over(same).alias("wholes"),
        F.min(me).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("left"),
        F.min(me).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("right"))
    near = F.when(F.col("whole"), F.col("firsts")).otherwise(
        F.col("size") - F.col("wholes") - 1 + F.col("wholes") * F.col("first"))
    return seen.where("size > 1").select("word", near.alias("n_near"),
                                         F.least("left", "right").alias("best"))


# --- long words -----------------------------------------------------------------

_MOD = (1 << 61) - 1
_BASES = (1_000_003 * 911 + 7, 1_000_033 * 677 + 5)


def _long_ranges(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``(key, id)`` of the same ranges, named by hashes of ``b`` and ``a``."""
    rows: list[tuple[str, str]] = []
    for pdf in batches:
        for word, wid in zip(pdf["word"], pdf["id"]):
            size = len(word)
            sums = []
            for base in _BASES:
                power, total = [1], [0]
                for ch in word:
                    total.append((total[-1] * base + ord(ch)) % _MOD)
                    power.append(power[-1] * base % _MOD)
                sums.append((power, total))
            part = lambda s, i, j: (s[1][j] - s[1][i] * s[0][j - i]) % _MOD
            for k in range(2 * size + 1):
                i, j = (k, k + 1) if k < size else (k - size, k - size)  # without [i, j)
                name = ".".join(f"{part(s, 0, i):x}.{part(s, j, size):x}" for s in sums)
                rows.append((f"{i}.{name}.{size - j}", wid))
                if len(rows) >= 50_000:
                    yield pd.DataFrame(rows, columns=["key", "id"])
                    rows = []
    if rows:
        yield pd.DataFrame(rows, columns=["key", "id"])


def _near_long(words: DataFrame) -> DataFrame:
    """The same rows for pairs with a word over ``LONG`` letters."""
    named = words.where(F.length("word") >= LONG).withColumn("id", F.md5("word"))
    ranges = named.select("word", "id").mapInPandas(_long_ranges, "key string, id string").distinct()
    pairs = ranges.join(ranges.withColumnRenamed("id", "other"), "key").where("id <> other").select(
        "id", "other").distinct()
    other = named.select(F.col("id").alias("other"), F.col("word").alias("o_word"), F.col("n").alias("o_n"))
    met = pairs.join(named, "id").join(other, "other").where(
        (F.greatest(F.length("word"), F.length("o_word")) > LONG)
        & (F.levenshtein("word", "o_word", 1) == 1))
    return met.select("word", F.lit(1).cast("long").alias("n_near"),
                      F.struct((-F.col("o_n")).alias("n"), F.col("o_word").alias("word")).alias("best"))


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n, n_near, best)`` for every row of ``words(word, n)`` (distinct words,
    stored): the number of words at one inserted, deleted or replaced code point, and
    the one of largest count, a struct ``(n, word)`` with ``n`` negated."""
    able = words.where(~F.col("word").contains(TERMINATOR))
    short = scan_ranges(rotations(able.where(F.length("word") <= LONG))
                        .repartitionByRange("prefix").sortWithinPartitions("prefix", "letter"))
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"),
                        F.lit(None).cast(Best).alias("best"))
    zero = F.lit(0).cast("long").alias("n")
    found = short.unionByName(_near_long(able)).select("word", zero, "n_near", "best")
    return none.unionByName(found).groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``forms(word, form)``: the last of the chain of forms.  A chain
    has fewer than 64 links, since counts at least double: six doubling steps."""
    up = forms.select("word", F.col("form").alias("root"))
    for _ in range(6):
        step = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = stored(up.join(step, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "roots")
        if not up.where("moved").limit(1).count():
            break
        up = up.drop("moved")
    return up.select("word", "root")


def group_variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for ``words(word, n)``, distinct words.
    ``factor`` is at least 2."""
    if factor < 2:
        raise ValueError("a form has at least twice the count of its word")
    near = near_words(stored(plain(words, word="string", n="long"), "words"))
    formed = -F.col("best.n") >= factor * F.col("n")
    out = stored(near.select("word", F.when(formed, F.col("best.word")).alias("form"), "n", "n_near",
                             F.when(formed, -F.col("best.n")).alias("form_n")), "forms")
    ends = roots(out.where("form IS NOT NULL").select("word", "form"))
    return out.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def counted_runs(documents: DataFrame) -> DataFrame:
    """``(word, n)`` of the query's contract: runs of letters of whole texts, A-Z
    lower-cased, a code point dropped from one in ``DROP_ONE_IN`` of them."""
    docs = plain(documents, doc_id="string", text="string")
    # a deletion only shortens, so shorter runs need not be read
    runs = F.regexp_extract_all("text", F.lit(f"({LETTERS}{{{LEAST_LENGTH},}})"), F.lit(1))
    run = docs.select("doc_id", F.explode(runs).alias("run")).select(
        "doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = run.select("run", F.crc32(F.concat(F.coalesce("doc_id", F.lit("")), F.lit(":"), "run")
                                       .cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % DROP_ONE_IN == 0, F.concat(
        F.substr("run", F.lit(1), at), F.substr("run", at + 2))).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(counted_runs(read(spark, sf_dir, "documents")))


def _crc_nibbles() -> list[int]:
    """Remainders of the 16 half bytes under the reflected CRC-32 polynomial."""
    out = []
    for n in range(16):
        for _ in range(4):
            n = (n >> 1) ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return out


def crc32_sql(text: str) -> str:
    """DuckDB text of the CRC-32 of a string's UTF-8 bytes."""
    byte = f"CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)"
    table = str(_crc_nibbles())
    half = lambda c: f"xor({c} >> 4, {table}[CAST(({c} & 15) + 1 AS BIGINT)])"
    return (f"xor(list_reduce(list_transform(range(strlen({text})), lambda i: {byte}), lambda c, b: "
            f"{half(half('xor(c, b)'))}, 4294967295), 4294967295)")


OP11_SQL = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '{LETTERS}{{{LEAST_LENGTH},}}')),
                           '{UPPER}', '{LOWER}') AS run
  FROM documents),
hashed AS (SELECT run, {crc32_sql("(doc_id || ':' || run)")} AS h FROM runs),
damaged AS (
  SELECT CASE WHEN h % {DROP_ONE_IN} = 0
              THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM hashed),
words AS (
  SELECT word, count(*) AS n FROM damaged WHERE length(word) >= {LEAST_LENGTH}
  GROUP BY word HAVING count(*) >= {LEAST_COUNT}),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
holes AS (
  SELECT word, n, substr(word, 1, i - 1) || '_' || substr(word, i + 1) AS pattern,
         substr(word, 1, i - 1) || substr(word, i + 1) AS shorter FROM places),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b USING (pattern)
  WHERE a.word <> b.word
  UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON w.word = h.shorter
  UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON w.word = h.shorter),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n
  FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= {FACTOR} * w.n THEN other END AS form,
         CASE WHEN other_n >= {FACTOR} * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, form AS root FROM forms WHERE form IS NOT NULL
  UNION ALL
  SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(e.root, f.word) AS root, f.n, f.n_near, f.form_n
FROM forms f LEFT JOIN ends e USING (word)
"""

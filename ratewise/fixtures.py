"""Adapter views: the driver's generated tables seen as the ratings domain.

users   <- customer           ratings <- lineitem ⋈ orders (on the order key)
movies  <- part
Each view is a lazy DataFrame over the parquet files, so every query built on
it scans (and prunes) the real tables and grows with them.  The DuckDB text of
the same views lives in :mod:`ratewise.oracle`; both must cast the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Category vocabulary of the fixture items: words of part names, in alphabetical
# order.  Three words that occur are left out, so that some items have one
# category and some have none.
FIXTURE_GENRES: tuple[str, ...] = (
    "anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large",
    "new", "plate", "red", "ring", "rod",
)
FIXTURE_RELEASE_DATE = "01-Jan-1995"
FIXTURE_URL_PREFIX = "http://example.org/"
# The occupation that plays the part of 'scientist' in the fixture users.
FIXTURE_OCCUPATION = "building"
# ---------------------------------------------------------------------------

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth customer comes twice, the second time 30 years younger (so
    the copy that is kept can be the invalid one) and with another gender."""
    c = table(spark, sf_dir, "customer")
    copies = F.when(F.col("c_custkey") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    c = c.select("c_custkey", "c_acctbal", "c_mktsegment", F.explode(copies).alias("_copy"))
    return c.select(
        F.col("c_custkey").cast("bigint").alias("user_id"),
        (F.floor(F.col("c_acctbal") / 100) - 30 * F.col("_copy")).cast("int").alias("age"),
        F.when(F.col("_copy") == 1, F.lit("X")).when(F.col("c_custkey") % 2 == 0, F.lit("M"))
         .otherwise(F.lit("F")).alias("gender"),
        F.lower("c_mktsegment").alias("occupation"),
        F.lpad(F.col("c_custkey").cast("string"), 5, "0").alias("zip_code"),
    )


def _epoch_seconds(col: str) -> Column:
    return F.expr(f"timestampdiff(SECOND, {EPOCH_NTZ}, {col})").cast("bigint")


def _other_id(key: str, every: int) -> Column:
    """The key, negated in every ``every``-th."""
    k = F.col(key).cast("bigint")
    return F.when(k % every == 0, -k).otherwise(k)


def _rating_rows(spark: SparkSession, sf_dir: str, rating: Column,
                 extra: Sequence[str] = ()) -> DataFrame:
    # ratings of every 13th part, and every 11th movie, carry an id that the other
    # side lacks (but where both do), so there are orphans on both sides
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_shipdate", *extra)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        F.col("o_custkey").cast("bigint").alias("user_id"),
        _other_id("l_partkey", 13).alias("movie_id"),
        rating.alias("rating"),
        _epoch_seconds("l_shipdate").alias("timestamp"),
        *extra,
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings 1..5 from quantities 1..50."""
    return _rating_rows(spark, sf_dir, F.ceil(F.col("l_quantity") / 10).cast("int"))


def ratings_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings 0..6 (so the range check drops rows) plus, again, every row of
    line number 1 (guaranteed duplicates).  The copies come from a generator
    over one scan rather than a second scan and join."""
    base = _rating_rows(spark, sf_dir, (F.col("l_quantity").cast("int") % 7).cast("int"),
                        extra=("l_linenumber",))
    copies = F.when(F.col("l_linenumber") == 1, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1)))
    return (base.withColumn("_copy", F.explode(copies))
            .drop("_copy", "l_linenumber"))


def _name_words() -> Column:
    return F.split(F.col("p_name"), " ", -1)


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_name")


def movies_wide(spark: SparkSession, sf_dir: str,
                vocabulary: Sequence[str] = FIXTURE_GENRES) -> DataFrame:
    p = _parts(spark, sf_dir)
    words = _name_words()
    return p.select(
        _other_id("p_partkey", 11).alias("movie_id"),
        F.col("p_name").alias("movie_title"),
        F.lit(FIXTURE_RELEASE_DATE).alias("release_date"),
        F.lit("").alias("video_release_date"),
        F.concat(F.lit(FIXTURE_URL_PREFIX), F.col("p_partkey").cast("string")).alias("imdb_url"),
        *[F.array_contains(words, w).cast("int").alias(w) for w in vocabulary],
    )


def movies(spark: SparkSession, sf_dir: str,
           vocabulary: Sequence[str] = FIXTURE_GENRES) -> DataFrame:
    """Document form: the words of the name that are in the vocabulary, in
    vocabulary order."""
    p = _parts(spark, sf_dir)
    words = _name_words()
    vocab = F.array(*[F.lit(w) for w in vocabulary])
    return p.select(
        _other_id("p_partkey", 11).alias("movie_id"),
        F.col("p_name").alias("movie_title"),
        F.lit(FIXTURE_RELEASE_DATE).alias("release_date"),
        F.lit("").alias("video_release_date"),
        F.concat(F.lit(FIXTURE_URL_PREFIX), F.col("p_partkey").cast("string")).alias("imdb_url"),
        F.array_intersect(vocab, words).alias("genres"),  # vocabulary order, one split
    )


def movies_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide form with second copies: every ninth movie under another title,
    every seventh without one (which sorts first, so that movie is lost)."""
    m = movies_wide(spark, sf_dir)
    one = F.lit(0)
    copies = F.when(F.col("movie_id") % 7 == 0, F.array(one, F.lit(2))).when(
        F.col("movie_id") % 9 == 0, F.array(one, F.lit(1))).otherwise(F.array(one))
    title = F.when(F.col("_copy") == 0, F.col("movie_title")).when(
        F.col("_copy") == 1, F.concat(F.lit("a "), F.col("movie_title")))
    return m.withColumn("_copy", F.explode(copies)).withColumn("movie_title", title).drop("_copy")


def movies_without_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document form with a null category list in every fifth movie."""
    return movies(spark, sf_dir).withColumn(
        "genres", F.when(F.col("movie_id") % 5 != 0, F.col("genres")))


# --- raw text lines ---------------------------------------------------------

def _s(c: str) -> Column:
    return F.col(c).cast("string")


def user_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = users(spark, sf_dir)
    return u.select(F.concat_ws("|", *[_s(c) for c in u.columns]).alias("value"))


def rating_lines(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    r = (ratings_dirty if dirty else ratings)(spark, sf_dir)
    return r.select(F.concat_ws("\t", *[_s(c) for c in r.columns]).alias("value"))


def rating_lines_mixed(spark: SparkSession, sf_dir: str, again: bool = False) -> DataFrame:
    """Rating lines of which some end in text and some lack the last field; with
    ``again`` those of the first kind alone, for users with even ids."""
    r = ratings(spark, sf_dir)
    if again:
        r = r.where((F.col("user_id") % 6 == 0) & (F.col("rating") == 2))
    last = F.when((F.col("user_id") % 3 == 0) & (F.col("rating") == 2),
                  F.concat(F.lit("x"), _s("timestamp"))).when(
        (F.col("user_id") % 5 == 0) & (F.col("rating") == 4), F.lit(None).cast("string")).otherwise(
        _s("timestamp"))
    return r.select(F.concat_ws("\t", _s("user_id"), _s("movie_id"), _s("rating"), last).alias("value"))


def ratings_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings whose movie is unknown for every tenth movie."""
    return ratings(spark, sf_dir).withColumn(
        "movie_id", F.when(F.col("movie_id") % 10 != 0, F.col("movie_id")))


def item_lines(spark: SparkSession, sf_dir: str,
               vocabulary: Sequence[str] = FIXTURE_GENRES) -> DataFrame:
    m = movies_wide(spark, sf_dir, vocabulary)
    return m.select(F.concat_ws("|", *[_s(c) for c in m.columns]).alias("value"))


# --- profile inputs ---------------------------------------------------------

def profile_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with NULLs (status 'P') and blanks (priority '5-LOW')."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey", "o_custkey",
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(" "))
         .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        "o_totalprice",
    )


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts; some are exact copies of each other."""
    return table(spark, sf_dir, "documents").select("text")

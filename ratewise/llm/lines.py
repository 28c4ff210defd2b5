"""Line dedup by content-defined line chunks [native].

A text's lines are hashed, a rolling hash over the last two line hashes decides
where a chunk ends (probability 1/2 a line), and a line of at least ``LINE_WORDS`` words
is a chunk by itself.  Boundaries therefore depend on the lines around them alone,
and a passage keeps its inner chunks, and all its long lines, wherever it stands.

Chunks that occur more than once in the corpus, in any document or place, are
repeated except at their first occurrence (by document id, then place), after a byte
comparison: equal digests propose, equal text decides.  Adjacent repeated chunks make
a run, and runs of at least ``MIN_WORDS`` words together are removed: whole passages,
also of short lines, but not a short line that stands alone.

Words are counted as pieces between spaces.  Built from DataFrame functions
alone.  The digests of a corpus's chunks are counted with a map-side combine; texts
are shuffled only for repeated chunks.  The lists of what a document loses come to the
documents by broadcast, up to a counted size (beyond it the texts are shuffled once).

Cases: null or empty text has no chunk and stays; a text that loses every chunk
becomes the empty string; very long texts are whole; of repeated document ids
each row counts as its own document (rows are told apart by their text's digest,
and identical rows by nothing: they are cleaned alike); an empty table gives no
rows; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import plain, read, sized, stored

LINE_WORDS, MIN_WORDS = 15, 15
#: A list of repeated digests is broadcast up to this many bytes, joined beyond.
BROADCAST_BYTES = 64 << 20
_ROW_BYTES = 64


def n_words(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1


def chunks(text: Column) -> Column:
    """Array of ``(first_line, n_lines, n_words, text)`` of a text column."""
    cut = F.transform(F.split(text, "\n", -1), lambda l: F.struct(
        l.alias("l"), F.md5(l.cast("binary")).alias("h"), n_words(l).alias("w")))

    # arrays used more than once are bound by a one-element transform, so that
    # they are computed once
    once = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))

    def bounds(rows: Column) -> Column:
        ends = F.transform(rows, lambda r, i:
                           (r["w"] >= LINE_WORDS)
                           | F.coalesce(F.get(rows, i + 1)["w"] >= LINE_WORDS, F.lit(False))
                           | (F.md5(F.concat(F.coalesce(F.get(rows, i - 1)["h"], F.lit("")), r["h"])
                                    .cast("binary")) < F.lit("8")))
        starts = lambda e: F.filter(F.sequence(F.lit(0), F.size(rows) - 1),
                                    lambda i: (i == 0) | F.get(e, i - 1))
        return once(once(ends, starts), lambda at: F.transform(at, lambda s, k: F.struct(
            s.alias("first_line"),
            (F.coalesce(F.get(at, k + 1), F.size(rows)) - s).alias("n_lines"))))

    return once(cut, lambda rows: F.transform(bounds(rows), lambda b: F.struct(
        b["first_line"].alias("first_line"), b["n_lines"].alias("n_lines"),
        F.aggregate(F.slice(rows, b["first_line"] + 1, b["n_lines"]), F.lit(0),
                    lambda a, r: a + r["w"]).alias("n_words"),
        F.array_join(F.transform(F.slice(rows, b["first_line"] + 1, b["n_lines"]), lambda r: r["l"]),
                     "\n").alias("text"))))


def document_chunks(documents: DataFrame) -> DataFrame:
    """``(doc_id, doc, chunk, first_line, n_lines, n_words, digest, text)`` of every
    chunk; ``doc`` tells rows of one id apart."""
    docs = plain(documents, doc_id="long", text="string").where("text <> ''")
    rows = docs.select("doc_id", F.xxhash64("text").alias("doc"), F.posexplode(chunks(F.col("text"))))
    return rows.select("doc_id", "doc", F.col("pos").alias("chunk"), "col.first_line", "col.n_lines",
                       "col.n_words", F.col("col.text").alias("text")).withColumn(
        "digest", F.md5(F.col("text").cast("binary")))


def repeated_chunks(documents: DataFrame) -> DataFrame:
    """Every later occurrence of a chunk: ``(doc_id, doc, chunk, n_lines, n_words,
    kept_doc_id)``, the last naming the document of the first occurrence."""
    rows = document_chunks(documents)
    again = stored(rows.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"),
                   "digests")
    small = again.count() * _ROW_BYTES <= BROADCAST_BYTES
    found = stored(rows.join(F.broadcast(again) if small else again.hint("merge"), "digest"), "repeated")
    first = stored(found.groupBy("digest", "text").agg(
        F.min(F.struct("doc_id", "doc", "chunk")).alias("first")), "first")
    at = F.struct("doc_id", "doc", "chunk")
    return found.join(first.withColumnRenamed("text", "same"), "digest").where(
        (F.col("text") == F.col("same")) & ~at.eqNullSafe(F.col("first"))).select(
        "doc_id", "doc", "chunk", "n_lines", "n_words", F.col("first.doc_id").alias("kept_doc_id"))


def repeated_runs(documents: DataFrame) -> DataFrame:
    """The rows of :func:`repeated_chunks` that stand in a run of adjacent ones with at
    least ``MIN_WORDS`` words together."""
    rows = repeated_chunks(documents).distinct()
    text = Window.partitionBy("doc_id", "doc")
    runs = rows.withColumn("run", F.col("chunk") - F.row_number().over(text.orderBy("chunk")))
    words = F.sum("n_words").over(Window.partitionBy("doc_id", "doc", "run"))
    return runs.withColumn("words", words).where(F.col("words") >= MIN_WORDS).drop("run", "words")


def _lost(repeated: DataFrame) -> DataFrame:
    """One row per document row that loses chunks, ``(doc_id, doc, lost)``, with a
    broadcast hint if it is small enough."""
    return sized(stored(repeated.groupBy("doc_id", "doc").agg(F.collect_set("chunk").alias("lost")), "lost"))


def _remaining(text: Column, lost: Column) -> Column:
    return F.array_join(F.transform(
        F.filter(F.transform(chunks(text), lambda c, k: F.struct(k.alias("k"), c["text"].alias("t"))),
                 lambda c: ~F.array_contains(lost, c["k"])), lambda c: c["t"]), "\n")


def drop_repeated_lines(documents: DataFrame) -> DataFrame:
    """``documents`` with the runs of repeated chunks cut out of ``text``; the same
    rows and columns."""
    lost = _lost(repeated_runs(documents)).select(
        F.col("doc_id").alias("__llm_id"), F.col("doc").alias("__llm_doc"), F.col("lost").alias("__llm_lost"))
    joined = documents.withColumn("__llm_key", F.xxhash64("text")).join(
        lost, F.col("doc_id").cast("long").eqNullSafe(F.col("__llm_id")) & (F.col("__llm_key") == F.col("__llm_doc")), "left")
    return joined.withColumn("text", F.when(F.col("__llm_lost").isNull(), F.col("text")).otherwise(
        _remaining(F.col("text"), F.col("__llm_lost")))).select(*documents.columns)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document that loses chunks and document that keeps their first
    occurrence: what is cut, and the digest of the text that is left."""
    documents = plain(read(spark, sf_dir, "documents"), doc_id="long", text="string")
    repeated = stored(repeated_runs(documents), "removed")
    pairs = repeated.groupBy("doc_id", "doc", "kept_doc_id").agg(
        F.count("*").alias("removed_chunks"), F.sum(F.col("n_lines").cast("long")).alias("removed_lines"),
        F.sum(F.col("n_words").cast("long")).alias("removed_words"))
    left = documents.withColumn("doc", F.xxhash64("text")).join(_lost(repeated), ["doc_id", "doc"]).select(
        "doc_id", "doc", _remaining(F.col("text"), F.col("lost")).alias("text"))
    told = left.select("doc_id", "doc", F.length("text").cast("long").alias("chars_left"),
                       F.md5(F.col("text").cast("binary")).alias("text_md5"))
    return pairs.join(told, ["doc_id", "doc"]).select(
        "doc_id", "kept_doc_id", "removed_chunks", "removed_lines", "removed_words", "chars_left",
        "text_md5")


OP3_SQL = """
WITH lines AS (
  SELECT doc_id, CAST(i - 1 AS BIGINT) AS i, l, md5(l) AS h,
         length(l) - length(replace(l, ' ', '')) + 1 AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l,
               unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
        FROM documents WHERE text <> '')),
marked AS (
  SELECT *, w >= 15 OR coalesce(lead(w) OVER d >= 15, false) OR md5(coalesce(lag(h) OVER d, '') || h) < '8' AS ends FROM lines
  WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (
  SELECT *, coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY doc_id ORDER BY i
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM marked),
chunked AS (
  SELECT doc_id, chunk, count(*) AS n_lines, sum(w) AS n_words,
         string_agg(l, chr(10) ORDER BY i) AS text FROM numbered GROUP BY doc_id, chunk),
ranked AS (
  SELECT *, row_number() OVER c AS nth, first_value(doc_id) OVER c AS kept_doc_id
  FROM chunked WINDOW c AS (PARTITION BY text ORDER BY doc_id, chunk)),
repeated AS (
  SELECT *, chunk - row_number() OVER (PARTITION BY doc_id ORDER BY chunk) AS run
  FROM ranked WHERE nth > 1),
removed AS (
  SELECT * FROM repeated QUALIFY sum(n_words) OVER (PARTITION BY doc_id, run) >= 15),
left_over AS (
  SELECT c.doc_id, coalesce(string_agg(CASE WHEN r.doc_id IS NULL THEN c.text END, chr(10) ORDER BY c.chunk), '') AS text
  FROM chunked c LEFT JOIN removed r ON r.doc_id = c.doc_id AND r.chunk = c.chunk
  WHERE c.doc_id IN (SELECT doc_id FROM removed) GROUP BY c.doc_id)
SELECT r.doc_id, r.kept_doc_id, count(*) AS removed_chunks, CAST(sum(r.n_lines) AS BIGINT) AS removed_lines,
       CAST(sum(r.n_words) AS BIGINT) AS removed_words, any_value(length(l.text)) AS chars_left,
       any_value(md5(l.text)) AS text_md5
FROM removed r JOIN left_over l ON l.doc_id = r.doc_id GROUP BY r.doc_id, r.kept_doc_id
"""

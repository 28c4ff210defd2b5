"""A training corpus from ``documents``: five stages, each over all that its
predecessor kept, each written as Parquet and read again.

1. language ID: documents without an identifiable language go;
2. line dedup: repeated line chunks are cut out but for their first occurrence;
   documents that keep no text go;
3. MinHash near-dedup (five-word shingles, similarity 0.8): one document of each
   group stays;
4. benchmark decontamination: documents that hold a benchmark item go;
5. best-fit packing: the pieces of all that is left and their places.

All stages but the last return the columns of ``documents``.  Two stages learn or
tokenise, so SQL cannot express the rows; the tests hold them against a
brute-force version.

A stage's ``docs`` are its predecessor's stored rows, so when a stage begins, the
intermediate tables of the one before it are no longer read and are removed.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm import decontam, langid, lines, minhash, packing
from ratewise.llm.common import forget, noting, read, stored

#: A document is rejected below this score, or when it has no letter at all.
LEAST_SCORE = 0.3

ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.identified(docs, LEAST_SCORE)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = lines.drop_repeated_lines(docs).where("text <> ''")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs, 5, 80, 100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


#: Intermediate tables of the latest stage, by the folder it works for.
_left: dict[str, list[str]] = {}


def _tidy(stage):
    """The stage, removing first what the stage before it left behind."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        forget(spark, _left.pop(sf_dir, []))
        with noting() as made:
            out = stage(spark, docs, sf_dir)
        _left[sf_dir] = made
        return out
    return run_stage


STAGES = [(stage.__name__, _tidy(stage)) for stage in (
    language_id, line_dedup, minhash_dedup, decontamination, best_fit_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    forget(spark, _left.pop(sf_dir, []))
    return docs

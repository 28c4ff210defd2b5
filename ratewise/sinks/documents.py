"""Document sink (K3): one JSON object per row, arrays kept as arrays."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas
from .tables import commit, conform, observed, stage


def stage_documents(df: DataFrame, path: str, fmt: str = "json",
                    options: Mapping[str, str] | None = None,
                    conform_to=schemas.MOVIES, observation: Observation | None = None) -> dict:
    """The first half of K3: write ``df``'s documents to a new folder of ``path``.  The
    checksum is of the documents as they read back, with no list as an empty one."""
    out = conform(df, conform_to) if conform_to is not None else df
    if observation is not None and "genres" in out.columns:
        out = out.withColumn("genres", F.coalesce("genres", F.array().cast(out.schema["genres"].dataType)))
    writer = observed(out, observation).write.format(fmt).options(**(options or {}))
    return stage(df.sparkSession, path, writer.save)


def load_documents_overwrite(df: DataFrame, path: str, fmt: str = "json",
                             options: Mapping[str, str] | None = None,
                             conform_to=schemas.MOVIES,
                             observation: Observation | None = None) -> str:
    """K3: replace the collection at ``path`` with ``df``'s documents, written beside
    it and then committed; ``observation`` gets their number and checksum.  An
    empty input leaves an empty collection (drop, then nothing to insert).
    NULL fields are omitted from a document, and read back as missing."""
    return commit(df.sparkSession, path,
                  stage_documents(df, path, fmt, options, conform_to, observation))

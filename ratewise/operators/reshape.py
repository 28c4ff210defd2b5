"""Flag columns <-> category arrays <-> long rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import flag_names_array


def flags_to_array(wide: DataFrame, vocabulary: Sequence[str] = schemas.DEFAULT_GENRES,
                   array_column: str = "genres") -> DataFrame:
    """Replace the flag columns named in ``vocabulary`` by one array of the
    names set to 1, in vocabulary order.  Other columns are kept as they are."""
    vocab = list(vocabulary)
    keep = [F.col(f"`{c}`") for c in wide.columns if c not in vocab]
    flags = [(name, F.col(f"`{name}`")) for name in vocab]
    return wide.select(*keep, flag_names_array(flags).alias(array_column))


def explode_genres(movies: DataFrame, array_column: str = "genres",
                   keep: Sequence[str] = ("movie_id", "movie_title"),
                   out_column: str = "genre") -> DataFrame:
    """R2: one row per array element.  NULL or empty arrays produce no row
    (``explode``, not ``explode_outer``)."""
    return movies.select(*keep, F.explode(array_column).alias(out_column))

"""Projections and row predicates.

Comparisons are plain column predicates, so on a stored table they reach the
scan as ``PushedFilters`` (and ``PartitionFilters`` on a layout partitioned by
the filtered column).  NULL never satisfies them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

USER_COLUMNS = ("user_id", "age", "gender", "occupation", "zip_code")


def project_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the named columns, in the given order."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def users_younger_than(users: DataFrame, age: int = 20) -> DataFrame:
    """Users with ``age < n`` (strict)."""
    return users.filter(F.col("age") < age).select(*USER_COLUMNS)


def users_by_occupation_and_age(users: DataFrame, occupation: str = "scientist",
                                min_age: int = 30, max_age: int = 40) -> DataFrame:
    """P5: ``occupation = x`` (case-sensitive) and ``min <= age <= max``."""
    return (users.filter((F.col("occupation") == occupation)
                         & (F.col("age") >= min_age) & (F.col("age") <= max_age))
            .select(*USER_COLUMNS))

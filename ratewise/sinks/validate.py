"""Read-back validation of stored tables (K7)."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import checksum, conform


class Written(NamedTuple):
    """What a write's observation counted."""
    rows: int
    checksum: str | None = None


def _measured(df: DataFrame, name: str, kind: str, with_checksum: bool) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                  (checksum(df) if with_checksum else F.lit(None).cast("string")).alias("checksum")).select(
        F.lit(name).alias("table_name"), F.lit(kind).alias("kind"), "n", "checksum")


def _hashable(df: DataFrame) -> bool:
    return not any(isinstance(f.dataType, (T.MapType, T.VariantType)) for f in df.schema.fields)


def validate_stored_counts(stored: Mapping[str, DataFrame],
                           expected: Mapping[str, DataFrame | Written | int]) -> DataFrame:
    """K7: ``(table_name, expected_rows, actual_rows, checksum_ok, ok)``, one row per table.
    ``stored`` are the tables read back; ``expected`` gives what the writer observed
    (:class:`Written`), the DataFrame whose rows are expected (evaluated again, as the
    stored types), or a bare row count.

    Counts alone accept wrong values, so an order-free checksum of the rows is compared
    too (``checksum_ok``; null where only a count is known).  ``ok`` says that nothing
    known differs.  All are aggregates on the executors; only the small report is ever
    collected."""
    parts: list[DataFrame] = []
    for name, df in stored.items():
        exp = expected.get(name)
        same = isinstance(exp, DataFrame) and sorted(exp.columns) == sorted(df.columns)
        summed = _hashable(df) and (same or (isinstance(exp, Written) and exp.checksum is not None))
        parts.append(_measured(df, name, "actual", summed))
        if isinstance(exp, DataFrame):
            parts.append(_measured(conform(exp, df.schema) if summed else exp, name, "expected", summed))
        elif exp is not None:
            rows, told = exp if isinstance(exp, Written) else (exp, None)
            parts.append(df.sparkSession.range(1).select(
                F.lit(name).alias("table_name"), F.lit("expected").alias("kind"),
                F.lit(int(rows)).cast("bigint").alias("n"),
                F.lit(told if summed else None).cast("string").alias("checksum")))
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    of = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    return (report.groupBy("table_name")
            .agg(of("expected", "n").alias("expected_rows"), of("actual", "n").alias("actual_rows"),
                 (of("expected", "checksum") == of("actual", "checksum")).alias("checksum_ok"))
            .withColumn("ok", F.coalesce(F.col("expected_rows") == F.col("actual_rows"), F.lit(False))
                        & F.coalesce("checksum_ok", F.lit(True))))

"""Rows that cannot be loaded, with the reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASONS = "reject_reasons"


class RejectedRowsError(ValueError):
    """A strict load met rows it cannot accept."""


def reasons(checks: dict[str, Column]) -> Column:
    """Names of the checks that hold, as an array; a null check does not hold."""
    named = F.array(*[F.when(check, F.lit(name)) for name, check in checks.items()])
    return F.array_compact(named).alias(REASONS)


def split_valid_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    bad = F.size(REASONS) > 0
    return df.filter(~bad).drop(REASONS), df.filter(bad)


def count_reasons(df: DataFrame) -> DataFrame:
    """Rows per reject reason."""
    return df.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


def require_valid(df: DataFrame) -> DataFrame:
    """All or nothing: fail if any row is rejected, before anything is written."""
    counts = {r["reason"]: r["rows"] for r in count_reasons(df).collect()}
    if counts:
        raise RejectedRowsError(", ".join(f"{k}: {n} rows" for k, n in sorted(counts.items())))
    return df.drop(REASONS)

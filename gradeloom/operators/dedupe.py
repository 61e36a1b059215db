"""Distinct rows, first and last rows per key, duplicate reports.

First and last are aggregates (``min_by``, ``max_by``), not windows: each task reduces its own
rows before the shuffle, so a key that holds a third of the table stays cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, key: list[str], chosen: Column) -> DataFrame:
    picked = df.groupBy(*key).agg(chosen.alias("r"))
    return picked.select(*[F.col(f"r.`{c}`").alias(c) for c in df.columns])


def _row(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """First row per key in the given order."""
    return _pick(df, key, F.min_by(_row(df), F.struct(*order)))


def keep_last(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Last row per key in the given order, as when later rows overwrite earlier ones."""
    return _pick(df, key, F.max_by(_row(df), F.struct(*order)))


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count. Null keys do not count."""
    return df.dropna(subset=key).groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def duplicate_rows(df: DataFrame, key: list[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    return df.join(duplicate_keys(df, key), key)


def distinct_schools(rows: DataFrame, name: str, county: str, drop_nulls: bool = False) -> DataFrame:
    """Distinct school names with their county, ready to be matched."""
    schools = rows.select(name, county)
    return (schools.dropna() if drop_nulls else schools).distinct()


def used_codes(*facts: DataFrame, code: str = "unitate_siiir") -> DataFrame:
    """School codes that occur in any fact table.

    Each table is reduced on its own first, so the union holds one row per code and table.
    """
    merged = None
    for fact in facts:
        codes = fact.select(code).distinct()
        merged = codes if merged is None else merged.union(codes)
    return merged.distinct()


def school_triples(
    facts: DataFrame, year: int | None = None, own_cohort_only: bool = False, drop_nulls: bool = False
) -> DataFrame:
    """Distinct code, name and county of the schools in a fact table."""
    if year is not None:
        facts = facts.filter(F.col("an") == year)
    if own_cohort_only:
        facts = facts.filter(~F.col("promotie_anterioara"))
    triples = facts.select("unitate_siiir", "unitate_nume", "unitate_cod_judet")
    return (triples.dropna() if drop_nulls else triples).distinct()

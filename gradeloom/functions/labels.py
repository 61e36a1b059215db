"""Closed label sets and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeloom.functions import rules
from gradeloom.functions._columns import ColumnLike, col, lookup
from gradeloom.functions.names import plain_letters


def parse_sex(c: ColumnLike) -> Column:
    return lookup(F.lower(col(c)), rules.SEX_LABELS)


def result_label(c: ColumnLike) -> Column:
    """One of five labels; null for anything else."""
    labels = rules.RESULT_SYNONYMS | {label: label for label in rules.RESULT_LABELS}
    return lookup(F.lower(col(c)), labels)


def old_result_label(c: ColumnLike) -> Column:
    return lookup(F.upper(plain_letters(c)), rules.OLD_RESULT_SYNONYMS)


def earlier_cohort(cohort: ColumnLike, year: int | ColumnLike) -> Column:
    """True unless the cohort text is the year's own; a missing text counts as earlier."""
    year = F.lit(year) if isinstance(year, int) else col(year)
    own = F.concat((year - 1).cast("string"), F.lit("-"), year.cast("string"))
    return ~col(cohort).eqNullSafe(own)


def is_yes(c: ColumnLike) -> Column:
    return F.upper(col(c)) == "DA"


def mother_tongue(c: ColumnLike, none_marks: tuple[str, ...] = ("",)) -> Column:
    c = col(c)
    return F.when(~c.isin(*none_marks), c)

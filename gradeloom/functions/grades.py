"""Grades, final marks and averages. Grades are ``DECIMAL(4,2)`` between 1 and 10."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeloom.functions._columns import ColumnLike, col

GRADE = "decimal(4,2)"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def parse_number(c: ColumnLike) -> Column:
    """Number, else null. Texts such as ``9.5d`` or ``NaN``, which a cast would take, are none."""
    text = col(c).cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def parse_grade(c: ColumnLike, upper: float | None = 10) -> Column:
    """Number between 1 and ``upper``, else null."""
    value = parse_number(c)
    in_range = value >= 1
    if upper is not None:
        in_range = in_range & (value <= upper)
    return F.when(in_range, value.try_cast(GRADE if upper == 10 else "decimal(12,2)"))


def final_grade(appeal: ColumnLike, first: ColumnLike) -> Column:
    """The mark after appeal counts, else the first one."""
    return F.coalesce(col(appeal), col(first))


def published_final_grade(final_raw: ColumnLike, first_raw: ColumnLike, test_raw: bool = False) -> Column:
    """Older files: the published final mark, else the first one.

    ``test_raw`` lets any non-null cell win, even one that is no valid grade.
    """
    final, first = parse_grade(final_raw, upper=None), parse_grade(first_raw, upper=None)
    if test_raw:
        return F.when(col(final_raw).isNotNull(), final).otherwise(first)
    return F.coalesce(final, first)


def hundredths(grade: ColumnLike) -> Column:
    return (col(grade) * 100).cast("int")


def truncated_mean(required: list[ColumnLike], optional: ColumnLike, optional_subject: ColumnLike) -> Column:
    """Mean cut to two decimals; the optional grade counts when present.

    Null when a required grade is missing, or the optional one is although its subject is named.
    """
    optional, optional_subject = col(optional), col(optional_subject)
    total = reduce(lambda a, b: a + b, [hundredths(g) for g in required])
    with_optional = F.floor((total + hundredths(optional)) / F.lit(len(required) + 1))
    without = F.floor(total / F.lit(len(required)))
    mean = F.when(optional.isNotNull(), with_optional).when(optional_subject.isNull(), without)
    return (mean / F.lit(100)).cast(GRADE)


def reconcile(published: ColumnLike, computed: ColumnLike) -> Column:
    return F.coalesce(col(published), col(computed))


def averages_disagree(published: ColumnLike, computed: ColumnLike) -> Column:
    return F.coalesce(col(published) != col(computed), F.lit(False))


def old_mean(label: ColumnLike, lr: ColumnLike, do: ColumnLike, da: ColumnLike, lm: ColumnLike) -> Column:
    """Older average: only for passed or failed rows, not cut."""
    lm = col(lm).cast("double")
    total = col(lr).cast("double") + col(do).cast("double") + col(da).cast("double")
    total = total + F.coalesce(lm, F.lit(0.0))
    count = F.when(lm.isNotNull(), 4).otherwise(3)
    return F.when(col(label).isin("REUSIT", "RESPINS"), total / count)

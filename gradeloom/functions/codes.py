"""Candidate codes and ten-digit school codes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeloom.functions import rules
from gradeloom.functions._columns import ColumnLike, bind, col

_LETTERS_THEN_DIGITS = r"^([A-Za-z]*)([0-9]*)"


def candidate_number(c: ColumnLike) -> Column:
    """Digits after the leading letters; may be empty."""
    return F.regexp_extract(col(c), _LETTERS_THEN_DIGITS, 2)


def county_prefix(c: ColumnLike) -> Column:
    """Leading letters; null when there are none."""
    return F.nullif(F.regexp_extract(col(c), _LETTERS_THEN_DIGITS, 1), F.lit(""))


def check_digit(code: ColumnLike) -> Column:
    """Weighted sum of the first nine digits modulo nine, with nine in place of zero."""
    code = col(code)
    terms = [
        F.substring(code, place + 1, 1).try_cast("int") * weight
        for place, weight in enumerate(rules.SCHOOL_CODE_WEIGHTS)
    ]
    remainder = reduce(lambda a, b: a + b, terms) % 9
    return F.when(remainder == 0, 9).otherwise(remainder).cast("string")


def school_code(c: ColumnLike) -> Column:
    """Active form of a code: 4th digit 1; 5th digit 3 becomes 2 with a new check digit."""
    c = col(c)
    active = F.concat(F.substring(c, 1, 3), F.lit("1"), F.substring(c, 5, 6))
    stem = F.concat(F.substring(active, 1, 4), F.lit("2"), F.substring(active, 6, 4))
    fixed = F.when(F.substring(c, 5, 1) == "3", bind(stem, lambda s: F.concat(s, check_digit(s)))).otherwise(active)
    return F.when(F.length(c) == 10, fixed)


def bad_school_code(c: ColumnLike) -> Column:
    """True for a code that is present but cannot be brought to the active form."""
    return col(c).isNotNull() & school_code(c).isNull()

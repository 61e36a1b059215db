"""Cells of the school registry and attributes built from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeloom.functions import rules
from gradeloom.functions._columns import ColumnLike, bind, col, strip
from gradeloom.functions.codes import school_code
from gradeloom.functions.names import title_case

_DAY_FIRST = r"(\d{2})/(\d{2})/(\d{4})"


def registry_cell(c: ColumnLike) -> Column:
    """Empty to null; a text that starts with a day-first date gets year-first dates."""
    c = F.nullif(col(c), F.lit(""))
    return F.when(c.rlike("^" + _DAY_FIRST), F.regexp_replace(c, _DAY_FIRST, "$3-$2-$1")).otherwise(c)


def registry_code_cell(c: ColumnLike) -> Column:
    """Codes of more than three characters are brought to their active form."""
    return bind(registry_cell(c), lambda cell: F.when(F.length(cell) > 3, school_code(cell)).otherwise(cell))


def bad_registry_code(c: ColumnLike) -> Column:
    """A long code cell that has no active form."""
    return bind(registry_cell(c), lambda cell: F.coalesce((F.length(cell) > 3) & school_code(cell).isNull(), F.lit(False)))


def _edge(c: Column) -> Column:
    return F.trim(c, F.lit(" ,."))


def postal_address(street: ColumnLike, number: ColumnLike, locality: ColumnLike, postcode: ColumnLike) -> Column:
    """One line from the parts; null without a street."""
    number = F.coalesce(col(number), F.lit(""))
    shown = ~strip(number).isin(rules.NO_STREET_NUMBER)
    return F.concat(
        _edge(col(street)),
        F.when(shown, F.concat(F.lit(" "), _edge(number))).otherwise(F.lit("")),
        F.coalesce(F.concat(F.lit(", "), title_case(locality)), F.lit("")),
        F.coalesce(F.concat(F.lit(", "), col(postcode)), F.lit("")),
    )


def change_stamp() -> Column:
    """Now, in milliseconds since the epoch."""
    return F.unix_millis(F.current_timestamp())

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def replace_all(c: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda acc, pair: F.replace(acc, F.lit(pair[0]), F.lit(pair[1])), pairs, c)


# White space as Unicode-aware trimming understands it.
_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007" \
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.trim(c, F.lit(_SPACES))


def lookup(c: Column, table: dict[str, str]) -> Column:
    """Value of ``c`` in a short fixed table, null when absent."""
    cells = [F.lit(cell) for pair in table.items() for cell in pair]
    return F.try_element_at(F.create_map(*cells), c)


def bind(c: Column, body) -> Column:
    """``body`` applied to ``c``, with ``c`` worked out once however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(c), body), 1)

"""Import this to have every query registered."""

from catalog import expression_queries, file_queries, school_queries, table_queries, year_queries  # noqa: F401
from catalog.registry import ORACLES, QUERIES  # noqa: F401

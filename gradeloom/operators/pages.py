"""Stored result pages ``(page_id, url, html)`` as tables.

Rows are cut out of a page with native regular expressions, so a page never leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.functions import rules
from gradeloom.functions._columns import ColumnLike, bind, col, replace_all, strip

RESULT_ROW = r"""(?is)<tr\b[^>]*\bclass\s*=\s*["']?(?:[^"'>]*\s)?tr[12](?=[\s"'>])[^>]*>(.*?)</tr>"""
TABLE_CELL = r"(?is)<td\b[^>]*>(.*?)</td>"
LIST_ROW = r"(?is)<li\b[^>]*>(.*?)</li>"
LINK_CELL = r"(?is)<a\b[^>]*>(.*?)</a>"

_HIDDEN = r"""(?is)<input\b(?=[^>]*\btype\s*=\s*["']?hidden["'\s/>])[^>]*>"""
_NAME = r"""(?is)\bname\s*=\s*["']([^"']*)["']"""
_VALUE = r"""(?is)\bvalue\s*=\s*["']([^"']*)["']"""


def is_error_page(html: ColumnLike) -> Column:
    return col(html).contains(rules.ERROR_PAGE_MARK)


def page_numbers(html: ColumnLike) -> Column:
    """All numbers of ``pag. N`` labels, in page order."""
    found = F.regexp_extract_all(col(html), F.lit(r"pag. ([0-9]+)"), 1)
    return F.transform(found, lambda n: n.cast("int"))


def page_count(html: ColumnLike, last: bool = False) -> Column:
    """Highest labelled page, or the last label on the page."""
    numbers = page_numbers(html)
    return F.try_element_at(numbers, F.lit(-1)) if last else F.array_max(numbers)


def _character(number: Column) -> Column:
    """Character of a code point; those that are none give the replacement character."""
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(valid, number).otherwise(0xFFFD)), 8, "0")), "UTF-32")


# The usual references: all but that of the ampersand itself can be replaced one after the other.
_USUAL = ["lt", "gt", "quot", "apos", "nbsp"]
_UNUSUAL = "&(?!(?:amp|" + "|".join(_USUAL) + ");)#?[0-9A-Za-z]+;"


def decoded(text: Column) -> Column:
    """Text with its character references replaced, each once; unknown ones stay as they are."""
    entities = rules.html_entities() | {"&apos;": "'"}
    usual = F.replace(replace_all(text, [(f"&{n};", entities[f"&{n};"]) for n in _USUAL]), F.lit("&amp;"), F.lit("&"))
    return F.when(~text.contains("&"), text).when(text.rlike(_UNUSUAL), _decoded_pieces(text)).otherwise(usual)


def _decoded_pieces(text: Column) -> Column:
    """The same for any references: the text is cut at each, and each is looked up."""
    named = F.create_map(*[F.lit(x) for pair in rules.html_entities().items() for x in pair])

    def reference(piece: Column) -> Column:
        decimal = F.regexp_extract(piece, r"^&#([0-9]{1,8});$", 1)
        hexadecimal = F.regexp_extract(piece, r"^&#[xX]([0-9A-Fa-f]{1,7});$", 1)
        return (
            F.when(~piece.startswith("&"), piece)
            .when(decimal != "", _character(decimal.try_cast("bigint")))
            .when(hexadecimal != "", _character(F.conv(hexadecimal, 16, 10).try_cast("bigint")))
            .otherwise(F.coalesce(F.try_element_at(named, piece), piece))
        )

    pieces = F.regexp_extract_all(text, F.lit(r"(&#?[0-9A-Za-z]+;|[^&]+|&)"), F.lit(1))
    return F.array_join(F.transform(pieces, reference), "")


def cell_text(inner: ColumnLike, separator: str = "") -> Column:
    """Text of a cell: its parts between tags, each trimmed, empty ones dropped, joined."""
    text = F.regexp_replace(col(inner), r"(?is)<!--.*?-->|<(script|style)\b.*?</\1>", "")
    parts = F.transform(F.split(text, r"<[^>]*>"), lambda p: strip(decoded(p)))
    return F.array_join(F.filter(parts, lambda p: p != ""), separator)


def row_cells(
    html: ColumnLike, row: str = RESULT_ROW, cell: str = TABLE_CELL, separator: str = ""
) -> Column:
    """Array of rows, each an array of cell texts."""
    rows = F.regexp_extract_all(col(html), F.lit(row), 1)
    return F.transform(
        rows,
        lambda r: F.transform(
            F.regexp_extract_all(r, F.lit(cell), 1), lambda c: cell_text(c, separator)
        ),
    )


def paired_rows(rows: ColumnLike) -> Column:
    """Records that span two lines: row 2k joined with row 2k+1.

    The second half of a last odd row is empty, which the page audit reports.
    """
    nothing = F.array().cast("array<string>")

    def pair_up(lines: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(lines)), lambda i: (i % 2 == 0) & (i < F.size(lines)))
        return F.transform(starts, lambda i: F.concat(F.get(lines, i), F.coalesce(F.get(lines, i + 1), nothing)))

    return bind(F.coalesce(col(rows), F.array().cast("array<array<string>>")), pair_up)


def page_rows(
    pages: DataFrame, row: str = RESULT_ROW, cell: str = TABLE_CELL, separator: str = "",
    two_lines: bool = False, keep: list[str] = ["page_id"],
) -> DataFrame:
    """One line per result row of every page that is not an error page."""
    rows = row_cells("html", row, cell, separator)
    if two_lines:
        rows = paired_rows(rows)
    good = pages.filter(~is_error_page("html"))
    # The inner form would make Spark test the array for emptiness, and cut the page up twice.
    cut = good.select(*keep, F.posexplode_outer(rows).alias("row_no", "cells"))
    return cut.filter(F.col("row_no").isNotNull())


def first_line(c: ColumnLike) -> Column:
    return strip(F.split_part(col(c), F.lit("\n"), F.lit(1)))


def reorder_two_lines(first: ColumnLike, second: ColumnLike) -> Column:
    """Older layout of a two-line record, without the ranking columns the first line may have.

    The first cell of each span keeps all its lines, the others their first one.
    """

    def span(line: Column, start, stop) -> Column:
        return F.slice(line, start + F.lit(1), stop - start + F.lit(1))

    def kept_whole(cells: Column) -> Column:
        return F.transform(cells, lambda c, i: F.when(i == 0, strip(c)).otherwise(first_line(c)))

    def join_spans(one: Column, two: Column) -> Column:
        extra = F.size(one) - 19
        # Spans of the two lines, in the order of the older files.
        return F.concat(*[kept_whole(s) for s in (
            span(one, F.lit(0), F.lit(1)),
            span(one, extra + 2, extra + 11),
            span(two, F.lit(0), F.lit(3)),
            span(one, extra + 12, extra + 14),
            span(two, F.lit(4), F.lit(6)),
            span(one, extra + 15, extra + 15),
            span(two, F.lit(7), F.lit(9)),
            span(one, extra + 16, extra + 18),
        )])

    return bind(col(first), lambda one: bind(col(second), lambda two: join_spans(one, two)))


def name_cells(rows: DataFrame, header: list[str], keep: list[str]) -> DataFrame:
    """Cells as named columns."""
    return rows.select(*keep, *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(header)])


def page_audit(rows: DataFrame, page: list[str], first_id: str, size: int, last_page: DataFrame | None = None,
               set_key: list[str] = []) -> DataFrame:
    """Completeness of each page: rows seen, expected first number, and what is wrong.

    ``rows`` has one line per result row with ``row_no`` and its printed number ``first_id``;
    the last element of ``page`` is the page number. ``last_page`` gives the last page number
    per ``set_key``; without it the highest page seen counts as last.
    """
    number = page[-1]
    seen = rows.groupBy(*page).agg(F.count("*").alias("rows"), F.min_by(F.col(first_id), "row_no").alias("first_no"))
    if set_key:
        tops = last_page if last_page is not None else seen.groupBy(*set_key).agg(F.max(number).alias("last_no"))
        seen = seen.join(tops.select(*set_key, "last_no"), set_key)
    else:
        last = last_page.agg(F.max("last_no")) if last_page is not None else seen.agg(F.max(number))
        seen = seen.withColumn("last_no", last.scalar())
    expected = (F.col(number) - 1) * size + 1
    wrong_first = ~F.col("first_no").cast("bigint").eqNullSafe(expected.cast("bigint"))
    wrong_size = (F.col("rows") != size) & ((F.col(number) < F.col("last_no")) | (F.col("rows") > size))
    return seen.withColumns(
        {"expected_first": expected.cast("bigint"), "wrong_first": wrong_first, "wrong_size": wrong_size}
    ).withColumn("refetch", F.col("wrong_first") | F.col("wrong_size"))


def hidden_fields(html: ColumnLike) -> Column:
    """Hidden form fields as a map from name to value; the last of a repeated name counts."""
    tags = F.regexp_extract_all(col(html), F.lit(_HIDDEN), 0)
    entries = F.transform(
        tags, lambda t: F.struct(F.regexp_extract(t, _NAME, 1).alias("k"), F.regexp_extract(t, _VALUE, 1).alias("v"))
    )

    def put(fields: Column, entry: Column) -> Column:
        others = F.map_filter(fields, lambda k, _: k != entry["k"])
        return F.map_concat(others, F.create_map(entry["k"], entry["v"]))

    return F.aggregate(entries, F.create_map().cast("map<string,string>"), put)


def has_form_fields(html: ColumnLike, required: list[str] = rules.REQUIRED_FORM_FIELDS) -> Column:
    names = F.map_keys(hidden_fields(html))
    return F.size(F.array_except(F.array(*[F.lit(r) for r in required]), names)) == 0


def expected_pages(counts: DataFrame, set_key: str, pages: str) -> DataFrame:
    """Every page that should exist, with the batch that ends before the next multiple of ten."""
    numbered = counts.select(set_key, F.explode(F.sequence(F.lit(1), F.col(pages))).alias("page_no"))
    return numbered.withColumn("batch", F.floor(F.col("page_no") / 10).cast("int"))


def missing_pages(expected: DataFrame, seen: DataFrame, key: list[str]) -> DataFrame:
    return expected.join(seen.select(*key), key, "left_anti")


def in_page_order(rows: DataFrame, order: list[str] = ["page_no", "row_no"]) -> DataFrame:
    return rows.orderBy(*order)


def counties(spark) -> DataFrame:
    """County reference: position, code, plain name, display name."""
    rows = [(i, *c) for i, c in enumerate(rules.COUNTIES, start=1)]
    return spark.createDataFrame(rows, "county_no int, cod_judet string, nume string, nume_complet string")


def with_county(rows: DataFrame, county_no: str) -> DataFrame:
    """County code of a page set on each of its rows. The reference has 42 rows."""
    codes = F.broadcast(counties(rows.sparkSession).select(F.col("county_no").alias(county_no), "cod_judet"))
    return rows.join(codes, county_no, "left")

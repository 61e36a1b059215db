"""Readers. Every cell is a string until an expression parses it."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom.functions._columns import strip
from gradeloom.functions.grades import parse_number
from gradeloom.sources.contracts import ContractError, parse_layout, quoted
from gradeloom.sources.pieces import CsvLines, json_lines, split_records

BAD_LINE = "_bad_line"
#: Bytes that a file is opened for to find its header.
HEADER_BYTES = 65_536

# Quotes are doubled inside quoted cells, not escaped by a backslash.
_CSV = {"quote": '"', "escape": '"', "encoding": "UTF-8", "mode": "PERMISSIVE"}


def _strings(names: list[str]) -> T.StructType:
    fields = [T.StructField(n, T.StringType()) for n in names]
    return T.StructType(fields + [T.StructField(BAD_LINE, T.StringType())])


def _csv(spark: SparkSession, path, names: list[str], header: bool, quoted_newlines: bool) -> DataFrame:
    reader = spark.read.options(**_CSV).option("columnNameOfCorruptRecord", BAD_LINE)
    # With a header, each file's own is held against the names: another order of columns is an error.
    return reader.csv(path, schema=_strings(names), header=header, multiLine=quoted_newlines, enforceSchema=not header)


def csv_header(spark: SparkSession, path, quoted_newlines: bool = True) -> list[str]:
    """Names in the first row. A repeated name is an error."""
    first = spark.read.options(**_CSV).csv(path, header=False, multiLine=quoted_newlines).first()
    if first is None:
        raise ContractError("no header row")
    names = [cell if cell is not None else "" for cell in first]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ContractError(f"repeated column names: {repeated}")
    return names


def read_records(
    spark: SparkSession, path, fmt: str = "csv", quoted_newlines: bool = True, lines: bool = False, split: bool = False
) -> DataFrame:
    """Records of a headed CSV file or of a JSON array of objects.

    Rows with more or fewer cells than the header keep their raw text in ``_bad_line``.
    A file is read by one task if it has quoted line breaks or is a JSON array. Pass ``split`` to
    cut such files into pieces for many tasks, at the price of a scan more (and, for JSON, of writing the
    objects once); ``quoted_newlines=False``, or ``lines=True`` for one object per line, where a file has neither.
    """
    if split and not lines and (fmt == "json" or fmt == "csv" and quoted_newlines):
        if fmt == "csv":
            return split_csv(spark, path)
        return spark.read.json(json_lines(spark, path), primitivesAsString=True)
    if fmt == "csv":
        names = csv_header(spark, path, quoted_newlines)
        return _csv(spark, path, names, True, quoted_newlines)
    if fmt == "json":
        return spark.read.json(path, multiLine=not lines, primitivesAsString=True)
    raise ContractError(f"unsupported format: {fmt}")


def _first_lines(spark: SparkSession, paths: list[str], most: int = HEADER_BYTES) -> dict[str, str]:
    """First line of each file. Opens each, but reads no more of it than its first bytes, however large it is."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def first(path: str) -> str:
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
        stream = at.getFileSystem(conf).open(at)
        try:
            found = bytes(stream.readNBytes(most))
        finally:
            stream.close()
        line, end, _ = found.partition(b"\n")
        if not end and len(found) == most:
            raise ContractError(f"the header of {path} is longer than {most} bytes")
        return line.decode("utf-8-sig").rstrip("\r")

    with ThreadPoolExecutor(16) as pool:
        return dict(zip(paths, pool.map(first, paths), strict=True))


def _headers(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files under the paths by their header. Empty files have none.

    Files are listed without their content. Names and headers come to the driver, one for each file; a line break
    inside a header is an error.
    """
    listed = spark.read.format("binaryFile").load(paths).filter("length > 0").select("path").collect()
    files: dict[tuple[str, ...], list[str]] = {}
    for path, line in sorted(_first_lines(spark, [r["path"] for r in listed]).items()):
        if line.count('"') % 2:
            raise ContractError(f"line break in the header of {path}")
        names = next(csv.reader([line]), [""])
        if len(set(names)) != len(names):
            raise ContractError(f"repeated column names in {path}")
        files.setdefault(tuple(names), []).append(path)
    return files


def split_csv(spark: SparkSession, path, names: list[str] | None = None) -> DataFrame:
    """Records of headed CSV files with quoted line breaks, each file read by many tasks.

    The rows are those of ``read_records`` (but that a last line without a line end keeps the breaks in its cells as they
    are). All files have the header ``names`` (that of the files, if not
    given); another one is an error.
    """
    if names is None:
        found = list(_headers(spark, [path] if isinstance(path, str) else path))
        if len(found) != 1:
            raise ContractError("no header row" if not found else f"{len(found)} different headers")
        names = list(found[0])
    records = split_records(spark, path, CsvLines())
    cells = [f"c{n}" for n in range(len(names))]
    is_first = (F.col("start") == 0) & (F.col("place") == 0)
    # Where lines end in two signs, line breaks in cells are read as one, too.
    two = F.col("value").endswith("\r")
    text = F.when(two, F.replace(F.regexp_replace("value", "\r$", ""), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("value"))
    text = F.when(is_first, F.regexp_replace(text, "^\ufeff", "")).otherwise(text)
    layout = ", ".join(f"{c} string" for c in [*cells, BAD_LINE])
    parsed = F.from_csv(text, layout, _CSV | {"columnNameOfCorruptRecord": BAD_LINE, "multiLine": "true"})
    rows = records.filter(text != "").select(is_first.alias("is_first"), parsed.alias("r"), "value")
    header = F.col(f"r.{BAD_LINE}").isNull()
    for cell, name in zip(cells, names, strict=True):
        header = header & F.col(f"r.{cell}").eqNullSafe(F.lit(name if name != "" else None).cast("string"))
    other = F.raise_error(F.concat(F.lit("a file has another header: "), "value")).cast("boolean")
    kept = rows.filter(F.when(~F.col("is_first"), True).when(header, False).otherwise(other))
    return kept.select(*[F.col(f"r.{c}").alias(n) for c, n in zip([*cells, BAD_LINE], [*names, BAD_LINE], strict=True)])


def read_many(spark: SparkSession, paths: list[str], fmt: str = "csv", **options) -> DataFrame:
    """One set from many files or folders, with the file each row came from.

    JSON files go through one scan. CSV headers may differ between files, also inside a folder:
    each distinct header gets one scan and the parts are joined by name.
    """
    if fmt == "json":
        df = spark.read.json(paths, multiLine=not options.get("lines", False), primitivesAsString=True)
        return df.select("*", F.col("_metadata.file_path").alias("source_file"))
    newlines, merged = options.get("quoted_newlines", True), None
    for names, group in _headers(spark, paths).items():
        part = _csv(spark, group, list(names), True, newlines).select("*", F.col("_metadata.file_path").alias("source_file"))
        merged = part if merged is None else merged.unionByName(part, allowMissingColumns=True)
    if merged is None:
        raise ContractError("no file with a header row")
    return merged


def promote_header(grid: DataFrame, order: str, probe: int) -> DataFrame:
    """Skip title rows: the first row whose probe cell is filled names the columns.

    ``grid`` holds text cells plus the row number ``order``; ``probe`` counts from zero.
    """
    cells = [c for c in grid.columns if c != order]
    probe_cell = quoted(cells[probe])
    header = (
        grid.filter(probe_cell.isNotNull())
        .agg(F.min_by(F.struct(*[quoted(c) for c in [order] + cells]), quoted(order)).alias("h"))
        .first()["h"]
    )
    if header is None:
        raise ContractError(f"no row has a value in cell {probe + 1}")
    names = [header[c] for c in cells]
    named = [(c, n) for c, n in zip(cells, names) if n is not None]
    if len({n for _, n in named}) != len(named):
        raise ContractError("repeated column names in the header row")
    return grid.filter(quoted(order) > header[order]).select(
        quoted(order), *[quoted(c).alias(n) for c, n in named]
    )


def read_typed_csv(
    spark: SparkSession, path, layout_lines: list[str], quoted_newlines: bool = True
) -> DataFrame:
    """Headerless CSV with a fixed layout: numbers or null, trimmed text or null."""
    layout = parse_layout(layout_lines)
    raw = _csv(spark, path, [c.name for c in layout], False, quoted_newlines)
    cells = []
    for column in layout:
        cell = quoted(column.name)
        value = parse_number(cell) if column.kind == "num" else F.nullif(strip(cell), F.lit(""))
        cells.append(value.alias(column.name))
    return raw.select(*cells, BAD_LINE)


def registry_from_json(response: DataFrame) -> DataFrame:
    """School rows of a registry response ``{data: {content: [...]}}``."""
    return registry_from_objects(response.select(F.explode("data.content").alias("r")).select("r.*"))


def read_registry(spark: SparkSession, path) -> DataFrame:
    """School rows of stored registry responses, each of which may be far larger than a task."""
    return registry_from_objects(spark.read.json(json_lines(spark, path, depth=3), primitivesAsString=True))


def registry_from_objects(schools: DataFrame) -> DataFrame:
    """School rows from the objects of a registry response."""
    # Field of the response, column of the registry.
    names = {
        "CODE": "cod",
        "ID_SCHOOL": "aux_id",
        "NAME": "denumire",
        "SHORT_NAME": "denumire_scurta",
        "LOCALITY": "localitate",
        "PARENT_LOCALITY": "localitate_superioara",
        "COUNTY": "judet",
        "STATUT": "statut",
        "SCHOOL_TYPE": "tip_unitate",
        "PROPERTY_FORM": "forma_proprietate",
    }
    return schools.select(
        *[(F.col(src) if src in schools.columns else F.lit(None)).cast("string").alias(dst) for src, dst in names.items()]
    )


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, where=None) -> DataFrame:
    """Stored table with the projection and filter pushed into the scan."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df

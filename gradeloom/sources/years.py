"""Tables of years whose versions are committed as a whole.

A table is a folder of data files that are never changed or moved. A manifest lists the files of one
version, with their year and rows; a small file ``versions/<number>`` names the manifest. A write adds data
files, a manifest, and last that file: until then nothing of it counts, whatever fails, and readers keep the
version they began with. The file is renamed into place, and a name that is taken refuses the rename:
of two writers that begin with the same version one commits, and the other commits on top of it if they
changed different years, or fails. (A file system whose renames are not atomic allows one writer at a time.)

Replacing years touches no file of another year. Changing rows by key rewrites only the files that hold
one of the keys.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom.sources.tables import FOREIGN_YEAR, YEAR, EmptyBatchError

_FILES = "an int, file string, n long"
_COUNTS = "array<struct<an: int, measure: string, n: bigint>>"
_MARKER = f"version long, parent long, manifest string, at timestamp, years array<int>, columns string, counts {_COUNTS}, notes string"


class ConflictError(RuntimeError):
    """Another writer has changed the same year since this write began."""


def _by_year(files: list[tuple[int, str, int]]) -> dict[int, int]:
    counts: dict[int, int] = {}
    for year, _, n in files:
        counts[year] = counts.get(year, 0) + n
    return counts


class YearTable:
    """A fact table by year. ``version`` counts commits; 0 is the empty table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        root = hadoop.Path(self.path)
        self._fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        self._files = hadoop.FileContext.getFileContext(self._fs.makeQualified(root).toUri(), spark._jsc.hadoopConfiguration())
        self._no_option = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)

    # -- versions -----------------------------------------------------------------

    def version(self) -> int:
        """Number of the newest version."""
        folder = self._path(f"{self.path}/versions")
        if not self._fs.exists(folder):
            return 0
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return max((int(name) for name in names if name.isdigit()), default=0)

    def history(self) -> DataFrame:
        """One row per version: what it began with, when it was made, which years it changed, and its counts."""
        if not self.version():
            return self.spark.createDataFrame([], _MARKER)
        return self.spark.read.schema(_MARKER).json(f"{self.path}/versions")

    def runs(self) -> DataFrame:
        """The counts of all writes: ``version``, ``an``, ``measure`` and ``n``."""
        return self.history().select("version", F.explode("counts").alias("c")).select("version", "c.*")

    def notes(self, version: int) -> DataFrame | None:
        """The table that was stored beside a version, if any."""
        name = self._marker(version).get("notes")
        return None if name is None else self.spark.read.parquet(f"{self.path}/notes/{name}")

    def _marker(self, version: int) -> dict:
        at = self._path(f"{self.path}/versions/{version:012d}")
        stream = self._fs.open(at)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def files(self, version: int | None = None) -> DataFrame:
        """The live files of a version, with their year and number of rows."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], _FILES)
        return self.spark.read.schema(_FILES).parquet(f"{self.path}/manifests/{self._marker(version)['manifest']}")

    def _listed(self, version: int) -> list[tuple[int, str, int]]:
        """The same on the driver, which needs the names of all files it reads anyway."""
        return [tuple(r) for r in self.files(version).collect()] if version else []

    # -- reading --------------------------------------------------------------------

    def _rows(self, files: list[str], columns: str, *more: Column) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(columns))
        if not files:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([f for f in schema.fields if f.name != YEAR] + [T.StructField("write", T.StringType()), T.StructField(YEAR, T.IntegerType())])
        rows = self.spark.read.schema(stored).option("basePath", f"{self.path}/rows").parquet(*[f"{self.path}/rows/{f}" for f in files])
        return rows.select(*schema.names, *more)

    def read(self, version: int | None = None, years: list[int] | None = None) -> DataFrame:
        """The rows of a version, of all or some of its years."""
        version = self.version() if version is None else version
        if not version:
            raise EmptyBatchError("the table has no version yet")
        wanted = [file for year, file, _ in self._listed(version) if years is None or year in years]
        return self._rows(wanted, self._marker(version)["columns"])

    def counted(self, version: int) -> dict[int, int]:
        """Rows of each year."""
        return _by_year(self._listed(version))

    # -- writing --------------------------------------------------------------------

    def _write(self, rows: DataFrame) -> list[tuple[int, str, int]]:
        """Write data files; returns what a manifest says of them. Nothing names them yet."""
        folder = f"{self.path}/rows/write=w{uuid.uuid4().hex}"
        rows.write.partitionBy(YEAR).parquet(folder)
        name = F.regexp_extract(F.col("_metadata.file_path"), f"(write=[^/]+/{YEAR}=[^/]+/[^/]+)$", 1)
        found = self.spark.read.schema(f"{YEAR} int").option("basePath", f"{self.path}/rows").parquet(folder)
        counted = found.groupBy(YEAR, name.alias("file")).agg(F.count("*").alias("n"))
        return [tuple(r) for r in counted.select(YEAR, "file", "n").collect()]

    def _publish(self, version: int, marker: dict) -> bool:
        """Put a version's file in place; false if there is one already."""
        folder, name = f"{self.path}/versions", f"{version:012d}"
        target = self._path(f"{folder}/{name}")
        if self._fs.exists(target):
            return False
        staged = self._path(f"{self.path}/staged/{uuid.uuid4().hex}")
        out = self._fs.create(staged, False)
        out.write(bytearray(json.dumps(marker).encode("utf-8")))
        out.close()
        self._fs.mkdirs(self._path(folder))
        try:
            self._files.rename(staged, target, self._no_option)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            return False
        return True

    def _commit(self, start: int, years: list[int], change: Callable[[list[tuple]], list[tuple]], columns: str, counts: list[dict], notes: DataFrame | None) -> int:
        if notes is not None:
            stored = uuid.uuid4().hex
            notes.write.parquet(f"{self.path}/notes/{stored}")
        while True:
            manifest = uuid.uuid4().hex
            files = self.spark.createDataFrame(change(self._listed(start)), _FILES)
            files.coalesce(1).write.parquet(f"{self.path}/manifests/{manifest}")
            at = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
            marker = {"version": start + 1, "parent": start, "manifest": manifest, "at": at, "years": years, "columns": columns, "counts": counts}
            if self._publish(start + 1, marker | ({} if notes is None else {"notes": stored})):
                return start + 1
            newest = self.version()
            theirs = {y for v in range(start + 1, newest + 1) for y in self._marker(v)["years"]}
            if theirs & set(years):
                raise ConflictError(f"years {sorted(theirs & set(years))} were changed after version {start}")
            start = newest

    def replace(
        self, rows: DataFrame, years: list[int], start: int | None = None, measures: Callable[[], list[dict]] | None = None, notes: DataFrame | None = None
    ) -> int:
        """Replace whole years by ``rows``; returns the version that was made.

        A year without new rows, or a row of no or another year, fails the write, and no year changes. The
        write counts the rows it has ``replaced`` and ``inserted`` for each year; ``measures`` is asked for
        more when the rows are written.
        """
        start = self.version() if start is None else start
        listed = sorted(set(years))
        other = F.raise_error(F.concat(F.lit(f"{FOREIGN_YEAR} {', '.join(map(str, listed))}: "), F.coalesce(F.col(YEAR).cast("string"), F.lit("null"))))
        known = F.coalesce(F.col(YEAR).isin(listed), F.lit(False))
        rows = rows.withColumn(YEAR, F.col(YEAR).cast("int"))
        written = self._write(rows.filter(F.when(known, True).otherwise(other.cast("boolean"))))
        new = _by_year(written)
        if missing := [y for y in listed if not new.get(y)]:
            raise EmptyBatchError(f"no rows for {', '.join(map(str, missing))}")
        old = self.counted(start)
        counts = [{YEAR: y, "measure": m, "n": n} for y in listed for m, n in (("replaced", old.get(y, 0)), ("inserted", new[y]))]
        columns = rows.schema.json()
        return self._commit(
            start, listed, lambda files: [f for f in files if f[0] not in listed] + written, columns, counts + (measures() if measures else []), notes
        )

    def rewrite(
        self, keys: DataFrame, change: Callable[[DataFrame], DataFrame], added: DataFrame | None = None, start: int | None = None,
        measures: Callable[[], list[dict]] | None = None,
    ) -> tuple[int, int]:
        """Change the rows with some keys; returns the version and how many files were rewritten.

        ``keys`` has the year and further columns of the table. Only files of these years are searched,
        by their key columns alone, and only files with a key are read whole and written anew, as
        ``change`` gives back their rows. Rows ``added`` (which have one of these years) become files of their own.
        """
        start = self.version() if start is None else start
        if not start:
            raise EmptyBatchError("the table has no version yet")
        years = sorted(r[0] for r in keys.select(YEAR).distinct().collect() if r[0] is not None)
        marker = self._marker(start)
        live = [file for year, file, _ in self._listed(start) if year in years]
        name = F.regexp_extract(F.col("_metadata.file_path"), f"(write=[^/]+/{YEAR}=[^/]+/[^/]+)$", 1).alias("_file")
        held = self._rows(live, marker["columns"], name) if live else self._rows([], marker["columns"]).withColumn("_file", F.lit(""))
        hit = held.select(*keys.columns, "_file").join(keys.distinct(), keys.columns, "left_semi")
        touched = [r[0] for r in hit.select("_file").distinct().collect()]
        written = self._write(change(self._rows(touched, marker["columns"]))) if touched else []
        if added is not None:
            written += self._write(added.select(*T.StructType.fromJson(json.loads(marker["columns"])).names))
        gone = set(touched)
        counts = measures() if measures else []
        return self._commit(start, years, lambda files: [f for f in files if f[1] not in gone] + written, marker["columns"], counts, None), len(touched)

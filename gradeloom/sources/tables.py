"""Writing tables and files.

Plain fact tables are Parquet partitioned by ``an``. A year is replaced by a dynamic partition
overwrite: tasks write to a staging folder and the job commit swaps the partition, so lost
executors and failed tasks leave the old rows in place. The swap itself deletes and renames: a driver
that is lost in it, a reader at work or a second writer can see a half. Where that matters use
``years.YearTable``, whose versions are committed as a whole.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

YEAR = "an"
FOREIGN_YEAR = "rows of another year than"


class EmptyBatchError(ValueError):
    """A load without rows; replacing a year by nothing is not allowed."""


def replace_year(df: DataFrame, path: str, year: int) -> dict[str, int]:
    """Replace one year of a fact table; returns how many rows went and came.

    A row of another year, or of none, fails the write before anything is replaced.
    """
    spark = df.sparkSession
    other = F.raise_error(F.concat(F.lit(f"{FOREIGN_YEAR} {year}: "), F.coalesce(F.col(YEAR).cast("string"), F.lit("null"))))
    rows = df.filter(F.when(F.col(YEAR).eqNullSafe(F.lit(year)), True).otherwise(other.cast("boolean")))
    old = count_year(spark, path, year)
    seen = Observation("replace_year")
    (
        rows.observe(seen, F.count(F.lit(1)).alias("n"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(YEAR)
        .parquet(path)
    )
    if not seen.get["n"]:
        # An empty dynamic overwrite touches no partition, so nothing is lost here.
        raise EmptyBatchError(f"no rows for {year}")
    return {"deleted": old, "inserted": seen.get["n"]}


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def count_year(spark: SparkSession, path: str, year: int) -> int:
    """Rows stored for a year, zero when there is no table yet."""
    stored = _stored(spark, path)
    return 0 if stored is None else stored.filter(F.col(YEAR) == year).count()


def replace_table(df: DataFrame, path: str) -> int:
    """Replace a whole table, also when ``df`` reads from it; returns the number of rows.

    The new rows are written in full to a folder of their own, then one row is added to the list
    of versions. Until that is committed the old version counts, whatever fails; nothing is ever
    moved or deleted. Old versions stay until the owner of the folder removes them.
    """
    if df.isEmpty():
        raise EmptyBatchError("no rows")
    spark, version, seen = df.sparkSession, uuid.uuid4().hex, Observation("replace_table")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/rows-{version}")
    row = spark.createDataFrame([(version, time.time_ns(), seen.get["n"])], "version string, at long, n long")
    row.coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return seen.get["n"]


def current_table(spark: SparkSession, path: str) -> DataFrame:
    """The last version of a table that is replaced as a whole."""
    newest = spark.read.parquet(f"{path}/versions").agg(F.max_by("version", F.struct("at", "version"))).first()[0]
    return spark.read.parquet(f"{path}/rows-{newest}")


def write_csv(df: DataFrame, path: str, order: list[str], drop_order: bool = True) -> None:
    """Headed CSV parts whose names follow the given row order."""
    rows = df.orderBy(*order)
    if drop_order:
        rows = rows.drop(*order)
    exact = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.mode("overwrite").options(header=True, quote='"', escape='"', **exact).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line, nulls kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)

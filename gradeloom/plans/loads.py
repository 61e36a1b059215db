"""Loads of a whole year or registry: read, clean, match, check, write.

Every load checks all rows before it writes anything (``strict``), or sets bad rows aside.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.functions import registry as cells
from gradeloom.operators import dedupe, matching, updates
from gradeloom.operators.dimension import correct_assignments, grow_dimension
from gradeloom.operators.rejects import REASONS, reasons, require_valid, split_valid_rejects
from gradeloom.plans.rows import BAC_COLUMNS, EN_COLUMNS, bac_rows, en_rows
from gradeloom.session import cut_lineage
from gradeloom.sources.contracts import normalise_names, quoted
from gradeloom.sources.readers import promote_header
from gradeloom.sources.tables import YEAR, replace_year

ORDER = "_row"


@dataclass
class Schools:
    """Tables that school names are matched against."""

    institutions: DataFrame
    registry: DataFrame | None = None


@dataclass
class Layer:
    """One source of a year. Later layers update what earlier ones wrote."""

    raw: DataFrame
    mapping: dict[str, str]
    update: bool = False
    detect_origin: bool = False
    detect_placement: bool = False
    keep_first_by: list[str] = field(default_factory=list)


def _accepted(rows: DataFrame, strict: bool) -> DataFrame:
    rows = cut_lineage(rows)
    return require_valid(rows) if strict else split_valid_rejects(rows)[0]


def _origin_codes(rows: DataFrame, schools: Schools, high_school: bool) -> DataFrame:
    name, county = "unitate_nume", "unitate_cod_judet"
    wanted = dedupe.distinct_schools(rows, name, county)
    matches = matching.match_schools(wanted, name, county, schools.institutions, schools.registry, high_school)
    return matching.attach_codes(rows, matches, name, county, "unitate_siiir")


def _placement_codes(rows: DataFrame, schools: Schools) -> DataFrame:
    name, county = "repartizat_liceu_nume", "repartizat_cod_judet"
    wanted = dedupe.distinct_schools(rows, name, county, drop_nulls=True)
    matches = matching.match_schools(wanted, name, county, schools.institutions, schools.registry, False)
    return matching.attach_codes(rows, matches, name, county, "repartizat_liceu_siiir", only_missing=False)


def bac_batch(layer: Layer, year: int, schools: Schools | None = None, strict: bool = True) -> DataFrame:
    """Clean leaving-exam rows, with school codes found by name where asked for; of repeated
    candidates the first may be kept."""
    rows = _accepted(bac_rows(layer.raw, layer.mapping, year, layer.keep_first_by), strict)
    if layer.detect_origin:
        rows = _origin_codes(rows, schools, high_school=True)
    if layer.keep_first_by:
        rows = dedupe.keep_first(rows, ["cod_candidat"], layer.keep_first_by)
    return rows.select(*BAC_COLUMNS)


def en_batch(layer: Layer, year: int, schools: Schools | None = None, strict: bool = True) -> DataFrame:
    """Clean 8th-grade rows; of repeated candidates the first may be kept."""
    rows = _accepted(en_rows(layer.raw, layer.mapping, year, layer.keep_first_by), strict)
    if layer.detect_origin:
        rows = _origin_codes(rows, schools, high_school=False)
    if layer.detect_placement:
        rows = _placement_codes(rows, schools)
    if layer.keep_first_by:
        rows = dedupe.keep_first(rows, ["cod_candidat"], layer.keep_first_by)
    return rows.select(*EN_COLUMNS)


def apply_batch(
    spark: SparkSession, batch: DataFrame, table: str, year: int, update: bool, order: list[str] | None = None
) -> dict:
    """Write a batch: replace the year, or update its stored rows by candidate.

    An update reads and rewrites one year only. Candidates without a stored row are counted,
    not inserted; several rows of a candidate count once.
    """
    if not update:
        return replace_year(batch, table, year)
    batch = cut_lineage(batch)
    stored = spark.read.parquet(table).filter(F.col(YEAR) == year)
    key = [YEAR, "cod_candidat"]
    new = updates.update_by_key(stored, batch, key, order=order)
    known = batch.select(*key).distinct().join(stored.select(*key).withColumn("_hit", F.lit(True)), key, "left")
    counts = known.agg(F.count_if("_hit").alias("updated"), F.count_if(F.col("_hit").isNull()).alias("unknown")).first()
    return {**counts.asDict(), **replace_year(new, table, year)}


def load_bac_year(
    spark: SparkSession, layers: list[Layer], year: int, table: str,
    schools: Schools | None = None, corrections: DataFrame | None = None, strict: bool = True,
) -> list[dict]:
    """A leaving-exam year from its layers in order, then the correction list."""
    report = []
    for layer in layers:
        report.append(apply_batch(spark, bac_batch(layer, year, schools, strict), table, year, layer.update))
    if corrections is not None:
        stored = spark.read.parquet(table).filter(F.col(YEAR) == year)
        report.append(replace_year(correct_assignments(stored, corrections), table, year))
    return report


def load_en_year(
    spark: SparkSession, layers: list[Layer], year: int, table: str,
    schools: Schools | None = None, strict: bool = True,
) -> list[dict]:
    """An 8th-grade year from its layers in order.

    Placement goes last: a source without an admission column writes its exam average there,
    and would overwrite the real one.
    """
    return [apply_batch(spark, en_batch(l, year, schools, strict), table, year, l.update) for l in layers]


def registry_rows(grid: DataFrame, order: str) -> DataFrame:
    """Registry table from a grid of cells: header row promoted, names and cells cleaned."""
    table = promote_header(grid, order, probe=1).drop(order)
    names = table.columns
    is_code = {n: "siiir" in n.lower() for n in names}
    values = [
        (cells.registry_code_cell(quoted(n)) if is_code[n] else cells.registry_cell(quoted(n))).alias(n)
        for n in names
    ]
    checks = {n: cells.bad_registry_code(quoted(n)) for n in names if is_code[n]}
    return normalise_names(table.select(*values, reasons(checks)))


def old_en_year(
    base: DataFrame, batch: DataFrame, institutions: DataFrame, order: list[str], update: bool,
    insert_only: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Older 8th-grade load: the facts with the batch added or merged, and the grown dimension."""
    schools = batch.select(F.col("id_scoala").alias("id"), F.col("nume_scoala").alias("nume"), "cod_siiir", *order)
    grown = grow_dimension(institutions, schools, order, insert_only)
    facts = batch.select(*[c for c in base.columns])
    if not update:
        year = batch.select("an").distinct()
        return base.join(year, "an", "left_anti").select(*base.columns).unionByName(facts), grown
    changed = ["medie_en", "medie_abs", "medie_adm", "repartizat_id_liceu", "repartizat_specializare"]
    return updates.upsert_by_key(base, facts, ["an", "cod_candidat"], changed), grown


def old_admission_update(base: DataFrame, batch: DataFrame, year: int | None, order: list[str]) -> DataFrame:
    """Older admission update: four columns of the stored rows of a year, first row per candidate.

    Without a ``year`` the batch has its own column of years, and all stored rows are given back.
    """
    columns = ["medie_adm", "medie_abs", "repartizat_id_liceu", "repartizat_specializare"]
    if year is not None:
        base, batch = base.filter(F.col("an") == year), batch.withColumn("an", F.lit(year))
    return updates.update_by_key(base, batch, ["an", "cod_candidat"], mode="row", order=order, columns=columns)

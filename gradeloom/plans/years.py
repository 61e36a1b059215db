"""Loads of all years of a source at once, committed together.

The layers of every year are cleaned in one job each, checked by one aggregate, given school codes, folded
over each other in one shuffle by candidate, and written as one version of the table. A year with a row that
can't be loaded is left out whole; the others go in.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gradeloom.operators import dedupe, matching, updates
from gradeloom.operators.dimension import correct_assignments
from gradeloom.operators.rejects import REASONS, RejectedRowsError
from gradeloom.plans.loads import Layer, Schools
from gradeloom.plans.rows import BAC_COLUMNS, EN_COLUMNS, bac_rows, en_rows
from gradeloom.session import cut_lineage
from gradeloom.sources.contracts import quoted
from gradeloom.sources.tables import YEAR
from gradeloom.sources.years import YearTable

KEY = [YEAR, "cod_candidat"]


@dataclass
class Report:
    """What a load did: the version it made (none if no year was accepted), the years it took, and why it
    left others out (reason and rows)."""

    version: int | None = None
    years: list[int] = field(default_factory=list)
    left_out: dict[int, dict[str, int]] = field(default_factory=dict)


def _verdicts(rows: DataFrame) -> dict[int | None, dict[str, int]]:
    """Rows of each year by reject reason; fine rows have the reason ''. As many rows as years and reasons."""
    why = F.when(F.size(REASONS) == 0, F.array(F.lit(""))).otherwise(F.col(REASONS))
    found: dict[int | None, dict[str, int]] = {}
    for r in rows.select(YEAR, F.explode(why).alias("why")).groupBy(YEAR, "why").count().collect():
        found.setdefault(r[YEAR], {})[r["why"]] = r["count"]
    return found


def _codes(rows: DataFrame, years: list[int], schools: Schools, name: str, county: str, code: str, high_school: bool, only_missing: bool) -> DataFrame:
    """School codes by name. Each year is matched on its own, as names of one year compete for codes."""
    if not years:
        return rows
    wanted = rows.select(YEAR, name, county).distinct()
    matches = matching.match_schools_by_year(wanted, YEAR, years, name, county, schools.institutions, schools.registry, high_school)
    return matching.attach_codes(rows, matches, name, county, code, only_missing, by=[YEAR])


def _batches(make, columns: list[str], layers: list[Layer], year: str, schools: Schools | None, strict: bool, high_school: bool) -> tuple[list[DataFrame], Report]:
    """Clean rows of each layer, of the years that can be loaded."""
    kept, seen, report = [], [], Report()
    for layer in layers:
        rows = cut_lineage(make(layer.raw, layer.mapping, quoted(year).cast("int"), list(dict.fromkeys([year, *layer.keep_first_by]))))
        verdicts = _verdicts(rows)
        if None in verdicts and strict:
            raise RejectedRowsError(f"{sum(verdicts[None].values())} rows without a year")
        kept.append(rows)
        seen.append({y for y, why in verdicts.items() if y is not None and (strict or "" in why)})
        for y, why in verdicts.items():
            if bad := {r: n for r, n in why.items() if r}:
                known = report.left_out.setdefault(y, {})
                known.update({r: known.get(r, 0) + n for r, n in bad.items()})
    found = set().union(*seen) if layers[0].update else seen[0]
    report.years = sorted(found - set(report.left_out)) if strict else sorted(found)
    batches = []
    for layer, rows in zip(layers, kept, strict=True):
        rows = rows.filter(F.col(YEAR).isin(report.years) & (F.size(REASONS) == 0)).drop(REASONS)
        if layer.detect_origin:
            rows = _codes(rows, report.years, schools, "unitate_nume", "unitate_cod_judet", "unitate_siiir", high_school, True)
        if layer.detect_placement:
            rows = _codes(rows, report.years, schools, "repartizat_liceu_nume", "repartizat_cod_judet", "repartizat_liceu_siiir", False, False)
        if layer.keep_first_by:
            rows = dedupe.keep_first(rows, KEY, layer.keep_first_by)
        rows = rows.select(*columns)
        # Read for the names without a code, for what a layer fills, and for the fold: codes are attached once.
        batches.append(cut_lineage(rows) if layer.detect_origin or layer.detect_placement or layer.keep_first_by else rows)
    return batches, report


def _unmatched(batches: list[DataFrame], layers: list[Layer]) -> DataFrame | None:
    """School names that were looked for and not found, with their year, layer and rows."""
    parts = []
    for number, (rows, layer) in enumerate(zip(batches, layers, strict=True)):
        for wanted, name, county, code in (
            (layer.detect_origin, "unitate_nume", "unitate_cod_judet", "unitate_siiir"),
            (layer.detect_placement, "repartizat_liceu_nume", "repartizat_cod_judet", "repartizat_liceu_siiir"),
        ):
            if wanted:
                missing = rows.filter(F.col(name).isNotNull() & F.col(code).isNull())
                parts.append(missing.groupBy(YEAR, F.col(county).alias("county"), F.col(name).alias("name")).agg(F.count("*").alias("rows")).withColumn("layer", F.lit(number)))
    return reduce(DataFrame.unionByName, parts) if parts else None


def _load(table: YearTable, make, columns: list[str], layers: list[Layer], year: str, schools: Schools | None, corrections: DataFrame | None, strict: bool, high_school: bool) -> Report:
    if any(not layer.update for layer in layers[1:]):
        raise ValueError("only the first layer can replace years")
    start = table.version()
    batches, report = _batches(make, columns, layers, year, schools, strict, high_school)
    if layers[0].update:  # nothing is replaced: a year must be stored
        stored = set(table.counted(start))
        report.years = [y for y in report.years if y in stored]
        base = table.read(start, report.years) if report.years else None
        batches = [b.filter(F.col(YEAR).isin(report.years)) for b in batches]
    else:
        base, batches = batches[0], batches[1:]
    if not report.years:
        return report
    unmatched = _unmatched(([base] if not layers[0].update else []) + batches, layers)
    seen = None
    if batches:
        seen = Observation("load")
        folded = updates.fold_layers(base, batches, KEY, YEAR)
        tests = {"updated": F.col("is_updated"), "unknown": ~F.col("is_known")}
        folded = folded.observe(seen, *[F.count_if((F.col(YEAR) == y) & test).alias(f"{y} {m}") for y in report.years for m, test in tests.items()])
        base = folded.filter("is_known").select(*columns)
    if corrections is not None:
        base = correct_assignments(base, corrections)

    def measures() -> list[dict]:
        found = [] if seen is None else [(y, m, seen.get[f"{y} {m}"]) for y in report.years for m in ("updated", "unknown")]
        return [{YEAR: y, "measure": m, "n": n} for y, m, n in found]

    report.version = table.replace(base, report.years, start, measures, unmatched)
    return report


def load_bac_years(
    table: YearTable, layers: list[Layer], year: str, schools: Schools | None = None, corrections: DataFrame | None = None, strict: bool = True
) -> Report:
    """Leaving-exam years from their layers in order, then the correction list, as one version.

    ``year`` is the column of each layer's raw rows that tells the year. The first layer replaces its years, or
    updates stored ones like all others. ``strict`` leaves out a year with a row that can't be loaded; otherwise only
    such rows are. Rows without a year stop a strict load.
    """
    return _load(table, bac_rows, BAC_COLUMNS, layers, year, schools, corrections, strict, True)


def load_en_years(table: YearTable, layers: list[Layer], year: str, schools: Schools | None = None, strict: bool = True) -> Report:
    """8th-grade years in the same way. Placement goes last: a source without an admission column writes its
    exam average there, and would overwrite the real one."""
    return _load(table, en_rows, EN_COLUMNS, layers, year, schools, None, strict, False)


# -- stored rows by key ---------------------------------------------------------------


def update_stored(table: YearTable, batch: DataFrame, key: list[str], mode: str = "column", order: list[str] | None = None) -> tuple[int, int]:
    """Stored rows with the values of a batch; only files that hold one of its keys are written anew.

    The key has the year. Keys that are not stored are not added, and counted as ``unknown`` for the run.
    Returns the version and the number of files.
    """
    batch = cut_lineage(dedupe.keep_first(batch, key, order) if order is not None else batch)
    start = table.version()
    stored = table.read(start).select(*key)
    unknown = updates.unknown_keys(stored, batch.select(*key).distinct(), key).groupBy(YEAR).count()
    asked = {r[YEAR]: r["count"] for r in batch.select(*key).distinct().groupBy(YEAR).count().collect()}
    missing = {r[YEAR]: r["count"] for r in unknown.collect()}
    counts = [{YEAR: y, "measure": m, "n": n} for y, all_keys in asked.items() if y is not None for m, n in (("updated", all_keys - missing.get(y, 0)), ("unknown", missing.get(y, 0)))]
    return table.rewrite(batch.select(*key), lambda rows: updates.update_by_key(rows, batch, key, mode), start=start, measures=lambda: counts)


def upsert_stored(table: YearTable, batch: DataFrame, key: list[str], update_columns: list[str]) -> tuple[int, int]:
    """Known keys change in ``update_columns``; unknown ones are added as files of their own."""
    batch, start = cut_lineage(batch), table.version()
    stored = table.read(start)
    new = cut_lineage(updates.unknown_keys(stored, batch, key))
    known = batch.join(new.select(*key), key, "left_anti")
    cells = [F.col(c) if c in batch.columns else F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in stored.columns]
    return table.rewrite(
        batch.select(*key), lambda rows: updates.upsert_by_key(rows, known.join(rows.select(*key), key, "left_semi"), key, update_columns).drop("is_new"),
        added=None if new.isEmpty() else new.select(*cells), start=start,
    )


def correct_stored(table: YearTable, corrections: DataFrame) -> tuple[int, int]:
    """Blank the schools of listed candidates in the files that hold them."""
    listed = cut_lineage(corrections.select(*KEY).distinct())
    return table.rewrite(listed, lambda rows: correct_assignments(rows, listed))

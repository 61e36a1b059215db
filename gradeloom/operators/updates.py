"""Changing stored rows by key. Plain Parquet has no MERGE, so each operator returns the new
rows and the caller overwrites the year they belong to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.operators.dedupe import duplicate_keys, keep_first
from gradeloom.session import cut_lineage


class DuplicateKeyError(ValueError):
    """An update batch that names one row twice."""


def active_columns(df: DataFrame, columns: list[str] | None = None) -> list[str]:
    """Columns that hold a value in some row. One pass, one row back to the driver."""
    columns = columns or df.columns
    flags = df.agg(*[F.bool_or(F.col(c).isNotNull()).alias(c) for c in columns]).first()
    return [c for c in columns if flags[c]]


def update_by_key(
    base: DataFrame, batch: DataFrame, key: list[str], mode: str = "column",
    order: list[str] | None = None, columns: list[str] | None = None,
) -> DataFrame:
    """Stored rows with the values of a batch; rows unknown to ``base`` are not added.

    ``mode="column"`` overwrites, also with null, every column the batch fills anywhere;
    ``mode="row"`` overwrites every column of the batch; ``mode="cell"`` overwrites only where
    the batch has a value. A batch with repeated keys needs ``order`` (the first row wins), else it is an error.
    """
    candidates = [c for c in (columns or batch.columns) if c in base.columns and c not in key]
    if order is not None:
        batch = keep_first(batch, key, order)
        if mode == "column":
            # Needed twice, and smaller than what it was picked from.
            batch = cut_lineage(batch)
    elif not duplicate_keys(batch, key).isEmpty():
        raise DuplicateKeyError("the batch repeats a key; give an order to pick one")
    changed = active_columns(batch, candidates) if mode == "column" else candidates
    new = batch.select(*key, *[F.col(c).alias("_new_" + c) for c in changed], F.lit(True).alias("_hit"))

    def value(c: str) -> Column:
        if c not in changed:
            return F.col(c)
        fresh = F.col("_new_" + c)
        if mode == "cell":
            return F.coalesce(fresh, F.col(c)).alias(c)
        return F.when(F.col("_hit"), fresh).otherwise(F.col(c)).alias(c)

    return base.join(new, key, "left").select(*[value(c) for c in base.columns])


def fold_layers(base: DataFrame, layers: list[DataFrame], key: list[str], scope: str) -> DataFrame:
    """Stored rows with several update batches applied in turn, in one pass over all of them.

    The rows are those of ``update_by_key`` (``mode="column"``) layer by layer, where a layer fills a column if it
    has a value of it anywhere in the same ``scope`` (a column of the key, such as the year): for each column
    the last such layer that has the key counts, also with null. Each layer and the base are shuffled once.

    Adds ``is_known`` (false for rows of keys that only layers have; filter on it) and ``is_updated``. A key that
    a layer repeats fails the job.
    """
    columns = [c for c in base.columns if c not in key]
    kinds = {c: base.schema[c].dataType for c in columns}
    stacked = None
    for number, layer in enumerate(layers):
        cells = [(F.col(c) if c in layer.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in columns]
        part = layer.select(*key, *cells, F.lit(number).alias("_layer"))
        stacked = part if stacked is None else stacked.unionByName(part)
    # One row for each value of the scope.
    filled = stacked.groupBy(scope, "_layer").agg(*[F.bool_or(F.col(c).isNotNull()).alias(c) for c in columns])
    fills = [F.bool_or(F.when(F.col("_layer") == n, F.col(c))).alias(f"_fills_{n}_{c}") for n in range(len(layers)) for c in columns]
    filled = filled.groupBy(scope).agg(*fills)
    own = [F.first(F.when(F.col("_layer") == n, F.struct(*columns)), ignorenulls=True).alias(f"_new_{n}") for n in range(len(layers))]
    layer = F.expr("shiftleft(1L, _layer)")
    folded = stacked.groupBy(*key).agg(*own, (F.sum(layer) != F.bit_or(layer)).alias("_again")).join(F.broadcast(filled), scope)
    joined = base.withColumn("_old", F.lit(True)).join(folded, key, "full_outer")
    repeats = F.raise_error(F.lit("a layer repeats a key; keep its first row")).cast("boolean")

    def latest(c: str) -> Column:
        value = F.col(c)
        for n in range(len(layers)):
            value = F.when(F.col(f"_new_{n}").isNotNull() & F.col(f"_fills_{n}_{c}"), F.col(f"_new_{n}.{c}")).otherwise(value)
        return value.alias(c)

    value = [latest(c) if c in columns else F.col(c) for c in base.columns]
    known = F.col("_old").isNotNull()
    hit = F.when(F.col("_again"), repeats).otherwise(known & F.col("_again").isNotNull())
    return joined.select(*value, known.alias("is_known"), hit.alias("is_updated"))


def upsert_by_key(base: DataFrame, batch: DataFrame, key: list[str], update_columns: list[str]) -> DataFrame:
    """Known keys change in ``update_columns`` only; unknown keys are added whole.

    The result carries ``is_new`` for the insert count.
    """
    stored = base.withColumn("_old", F.lit(True)).alias("o")
    fresh = batch.withColumn("_new", F.lit(True)).alias("n")
    joined = stored.join(fresh, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in key], "full_outer")
    is_new, hit = F.col("o._old").isNull(), F.col("n._new").isNotNull()
    cells = []
    for c in base.columns:
        old = F.col(f"o.{c}")
        if c not in batch.columns:
            cells.append(old)
        elif c in update_columns:
            cells.append(F.when(hit, F.col(f"n.{c}")).otherwise(old).alias(c))
        else:
            cells.append(F.when(is_new, F.col(f"n.{c}")).otherwise(old).alias(c))
    return joined.select(*cells, is_new.alias("is_new"))


def unknown_keys(base: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """Rows of a batch whose key is not stored."""
    return batch.join(base.select(*key), key, "left_anti")


def bad_values(batch: DataFrame, key: list[str], grade: str) -> DataFrame:
    """Rows of a batch without a usable grade."""
    return batch.filter(F.col(grade).isNull()).select(*key)


def apply_details(registry: DataFrame, details: DataFrame, order: list[str]) -> DataFrame:
    """Detail records over registry rows by ``aux_id``; a record replaces all eight columns,
    also with null. Of several records for one school the last counts."""
    # Field of the record, column of the registry.
    names = {
        "street": "strada",
        "streetNumber": "nr_strada",
        "postalCode": "cod_postal",
        "website": "website",
        "phoneNumber": "telefon",
        "siruesCode": "cod_sirues",
        "fiscalCode": "cod_fiscal",
        "operatingMode": "mod_operare",
    }
    for target in names.values():
        if target not in registry.columns:
            registry = registry.withColumn(target, F.lit(None).cast("string"))
    latest = details.groupBy("aux_id").agg(
        F.max_by(F.struct(*[F.col(s).cast("string").alias(t) for s, t in names.items()]), F.struct(*order)).alias("d")
    )
    cells = [
        F.when(F.col("d").isNotNull(), F.col(f"d.{c}")).otherwise(F.col(c)).alias(c)
        if c in names.values() else F.col(c)
        for c in registry.columns
    ]
    return registry.join(latest, "aux_id", "left").select(*cells)


def run_metrics(facts: DataFrame, matched: str, code: str) -> DataFrame:
    """One row of counts over a loaded batch."""
    return facts.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(code).isNotNull()).alias("with_code"),
        F.count_if(F.col(code).isNull()).alias("without_code"),
        F.count_if(F.col(matched)).alias("matched"),
    )

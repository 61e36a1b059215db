"""Helpers the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.session import cut_lineage

#: Copies of the small side of a salted join: no reducer gets more than this fraction of a hot key.
SALTS = 16
#: Numbers that the keys of a small table are hashed to, to find the rows of a large one that may match.
SLOTS = 1 << 20


Batches = Iterator[pa.RecordBatch]


def give_back() -> None:
    """Return freed memory to the machine. Python workers idle on after a task and would hold it beside the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def tidied(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run``, a function for mapInArrow, with its memory given back at the end of a task."""

    def tidy(found: Batches) -> Batches:
        yield from run(found)
        give_back()

    return tidy


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most ``rows`` rows, which share its memory."""
    return (batch.slice(start, rows) for start in range(0, batch.num_rows, rows))


def small_batches(spark: SparkSession, rows: int) -> None:
    """From now on Python tasks of the session get at most ``rows`` rows in a batch. The JVM and the worker both hold
    a batch, outside of the heap, so long texts want small ones."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator reads, so that any others may have any name. Null text is empty."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def ascii_lower(text: Column | str) -> Column:
    """Lower-case A-Z and nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def salted_left_join(rows: DataFrame, table: DataFrame, key: str | list[str], spread: str) -> DataFrame:
    """Left join on ``key`` whose hot keys are spread by the hash of ``spread`` over SALTS reducers.

    ``table`` has at most one row for a key and is small beside ``rows``; each of its rows is sent
    SALTS times.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    spread_out = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    keys = [key] if isinstance(key, str) else key
    return salted.join(spread_out, [*keys, "_salt"], "left").drop("_salt")


def may_match(rows: DataFrame, key: str, wanted: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose ``key`` may be one of ``wanted``: all that are, and a few more; ``left_anti`` gives the others.

    At most SLOTS numbers are broadcast, however many keys are wanted, and no row is shuffled.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS)).alias("_slot")
    slots = wanted.select(slot).distinct()
    return rows.withColumn("_slot", F.pmod(F.xxhash64(key), F.lit(SLOTS))).join(F.broadcast(slots), "_slot", how).drop("_slot")


def without(docs: DataFrame, digest: Column, judged: DataFrame) -> DataFrame:
    """Rows of ``docs``, with all their columns, but for copies.

    ``judged`` has ``doc_id``, ``sha`` (the ``digest`` of a text), ``n`` (rows with both) and ``stays``, for pairs of doc_id and
    digest of which a row goes: one row stays, the smallest, where ``stays`` holds, else none. Other rows stay as
    they are, and so do rows without a doc_id. Only rows whose doc_id may be listed are hashed and shuffled.
    """
    judged = cut_lineage(judged.filter("doc_id is not null and (not stays or n > 1)").select("doc_id", "sha", "stays"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", digest.alias("sha"))
    met = may_match(rows, "doc_id", judged).join(judged, ["doc_id", "sha"], "left")
    first = met.filter("stays").groupBy("doc_id", "sha").agg(F.min("_row").alias("_row"))
    rest = may_match(rows, "doc_id", judged, "left_anti").select("_row").union(met.filter("stays is null").select("_row"))
    return rest.union(first.select("_row")).select("_row.*")


def one_row_each(docs: DataFrame, listed: DataFrame) -> DataFrame:
    """A row of ``docs`` as ``_row`` for each doc_id of ``listed``, beside the columns of ``listed``.

    ``listed`` has one row for each doc_id, none for null, and ``_often``: whether docs has several
    rows of it. Only those are grouped, and give their smallest row.
    """
    columns = [c for c in listed.columns if c not in ("doc_id", "_often")]
    found = docs.select("doc_id", F.struct(*docs.columns).alias("_row")).join(listed, "doc_id")
    once = found.filter("not _often").select("_row", *columns)
    first = [F.first(c).alias(c) for c in columns]
    several = found.filter("_often").groupBy("doc_id").agg(F.min("_row").alias("_row"), *first).select("_row", *columns)
    return once.union(several)


def keep_listed(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is in ``kept``, one for each doc_id, and all without one.

    ``kept`` has a doc_id as often as docs has.
    """
    listed = kept.filter("doc_id is not null").groupBy("doc_id").agg((F.count("*") > 1).alias("_often"))
    return one_row_each(docs, listed).select("_row.*").union(docs.filter("doc_id is null"))

"""Exact duplicates of an incoming batch against immutable snapshots and within itself.

A snapshot is the digests of its texts, grouped, and one static binary-fuse filter per shard of
digests. The filters screen the digests of a batch: what they refuse is new. What they let through
joins the exact buckets of the snapshot (all digests of a shard), and the texts of those that meet are
compared byte by byte. Duplicates inside the batch are grouped on their own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import ascii_lower, id_and_text, salted_left_join, without
from gradeloom.llm.fuse import FuseFilter
from gradeloom.session import cut_lineage

#: Digests that share one filter, about; a filter is then some 120 KB.
SHARD_KEYS = 100_000


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``sha`` of the text with A-Z lower-cased, and the 64-bit ``key`` of the filters."""
    sha = F.sha2(ascii_lower("text"), 256)
    return id_and_text(docs).select("doc_id", sha.alias("sha")).withColumn("key", F.xxhash64("sha"))


def grouped(found: DataFrame) -> DataFrame:
    """One row per digest: the largest doc_id and the number of rows."""
    return found.groupBy("sha", "key").agg(F.max("doc_id").alias("top"), F.sum("copies").alias("n"))


@dataclass(frozen=True)
class Snapshot:
    """An immutable part of the corpus: its documents, its digests by bucket, and their filters."""

    docs: DataFrame
    buckets: DataFrame
    filters: DataFrame
    shards: int


def snapshot(docs: DataFrame, groups: DataFrame) -> Snapshot:
    """Index the documents of a snapshot, given their grouped digests. Written once, never changed."""
    shards = max(1, -(-groups.count() // SHARD_KEYS))
    buckets = cut_lineage(groups.withColumn("shard", F.pmod("key", F.lit(shards)).cast("int")))

    def build(shard: pd.DataFrame) -> pd.DataFrame:
        made = FuseFilter.build(shard["key"].to_numpy().view(np.uint64))
        return pd.DataFrame({
            "shard": [shard["shard"].iloc[0]], "seed": [made.seed], "segment": [made.segment],
            "segments": [made.segments], "slots": [made.slots.tobytes()],
        })

    filters = buckets.select("shard", "key").groupBy("shard").applyInPandas(
        build, "shard int, seed long, segment int, segments int, slots binary"
    )
    return Snapshot(docs, buckets, cut_lineage(filters), shards)


def screened(groups: DataFrame, base: Snapshot) -> DataFrame:
    """The groups of a batch whose digest the snapshot may hold: no false negatives.

    Shards of the batch meet the filter of the same shard; a batch that is larger than the snapshot
    is cut further, and the filters are sent to each cut.
    """
    cuts = max(1, -(-groups.count() // (base.shards * SHARD_KEYS)))
    batch = groups.select(
        F.pmod("key", F.lit(base.shards)).cast("int").alias("shard"), F.pmod(F.xxhash64("key"), F.lit(cuts)).cast("int").alias("cut"),
        "sha", "key", "top", "n",
    )
    filters = base.filters.withColumn("cut", F.explode(F.sequence(F.lit(0), F.lit(cuts - 1))))

    def probe(rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(held):
            return rows.iloc[:0]
        one = held.iloc[0]
        made = FuseFilter(int(one["seed"]), int(one["segment"]), int(one["segments"]), np.frombuffer(one["slots"], np.uint8))
        return rows[made.may_hold(rows["key"].to_numpy().view(np.uint64))]

    return batch.groupBy("shard", "cut").cogroup(filters.groupBy("shard", "cut")).applyInPandas(probe, batch.schema)


def verified(positives: DataFrame, batch: DataFrame, base: Snapshot) -> DataFrame:
    """Digests that are in both, with the texts of the two largest doc_ids compared byte by byte."""
    met = positives.select("sha", F.col("top").alias("new_top"), F.col("n").alias("new_n")).join(
        base.buckets.select("sha", F.col("top").alias("old_top"), F.col("n").alias("old_n")), "sha"
    )
    met = cut_lineage(met)

    def text_of(docs: DataFrame, top: str) -> DataFrame:
        wanted = met.filter(F.col(top).isNotNull()).select("sha", F.col(top).alias("doc_id"))
        text = id_and_text(docs).select("doc_id", F.encode(ascii_lower("text"), "UTF-8").alias("bytes"))
        # a doc_id may have several rows: only the text with the digest counts
        return wanted.join(text, "doc_id").filter(F.sha2("bytes", 256) == F.col("sha")).select("sha", F.col("bytes").alias(top + "_bytes")).dropDuplicates(["sha"])

    both = met.join(text_of(batch, "new_top"), "sha", "left").join(text_of(base.docs, "old_top"), "sha", "left")
    nameless = F.col("new_top").isNull() | F.col("old_top").isNull()  # no doc_id to find a text by: the digest decides
    return both.filter(nameless | (F.col("new_top_bytes") == F.col("old_top_bytes"))).select(
        "sha", F.greatest("new_top", "old_top").alias("keep_id"), (F.col("new_n") + F.col("old_n")).alias("group_size")
    )


def exact_duplicates(docs: DataFrame, incoming) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id`` (the row of its text that stays: the one with
    the largest doc_id), ``group_size``, ``kept`` and ``text_sha256``.

    ``incoming`` is a condition on ``doc_id``: its rows are the new batch, the others the snapshot.
    The result is the same for every choice. Texts are equal if they are identical after lower-casing A-Z
    only. Null text is empty. Of repeated rows (same doc_id, same text) one is kept. Rows without
    a doc_id are the batch's, count in their group, and are kept only if no row of it has one. An
    empty table gives no rows; other columns are not read.
    """
    new = F.coalesce(incoming, F.lit(True))
    per_row = digests(docs).groupBy("doc_id", "sha", "key").agg(F.count("*").alias("copies")).withColumn("new", new)
    per_row = cut_lineage(per_row)
    batch, base = grouped(per_row.filter("new")), grouped(per_row.filter("not new"))
    batch = cut_lineage(batch)
    base = snapshot(docs.filter(~new), base)
    merged = cut_lineage(verified(screened(batch, base), docs.filter(new), base))
    groups = (
        batch.select("sha", "top", "n", F.lit(True).alias("new"))
        .union(base.buckets.select("sha", "top", "n", F.lit(False).alias("new")))
        .join(merged, "sha", "left")
        .select("sha", "new", F.coalesce("keep_id", "top").alias("keep_id"), F.coalesce("group_size", "n").alias("group_size"))
        .filter("group_size > 1")
    )
    joined = salted_left_join(per_row, groups, ["sha", "new"], "doc_id")
    first = F.col("number") == 1
    return joined.select(
        "doc_id",
        F.coalesce("keep_id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("sha").alias("text_sha256"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("number"),
    ).select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & first).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, incoming) -> DataFrame:
    """Rows of ``docs``, with all their columns, that stay: of equal texts the largest doc_id.

    Of repeated rows one stays. Different texts stay, also where they have the same doc_id. Rows without a doc_id have
    nothing to be told by and stay.
    """
    judged = exact_duplicates(docs, incoming).filter("group_size > 1").groupBy("doc_id", F.col("text_sha256").alias("sha"))
    pairs = judged.agg(F.bool_or("kept").alias("stays"), F.count("*").alias("n"))
    return without(docs, F.sha2(ascii_lower(F.coalesce("text", F.lit(""))), 256), pairs)

"""Token counts kept by deltas: totals by source, language and tokenizer version.

A batch of changes becomes signed entries (the count a document had is taken back, the one it has now is added),
and its entries are summed into additive totals. A batch is written under its own name and counts only
once its commit is there: a batch that broke off is written anew, one that was committed is not
applied again, and no total is ever updated in place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.llm.bpe import Encoder, Vocabulary, in_goes
from gradeloom.llm.common import id_and_text, may_match
from gradeloom.session import cut_lineage, shared_folder

KEYS = ["source", "lang", "version"]
_TOTALS = "source string, lang string, version string, n_docs long, n_tokens long"
_COMMITS = "batch string"
#: Versions that count() knows: the vocabulary's ids, and words between ASCII blanks.
BPE, WORDS = "byte_bpe_50k", "words"


@dataclass(frozen=True)
class Ledger:
    """Totals in a folder that all executors share."""

    spark: SparkSession
    folder: str
    id_type: str = "bigint"

    @classmethod
    def create(cls, spark: SparkSession, folder: str | None = None, id_type: str = "bigint") -> Ledger:
        made = cls(spark, folder or shared_folder(spark, "token-ledger"), id_type)
        spark.createDataFrame([], _COMMITS).write.mode("ignore").parquet(f"{made.folder}/commits")
        return made

    def batches(self) -> list[str]:
        """Names of the committed batches."""
        return sorted(r[0] for r in self.spark.read.schema(_COMMITS).parquet(f"{self.folder}/commits").distinct().collect())

    def _stored(self, kind: str, schema: str) -> DataFrame | None:
        paths = [f"{self.folder}/{kind}/{batch}" for batch in self.batches()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else None

    def current(self, touched: DataFrame | None = None) -> DataFrame | None:
        """Count of each document and version as of the committed batches; given ``touched``, with the ``doc_id`` of
        documents, only of these and a few more, and only their entries are shuffled."""
        entries = self._stored("entries", f"doc_id {self.id_type}, {_TOTALS}")
        if entries is None:
            return None
        if touched is not None:
            entries = may_match(entries, "doc_id", touched)
        sums = entries.groupBy("doc_id", *KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.filter("n_docs <> 0 OR n_tokens <> 0")

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch of changes; False if it was committed before, which leaves all as it is.

        ``changes`` has ``doc_id``, ``source``, ``lang``, ``version``, ``n_tokens`` and ``deleted``.
        What the ledger holds of a document and version is taken back; unless deleted, the new
        count is added, be it an insert or a revised count. Deleting what isn't there does nothing.
        Several rows of a document in one batch count as so many documents. Rows without a doc_id
        are always inserts. Null sources and languages are groups of their own; a null count is 0.
        """
        if batch in self.batches():
            return False
        added = changes.filter("NOT coalesce(deleted, false)").select(
            "doc_id", *KEYS, F.lit(1).cast("long").alias("n_docs"), F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)).alias("n_tokens")
        )
        touched = changes.select("doc_id", "version").filter("doc_id IS NOT NULL").distinct()
        held = self.current(touched)
        if held is not None:
            old = held.join(touched, ["doc_id", "version"], "left_semi")
            added = added.union(old.select("doc_id", *KEYS, (-F.col("n_docs")).alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens")))
        added.write.mode("overwrite").parquet(f"{self.folder}/entries/{batch}")
        entries = self.spark.read.schema(f"doc_id {self.id_type}, {_TOTALS}").parquet(f"{self.folder}/entries/{batch}")
        totals = entries.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        totals.write.mode("overwrite").parquet(f"{self.folder}/totals/{batch}")
        self.spark.createDataFrame([(batch,)], _COMMITS).coalesce(1).write.mode("append").parquet(f"{self.folder}/commits")
        return True

    def totals(self) -> DataFrame:
        """``source``, ``lang``, ``version``, ``n_docs`` and ``n_tokens`` of all committed batches;
        groups that have nothing left are not listed."""
        stored = self._stored("totals", _TOTALS)
        if stored is None:
            return self.spark.createDataFrame([], _TOTALS)
        return stored.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).filter("n_docs <> 0 OR n_tokens <> 0")


def counted(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id``, ``source``, ``lang``, ``version`` and ``n_tokens`` of every whole text, for both versions.

    Null and empty texts have no tokens. Only these columns and text are read.
    """
    with open(vocabulary, "rb") as file:
        held = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in found:
            encoder = encoder or Encoder(Vocabulary(held.value))
            texts = batch.column("text").to_pylist()
            bpe = [n for a, b in in_goes(texts) for n in encoder.encode(texts[a:b])[1].tolist()]
            words = [len(t.encode("utf-8", "surrogatepass").split()) for t in texts]
            for version, counts in ((BPE, bpe), (WORDS, words)):
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("doc_id", "source", "lang")), pa.array([version] * len(texts), pa.string()), pa.array(counts, pa.int64())],
                    names=["doc_id", "source", "lang", "version", "n_tokens"],
                )

    rows = id_and_text(docs, "source", "lang")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, source string, lang string, version string, n_tokens long")


def ingested(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Totals of all documents after a history of batches that ends with each of them counted once.

    The first batch inserts three quarters, some with provisional counts, a quarter of the real
    ones; the second inserts the rest, revises those counts, and deletes some documents;
    the third brings these back; the second is then delivered again. Quarters and so on go by a
    hash of doc_id, and rows without one come first.
    """
    spark = docs.sparkSession
    slot = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(16)), F.lit(0))
    counts = cut_lineage(counted(docs, vocabulary)).withColumn("deleted", F.lit(False))
    ledger = Ledger.create(spark, id_type=docs.schema["doc_id"].dataType.simpleString())
    provisional = F.when(slot == 1, F.floor(F.col("n_tokens") / 4)).otherwise(F.col("n_tokens"))
    ledger.apply("first", counts.filter(slot < 12).withColumn("n_tokens", provisional))
    second = counts.filter((slot >= 12) | slot.isin(1, 2)).withColumn("deleted", slot == 2)
    ledger.apply("second", second)
    ledger.apply("third", counts.filter(slot == 2))
    ledger.apply("second", second)
    return ledger.totals()

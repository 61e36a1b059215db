"""From raw documents to encoded training text: each stage reads what the one before has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gradeloom.llm import bpe, exact_dedup, langid, mixing, shingles, simhash
from gradeloom.llm.common import small_batches
from gradeloom.llm.queries import new_batch, vocabulary
from gradeloom.session import shared_folder

#: Texts that a Python task of a stage gets at a time.
BATCH = 1_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay; those without a letter go."""
    small_batches(spark, BATCH)
    return langid.keep_identified(docs, langid.learn(docs, ~langid.held_out()))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.drop_exact_duplicates(docs, new_batch())


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id. Candidates are the texts
    of a SimHash component (fingerprints linked at four bits, found at anchors as op9 finds them) and those of a bucket
    of shingles, as four bits are too few for the texts at the limit. All shingles decide: eight tenths must be common."""
    small_batches(spark, BATCH)
    return shingles.drop_near_copies(docs, also=simhash.text_groups)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, each one whole."""
    return mixing.mix_documents(docs, whole=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, and whether they decode to its text."""
    small_batches(spark, BATCH)
    return bpe.encoded(docs, vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("simhash_dedup", near),
    ("source_mixing", mix),
    ("bpe", encode),
]

#: SQL can't say what the stages do; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""The queries of the operators, by name, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.llm import bpe, exact_dedup, gnat, grammar, langid, mixing, periodic, pivots, quality, secret_scan, simhash, token_counts, winnow
from gradeloom.llm.common import documents


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.fingerprinted(documents(spark, sf_dir))


def new_batch() -> Column:
    """The rows of documents that count as a new batch; the others are the snapshot they meet."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir), new_batch())


OP2_SQL = """
WITH rows AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
numbered AS (
    SELECT doc_id, sha256(low) AS text_sha256, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        row_number() OVER (PARTITION BY low, doc_id) AS number
    FROM rows WINDOW same AS (PARTITION BY low)
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND number = 1 AS kept, text_sha256 FROM numbered
"""


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trips(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scanned(documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.ingested(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.identify(docs, langid.learn(docs, ~langid.held_out()))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grammar.stored(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.scored(docs, quality.learn(docs, labels, ~langid.held_out()))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.top_k(embeddings(spark, sf_dir), F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
    FROM v AS q JOIN v AS c ON q.r <> c.r WHERE q.vec_id % 100 = 0
),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST))::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.summarised(documents(spark, sf_dir))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    table = embeddings(spark, sf_dir).select("vec_id", "embedding", moved.alias("label"))
    return gnat.hard_negatives(table, F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.r, q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, list_dot_product(q.e, c.e)::BIGINT AS score
    FROM v AS q JOIN v AS c ON q.r <> c.r WHERE q.vec_id % 100 = 0
),
positives AS (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS n FROM scored WHERE same QUALIFY n <= 5
),
pairs AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, c.vec_id AS negative_id, c.score AS negative_score,
        (row_number() OVER (PARTITION BY p.r, p.n ORDER BY c.score DESC, c.vec_id NULLS LAST))::INT AS rank
    FROM positives AS p JOIN scored AS c ON p.r = c.r AND NOT c.same AND 80 * p.score <= 100 * c.score AND c.score <= p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM pairs WHERE rank <= 5
"""


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_bpe": op3_bpe,
    "op4_secrets": op4_secrets,
    "op5_token_counts": op5_token_counts,
    "op6_langid": op6_langid,
    "op7_token_files": op7_token_files,
    "op8_mixing": op8_mixing,
    "op9_simhash": op9_simhash,
    "op10_quality": op10_quality,
    "op11_topk_search": op11_topk_search,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_hard_negatives": op13_hard_negatives,
}

#: DuckDB SQL for the rows of a query, where SQL can say them.
ORACLES: dict[str, str] = {
    "op2_exact_dedup": OP2_SQL,
    "op11_topk_search": OP11_SQL,
    "op13_hard_negatives": OP13_SQL,
}

"""Exact top-k search by an index of distances to pivots.

Each row is keyed by its nearest pivot and its distance to it, and the index is sorted by that key, so
a stretch of it is an annulus around a pivot. A query first looks into the annulus of its own distance
to its nearest pivot, widened until it holds enough rows; their k-th best score bounds the distance
of the result. Then all annuli are met, nearest first: by the triangle inequality no row of one lies nearer
than the difference of the distances to the pivot, and the search of a task stops where that exceeds the k-th best so far.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm import vectors
from gradeloom.llm.vectors import Block, Space, distances
from gradeloom.session import shared_folder

K = 10
#: Pivots, and the rows they are fitted on. Every row is indexed.
PIVOTS, SAMPLE = 64, 4_096
#: Rings of equal width that rows are counted in, around each pivot.
RINGS = 256
ROUNDS = 5
SCALE = 1024


def pivots_of(places: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Centres of a sample: spread out, then moved to the mean of their rows a few times."""
    chosen = [0]
    near = distances(places, places[:1])[:, 0]
    while len(chosen) < count and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(places, places[chosen[-1:]])[:, 0])
    centres = places[chosen].copy()
    for _ in range(ROUNDS):
        own = distances(places, centres).argmin(axis=1)
        for p in np.unique(own):
            centres[p] = places[own == p].mean(axis=0)
    return centres


def indexed(rows: DataFrame, space: Space, pivots: np.ndarray) -> DataFrame:
    """Rows with their pivot as ``part`` and their ``distance`` to it, in this order."""

    def run(found):
        for batch in found:
            apart = distances(space.rows(space.ints(batch.column("v"))), pivots)
            part = apart.argmin(axis=1)
            keys = [pa.array(part.astype(np.int32)), pa.array(apart[np.arange(len(part)), part])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *keys], names=[*batch.schema.names, "part", "distance"])

    kept = rows.select("row", "vec_id", "v")
    return vectors.ordered(kept.mapInArrow(run, f"row long, vec_id {rows.schema['vec_id'].dataType.simpleString()}, v binary, part int, distance double"))


def _own_annuli(apart: np.ndarray, counts: np.ndarray, width: float, wanted: int) -> tuple[np.ndarray, ...]:
    """Nearest pivot of each query, and the distances its first annulus begins and ends at."""
    home = apart.argmin(axis=1)
    ring = np.minimum((apart[np.arange(len(home)), home] / width).astype(np.int64), counts.shape[1] - 1)
    total = np.concatenate([np.zeros((len(counts), 1), np.int64), counts.cumsum(axis=1)], axis=1)
    begin, end = ring.copy(), ring + 1
    for _ in range(counts.shape[1]):
        few = total[home, end] - total[home, begin] < wanted
        if not few.any():
            break
        begin, end = np.where(few, np.maximum(begin - 1, 0), begin), np.where(few, np.minimum(end + 1, counts.shape[1]), end)
    return home, begin * width, end * width


def top_k(table: DataFrame, queries: Column, k: int = K, scale: int = SCALE, pivots: int = PIVOTS) -> DataFrame:
    """For each row of ``table`` (``vec_id``, ``embedding``) that fits ``queries`` (a condition on vec_id) the ``k`` other
    rows with the highest inner product of components floor(scale * x): ``query_id``, ``rank``, ``vec_id``, ``score``.

    Ties go to the smaller vec_id; a row without one comes last and is no query. Every row is a candidate but
    the query's own; repeated rows and vec_ids are rows of their own, and repeated queries get their own
    results. Fewer candidates than k are all returned. Which vectors take no part is said in
    ``vectors.numbered``; shorter vectors are filled up with zeros. An empty table gives no rows.
    """
    spark = table.sparkSession
    rows = vectors.numbered(table, scale)
    space = Space.of(rows)
    path = shared_folder(spark, "found")
    schema = f"query_id {rows.schema['vec_id'].dataType.simpleString()}, rank int, vec_id {rows.schema['vec_id'].dataType.simpleString()}, score long"
    spark.createDataFrame([], schema).write.parquet(path)
    index = None
    for block, own in vectors.query_blocks(spark, rows, queries, space):
        if index is None:
            centres = pivots_of(vectors.sample(rows, space, SAMPLE), pivots)
            index = indexed(rows, space, centres)
            width = max((index.agg(F.max("distance")).first()[0] or 0) / RINGS, 1e-9) * 1.000001
            ring = F.least(F.floor(F.col("distance") / width), F.lit(RINGS - 1)).cast("int")
            counts = np.zeros((len(centres), RINGS), dtype=np.int64)
            for r in index.groupBy("part", ring.alias("ring")).count().collect():  # pivots * rings at most
                counts[r["part"], r["ring"]] = r["count"]

        def within(block: Block, space: Space, centres=centres, counts=counts, width=width):
            home, begin, end = _own_annuli(distances(space.queries(block.ints), centres), counts, width, k + 1)
            return lambda part, low, high: np.where((home == part) & (begin <= high) & (end >= low), 0.0, np.inf)

        def annuli(block: Block, space: Space, centres=centres):
            apart = distances(space.queries(block.ints), centres)
            return lambda part, low, high: np.maximum(np.maximum(apart[:, part] - high, low - apart[:, part]) - space.slack, 0)

        shared = spark.sparkContext.broadcast(block)
        block = vectors.raised(block, vectors.best(index, shared, space, k, within), k)
        shared.unpersist()
        shared = spark.sparkContext.broadcast(block)
        names = spark.createDataFrame(pa.table({"query": pa.array(np.arange(len(block.row), dtype=np.int32)), "query_id": own.column("vec_id")}))
        found = vectors.ranked(vectors.best(index, shared, space, k, annuli), k)
        found.join(F.broadcast(names), "query").select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
        shared.unpersist()
    return spark.read.schema(schema).parquet(path)

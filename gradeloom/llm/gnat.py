"""Hard negatives by a tree of split points with distance ranges.

A node of the tree has a few split points; a row goes down with the nearest one. Each split point keeps,
for every sibling subtree, the least and greatest distance of that subtree's rows to it (over all rows). A query
wants rows in an annulus: no nearer than the highest score it accepts, no farther than the lowest. With its
distance to a split point, a sibling's range tells how near and how far its rows can be; where that misses the annulus,
the subtree is passed over. Leaves are compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm import vectors
from gradeloom.llm.vectors import Block, Space, distances
from gradeloom.session import shared_folder

POSITIVES, NEGATIVES = 5, 5
#: A negative's score is at least this percentage of the positive's, and at most 100.
PERCENT = 80
SCALE = 256
#: Split points of a node; a node is split while it has more than LEAF rows of the SAMPLE the tree is grown on.
FAN, LEAF, DEPTH, SAMPLE = 8, 48, 6, 4_096
#: Leaves a query looks into first.
FIRST = 4


@dataclass
class Tree:
    """Nodes from the root (0) down; a child n >= 0 is a node, others are leaf ~n."""

    points: list[np.ndarray]
    children: list[np.ndarray]
    leaves: int
    #: Of each node: least and greatest distance of split point i to the rows of subtree j.
    low: list[np.ndarray]
    high: list[np.ndarray]

    def route(self, places: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Each node that rows come to: node, rows, their distances to its split points, the child they take."""
        todo = [(0, np.arange(len(places)))] if self.points else []
        while todo:
            node, own = todo.pop()
            if not len(own):
                continue
            apart = distances(places[own], self.points[node])
            child = apart.argmin(axis=1)
            yield node, own, apart, child
            todo += [(int(below), own[child == j]) for j, below in enumerate(self.children[node]) if below >= 0]

    def limits(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For queries and leaves: how near and how far its rows can be, and the distance of its split point."""
        near, far, own = (np.zeros((len(places), self.leaves)) for _ in range(3))
        far[:] = np.inf
        todo = [(0, np.zeros(len(places)), np.full(len(places), np.inf))] if self.points else []
        while todo:
            node, least, most = todo.pop()
            apart = distances(places, self.points[node])
            for j, below in enumerate(self.children[node].tolist()):
                low, high = self.low[node][:, j], self.high[node][:, j]
                a = np.maximum(least, np.maximum(apart - high, low - apart).max(axis=1))
                b = np.minimum(most, (apart + high).min(axis=1))
                if below >= 0:
                    todo.append((below, a, b))
                else:
                    near[:, ~below], far[:, ~below], own[:, ~below] = a, b, apart[:, j]
        return near, far, own


def grow(places: np.ndarray, fan: int = FAN, leaf: int = LEAF, depth: int = DEPTH) -> Tree:
    """A tree over a sample; its ranges are still empty. Split points are far from each other."""
    tree = Tree([], [], 0, [], [])
    todo = [(np.arange(len(places)), 0, None)]
    while todo:
        own, level, above = todo.pop(0)
        points = [0]
        if level < depth and len(own) > leaf:
            apart = distances(places[own], places[own[:1]])[:, 0]
            while len(points) < fan and apart.max() > 0:
                points.append(int(apart.argmax()))
                apart = np.minimum(apart, distances(places[own], places[own[points[-1:]]])[:, 0])
        if len(points) > 1:
            number = len(tree.points)
            tree.points.append(places[own[points]])
            tree.children.append(np.zeros(len(points), dtype=np.int64))
            child = distances(places[own], tree.points[-1]).argmin(axis=1)
            todo += [(own[child == j], level + 1, (number, j)) for j in range(len(points))]
        else:
            number = ~tree.leaves
            tree.leaves += 1
        if above:
            tree.children[above[0]][above[1]] = number
    tree.low = [np.full((len(p), len(p)), np.inf) for p in tree.points]
    tree.high = [np.full((len(p), len(p)), -np.inf) for p in tree.points]
    return tree


def indexed(rows: DataFrame, space: Space, tree: Tree) -> DataFrame:
    """Rows with their leaf as ``part`` and their ``distance`` to its split point, in this order."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            places = space.rows(space.ints(batch.column("v")))
            part, distance = np.zeros(len(places), dtype=np.int32), np.zeros(len(places))
            for node, own, apart, child in tree.route(places):
                below = tree.children[node][child]
                part[own] = np.where(below < 0, ~below, -1)
                distance[own] = apart[np.arange(len(own)), child]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part), pa.array(distance)], names=[*batch.schema.names, "part", "distance"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    schema = f"row long, vec_id {kinds['vec_id']}, label {kinds['label']}, v binary, part int, distance double"
    return vectors.ordered(rows.select("row", "vec_id", "label", "v").mapInArrow(run, schema))


def ranged(rows: DataFrame, space: Space, tree: Tree) -> None:
    """Fill the ranges of the tree from all rows. Tasks send one row for each pair of siblings they met."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = [np.full((len(p), len(p)), np.inf) for p in tree.points]
        high = [np.full((len(p), len(p)), -np.inf) for p in tree.points]
        for batch in found:
            for node, _, apart, child in tree.route(space.rows(space.ints(batch.column("v")))):
                for j in np.unique(child):
                    low[node][:, j] = np.minimum(low[node][:, j], apart[child == j].min(axis=0))
                    high[node][:, j] = np.maximum(high[node][:, j], apart[child == j].max(axis=0))
        for node, (least, most) in enumerate(zip(low, high, strict=True)):
            i, j = np.nonzero(np.isfinite(least))
            if len(i):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), node, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(least[i, j]), pa.array(most[i, j])],
                    names=["node", "i", "j", "low", "high"],
                )

    found = rows.select("v").mapInArrow(run, "node int, i int, j int, low double, high double")
    for r in found.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():  # as many as the tree has
        tree.low[r["node"]][r["i"], r["j"]], tree.high[r["node"]][r["i"], r["j"]] = r["low"], r["high"]


def _bounds(tree: Tree, first: bool):
    """Bounds from the tree: of the first leaves of each query only, or of all."""

    def make(block: Block, space: Space):
        near, far, own = tree.limits(space.queries(block.ints))
        nearest = np.where(block.high.max(axis=1) == vectors.MOST, 0, space.reach(block.norm, block.high.max(axis=1).astype(np.float64)) - 2 * space.slack)
        near = np.where(far + space.slack < nearest[:, None], np.inf, np.maximum(near - space.slack, 0))
        if first and tree.leaves > FIRST:
            order = np.where(np.isinf(near), np.inf, own)
            near = np.where(order <= np.partition(order, FIRST - 1, axis=1)[:, FIRST - 1, None], near, np.inf)

        def bound(part: int, low: float, high: float) -> np.ndarray:
            if not tree.points:
                return near[:, part]
            around = own[:, part]
            nearer = np.maximum(near[:, part], np.maximum(around - high, low - around) - space.slack)
            return np.where(around + high + space.slack < nearest, np.inf, nearer)

        return bound

    return make


def hard_negatives(table: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = PERCENT, scale: int = SCALE) -> DataFrame:
    """Rows of other labels that score nearly as high as a positive, for each anchor and positive.

    ``table`` has ``vec_id``, ``embedding`` and ``label``; ``anchors`` is a condition on vec_id. The score is the inner
    product of components floor(scale * x); higher scores come first, ties by the smaller vec_id, rows
    without one last. Positives are the first rows of the anchor's label other than its own row; the negatives of each
    are the first rows of other labels with percent * positive_score <= 100 * negative_score <= 100 *
    positive_score. Gives ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``; a pair
    without such rows gives none.

    Rows with a null label take no part, nor do the vectors named in ``vectors.numbered``. Repeated rows and
    vec_ids are rows of their own, anchors too. An empty table gives no rows.
    """
    spark = table.sparkSession
    rows = vectors.numbered(table.filter("label is not null"), scale, "label")
    space = Space.of(rows)
    path = shared_folder(spark, "found")
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind}, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(path)
    index = None
    for block, own in vectors.query_blocks(spark, rows, anchors, space, "label"):
        if index is None:
            tree = grow(vectors.sample(rows, space, SAMPLE))
            ranged(rows, space, tree)
            index = indexed(rows, space, tree)

        def searched(block: Block, k: int, same: bool, tree=tree, index=index) -> DataFrame:
            """The first leaves give bounds, all others that the bounds leave are compared after that."""
            shared = spark.sparkContext.broadcast(block)
            block = vectors.raised(block, vectors.best(index, shared, space, k, _bounds(tree, True), same), k)
            return vectors.ranked(vectors.best(index, spark.sparkContext.broadcast(block), space, k, _bounds(tree, False), same), k)

        found = searched(block, positives, True).select("query", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), "rank").toArrow()
        query, rank, score = (found.column(c).to_numpy() for c in ("query", "rank", "positive_score"))
        low, high = (np.full((len(block.row), positives), x) for x in (vectors.MOST, vectors.LEAST))  # no score is wanted
        low[query, rank - 1], high[query, rank - 1] = [-(-percent * int(s) // 100) for s in score], score
        names = pa.table({
            "query": found.column("query"), "window": pa.array((rank - 1).astype(np.int32)), "positive_id": found.column("positive_id"),
            "positive_score": found.column("positive_score"), "anchor_id": own.column("vec_id").take(found.column("query")),
        })
        wanted = searched(block.windows(low, high), negatives, False).join(F.broadcast(spark.createDataFrame(names)), ["query", "window"])
        wanted.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)

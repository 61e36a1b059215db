"""Whole-number vectors for the searches: scores, distances, and the scan of an index for blocks of queries.

The searches want the greatest inner products and prune by distances. Both meet in a space of one more
dimension: with M the greatest norm, a row v becomes (v, sqrt(M^2 - |v|^2)) and a query q becomes (q, 0);
then their squared distance is |q|^2 + M^2 - 2 <q, v>, so that nearer is the same as a higher score. Scores are
whole numbers and exact; distances are rounded, so bounds on them are loosened by a slack.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradeloom.session import cut_lineage, shared_folder

#: Queries that are searched for at a time, and the most bytes of their vectors.
QUERIES, QUERY_BYTES = 16_384, 32 << 20
#: Rows of the index that are compared in one step: neighbours in its order, with one bound.
SEGMENT = 512
#: Queries that are compared with a segment in one step.
STEP = 1_024
#: Found rows that are held before they are cut to the best.
HELD = 500_000
#: No score is lower, none higher.
LEAST, MOST = -(2**63), 2**63 - 1


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary column."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def numbered(table: DataFrame, scale: int, *keep: str) -> DataFrame:
    """``row``, ``vec_id``, the columns ``keep``, ``v`` (floor(scale * x) of each component, 8 bytes each) and
    ``norm`` (squared) of every vector, written once.

    Vectors that are null or hold a null or a component that isn't finite take no part, nor do those
    whose squared norm does not fit a long (their scores might not either).
    """

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            lists = batch.column("embedding")
            sizes = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False))
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null components become NaN
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                with np.errstate(all="ignore"):
                    values = np.floor(scale * flat[offsets[own, None] + np.arange(int(size))])
                    norm = (values * values).sum(axis=1)
                fit = norm < 2.0**62  # false for all that is not finite
                own, ints = own[fit], values[fit].astype("<i8")
                if not len(own):
                    continue
                ends = np.arange(len(own) + 1, dtype=np.int32) * (8 * int(size))
                v = pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(ends), pa.py_buffer(ints.tobytes())])
                same = [batch.column(c).take(pa.array(own)) for c in ("row", "vec_id", *keep)]
                yield pa.RecordBatch.from_arrays([*same, v, pa.array(norm[fit])], names=["row", "vec_id", *keep, "v", "norm"])

    kinds = ", ".join(f"{c} {table.schema[c].dataType.simpleString()}" for c in keep)
    rows = table.select(F.monotonically_increasing_id().alias("row"), "vec_id", *keep, F.col("embedding").cast("array<double>").alias("embedding"))
    schema = f"row long, vec_id {table.schema['vec_id'].dataType.simpleString()}, {kinds + ', ' if kinds else ''}v binary, norm double"
    return cut_lineage(rows.filter("embedding is not null").mapInArrow(run, schema))


@dataclass
class Space:
    """Dimensions of the vectors (shorter ones get zeros) and their greatest squared norm."""

    dim: int
    top: float

    @staticmethod
    def of(vectors: DataFrame) -> Space:
        most = vectors.agg(F.max(F.octet_length("v")), F.max("norm")).first()
        return Space((most[0] or 0) // 8, most[1] or 0.0)

    @property
    def slack(self) -> float:
        return 1e-6 * (1 + self.top**0.5)

    def ints(self, column: pa.Array) -> np.ndarray:
        offsets, data = _bytes(column)
        n = len(column)
        if offsets[-1] - offsets[0] == n * self.dim * 8:  # no vector is longer than dim
            return data[offsets[0]:offsets[-1]].view("<i8").reshape(n, self.dim)
        out = np.zeros((n, self.dim), dtype=np.int64)
        for k in range(n):
            own = data[offsets[k]:offsets[k + 1]].view("<i8")
            out[k, : len(own)] = own
        return out

    def rows(self, ints: np.ndarray) -> np.ndarray:
        """Places of rows."""
        x = ints.astype(np.float64)
        return np.column_stack([x, np.sqrt(np.maximum(self.top - (x * x).sum(axis=1), 0))])

    def queries(self, ints: np.ndarray) -> np.ndarray:
        """Places of queries."""
        return np.column_stack([ints.astype(np.float64), np.zeros(len(ints))])

    def reach(self, norms: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Distance of a row with that score; more than that for the slack."""
        return np.sqrt(np.maximum(norms + self.top - 2.0 * score, 0)) + self.slack


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products, exact: by floating point where it holds all sums, else by whole numbers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


@dataclass
class Block:
    """A block of queries. ``low`` and ``high`` are the scores wanted, one column per window."""

    row: np.ndarray
    ints: np.ndarray
    low: np.ndarray
    high: np.ndarray
    label: np.ndarray | None = None
    norm: np.ndarray = field(init=False)

    def __post_init__(self):
        self.norm = (self.ints.astype(np.float64) ** 2).sum(axis=1)

    def windows(self, low: np.ndarray, high: np.ndarray) -> Block:
        return replace(self, low=low, high=high)


def sample(vectors: DataFrame, space: Space, size: int) -> np.ndarray:
    """Places of a bounded sample, the same whenever the rows are."""
    some = vectors.select("v", F.xxhash64("v", "vec_id").alias("at")).orderBy("at").limit(size).select("v").toArrow()
    return space.rows(np.concatenate([space.ints(c) for c in some.column("v").chunks if len(c)]))


def query_blocks(spark: SparkSession, vectors: DataFrame, queries, space: Space, label: str | None = None) -> Iterator[tuple[Block, pa.Table]]:
    """The rows that are queries in blocks of bounded size, dealt out by hash, with their own columns."""
    at_once = max(1, min(QUERIES, QUERY_BYTES // (8 * max(1, space.dim))))
    path = shared_folder(spark, "queries")
    wanted = vectors.filter(queries)
    blocks = -(-wanted.count() // at_once)
    if not blocks:
        return
    number = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    wanted.withColumn("block", number).write.partitionBy("block").parquet(path)
    for n in range(blocks):
        found = spark.read.parquet(path).filter(F.col("block") == n).drop("block").toArrow().combine_chunks()
        if found.num_rows:
            ints = np.concatenate([space.ints(c) for c in found.column("v").chunks if len(c)])
            all_scores = np.full((len(ints), 1), LEAST), np.full((len(ints), 1), MOST)
            labels = None if label is None else found.column(label).to_numpy()
            yield Block(found.column("row").to_numpy(), ints, *all_scores, labels), found


class _Best:
    """The best rows found so far: ``k`` for each query and window."""

    def __init__(self, block: Block, k: int):
        self.k, self.floor, self.width = k, block.low.copy(), block.low.shape[1]
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, *found: np.ndarray) -> None:
        """Query and window as one number, score, vec_id, whether it is known, row."""
        self.held.append(found)
        self.size += len(found[0])
        if self.size > HELD:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        if not self.held:
            return ()
        key, score, vec_id, known, row = (np.concatenate(x) for x in zip(*self.held, strict=True))
        order = np.lexsort((vec_id, ~known, ~score, key))  # ~score falls where score rises, and never overflows
        sorted_key = key[order]
        first = np.searchsorted(sorted_key, sorted_key)
        best = order[np.arange(len(order)) - first < self.k]
        found = key[best], score[best], vec_id[best], known[best], row[best]
        last = np.flatnonzero(np.arange(len(best)) - np.searchsorted(found[0], found[0]) == self.k - 1)
        floor = self.floor.reshape(-1)
        floor[found[0][last]] = np.maximum(floor[found[0][last]], found[1][last])
        self.held, self.size = [found], len(best)
        return found


#: Makes of a block of queries the function that bounds from below the distances of all queries to a
#: segment: a part of the index, and the least and greatest ``distance`` in it.
Bounds = Callable[[Block, Space], Callable[[int, float, float], np.ndarray]]


def best(index: DataFrame, shared: Broadcast, space: Space, k: int, bounds: Bounds, same: bool | None = None) -> DataFrame:
    """For each query and window of the block in ``shared`` the ``k`` best rows of ``index`` that any task found:
    ``query``, ``window``, ``vec_id``, ``row``, ``score``. The best of all are among them.

    ``index`` has ``part``, ``distance``, ``row``, ``vec_id``, ``v`` (and ``label``), in order of part and distance. Segments
    are taken nearest first; one that is farther than the k-th best row so far is passed over. ``same``: only rows of
    the query's label, or only of others.
    """

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        bound, top = bounds(block, space), _Best(block, k)
        for batch in found:
            part, distance = batch.column("part").to_numpy(), batch.column("distance").to_numpy()
            row, ints = batch.column("row").to_numpy(), space.ints(batch.column("v"))
            ids = batch.column("vec_id")
            known, vec_id = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy().astype(np.int64)
            label = batch.column("label").to_numpy() if same is not None else None
            edges = np.unique(np.r_[0, np.flatnonzero(np.diff(part)) + 1, np.arange(0, len(part), SEGMENT), len(part)]).tolist()
            segments = list(zip(edges[:-1], edges[1:], strict=True))
            lower = [bound(int(part[s]), float(distance[s]), float(distance[e - 1])) for s, e in segments]
            for g in sorted(range(len(segments)), key=lambda g: float(lower[g].min())):
                s, e = segments[g]
                near = np.flatnonzero(lower[g] <= space.reach(block.norm, top.floor.min(axis=1).astype(np.float64)))
                for at in range(0, len(near), STEP):
                    active = near[at:at + STEP]
                    score = scores(block.ints[active], ints[s:e])
                    fit = block.row[active, None] != row[s:e]
                    if same is not None:
                        fit &= (block.label[active, None] == label[s:e]) == same
                    for w in range(top.width):
                        a, c = np.nonzero(fit & (score >= top.floor[active, w, None]) & (score <= block.high[active, w, None]))
                        if len(a):
                            top.add(active[a] * top.width + w, score[a, c], vec_id[s + c], known[s + c], row[s + c])
            top.cut()
        out = top.cut()
        if out:
            key, score, vec_id, known, row = out
            yield pa.RecordBatch.from_arrays(
                [pa.array((key // top.width).astype(np.int32)), pa.array((key % top.width).astype(np.int32)), pa.array(vec_id, mask=~known), pa.array(row), pa.array(score)],
                names=["query", "window", "vec_id", "row", "score"],
            )

    columns = ["part", "distance", "row", "vec_id", "v"] + ([] if same is None else ["label"])
    return index.select(*columns).mapInArrow(run, "query int, window int, vec_id long, row long, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query and window, with their ``rank`` from 1."""
    order = Window.partitionBy("query", "window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def raised(block: Block, found: DataFrame, k: int) -> Block:
    """The block with windows that begin at the k-th best score found, where there are that many."""
    full = ranked(found, k).groupBy("query", "window").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    rows = full.filter(F.col("n") == k).select("query", "window", "least").toArrow()  # one for each query and window at most
    low = block.low.copy()
    query, window, least = (rows.column(c).to_numpy() for c in ("query", "window", "least"))
    low[query, window] = np.maximum(low[query, window], least)
    return block.windows(low, block.high)


def ordered(rows: DataFrame) -> DataFrame:
    """Index rows in order of part and distance, dealt out evenly however many are alike, and written."""
    return cut_lineage(rows.repartitionByRange("part", "distance", "row").sortWithinPartitions("part", "distance"))

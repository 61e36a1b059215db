"""Near copies by the Jaccard similarity of word shingles.

Candidates are texts that share a bucket: BANDS keys, each of ROWS minima of hashed shingles. A pair of
similarity s shares one with probability 1 - (1 - s^ROWS)^BANDS: 0.99994 at 0.8, more above. Inside a
bucket the similarity is worked out from all shingles of both texts, so no link is a guess.

A first pass links most of what is alike, each text in one cell of a bucket. The second meets all pairs of a
bucket but those inside its largest tree; buckets that hold one tree only are passed over. Every cell passes on a
spanning forest of its links. Further buckets may come from elsewhere: the pipeline gives the components of
SimHash fingerprints, met in both passes. Shingles are worked out where the texts lie, and only those of texts in a cell move.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import id_and_text, may_match, salted_left_join, tidied, without
from gradeloom.llm.simhash import components
from gradeloom.session import cut_lineage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 6
#: Buckets that are met at a time. Texts that the first pass has linked need not meet again.
PASSES = ((0, 6), (0, BANDS))
SEED = 9
#: Texts of one bucket that share a tile; larger buckets become several tiles. Never drops a text.
TILE = 256
#: Shingles that are multiplied in one numpy step.
STEP = 4_096


def shingles(text: str, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a text with fewer words is one shingle."""
    words = text.encode("utf-8").lower().split()  # bytes: A-Z, and blanks 0x20 and 0x09-0x0D
    line = b" ".join(words)
    width = max(1, min(width, len(words)))
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), dtype=np.int64, count=len(words)))
    starts = np.r_[0, ends[:-1]].tolist() if words else [0]
    stops = (ends[width - 1:] - 1).tolist() if words else [0]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(line[s:e], SEED) for s, e in zip(starts, stops, strict=False)], dtype=np.uint64))


def _factors() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 2**64, (2, BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(1)


def buckets(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The BANDS bucket keys of a set of shingles."""
    low = np.full(BANDS * ROWS, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(hashes), STEP):
        part = hashes[None, at:at + STEP] * factors[0]
        part ^= part >> np.uint64(32)
        part *= factors[1]
        np.minimum(low, part.min(axis=1), out=low)
    bands = low.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), n) for n, b in enumerate(bands)], dtype=np.uint64)


def links_of(sets: list[np.ndarray], similarity: float = SIMILARITY) -> tuple[list[int], list[int]]:
    """A spanning forest of the links among sets, each compared with all that no tree has yet."""
    sizes = np.array([len(s) for s in sets])
    tokens = np.unique(np.concatenate(sets), return_inverse=True)[1]
    own = np.split(tokens, np.cumsum(sizes)[:-1])
    mark = np.zeros(int(tokens.max()) + 1, dtype=bool)
    left, a, b = np.arange(len(sets)), [], []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            one = queue.pop()
            fit = (np.minimum(sizes[left], sizes[one]) >= similarity * np.maximum(sizes[left], sizes[one]) - 1e-9)
            some = left[fit]
            if not len(some):
                continue
            mark[own[one]] = True
            ends = np.cumsum(sizes[some])
            common = np.add.reduceat(mark[np.concatenate([own[s] for s in some])].astype(np.int64), ends - sizes[some])
            mark[own[one]] = False
            near = some[common >= similarity * (sizes[some] + sizes[one] - common) - 1e-9]
            a += [one] * len(near)
            b += near.tolist()
            queue += near.tolist()
            left = np.setdiff1d(left, near, assume_unique=True)
    return a, b


def links(texts: DataFrame, tile: int = TILE, similarity: float = SIMILARITY, width: int = SHINGLE, groups: DataFrame | None = None) -> DataFrame:
    """Edges ``a``, ``b`` between the ``key`` of texts whose components are those of all candidates with at
    least that similarity. ``texts`` has ``key`` (long) and ``text``; rows of one key have one text.
    ``groups`` has further buckets of them, as ``key`` and ``bucket``.

    Copies grow with the texts: in a bucket of n near copies each text is in one cell. Where m texts of a
    bucket of n belong to other trees, each of the n is copied m / ``tile`` times.
    """

    def spread(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _factors()
        for batch in found:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                keys = [buckets(shingles(t, width), factors) for t in part.column("text").to_pylist()]
                offsets = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * BANDS)
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(keys).view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("key"), lists], names=["key", "buckets"])

    def sets_of(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [shingles(t, width).tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(sets, pa.binary())], names=["key", "shingles"])

    def compare(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, keys, sets = None, [], []

        def result():
            if len(keys) > 1:
                a, b = links_of(sets, similarity)
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i in a], pa.int64()), pa.array([keys[i] for i in b], pa.int64())], names=["a", "b"])

        for batch in found:
            for now, key, held in zip(batch.column("cell").to_pylist(), batch.column("key").to_pylist(), batch.column("shingles").to_pylist(), strict=True):
                if now != cell:
                    yield from result()
                    cell, keys, sets = now, [], []
                keys.append(key)
                sets.append(np.frombuffer(held, np.uint64))
        yield from result()

    marks = texts.select("key", "text").mapInArrow(tidied(spread), "key long, buckets array<long>")
    marks = cut_lineage(marks.groupBy("key").agg(F.first("buckets").alias("buckets")))
    edges = None
    for first, last in PASSES:
        own = marks.select("key", F.slice("buckets", first + 1, last - first).alias("buckets"))
        if groups is not None:
            own = own.union(groups.select("key", F.array("bucket")))
        if edges is None:
            own = own.withColumn("tree", F.col("key"))
        else:
            own = own.join(trees(edges), "key", "left").select("key", "buckets", F.coalesce("tree", "key").alias("tree"))
        own = own.select("key", "tree", F.explode("buckets").alias("bucket"))
        cells = cut_lineage(first_cells(own, tile) if edges is None else all_cells(own, tile))
        held = may_match(texts, "key", cells).select("key", "text").mapInArrow(tidied(sets_of), "key long, shingles binary").dropDuplicates(["key"])
        placed = cells.join(held, "key").select("cell", "key", "shingles")
        found = cut_lineage(placed.repartition("cell").sortWithinPartitions("cell", "key").mapInArrow(tidied(compare), "a long, b long").distinct())
        edges = found if edges is None else edges.union(found)
    return edges


def trees(edges: DataFrame) -> DataFrame:
    """``key`` and ``tree``: the smallest key two links away. Texts of one tree are linked, over others if not directly;
    a component may still be several trees, which costs comparisons but no link."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = cut_lineage(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("tree")))
    far = salted_left_join(both, near.withColumnRenamed("a", "b"), "b", "a").groupBy("a").agg(F.min("tree").alias("far"))
    return cut_lineage(near.join(far, "a").select(F.col("a").alias("key"), F.least("tree", "far").alias("tree")))


def _shared(own: DataFrame) -> DataFrame:
    """Buckets whose texts aren't all in one tree yet, one of those that hold the same texts, and their size."""
    shared = own.groupBy("bucket").agg(
        F.min("tree").alias("one"), F.max("tree").alias("other"), F.min("key").alias("low"), F.max("key").alias("high"),
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("key")).alias("members"),
    )
    once = shared.filter("one < other").groupBy("low", "high", "n", "members").agg(F.min("bucket").alias("bucket"))
    return cut_lineage(once.select("bucket", "low", "high", "n"))


def first_cells(own: DataFrame, tile: int) -> DataFrame:
    """``cell`` and ``key``: each bucket cut into tiles, and two of its texts in every tile. Each text is in one
    cell of a bucket, so a large group of near copies becomes a tree without all pairs of its tiles."""
    once = _shared(own).withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
    one = own.join(once, "bucket").select("bucket", "key", F.pmod(F.xxhash64("key"), F.col("tiles")).alias("tile"))
    ends = once.filter("tiles > 1").select("bucket", F.explode(F.array("low", "high")).alias("key"), "tiles")
    every = ends.select("bucket", "key", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("tiles") - 1).cast("long"))).alias("tile"))
    return one.union(every).select(F.xxhash64("bucket", "tile").alias("cell"), "key").distinct()


def all_cells(own: DataFrame, tile: int) -> DataFrame:
    """``cell`` and ``key``: all pairs of texts of a bucket meet but those inside its largest tree. Texts of other
    trees are hosts; a tile of hosts meets every tile of the bucket. A text of the largest tree is copied
    once for each tile of hosts."""
    once = _shared(own)
    small = own.join(once.filter(F.col("n") <= tile), "bucket").select(F.xxhash64("bucket", F.lit(0), F.lit(0)).alias("cell"), "key")
    large = cut_lineage(own.join(once.filter(F.col("n") > tile), "bucket").select("bucket", "key", "tree", "n"))
    trees = large.groupBy("bucket", "tree").agg(F.count("*").alias("size"), F.first("n").alias("n"))
    most = trees.groupBy("bucket").agg(F.max_by("tree", F.struct("size", "tree")).alias("largest"), F.max("size").alias("size"), F.first("n").alias("n"))
    cuts = most.select(
        "bucket", "largest", F.ceil(F.col("n") / tile).cast("int").alias("tiles"), F.ceil((F.col("n") - F.col("size")) / tile).cast("int").alias("hosts")
    )
    rows = large.drop("n").join(cuts, "bucket").withColumns({
        "host": F.pmod(F.xxhash64("key"), F.col("hosts")).cast("int"), "guest": F.pmod(F.xxhash64("key", F.lit(1)), F.col("tiles")).cast("int"),
    })
    hosts = rows.filter("tree <> largest").select("bucket", "key", "host", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("guest"))
    guests = rows.select("bucket", "key", F.explode(F.sequence(F.lit(0), F.col("hosts") - 1)).alias("host"), "guest")
    return small.union(hosts.union(guests).select(F.xxhash64("bucket", "host", "guest").alias("cell"), "key")).distinct()


def near_groups(docs: DataFrame, tile: int = TILE, also: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row for each ``doc_id`` and text: ``sha`` (SHA-256 of the text), ``n`` rows, ``component_id``, the smallest doc_id
    of all texts it is linked to, and ``stays``: it is the first text with that doc_id (by SHA-256).

    Texts are told by their SHA-256; the 64-bit numbers they have in the search differ, too. ``also`` gives
    further buckets (``key``, ``bucket``) of texts (``key``, ``text``), whose texts are candidates, too.
    """
    texts = id_and_text(docs).select("doc_id", F.xxhash64("text").alias("key"), "text")
    rows = texts.groupBy("doc_id", "key", F.sha2("text", 256).alias("sha")).agg(F.count("*").alias("n"))
    known = cut_lineage(rows)
    clashes = cut_lineage(known.groupBy("key").agg(F.min("sha").alias("a"), F.max("sha").alias("b")).filter("a < b").select("key", F.lit(True).alias("clash")))
    if not clashes.isEmpty():  # of n texts some n^2 / 2^65 share a number

        def told_apart(df: DataFrame, sha) -> DataFrame:
            key = F.when(F.col("clash"), F.xxhash64(sha, F.lit("again"))).otherwise(F.col("key"))
            return df.join(F.broadcast(clashes), "key", "left").withColumn("key", key).drop("clash")

        texts, known = told_apart(texts, F.sha2("text", 256)), told_apart(known, F.col("sha"))
    texts = texts.select("key", "text")
    joined = components(links(texts, tile, groups=also(texts) if also else None)).withColumnRenamed("node", "key")
    named = salted_left_join(known, joined, "key", "doc_id").select("doc_id", "sha", "n", F.coalesce("root", "key").alias("root"))
    member = cut_lineage(named)
    first = member.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sha")).alias("first"), F.count("*").alias("texts"))
    told = salted_left_join(member, first.filter("texts > 1"), "root", "doc_id")
    alone = F.col("texts").isNull()
    return told.select(
        "doc_id", "sha", "n", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("sha") == F.col("first.sha")))).alias("stays"),
    )


def near_copies(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """``doc_id`` and ``component_id``, the smallest doc_id among all texts it is linked to, one row per document.

    Null text is empty; texts without words are alike. A null doc_id is never the smallest unless there
    is no other. Repeated rows stay rows; an empty table gives none.
    """
    each = F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))
    return near_groups(docs, tile).select("doc_id", "component_id", each.alias("number")).drop("number")


def drop_near_copies(docs: DataFrame, also: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows of ``docs``, with all their columns, one of each group of near copies; ``also`` gives further
    candidates, as in ``near_groups``.

    The one with the smallest doc_id stays. Of repeated rows (same doc_id, same text) one stays, and of different
    texts with that doc_id the one whose SHA-256 comes first. Rows that have no near copy stay, whatever
    their doc_id; rows without a doc_id have nothing to be told by and stay.
    """
    return without(docs, F.sha2(F.coalesce("text", F.lit("")), 256), near_groups(docs, also=also))

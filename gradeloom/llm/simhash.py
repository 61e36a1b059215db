"""SimHash near-duplicates: fingerprints linked at few differing bits, found by anchor points.

A pair of 64-bit fingerprints that differ in at most four bits differs in at most one bit of some
block when the bits are dealt into three blocks. In each block the anchors are the words of a
covering code of radius one (a Hamming code beside free bits). A fingerprint has one home, the
anchor within the covering radius, and is copied to every anchor within covering radius plus
threshold: if two fingerprints agree in a block but for one bit, the second one reaches the home of
the first. Fingerprints are compared per anchor only; anchors with many are cut into cells of home
and guest tiles. A buffer of cells passes on a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import id_and_text, keep_listed, salted_left_join
from gradeloom.session import cut_lineage

SHINGLE = 4
THRESHOLD = 4
SEED = 42
#: Bits of each block; pigeonhole over them gives the threshold inside a block.
BLOCKS = (22, 21, 21)
#: Check bits of the Hamming code inside a block: it covers its first 2^4 - 1 bits with radius one.
CHECK_BITS = 4
#: Rows of one anchor that share a tile; larger anchors become several tiles. Never drops a row.
TILE = 2048
#: Nodes with more neighbours than HUB_ROWS, and than a HUBS-th of all, count as hubs.
HUB_ROWS, HUBS = 1_000, 10_000
#: Comparisons that are made in one numpy step.
STEP = 4_000_000


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text: a bit is set if it is in over half the hashes."""
    words = text.encode("utf-8").lower().split()  # bytes: A-Z, and blanks 0x20 and 0x09-0x0D
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths).tolist()
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[s:e], SEED) for s, e in zip(starts, (ends[width - 1:] - 1).tolist(), strict=False)]
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and the fingerprint ``fp`` (as a signed long) of every whole text."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            fps = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return id_and_text(docs).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


class AnchorCode:
    """Anchors of one block: its first 2^check - 1 bits hold a Hamming code, the others are free."""

    def __init__(self, bits: int, check: int, reach: int):
        self.check = check
        coded = (1 << check) - 1
        if bits < coded:
            raise ValueError(f"a block needs at least {coded} bits")
        self.masks = [sum(1 << (n - 1) for n in range(1, coded + 1) if n >> c & 1) for c in range(check)]
        patterns: dict[int, list[int]] = {s: [] for s in range(1 << check)}
        for weight in range(reach + 1):
            for where in combinations(range(bits), weight):
                syndrome = 0
                for w in where:
                    if w < coded:
                        syndrome ^= w + 1
                patterns[syndrome].append(sum(1 << w for w in where))
        #: Changes that lead from a word with a syndrome to each anchor within reach; the first is the home.
        self.patterns = [np.array(sorted(p, key=lambda x: (x.bit_count(), x)), dtype=np.uint64) for p in patterns.values()]

    def syndromes(self, block: np.ndarray) -> np.ndarray:
        out = np.zeros(len(block), dtype=np.int64)
        for c, mask in enumerate(self.masks):
            out |= (np.bitwise_count(block & np.uint64(mask)) & 1).astype(np.int64) << c
        return out


def _spread(fps: np.ndarray, blocks: tuple[int, ...], check: int, threshold: int) -> tuple[np.ndarray, ...]:
    """Anchor, fingerprint and home mark of every copy of the fingerprints."""
    anchors, values, homes, shift = [], [], [], 0
    inside = threshold // len(blocks)
    for n, bits in enumerate(blocks):
        code = AnchorCode(bits, check, 1 + inside)
        block = fps >> np.uint64(shift) & np.uint64((1 << bits) - 1)
        shift += bits
        syndromes = code.syndromes(block)
        for s, patterns in enumerate(code.patterns):
            own = np.flatnonzero(syndromes == s)
            at = (block[own, None] ^ patterns[None, :]) | np.uint64(n << 60)
            anchors += [at[:, 0], at.ravel()]
            values += [fps[own], np.repeat(fps[own], len(patterns))]
            homes += [np.ones(len(own), dtype=bool), np.zeros(at.size, dtype=bool)]
    return np.concatenate(anchors), np.concatenate(values), np.concatenate(homes)


def roots(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Smallest node reachable from each of n nodes over the edges u-v."""
    root = np.arange(n)
    while True:
        a, b = root[u], root[v]
        low = np.minimum(a, b)
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(before, root):
            return root


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As many edges as needed for the same components: each node and its smallest."""
    nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
    root = roots(index[: len(u)], index[len(u):], len(nodes))
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _cell_links(cells: np.ndarray, homes: np.ndarray, fps: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of links between homes and guests of the same cell; rows are in order of cells."""
    first = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    number = np.cumsum(np.r_[True, cells[1:] != cells[:-1]]) - 1
    host, guest = np.flatnonzero(homes), np.flatnonzero(~homes)
    guests = np.bincount(number[guest], minlength=len(first))
    guest_start = np.cumsum(guests) - guests
    pairs = guests[number[host]]
    edges: list[tuple[np.ndarray, np.ndarray]] = []
    done = 0
    ends = np.cumsum(pairs)
    while done < len(host):
        upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + STEP, "right")))
        own = np.arange(done, upto)
        count = pairs[own]
        left = np.repeat(host[own], count)
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        right = guest[np.repeat(guest_start[number[host[own]]], count) + offset]
        a, b = fps[left], fps[right]
        near = (np.bitwise_count(a ^ b) <= threshold) & (a != b)
        if near.any():
            edges.append(_forest(a[near], b[near]))
        done = upto
    if not edges:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return _forest(np.concatenate([e[0] for e in edges]), np.concatenate([e[1] for e in edges]))


def links(fps: DataFrame, threshold: int = THRESHOLD, blocks: tuple[int, ...] = BLOCKS, check: int = CHECK_BITS, tile: int = TILE) -> DataFrame:
    """Edges ``a``, ``b`` whose components are those of all distinct fingerprints ``fp`` that differ
    in at most ``threshold`` bits. Pairs are met at anchors, cut into cells of at most ``tile``
    homes and guests; each task passes on a forest of what it found."""
    if sum(blocks) != 64:
        raise ValueError("blocks must hold 64 bits")

    def replicate(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            values = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(values), 20_000):
                anchors, copies, homes = _spread(values[at:at + 20_000], blocks, check, threshold)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors.view(np.int64)), pa.array(copies.view(np.int64)), pa.array(homes)], names=["anchor", "fp", "home"]
                )

    def compare(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: tuple[np.ndarray, ...] = (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.uint64))

        def result(cells, homes, values):
            a, b = _cell_links(cells, homes, values, threshold)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in found:
            new = (
                batch.column("cell").to_numpy(), batch.column("home").to_numpy(zero_copy_only=False),
                batch.column("fp").to_numpy().view(np.uint64),
            )
            rest = tuple(np.concatenate([x, y]) for x, y in zip(rest, new, strict=True))
            ready = int(np.searchsorted(rest[0], rest[0][-1])) if len(rest[0]) else 0  # the last cell may go on
            if ready:
                yield from result(*(x[:ready] for x in rest))
                rest = tuple(x[ready:] for x in rest)
        if len(rest[0]):
            yield from result(*rest)

    copies = fps.select("fp").mapInArrow(replicate, "anchor long, fp long, home boolean")
    large = (
        copies.groupBy("anchor").count().filter(F.col("count") > tile)
        .select("anchor", F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    )
    tiles = F.coalesce("tiles", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), tiles)
    rows = copies.join(large, "anchor", "left").select(
        "fp", "home", "anchor", own.alias("own"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other")
    )
    host, guest = F.when(F.col("home"), F.col("own")).otherwise(F.col("other")), F.when(F.col("home"), F.col("other")).otherwise(F.col("own"))
    cells = rows.select(F.xxhash64("anchor", host, guest).alias("cell"), "home", "fp")
    return (
        cells.repartition("cell").sortWithinPartitions("cell")
        .mapInArrow(compare, "a long, b long").distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and the smallest node ``root`` it can reach over edges ``a``, ``b``.

    Alternating star steps: every node ties its larger neighbours to its smallest one, then its
    smaller ones. The edges are written after each step; the rounds grow as the logarithm of the
    nodes. Neighbours are never gathered: each step is a minimum per node and a join. The few nodes with
    many neighbours (HUBS at most) are joined by a broadcast, so that no task gets all edges of one.
    """

    def attached(rows: DataFrame, low: DataFrame, edges: int) -> DataFrame:
        most = max(HUB_ROWS, 2 * edges // HUBS)
        low = cut_lineage(low)
        if low.filter(F.col("n") > most).isEmpty():
            return rows.join(low.select("a", "low"), "a")
        hubs = F.broadcast(low.filter(F.col("n") > most).select("a", "low"))
        others = rows.join(hubs.select("a"), "a", "left_anti").join(low.filter(F.col("n") <= most).select("a", "low"), "a")
        return others.union(rows.join(hubs, "a").select(*others.columns))

    now = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    mark = (now.count(), None)
    while True:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"), F.count("*").alias("n"))
        large = attached(both, low, mark[0]).filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").distinct()
        large = cut_lineage(large)
        # of each node the smaller neighbours and the node itself go to the smallest
        low = large.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n"))
        joined = attached(large, low, mark[0])
        small = joined.select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b"))
        keep = small.union(low.select("a", F.col("low").alias("b"))).filter("a <> b").distinct()
        now = cut_lineage(keep)
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(seen) == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(seen)


def text_groups(texts: DataFrame, threshold: int = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """``key`` (long) of each text and ``bucket``, one number for all texts that ``near_duplicates`` puts in one component.

    ``texts`` has ``key`` and ``text``; rows of one key have one text and give one row.
    """
    found = cut_lineage(fingerprints(texts.select(F.col("key").alias("doc_id"), "text"), shingle).distinct())
    joined = components(links(cut_lineage(found.select("fp").distinct()), threshold)).withColumnRenamed("node", "fp")
    group = F.xxhash64(F.coalesce("root", "fp"), F.lit("simhash"))
    return cut_lineage(salted_left_join(found, joined, "fp", "doc_id").select(F.col("doc_id").alias("key"), group.alias("bucket")))


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the
    smallest doc_id among all documents it is linked to, directly or over others.

    Null text is empty. Texts without words have fingerprint zero and are linked like any other.
    Repeated rows stay rows. A null doc_id is never the smallest unless there is no other, and
    then ``component_id`` is null. An empty table gives no rows; other columns are not read.
    """
    found = cut_lineage(fingerprints(docs, shingle))
    distinct = cut_lineage(found.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")))
    joined = components(links(distinct, threshold))
    member = distinct.join(joined, distinct.fp == joined.node, "left").select(
        "fp", "low", "n", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("tied")
    )
    member = cut_lineage(member)
    group = member.groupBy("root").agg(F.min("low").alias("component_id"), F.bool_or("tied").alias("met")).filter("met")
    own = F.when(F.col("met"), F.col("component_id")).when(F.col("n") > 1, F.col("low"))
    told = salted_left_join(member, group, "root", "fp").select("fp", own.alias("component_id")).filter("component_id is not null")
    return salted_left_join(found, told, "fp", "doc_id").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, threshold: int = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """Rows of ``docs``, with all their columns, that are the first of their group of near copies.

    The first is the one with the smallest doc_id; of repeated rows with that doc_id one stays.
    Rows without a doc_id have nothing to be told by and stay.
    """
    groups = near_duplicates(docs, threshold, shingle).select("doc_id", "component_id")
    return keep_listed(docs, groups.filter("doc_id = component_id"))

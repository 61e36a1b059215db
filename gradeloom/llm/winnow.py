"""Winnowing fingerprints, in DataFrame functions only.

A text is cut into units: up to three letters or digits in a row, from the start of a word on, or a
run of punctuation. Rolling hashes are taken of every K units; of every W hashes in a row the least
is marked, the rightmost of equal ones, with its position. Two texts that share K + W - 1 units in a
row share a mark. Texts shorter than that have one mark, empty ones none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.common import id_and_text
from gradeloom.session import cut_lineage

#: Units in a hash, and hashes in a window. Both are powers of two: sums and minima are built by doubling.
K = 4
W = 4
#: Low bits of a mark that hold the position, counted down so that the least mark is the rightmost.
#: No array has more elements, so no text is too long.
PLACE_BITS = 30
UNIT = r"[^\s\p{Punct}]{1,3}|\p{Punct}+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _doubled(values: Column, width: int, join: Callable[[Column, Column], Column]) -> Column:
    """For each element the join of it and the width - 1 after it, as far as there are any."""

    def with_later(step: int) -> Callable[[Column], Column]:
        return lambda a: F.transform(a, lambda x, i: join(x, F.get(a, i + step)))

    step = 1
    while step < width:
        values = let(values, with_later(step))
        step *= 2
    return values


def _whole(values: Column, width: int) -> Column:
    """The elements that had width - 1 after them; at least one, if there is any."""
    return let(values, lambda a: F.slice(a, F.lit(1), F.greatest(F.size(a) - (width - 1), F.lit(1))))


def marks(text: Column) -> Column:
    """Marks of a text in order of position: the hash above the position, in one long."""
    units = F.transform(F.regexp_extract_all(text, F.lit(f"({UNIT})"), F.lit(1)), lambda u: F.xxhash64(u))
    grams = _whole(_doubled(units, K, lambda a, b: F.xxhash64(a, b)), K)
    last = (1 << PLACE_BITS) - 1
    placed = F.transform(grams, lambda h, i: F.shiftleft(F.shiftrightunsigned(h, PLACE_BITS + 1), PLACE_BITS) + (F.lit(last).cast("long") - i))
    return F.array_distinct(_whole(_doubled(placed, W, F.least), W))


def mark_hash(mark: Column) -> Column:
    return F.shiftright(mark, PLACE_BITS)


def mark_place(mark: Column) -> Column:
    """Position of the first unit of a mark, from 0."""
    last = (1 << PLACE_BITS) - 1
    return F.lit(last).cast("long") - mark.bitwiseAND(F.lit(last).cast("long"))


def hashes(found: Column) -> Column:
    """Distinct hashes of marks."""
    return F.array_distinct(F.transform(found, mark_hash))


def likeness(a: Column, b: Column) -> Column:
    """Shared part of two sets of hashes, 0 to 1; two empty ones are alike."""
    shared = F.size(F.array_intersect(a, b))
    both = F.size(a) + F.size(b) - shared
    return F.when(both == 0, 1.0).otherwise(shared / both)


def digest(found: Column) -> Column:
    """Marks and positions of a text as a short string: equal for equal fingerprints."""
    return F.sha2(F.array_join(F.transform(found, lambda m: m.cast("string")), ","), 256)


def _bucket(value: Column, lows: list) -> Column:
    """Number of the range that holds the value, by binary search over the lowest values of the
    ranges; -1 for null."""
    if not lows:
        return F.lit(-1)
    held, steps, step = F.lit(lows), [], 1
    while step <= len(lows):
        steps.insert(0, step)
        step *= 2

    def closer(at: Column, step: Column) -> Column:
        there = at + step
        return F.when((there <= len(lows)) & (F.get(held, there - 1) <= value), there).otherwise(at)

    return F.when(value.isNull(), -1).otherwise(F.aggregate(F.lit(steps), F.lit(0), closer))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``found`` (its marks), and ``next_text`` and ``next_found`` of the
    document after it by descending doc_id; after the last comes the first.

    Documents are dealt out by ranges of doc_id, once. The first of each range is also sent to
    the range before it, so a range is worked out by itself: two neighbouring rows are held at a
    time. Equal ids are in order of text, null ids come last.
    """
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = id_and_text(docs)
    ids = rows.select("doc_id").filter("doc_id is not null").repartitionByRange(ranges, "doc_id")
    lows = [r[0] for r in ids.groupBy(F.spark_partition_id()).agg(F.min("doc_id").alias("low")).select("low").collect()]
    placed = rows.withColumn("bucket", _bucket(F.col("doc_id"), sorted(set(lows))))
    tops = placed.groupBy("bucket").agg(F.max("doc_id").alias("top"))
    down = Window.orderBy(F.col("bucket").desc())  # one row for a range
    before = F.coalesce(F.lag("bucket").over(down), F.last("bucket").over(down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    firsts = cut_lineage(tops.select("top", F.col("bucket").alias("own"), before.alias("before")))
    # as many rows as ranges
    guests = (
        placed.join(F.broadcast(firsts), (F.col("bucket") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("top")))
        .groupBy("before").agg(F.min("text").alias("text"))
        .select(F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text", F.col("before").alias("bucket"), F.lit(True).alias("guest"))
    )
    dealt = placed.withColumn("guest", F.lit(False)).unionByName(guests).repartition("bucket").withColumn("found", marks(F.col("text")))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    return dealt.select(
        "doc_id", "text", "found", "guest", F.lead("text").over(order).alias("next_text"), F.lead("found").over(order).alias("next_found")
    ).filter("not guest").drop("guest")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``, and ``n_marks``.

    The edited text ends in the first half as many code points of the next document (or all of it, if
    it has fewer) in place of its own last half. Null text is empty. Equal texts have equal
    fingerprints, and likeness 1 to one another. Repeated rows stay rows and are neighbours; a single row is its own
    next; an empty table gives no rows; other columns are not read.
    """
    half = F.floor(F.char_length("text") / 2).cast("int")
    rows = with_next(docs)
    edited = F.concat(F.expr("left(text, char_length(text) - cast(floor(char_length(text) / 2) as int))"), F.left("next_text", half))
    rows = rows.withColumn("edited", edited)
    rows = rows.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "found", "next_found", marks(F.col("edited")).alias("edited_found"),
    )
    sets = rows.select("*", *[hashes(F.col(c)).alias("set_" + c) for c in ("found", "edited_found", "next_found")])
    return sets.select(
        "doc_id", "n_chars", "edited_sha256",
        digest(F.col("found")).alias("fingerprint"), digest(F.col("edited_found")).alias("edited_fingerprint"),
        likeness(F.col("set_found"), F.col("set_edited_found")).alias("near_edited"),
        likeness(F.col("set_found"), F.col("set_next_found")).alias("near_next"),
        F.size("found").cast("long").alias("n_marks"),
    )

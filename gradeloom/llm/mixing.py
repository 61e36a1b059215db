"""Mixing sources to target weights by pivotal dependent rounding.

A source whose target is x times its size takes every document floor(x) times, and once more with
the probability x - floor(x). Which ones is settled by duels: two documents with fractional
probabilities meet, and mass, counted in words, moves from one to the other at random until one of
them is integral; the other goes on. Either way is chosen such that no probability changes in the
mean, and the words expected of the two stay what they were. Duels run in blocks; each block passes
on one residual, residuals meet in blocks again, and so up a tree until one document is left for a
source. Of that one the query takes the words that are still missing, so a source meets its target
to the word.

A mix of whole documents (``whole``) settles the large ones first. Trees are built for each size
class; of every class one block is kept back, and these are settled in one row from large to small
with the residuals of the trees: each is taken or not by its probability, and what that is above or
below its expected words is spread over all smaller ones. The last, a small one unless there are none,
has nothing below it, so a source misses its target by some words of small documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.common import id_and_text, one_row_each
from gradeloom.session import cut_lineage

#: Copies of a document, and so of a source, that are never exceeded.
MOST = 3
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: Units that meet in one block, about; every block passes on one residual.
BLOCK = 64
SEED = 8


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source`` and the number of words of the whole text; null text has none."""
    size = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return id_and_text(docs, "source").select("doc_id", "source", size.alias("size"))


def targets(rows: DataFrame) -> DataFrame:
    """``source``, ``source_size`` and ``target`` words of every source.

    Sources in order of code points (null last) get the weights in turn and share all words; none
    gets more than MOST times its size, and what it can't take is shared by the others in the same
    way. With sources in order of the share at which they are full, the full ones come first, and
    the level of the rest follows from running sums. One row per source takes part.
    """
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    full = (F.col("source_size") * MOST).cast("double")
    ranked = totals.withColumn("weight", weight).withColumn("full", full).withColumn("full_at", F.col("full") / F.col("weight"))
    in_order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = in_order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    leveled = ranked.withColumn("level", level)
    # the first source that isn't full at its own level sets the level of all after it
    first = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(whole)
    return leveled.withColumn("first", first).select(
        "source", "source_size", F.least("full", F.col("first.level") * F.col("weight")).alias("target")
    )


def _chance(a: Column, b: Column) -> Column:
    """A number from 0 to 1 that is fixed by the two units."""
    return F.shiftrightunsigned(F.xxhash64(a["doc_id"], a["size"], b["doc_id"], b["size"], F.lit(SEED)), 11) / F.lit(float(1 << 53))


def _duel(state: Column, unit: Column) -> Column:
    """The carried unit meets the next one; one of them is settled, the other is carried on.

    A unit has ``words``, its size times its probability. ``up`` is what can go from the other to
    the carried unit, ``down`` what can go the other way; up happens with probability
    down / (up + down).
    """
    a, b = state["carried"], unit
    room_a, room_b = a["size"] - a["words"], b["size"] - b["words"]
    up, down = F.least(room_a, b["words"]), F.least(a["words"], room_b)
    rises = _chance(a, b) * (up + down) < down
    # rising, a is settled if it gets full; falling, if it gets empty; else b is settled
    a_settled = F.when(rises, room_a <= b["words"]).otherwise(a["words"] <= room_b)
    full = rises == a_settled
    settled = F.struct(
        F.when(a_settled, a["doc_id"]).otherwise(b["doc_id"]).alias("doc_id"),
        F.when(a_settled, a["size"]).otherwise(b["size"]).alias("size"),
        F.when(full, F.when(a_settled, a["size"]).otherwise(b["size"])).otherwise(F.lit(0).cast("long")).alias("extra"),
    )
    moved = F.when(rises, up).otherwise(-down)
    carried = F.struct(
        F.when(a_settled, b["size"]).otherwise(a["size"]).alias("size"),
        F.when(a_settled, b["doc_id"]).otherwise(a["doc_id"]).alias("doc_id"),
        F.when(a_settled, b["words"] - moved).otherwise(a["words"] + moved).alias("words"),
    )
    return F.struct(carried.alias("carried"), F.concat(state["settled"], F.array(settled)).alias("settled"))


def _met(units: DataFrame, falling: bool = False) -> DataFrame:
    """Duels inside each block of a key: what is settled, and the one unit carried on. Units meet
    from small to large, or from large to small if ``falling``."""
    kind = dict(units.dtypes)["doc_id"]
    none = F.expr(f"CAST(array() AS array<struct<doc_id:{kind},size:bigint,extra:bigint>>)")
    in_order = F.sort_array(F.collect_list(F.struct("size", "doc_id", "words")), asc=not falling)
    start = F.struct(F.element_at("units", 1).alias("carried"), none.alias("settled"))
    fought = F.aggregate(F.slice("units", F.lit(2), F.size("units")), start, _duel)
    groups = units.groupBy("key", "block").agg(in_order.alias("units")).select("key", "block", fought.alias("state"))
    return cut_lineage(groups.select("key", "block", "state.carried", "state.settled"))


def _up_the_tree(level: DataFrame, most: int, falling: bool = False) -> tuple[DataFrame, list[DataFrame]]:
    """The one unit carried on of each key, and all levels of what was settled on the way."""
    done = [level]
    while most > 1:
        most = -(-most // BLOCK)
        level = _met(level.select("key", F.floor(F.col("block") / BLOCK).alias("block"), "carried.*"), falling)
        done.append(level)
    return level, done


def rounded_whole(units: DataFrame) -> DataFrame:
    """``key``, ``doc_id``, ``size`` and the ``extra`` words taken of each unit: none or all.

    Size classes are powers of two. The last row of a key holds one block and one residual of each
    class: some 64 units for each doubling of the size, never more with more documents.
    """
    classed = units.withColumn("class", F.floor(F.log2("size")).cast("int")).withColumn("words", F.col("size") * F.col("p"))
    blocks = cut_lineage(classed.groupBy("key", "class").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks")))
    most = blocks.agg(F.max("blocks")).first()[0] or 1
    block = F.pmod(F.xxhash64("doc_id", "size", F.lit(SEED)), F.col("blocks"))
    placed = cut_lineage(classed.join(blocks, ["key", "class"]).select("key", "class", block.alias("block"), "size", "doc_id", "words"))
    last, done = placed.filter("block = 0").select("key", "size", "doc_id", "words"), []
    if most > 1:
        tree = placed.filter("block > 0").select(F.struct("key", "class").alias("key"), "block", "size", "doc_id", "words")
        top, done = _up_the_tree(_met(tree, True), most, True)
        last = last.union(top.select("key.key", "carried.*").select("key", "size", "doc_id", "words"))
    settled = cut_lineage(_settled(last))
    for part in done:
        settled = settled.union(part.select(F.col("key.key").alias("key"), F.explode("settled").alias("s")).select("key", "s.*"))
    return settled


def _settled(units: DataFrame) -> DataFrame:
    """``key``, ``doc_id``, ``size`` and ``extra``, none or all words, of each unit of a key.

    Units are settled from large to small. The state holds the size and the expected words of those to
    come, whose probabilities are ``scale`` times the first ones plus ``shift``. What a taken unit has
    above its expected words is taken from the others in proportion to their words, what a dropped one
    leaves goes to them in proportion to their room; both at most as far as the mean of each probability stays.
    """
    kind = dict(units.dtypes)["doc_id"]
    none = F.expr(f"CAST(array() AS array<struct<doc_id:{kind},size:bigint,extra:bigint>>)")
    in_order = F.sort_array(F.collect_list(F.struct("size", "doc_id", "words")), asc=False)
    groups = units.groupBy("key").agg(in_order.alias("units"), F.sum("size").cast("double").alias("size"), F.sum("words").alias("words"))
    start = F.struct(F.col("size"), F.col("words"), F.lit(1.0).alias("scale"), F.lit(0.0).alias("shift"), none.alias("settled"))

    def step(state: Column, unit: Column) -> Column:
        size = unit["size"].cast("double")
        p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), state["scale"] * unit["words"] / size + state["shift"]))
        left = F.greatest(F.lit(0.0), state["size"] - size)
        words = F.least(left, F.greatest(F.lit(0.0), state["words"] - p * size))
        room = left - words
        down = F.least((1 - p) * size, words, F.when(p > 0, room * (1 - p) / p).otherwise(0.0))
        up = F.when(p < 1, down * p / (1 - p)).otherwise(0.0)
        chance = F.shiftrightunsigned(F.xxhash64(unit["doc_id"], unit["size"], F.lit(SEED), F.lit("settled")), 11) / F.lit(float(1 << 53))
        taken = chance < p
        kept = F.when(taken, F.when(words > 0, 1 - down / words).otherwise(1.0)).otherwise(F.when(room > 0, 1 - up / room).otherwise(1.0))
        done = F.struct(unit["doc_id"].alias("doc_id"), unit["size"].alias("size"), F.when(taken, unit["size"]).otherwise(F.lit(0).cast("long")).alias("extra"))
        return F.struct(
            left.alias("size"), F.when(taken, words - down).otherwise(words + up).alias("words"), (state["scale"] * kept).alias("scale"),
            F.when(taken, state["shift"] * kept).otherwise(1 - kept + state["shift"] * kept).alias("shift"), F.concat(state["settled"], F.array(done)).alias("settled"),
        )

    found = groups.select("key", F.aggregate("units", start, step, lambda state: state["settled"]).alias("settled"))
    return found.select("key", F.explode("settled").alias("s")).select("key", "s.*")


def rounded(units: DataFrame) -> DataFrame:
    """``key``, ``doc_id``, ``size`` and the ``extra`` words taken of each unit: none or all, and for
    the last one of a key the rest. ``p``, above zero and below one, is the same for a key.

    Blocks hold BLOCK units in the mean. Reruns agree: blocks, order and chances hang on doc_id and
    size alone.
    """
    blocks = cut_lineage(units.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks")))
    most = blocks.agg(F.max("blocks")).first()[0] or 1
    block = F.pmod(F.xxhash64("doc_id", "size", F.lit(SEED)), F.col("blocks"))
    level = _met(units.join(blocks, "key").select("key", block.alias("block"), "doc_id", "size", (F.col("size") * F.col("p")).alias("words")))
    level, done = _up_the_tree(level, most)
    found = level.select("key", "carried.*").select("key", "doc_id", "size", F.round("words").cast("long").alias("extra"))
    for part in done:
        found = found.union(part.select("key", F.explode("settled").alias("s")).select("key", "s.*"))
    return found


def mixed(docs: DataFrame, whole: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``source_size``, ``target`` and ``taken``, the
    words the mix takes of it: whole copies, but for one document of each source. If ``whole``,
    whole copies of that one too; a source then meets its target but for less than one document.

    Null and empty texts have size 0 and are not taken. A null source is a source of its own.
    Repeated rows are documents of their own. Only doc_id, text and source are read; an empty table
    gives no rows.
    """
    rows = cut_lineage(sized(docs))
    goals = targets(rows).withColumn("key", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    share = F.when(F.col("source_size") > 0, F.least(F.lit(float(MOST)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    goals = cut_lineage(goals.withColumn("base", F.floor(share)).withColumn("p", share - F.floor(share)))
    named = goals.withColumnRenamed("source", "_source")
    placed = cut_lineage(rows.join(named, F.col("source").eqNullSafe(F.col("_source"))).select("key", "doc_id", "size", "p"))
    fractional = (F.col("p") > 0) & (F.col("size") > 0)
    plain = placed.filter(~fractional).select("key", "doc_id", "size", F.lit(0).cast("long").alias("extra"))
    found = plain.union((rounded_whole if whole else rounded)(placed.filter(fractional)))
    return found.join(goals, "key").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("base") + F.col("extra")).cast("long").alias("taken")
    )


def mix_documents(docs: DataFrame, whole: bool = False) -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, as often as they are taken.

    The one document of a source that is taken in part has its first words, joined by blanks; there
    is none if ``whole``.
    Several rows of one doc_id count as copies of it: what is taken of them is taken of the first.
    Rows without a doc_id can't be told by a mix and are left out.
    """
    copies = F.sum(F.when(F.col("size") > 0, F.expr("taken div size"))).alias("_copies")
    taken = mixed(docs, whole).filter("doc_id is not null").groupBy("doc_id").agg(
        F.sum("taken").alias("_taken"), F.max("size").alias("_size"), copies, (F.count("*") > 1).alias("_often")
    ).filter("_taken > 0")
    found = one_row_each(docs, taken)
    if whole:
        return found.withColumn("_copy", F.explode(F.expr("sequence(1L, _copies)"))).select("_row.*")
    copies = F.expr("sequence(1L, ceil(_taken / _size))")
    each = found.withColumn("_copy", F.explode(copies)).withColumn("_words", F.least("_size", F.col("_taken") - (F.col("_copy") - 1) * F.col("_size")))
    words = F.filter(F.split("_row.text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    text = F.when(F.col("_words") < F.col("_size"), F.array_join(F.slice(words, F.lit(1), F.col("_words").cast("int")), " ")).otherwise(F.col("_row.text"))
    return each.withColumn("_text", text).select(*[F.col("_text").alias("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns])

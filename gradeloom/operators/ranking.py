"""School rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.functions import rules
from gradeloom.functions.grades import hundredths
from gradeloom.session import cut_lineage


def school_averages(facts: DataFrame, school: str, grade: str) -> DataFrame:
    """Mean grade per year and school over rows that have one. Summed as whole hundredths, so
    the result does not depend on the order of the rows."""
    return (
        facts.filter(F.col(grade).isNotNull())
        .groupBy("an", F.col(school).alias("id"))
        .agg(F.sum(hundredths(grade)).alias("total"), F.count("*").alias("n"))
        .select("an", "id", "n", (F.col("total") / (F.col("n") * 100)).alias("medie"))
    )


def rank_by_average(averages: DataFrame) -> DataFrame:
    """Position per year in descending order of the average, ties by id.

    No task sees all schools of a year: averages lie between 1 and 10, so the schools fall into
    at most 901 steps of a hundredth. Positions are counted within a step and shifted by the
    number of schools in the steps above, a table of at most 901 rows per year.

    The averages are used twice; they are fixed first, so that the facts are read once.
    """
    stepped = cut_lineage(averages).withColumn("step", F.floor(F.col("medie") * 100).cast("int"))
    sizes = stepped.groupBy("an", "step").agg(F.count("*").alias("size"))
    above = Window.partitionBy("an").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("an", "step", F.coalesce(F.sum("size").over(above), F.lit(0)).alias("above"))
    within = F.row_number().over(Window.partitionBy("an", "step").orderBy(F.desc("medie"), "id"))
    ranked = stepped.join(offsets, ["an", "step"]).withColumn("rank", within + F.col("above"))
    return ranked.drop("step", "above")


def school_rank(facts: DataFrame, school: str, grade: str, year: int | None = None) -> DataFrame:
    """Average and rank of the schools, for one year or for each."""
    if year is not None:
        facts = facts.filter(F.col("an") == year)
    return rank_by_average(school_averages(facts, school, grade))


def combined_rank(institutions: DataFrame, middle: DataFrame, high: DataFrame) -> DataFrame:
    """Rank of every institution: as a high school, else as a middle school, else unranked.

    The two rankings are those of one year.
    """
    return (
        institutions.drop("rank")
        .join(middle.select("id", F.col("rank").alias("_middle")), "id", "left")
        .join(high.select("id", F.col("rank").alias("_high")), "id", "left")
        .withColumn("rank", F.coalesce("_high", "_middle", F.lit(rules.UNRANKED)))
        .drop("_middle", "_high")
    )


def website_work_list(institutions: DataFrame) -> DataFrame:
    """Institutions that have a website, best rank first."""
    return institutions.filter(F.col("website").isNotNull()).orderBy("rank")

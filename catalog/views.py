"""Exam-shaped inputs derived from the given tables, as DataFrames.

Every view covers the whole of its tables. ``catalog.oracle_views`` states the same views in
SQL for the result check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeloom.functions import rules

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXY"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. A file of few row groups is read by few tasks, so its rows are dealt out to all cores
    before any expression is worked out on them."""
    rows, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def _county(number: Column) -> Column:
    return F.concat(F.lit("J"), F.substring(F.lit(LETTERS), number.cast("int") + 1, F.lit(1)))


def padded(number: Column, width: int) -> Column:
    """Zeros before a number up to a width; longer numbers keep all their digits."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def _mark(h: Column) -> Column:
    return F.concat(F.floor(h / 100).cast("string"), F.lit("."), padded(h % 100, 2))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: candidate, school and labels, without marks."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    ord, cust, year = F.col("o_orderkey"), F.col("o_custkey"), F.year("o_orderdate")
    county = _county(F.col("c_nationkey"))
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        year.alias("an"),
        ord.alias("ord"),
        F.concat(county, padded(ord, 7)).alias("cod_candidat"),
        F.when(ord % 101 == 0, "x").when(ord % 2 == 0, "Masculin").otherwise("f").alias("sex"),
        F.when(ord % 9 == 0, None).when(ord % 7 == 0, "1990-1991")
        .otherwise(F.concat((year - 1).cast("string"), F.lit("-"), year.cast("string"))).alias("promotie"),
        F.concat(F.lit("Liceul „"), "c_mktsegment", F.lit("” Nr. "), (cust % 40).cast("string")).alias("unitate_nume"),
        county.alias("unitate_cod_judet"),
        F.when(
            cust % 11 != 0,
            F.concat(F.lit("016"), (cust % 2 + 1).cast("string"), (cust % 3 + 1).cast("string"), padded(cust, 4), F.lit("0")),
        ).alias("unitate_siiir"),
        F.when(ord % 6 == 0, "Limba 1").when(ord % 6 == 1, "-").otherwise("").alias("limba_materna"),
        F.when(ord % 211 == 0, "Amânat").when(ord % 40 == 0, "Eliminat din examen")
        .when(F.col("o_orderstatus") == "F", "REUSIT").when(F.col("o_orderstatus") == "O", "Respins")
        .otherwise("Neprezentat").alias("rezultat"),
        F.when(ord % 8 == 0, "")
        .otherwise(F.concat(F.lit("<b>Liceul "), "c_mktsegment", F.lit("</b><br/>Real/Liceal/Zi"))).alias("repartizat_liceu_nume"),
        F.when(ord % 8 == 0, "").when(ord % 13 == 0, "Nerepartizat")
        .otherwise(F.concat(
            F.lit("<b>("), (cust % 300 + 100).cast("string"), F.lit(") Profil "), "o_orderpriority",
            F.lit("</b><br/>Limba A"), F.when(ord % 5 == 0, " / Limba B").otherwise(""),
        )).alias("repartizat_specializare"),
    )


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with marks. Lines are reduced to one row per order before the join, and the
    reduction and the join share one partitioning by order key. The subjects are the first four
    line numbers of an order; its further lines are no marks."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = lines.groupBy("l_orderkey").agg(
        *[F.max(F.when(F.col("l_linenumber") == n, F.col("l_partkey"))).alias(f"p{n}") for n in (1, 2, 3, 4)]
    )
    ord = F.col("l_orderkey")

    def first_mark(n: int) -> Column:
        p = F.col(f"p{n}")
        h = (p * 37 + n * 101) % 901 + 100
        return F.when(p.isNull(), None).when(p % 97 == 0, "-").otherwise(_mark(h))

    def appeal(n: int) -> Column:
        p = F.col(f"p{n}")
        h = (p * 37 + n * 101) % 901 + 100
        return F.when(p.isNull(), None).when((p % 5 == 0) & (h <= 975), _mark(h + 25)).otherwise("")

    marks = parts.select(
        ord.alias("ord"),
        first_mark(1).alias("lr_init"), appeal(1).alias("lr_cont"),
        F.when(ord % 6 == 0, first_mark(4)).alias("lm_init"),
        first_mark(2).alias("do_init"), appeal(2).alias("do_cont"),
        first_mark(3).alias("da_init"), appeal(3).alias("da_cont"),
    )
    return candidates(spark, sf_dir).join(marks, "ord", "left")


def _letter_of_brand() -> Column:
    return _county(F.substring("p_brand", 7, 3).cast("int") - 1)


def institutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    name = F.concat(F.lit("Școala „"), "p_name", F.lit("” "), "p_type", F.lit(" Nr. "), F.col("p_size").cast("string"))
    code = F.concat(F.lit("0161"), (key % 3 + 1).cast("string"), padded(key, 4), F.lit("0"))
    return part.select(
        key.alias("id"), _letter_of_brand().alias("cod_judet"), name.alias("nume"),
        F.when(key % 10 != 0, code).alias("cod_siiir"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry of the institutions that have a code; every second one has a high-school level."""
    coded = institutions(spark, sf_dir).dropna(subset=["cod_siiir"])
    return coded.select(
        F.col("cod_siiir").alias("cod_siiir_unitate"),
        F.regexp_replace("nume", "[„”]", "").alias("denumire_lunga_unitate"),
        F.col("cod_judet").alias("judet_pj"),
        F.when(F.col("id") % 2 == 0, "da").alias("stare_liceal"),
    )


def source_schools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Misspelt, reordered or re-punctuated names of the parts."""
    part, key, size = table(spark, sf_dir, "part"), F.col("p_partkey"), F.col("p_size")
    name = (
        F.when(key % 4 == 0, F.concat(F.lit("SCOALA "), F.upper("p_name"), F.lit(" "), "p_type", F.lit(" NR "), size.cast("string")))
        .when(key % 4 == 1, F.concat(
            F.lit("Şcoala '"), F.replace("p_name", F.lit("l"), F.lit("")), F.lit("' "), "p_type", F.lit(" Nr."), size.cast("string")))
        .when(key % 4 == 2, F.concat(F.lit("Scoala "), "p_type", F.lit(" "), "p_name", F.lit(" "), (size + 1).cast("string")))
        .otherwise(F.concat(F.lit("Școala ,,"), "p_name", F.lit('" '), "p_type", F.lit(" Nr. "), size.cast("string")))
    )
    return part.select(_letter_of_brand().alias("cod_judet"), name.alias("nume")).distinct()


def county_text(number: Column) -> Column:
    """Upper-case county name with its Romanian letters, picked by a running number."""
    return F.element_at(F.array(*[F.lit("JUD. " + c[2].upper()) for c in rules.COUNTIES]), (number % 42 + 1).cast("int"))


def old_registries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two older registries with codes as numbers in text, the first with leading zeros. Some
    parts share a code, and every seventh code is in neither."""
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    name = F.concat(F.lit("Liceul "), "p_name", F.lit(" "), "p_size")
    first_code, second_code = F.floor(key / 3), F.floor(key / 2)
    first = part.filter(first_code % 7 != 0).select(
        key.cast("double").alias("nr_crt"), padded(first_code, 10).alias("cod_siiir"),
        name.alias("nume_unitate"), county_text(key).alias("judet"),
    )
    second = part.filter(second_code % 7 != 0).select(
        key.cast("double").alias("nr_crt"), second_code.cast("string").alias("cod_sirues"),
        F.concat(F.lit("Grup "), name).alias("nume_unitate"), county_text(key + 7).alias("judet"),
    )
    return first, second


def school_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry attributes per supplier: street, number, place, postcode, site, phone, tax code."""
    supplier, key = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    number = F.element_at(F.array(*[F.lit(t) for t in ["-", "12", " x ", "7 bis.", ""]]), (key % 5 + 1).cast("int"))
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        key.alias("aux_id"),
        padded(key, 10).alias("cod"),
        F.concat(F.lit(" Str. "), "s_name", F.lit(",")).alias("strada"),
        number.alias("nr_strada"),
        F.when(key % 6 != 0, F.concat("n_name", F.lit("-VALE"))).alias("localitate"),
        F.when(key % 4 != 0, padded(key * 7, 6)).alias("cod_postal"),
        F.when(key % 3 == 0, "").when(key % 3 == 1, F.concat(F.lit("www.s"), key.cast("string"), F.lit(".example"))).alias("website"),
        F.when(key % 2 == 0, F.concat(F.lit("07"), padded(key, 8))).alias("telefon"),
        F.when(key % 5 != 0, (key * 13).cast("string")).alias("cod_fiscal"),
    )


def listed_schools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """School rows with display attributes, one per customer; ten share a code of the details."""
    customer, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    return customer.select(
        key.alias("id"),
        F.concat("c_mktsegment", F.lit(" Nr. "), key.cast("string")).alias("nume"),
        F.when(key % 9 != 0, padded(F.floor(key / 10), 10)).alias("cod_siiir"),
        F.when(key % 4 == 0, "Str. Veche 1").when(key % 4 == 1, "").alias("adresa"),
        F.when(key % 5 == 0, "www.vechi.example").alias("website"),
        F.when(key % 7 == 0, "0700").alias("telefon"),
        F.lit(None).cast("string").alias("cod_fiscal"),
    )


def alias_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases in chains of up to nine steps: each customer not at the end of its run of ten
    points to the next one; every fourth has no alias and ends a chain."""
    key = F.col("c_custkey")
    linked = table(spark, sf_dir, "customer").filter((key % 10 != 9) & (key % 4 != 0))
    return linked.select(key.cast("string").alias("alternativ"), (key + 1).cast("string").alias("corect"))


def found_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbered rows without some that were lost on the way, for the audits of pages."""
    key = F.col("set_no") * 5000 + (F.col("page_no") - 1) * 20 + F.col("row_no")
    return numbered_rows(spark, sf_dir).filter(key % 997 != 0)


def numbered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result rows on numbered pages of twenty, in sets of 250 pages."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.floor(key / 5000).alias("set_no"),
        (F.floor(key % 5000 / 20) + 1).alias("page_no"),
        (key % 20).alias("row_no"),
        (key % 5000 + 1).cast("string").alias("crt"),
        F.col("o_orderpriority").alias("value"),
    )


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pages with two table lines per record, a page label, and hidden fields."""
    rows = numbered_rows(spark, sf_dir)
    line = F.concat(
        F.lit('<tr class="tr1 hint"><td> '), "crt", F.lit("</td><td>Nota <b>"), "value",
        F.lit("</b> &amp; &#259;&#x219;&icirc; &amp;lt; x</td></tr><tr class='tr2'><td>"), (F.col("row_no") % 3).cast("string"),
        F.lit("</td></tr><tr class=\"tr3\"><td>no</td></tr>"),
    )
    page = rows.groupBy("set_no", "page_no").agg(
        F.array_sort(F.collect_list(F.struct("row_no", line.alias("line")))).alias("lines")
    )
    body = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    fields = F.concat(
        F.lit('<input type="hidden" name="__VIEWSTATE" value="v'), F.col("page_no").cast("string"),
        F.lit('"/><input name="__EVENTVALIDATION" type="hidden" value=""/><input type="text" name="q" value="1"/>'),
        F.when(F.col("page_no") % 3 != 0, '<input type="hidden" name="__VIEWSTATEGENERATOR" value="g"/>').otherwise(""),
    )
    labels = F.concat(F.lit("<p>pag. 1 ... pag. 250 pag. "), F.col("page_no").cast("string"), F.lit("</p>"))
    error = F.when(F.col("page_no") % 101 == 0, "<h1>Eroare</h1>").otherwise("")
    html = F.concat(F.lit("<html>"), error, fields, F.lit("<table>"), body, F.lit("</table>"), labels, F.lit("</html>"))
    return page.select("set_no", "page_no", html.alias("html"))

"""Queries over files that many tasks read at once, and over the stored registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import oracle_views as ov
from catalog import views
from catalog.registry import query
from gradeloom.operators.rejects import split_valid_rejects
from gradeloom.plans import loads
from gradeloom.session import shared_folder
from gradeloom.sources import readers, tables


@query("split_csv_records", """
SELECT cast(o_orderkey AS string) AS id, 'a "' || o_orderpriority || '", ' || chr(10) || 'b' AS txt,
  CASE WHEN o_orderkey % 3 = 0 THEN o_clerk || chr(10) || chr(10) || ',"' || chr(10) END AS more
FROM (SELECT *, 'clerk ' || o_custkey AS o_clerk FROM orders)""")
def split_csv_records(spark: SparkSession, sf: str) -> DataFrame:
    """Headed CSV with quotes and line breaks in its cells, cut into pieces."""
    path, key = shared_folder(spark, "csv"), F.col("o_orderkey")
    rows = views.table(spark, sf, "orders").select(
        key.alias("id"), F.concat(F.lit('a "'), "o_orderpriority", F.lit('", \nb')).alias("txt"),
        F.when(key % 3 == 0, F.concat(F.lit("clerk "), F.col("o_custkey").cast("string"), F.lit('\n\n,"\n'))).alias("more"),
    )
    exact = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(header=True, quote='"', escape='"', **exact).csv(path)
    return readers.read_records(spark, path, split=True).drop(readers.BAD_LINE)


def _arrays(rows: DataFrame, number, folder: str) -> None:
    """Arrays of at most a thousand objects, one after another in each file."""
    objects = F.array_join(F.collect_list(F.to_json(F.struct(*[c for c in rows.columns if c != "_n"]), {"ignoreNullFields": "false"})), ",\n")
    rows.withColumn("_n", number).groupBy(F.floor(F.col("_n") / 1000)).agg(objects.alias("o")).select(F.concat(F.lit("[\n"), "o", F.lit("\n]"))).write.text(folder)


@query("json_array_records", """
SELECT cast(c_custkey AS string) AS id, c_mktsegment || ' } "' || c_name || '" ] {[' AS note, cast(c_nationkey AS string) AS nation,
  cast(c_custkey % 3 AS bigint) AS n FROM customer""")
def json_array_records(spark: SparkSession, sf: str) -> DataFrame:
    """Objects of JSON arrays over many lines, with objects and lists inside, and brackets in their texts."""
    path, key = shared_folder(spark, "json"), F.col("c_custkey")
    rows = views.table(spark, sf, "customer").select(
        key.alias("id"), F.concat("c_mktsegment", F.lit(' } "'), "c_name", F.lit('" ] {[')).alias("note"),
        F.struct(F.col("c_nationkey").alias("nation"), F.sequence(F.lit(1), (key % 3).cast("int")).alias("up"),
                 F.array_repeat(F.struct(key.alias("k")), (key % 3).cast("int")).alias("list")).alias("inner"),
    )
    _arrays(rows, F.col("id"), path)
    read = readers.read_records(spark, path, "json", split=True)
    return read.select("id", "note", F.col("inner.nation").alias("nation"), F.size("inner.list").cast("long").alias("n"))


@query("registry_responses", """
SELECT cast(s_suppkey AS string) AS cod, cast(s_suppkey + 1 AS string) AS aux_id, s_name AS denumire, 'S ' || s_suppkey AS denumire_scurta,
  'Loc ' || s_nationkey AS localitate, CASE WHEN s_suppkey % 2 = 0 THEN 'Mun. ' || s_nationkey END AS localitate_superioara, n_name AS judet,
  CASE WHEN s_suppkey % 3 = 0 THEN 'Cu PJ' ELSE 'Arondată' END AS statut, 'Unitate de învățământ' AS tip_unitate,
  CASE WHEN s_acctbal > 0 THEN 'Publică' ELSE 'Privată' END AS forma_proprietate
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def registry_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Stored registry responses of up to a hundred schools with all their fields, read in pieces."""
    path, key = shared_folder(spark, "responses"), F.col("s_suppkey")
    supplier, nation = views.table(spark, sf, "supplier"), views.table(spark, sf, "nation")
    school = F.struct(
        key.alias("CODE"), (key + 1).alias("ID_SCHOOL"), F.col("s_name").alias("NAME"), F.concat(F.lit("S "), key.cast("string")).alias("SHORT_NAME"),
        F.concat(F.lit("Loc "), F.col("s_nationkey").cast("string")).alias("LOCALITY"),
        F.when(key % 2 == 0, F.concat(F.lit("Mun. "), F.col("s_nationkey").cast("string"))).alias("PARENT_LOCALITY"),
        F.col("n_name").alias("COUNTY"), F.when(key % 3 == 0, "Cu PJ").otherwise("Arondată").alias("STATUT"),
        F.lit("Unitate de învățământ").alias("SCHOOL_TYPE"), F.when(F.col("s_acctbal") > 0, "Publică").otherwise("Privată").alias("PROPERTY_FORM"),
        F.struct(F.lit("}{").alias("not a field")).alias("more"),
    )
    pages_of = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).groupBy("n_name", F.floor(key / 100).alias("page"))
    data = F.struct(F.struct(F.count("*").alias("size")).alias("paging"), F.collect_list(school).alias("content"))
    pages_of.agg(F.to_json(F.struct(F.lit(True).alias("ok"), data.alias("data")))).drop("n_name", "page").write.text(path)
    return readers.read_registry(spark, path)


_CODE = "CASE WHEN p_partkey % 10 <> 0 THEN '016' || (p_partkey % 4) || (p_partkey % 3 + 1) || substr('0000' || p_partkey, -4) || '0' END"


@query("stored_registry", ov.sql(f"""
cells AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 7 = 0 THEN p_brand ELSE {_CODE} END AS code FROM part)""", select=f"""
SELECT cast(p_partkey AS string) AS nr, p_name AS denumire_unitate, {ov.fixed_code('code')} AS cod_siiir, '2024-01-' || lpad((p_partkey % 28 + 1)::varchar, 2, '0') AS data
FROM cells WHERE code IS NULL OR length(code) = 10"""))
def stored_registry(spark: SparkSession, sf: str) -> DataFrame:
    """A registry whose codes are good, can be mended or are none, loaded and stored in place of an older one."""
    key = F.col("p_partkey")
    code = F.concat(
        F.lit("016"), (key % 4).cast("string"), (key % 3 + 1).cast("string"), F.expr("right(concat('0000', p_partkey), 4)"), F.lit("0"),
    )
    day = F.concat(views.padded(key % 28 + 1, 2), F.lit("/01/2024"))
    body = views.table(spark, sf, "part").select(
        key.alias("row"), key.cast("string").alias("c0"), F.col("p_name").alias("c1"),
        F.when(key % 7 == 0, F.col("p_brand")).when(key % 10 != 0, code).alias("c2"), day.alias("c3"),
    )
    top = spark.createDataFrame([(-2, "Titlu", None, None, None), (-1, "Nr.", "Denumire Unitate", "Cod SIIIR", "Data")], "row bigint, c0 string, c1 string, c2 string, c3 string")
    path = shared_folder(spark, "registry")
    tables.replace_table(views.table(spark, sf, "part").select(F.col("p_name").alias("older")), path)
    good, _ = split_valid_rejects(loads.registry_rows(top.unionByName(body), "row"))
    tables.replace_table(good, path)
    return tables.current_table(spark, path).select("nr", "denumire_unitate", "cod_siiir", "data")

"""Queries over versions of year tables and over loads of all years, from several sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import expression_queries as ex
from catalog import oracle_views as ov
from catalog import views
from catalog.registry import as_double, query
from catalog.table_queries import _BASE, _BATCH_ORDER, stored_rows, update_batch
from gradeloom.operators.dedupe import keep_first
from gradeloom.plans import loads, years
from gradeloom.session import cut_lineage, shared_folder
from gradeloom.sources import readers
from gradeloom.sources.years import YearTable

# -- versions ---------------------------------------------------------------------

_YEAR_BATCH = """
batch AS (SELECT an, cod, status, price FROM (
  SELECT cast(year(l_shipdate) AS int) AS an, l_orderkey + 100 AS cod, CASE WHEN l_quantity > 25 THEN l_linestatus END AS status,
    l_extendedprice AS price, row_number() OVER (PARTITION BY year(l_shipdate), l_orderkey
      ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS rn
  FROM lineitem) WHERE rn = 1),
second AS (SELECT an, cod, CASE WHEN an = 1997 THEN 'new' ELSE status END AS status, price FROM base WHERE NOT (an = 1997 AND status = 'P')),
third AS (SELECT s.an, s.cod, CASE WHEN b.cod IS NULL THEN s.status ELSE b.status END AS status, coalesce(b.price, s.price) AS price
  FROM second s LEFT JOIN batch b ON b.an = s.an AND b.cod = s.cod)
"""


def _years(df: DataFrame) -> list[int]:
    return [r[0] for r in df.select("an").distinct().collect()]


def _shipped(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as updates of orders of the year they were shipped in; some orders are unknown, or of another year."""
    return update_batch(spark, sf).drop("note").withColumn("an", F.year("l_shipdate"))


def changed_table(spark: SparkSession, sf: str) -> YearTable:
    """All years stored, one of them replaced by rows made from itself, then rows of all years updated by key."""
    table, rows = YearTable(spark, shared_folder(spark, "versions")), stored_rows(spark, sf).drop("note")
    table.replace(rows, _years(rows))
    fresh = table.read(years=[1997]).filter("status <> 'P'")
    table.replace(fresh.withColumn("status", F.lit("new")), [1997])
    years.update_stored(table, _shipped(spark, sf), ["an", "cod"], order=_BATCH_ORDER)
    return table


@query("versioned_year", ov.sql(_BASE, _YEAR_BATCH, select="""
SELECT 1 AS version, an, cod, status, price FROM base UNION ALL SELECT 2, * FROM second UNION ALL SELECT 3, * FROM third"""))
def versioned_year(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of every version, the old ones too."""
    table, found = changed_table(spark, sf), None
    for version in (1, 2, 3):
        rows = table.read(version).select(F.lit(version).alias("version"), "an", "cod", "status", "price")
        found = rows if found is None else found.unionByName(rows)
    return found


@query("version_runs", ov.sql(_BASE, _YEAR_BATCH, select="""
SELECT 1 AS version, an, unnest(['replaced', 'inserted']) AS measure, unnest([0, count(*)]) AS n FROM base GROUP BY an
UNION ALL SELECT 2, 1997, unnest(['replaced', 'inserted']), unnest([count(*), count(*) FILTER (status <> 'P')]) FROM base WHERE an = 1997
UNION ALL SELECT 3, an, unnest(['updated', 'unknown']), unnest([count(s.cod), count(*) - count(s.cod)])
  FROM batch LEFT JOIN second s USING (an, cod) GROUP BY an"""))
def version_runs(spark: SparkSession, sf: str) -> DataFrame:
    """What each write counted, by year."""
    return changed_table(spark, sf).runs().select(F.col("version").cast("int").alias("version"), "an", "measure", "n")


@query("upserted_years", ov.sql(_BASE, _YEAR_BATCH, select="""
SELECT an, cod, base.status, CASE WHEN batch.cod IS NULL THEN base.price ELSE batch.price END AS price FROM base LEFT JOIN batch USING (an, cod)
UNION ALL SELECT an, cod, status, price FROM batch ANTI JOIN base USING (an, cod)"""))
def upserted_years(spark: SparkSession, sf: str) -> DataFrame:
    """Stored rows whose price changes by key, and rows of unknown keys added."""
    table, rows = YearTable(spark, shared_folder(spark, "versions")), stored_rows(spark, sf).drop("note")
    table.replace(rows, _years(rows))
    batch = keep_first(_shipped(spark, sf), ["an", "cod"], _BATCH_ORDER).select("an", "cod", "status", "price")
    years.upsert_stored(table, batch, ["an", "cod"], ["price"])
    return table.read().select("an", "cod", "status", "price")


@query("corrected_years", ov.sql(ov.RESULTS, "listed AS (SELECT DISTINCT l_orderkey AS ord FROM lineitem WHERE l_quantity = 50)", select="""
SELECT an, cod_candidat, CASE WHEN l.ord IS NULL THEN unitate_siiir END AS unitate_siiir,
  CASE WHEN l.ord IS NULL THEN unitate_nume END AS unitate_nume, CASE WHEN l.ord IS NULL THEN unitate_cod_judet END AS unitate_cod_judet
FROM results r LEFT JOIN listed l USING (ord)"""))
def corrected_years(spark: SparkSession, sf: str) -> DataFrame:
    """Corrections of stored years, in the files that hold the listed candidates."""
    facts = views.candidates(spark, sf).select("an", "ord", "cod_candidat", "unitate_siiir", "unitate_nume", "unitate_cod_judet")
    table = YearTable(spark, shared_folder(spark, "versions"))
    table.replace(facts, _years(facts))
    listed = views.table(spark, sf, "lineitem").filter("l_quantity = 50").select(F.col("l_orderkey").alias("ord"))
    years.correct_stored(table, facts.join(listed, "ord").select("an", "cod_candidat"))
    return table.read().select("an", "cod_candidat", "unitate_siiir", "unitate_nume", "unitate_cod_judet")


# -- layers -----------------------------------------------------------------------

_LATE = "late AS (SELECT DISTINCT l_orderkey AS ord FROM lineitem WHERE l_quantity = 50)"

BAC_SITE = {
    f: f for f in [
        "cod_candidat", "specializare", "promotie_anterioara", "unitate_nume", "unitate_cod_judet", "lr_init", "lr_cont", "limba_materna",
        "lm_init", "lm_cont", "disciplina_obligatorie", "do_init", "do_cont", "disciplina_alegere", "da_init", "da_cont", "limba_moderna",
        "medie", "rezultat",
    ]
}


def bac_layers(spark: SparkSession, sf: str) -> YearTable:
    """Open data of all years, with codes; over it the results site for every second candidate, with names,
    and then the corrections. Bad rows are set aside."""
    records = ex.bac_records(spark, sf)
    site = records.filter(F.col("ord") % 2 == 0).withColumns({
        "promotie_anterioara": F.when(F.col("ord") % 4 == 0, "Da").otherwise("Nu"), "medie": F.lit(""), "rezultat": F.lit("Promovat"),
    })
    listed = views.table(spark, sf, "lineitem").filter("l_quantity = 50").select(F.col("l_orderkey").alias("ord"))
    late = records.join(listed, "ord").select(F.col("year").alias("an"), F.regexp_extract("cod_candidat", "([0-9]+)", 1).alias("cod_candidat"))
    table = YearTable(spark, shared_folder(spark, "bac"))
    layers = [loads.Layer(records, ex.BAC_MAPPING), loads.Layer(site, BAC_SITE, update=True)]
    years.load_bac_years(table, layers, "year", corrections=late, strict=False)
    return table


@query("bac_layered_years", ov.sql(ov.RESULTS, ov.MARKS, ex._REJECT_RAW, _LATE, select=f"""
SELECT an, regexp_extract(cod_candidat, '([0-9]+)', 1) AS cod_candidat, {ov.SEX} AS sex,
  CASE WHEN ord % 2 = 0 THEN ord % 4 = 0 ELSE {ov.EARLIER} END AS promotie_anterioara,
  CASE WHEN late.ord IS NULL THEN {ov.fixed_code('unitate_siiir')} END AS unitate_siiir,
  CASE WHEN late.ord IS NULL AND ord % 2 = 0 THEN {ov.repair('unitate_nume')} END AS unitate_nume,
  CASE WHEN late.ord IS NULL AND ord % 2 = 0 THEN unitate_cod_judet END AS unitate_cod_judet, lang AS limba_materna, lr AS lr_final,
  lm_f AS lm_final, dob AS do_final, da AS da_final, CASE WHEN ord % 50 = 7 THEN 5.55 ELSE medie END AS medie,
  CASE WHEN ord % 2 = 0 THEN 'promovat' ELSE {ov.RESULT_LABEL} END AS rezultat
FROM means JOIN checked USING (ord) LEFT JOIN late USING (ord) WHERE len(why) = 0"""))
def bac_layered_years(spark: SparkSession, sf: str) -> DataFrame:
    return bac_layers(spark, sf).read().select(
        "an", "cod_candidat", "sex", "promotie_anterioara", "unitate_siiir", "unitate_nume", "unitate_cod_judet", "limba_materna",
        *as_double("lr_final", "lm_final", "do_final", "da_final", "medie"), "rezultat",
    )


@query("load_runs", ov.sql(ov.RESULTS, ov.MARKS, ex._REJECT_RAW, select="""
SELECT an, unnest(['replaced', 'inserted', 'updated', 'unknown']) AS measure, unnest([0, count(*) FILTER (len(why) = 0),
  count(*) FILTER (len(why) = 0 AND ord % 2 = 0), count(*) FILTER (len(why) > 0 AND ord % 2 = 0)]) AS n
FROM means JOIN checked USING (ord) GROUP BY an"""))
def load_runs(spark: SparkSession, sf: str) -> DataFrame:
    """What the load of all layers counted while it wrote, by year."""
    return bac_layers(spark, sf).runs().select("an", "measure", "n")


@query("accepted_years", ov.sql(ov.RESULTS, ov.MARKS, ex._REJECT_RAW, select="""
, kept AS (SELECT an, ord, why FROM means JOIN checked USING (ord) WHERE len(why) = 0 OR an % 2 = 0 AND ord % 3 = 0)
SELECT an, count(*) AS "rows", max(ord)::int AS "last" FROM kept GROUP BY an HAVING count(*) = count(*) FILTER (len(why) = 0)"""))
def accepted_years(spark: SparkSession, sf: str) -> DataFrame:
    """A strict load of all years, in which bad rows of even years were left: these years stay out whole."""
    checked = ex.bac_input_rows(spark, sf).select("ord", (F.size("reject_reasons") == 0).alias("fine"))
    records = ex.bac_records(spark, sf).join(checked, "ord").filter((F.col("year") % 2 == 0) & (F.col("ord") % 3 == 0) | F.col("fine"))
    table = YearTable(spark, shared_folder(spark, "bac"))
    years.load_bac_years(table, [loads.Layer(records, ex.BAC_MAPPING)], "year")
    return table.read().groupBy("an").agg(F.count("*").alias("rows"), F.max(F.col("cod_candidat").cast("int")).alias("last"))


_EN_MARKS = {"lr_init": "lr_init", "lr_cont": "lr_cont", "limba_materna": "limba_materna", "lm_init": "lm_init", "ma_init": "do_init", "ma_cont": "do_cont"}
EN_CODES = {"cod_candidat": "cod_candidat", "unitate_siiir": "unitate_siiir"} | _EN_MARKS
EN_NAMES = {"cod_candidat": "cod_candidat", "unitate_nume": "unitate_nume", "unitate_cod_judet": "cod_candidat"} | _EN_MARKS
EN_PLACED = {
    "cod_candidat": "cod_candidat", "unitate_nume": "unitate_nume", "unitate_cod_judet": "cod_candidat", "medie_abs": "do_cont", "medie_adm": "lr_cont",
    "repartizat_liceu_nume": "repartizat_liceu_nume", "repartizat_specializare": "repartizat_specializare", "repartizat_cod_judet": "unitate_cod_judet",
}


def high_schools(spark: SparkSession, sf: str) -> DataFrame:
    """A high school for each segment and county; those of every fifth nation have no code."""
    letter = F.expr(f"substring('{views.LETTERS}', c_nationkey + 1, 1)")
    code = F.concat(F.lit("01"), F.ascii("c_mktsegment").cast("string"), views.padded(F.col("c_nationkey"), 4), F.lit("10"))
    schools = views.table(spark, sf, "customer").select("c_mktsegment", "c_nationkey").distinct()
    return schools.select(
        F.concat(F.lit("Liceul "), "c_mktsegment").alias("nume"), F.concat(F.lit("J"), letter).alias("cod_judet"),
        F.when(F.col("c_nationkey") % 5 != 0, code).alias("cod_siiir"),
    )


def _en_years(spark: SparkSession, sf: str, placement_last: bool) -> DataFrame:
    """8th-grade years from open data, the results site and the placement site, in one of two orders."""
    raw = cut_lineage(views.results(spark, sf).withColumnRenamed("an", "year"))  # three layers read it
    first = loads.Layer(raw, EN_CODES)
    site = loads.Layer(raw.filter(F.col("ord") % 3 != 0), EN_NAMES, update=True)
    placed = loads.Layer(raw.filter(F.col("ord") % 5 != 0), EN_PLACED, update=True, detect_placement=True)
    table = YearTable(spark, shared_folder(spark, "en"))
    layers = [first, site, placed] if placement_last else [first, placed, site]
    years.load_en_years(table, layers, "year", loads.Schools(high_schools(spark, sf)), strict=False)
    return table.read().select(
        "an", "cod_candidat", "unitate_siiir", "unitate_nume", "unitate_cod_judet", "limba_materna",
        *as_double("lr_final", "lm_final", "ma_final", "medie_en", "medie_abs", "medie_adm"), "repartizat_liceu_nume", "repartizat_liceu_siiir",
    )


def _en_sql(admission: str) -> str:
    nation = f"(instr('{views.LETTERS}', substr(unitate_cod_judet, 2, 1)) - 1)"
    return ov.sql(ov.RESULTS, ov.MARKS, "customers AS (SELECT o_orderkey AS ord, c_mktsegment AS segment FROM orders JOIN customer ON o_custkey = c_custkey)", select=f"""
SELECT an, regexp_extract(cod_candidat, '([0-9]+)', 1) AS cod_candidat, {ov.fixed_code('unitate_siiir')} AS unitate_siiir,
  CASE WHEN ord % 15 <> 0 THEN unitate_nume END AS unitate_nume, CASE WHEN ord % 15 <> 0 THEN unitate_cod_judet END AS unitate_cod_judet,
  nullif(lang, '-') AS limba_materna, lr AS lr_final, lm_f AS lm_final, dob AS ma_final, medie_en,
  CASE WHEN ord % 5 <> 0 THEN do_c END AS medie_abs, {admission} AS medie_adm,
  CASE WHEN ord % 5 <> 0 AND placed THEN 'Liceul ' || segment END AS repartizat_liceu_nume,
  CASE WHEN ord % 5 <> 0 AND placed AND {nation} % 5 <> 0 THEN '01' || ascii(segment) || lpad({nation}::varchar, 4, '0') || '10' END AS repartizat_liceu_siiir
FROM (SELECT *, repartizat_liceu_nume <> '' AND repartizat_specializare <> '' AS placed FROM means)
JOIN customers USING (ord) WHERE unitate_siiir IS NULL OR length(unitate_siiir) = 10""")


@query("en_layered_years", _en_sql("CASE WHEN ord % 5 <> 0 THEN lr_c ELSE medie_en END"))
def en_layered_years(spark: SparkSession, sf: str) -> DataFrame:
    """Placement last: its admission averages stay, also where they are empty."""
    return _en_years(spark, sf, True)


@query("en_layers_out_of_order", _en_sql("CASE WHEN ord % 3 <> 0 THEN medie_en WHEN ord % 5 <> 0 THEN lr_c ELSE medie_en END"))
def en_layers_out_of_order(spark: SparkSession, sf: str) -> DataFrame:
    """Placement before the results site, whose exam averages overwrite the admission averages."""
    return _en_years(spark, sf, False)


@query("read_columns", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000")
def read_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Two columns of some stored rows; the scan reads no others."""
    wanted = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 1000)
    return readers.read_table(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_custkey"], wanted)

"""Queries over column expressions and row measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import oracle_views as ov
from catalog import views
from catalog.registry import as_double, query
from gradeloom.functions import codes, grades, labels, names, placement
from gradeloom.functions import registry as cells
from gradeloom.operators.rejects import REASONS, count_reasons
from gradeloom.plans import rows


@query("grade_parse", ov.sql(ov.RESULTS, ov.MARKS, select="""
SELECT ord, lr_i AS lr_init, lr_c AS lr_cont, lm_f AS lm_init, do_i AS do_init, do_c AS do_cont,
  da_i AS da_init, da_c AS da_cont FROM marks"""))
def grade_parse(spark: SparkSession, sf: str) -> DataFrame:
    marks = ["lr_init", "lr_cont", "lm_init", "do_init", "do_cont", "da_init", "da_cont"]
    return views.results(spark, sf).select("ord", *[grades.parse_grade(m).cast("double").alias(m) for m in marks])


@query("candidate_code", ov.sql(ov.RESULTS, select="""
SELECT ord, regexp_extract(cod_candidat, '^([A-Za-z]*)([0-9]*)', 2) AS number,
  nullif(regexp_extract(cod_candidat, '^([A-Za-z]*)([0-9]*)', 1), '') AS county FROM results"""))
def candidate_code(spark: SparkSession, sf: str) -> DataFrame:
    return views.candidates(spark, sf).select(
        "ord", codes.candidate_number("cod_candidat").alias("number"), codes.county_prefix("cod_candidat").alias("county")
    )


def _final_marks(spark: SparkSession, sf: str) -> DataFrame:
    df = views.results(spark, sf)
    for s in ("lr", "do", "da"):
        final = grades.final_grade(grades.parse_grade(f"{s}_cont"), grades.parse_grade(f"{s}_init"))
        df = df.withColumn(f"{s}_final", final)
    return df.withColumns({
        "lm_final": grades.parse_grade("lm_init"),
        "limba_bac": labels.mother_tongue("limba_materna"),
        "limba_en": labels.mother_tongue("limba_materna", ("", "-")),
    })


def _means(spark: SparkSession, sf: str) -> DataFrame:
    return _final_marks(spark, sf).withColumns({
        "medie": grades.truncated_mean(["lr_final", "do_final", "da_final"], "lm_final", "limba_bac"),
        "medie_en": grades.truncated_mean(["lr_final", "do_final"], "lm_final", "limba_en"),
    })


@query("truncated_mean", ov.sql(ov.RESULTS, ov.MARKS, select="""
SELECT ord, lr AS lr_final, dob AS do_final, da AS da_final, lm_f AS lm_final, medie, medie_en FROM means"""))
def truncated_mean(spark: SparkSession, sf: str) -> DataFrame:
    return _means(spark, sf).select(
        "ord", *as_double("lr_final", "do_final", "da_final", "lm_final", "medie", "medie_en")
    )


@query("mean_reconcile", ov.sql(ov.RESULTS, ov.MARKS, select="""
SELECT ord, published, coalesce(published, medie) AS medie,
  coalesce(published <> medie, false) AS disagrees
FROM (SELECT ord, medie, CASE WHEN ord % 10 = 0 THEN NULL WHEN ord % 50 = 7 THEN 5.55 ELSE medie END AS published FROM means)"""))
def mean_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("ord") % 10 == 0, "").when(F.col("ord") % 50 == 7, "5.55").otherwise(F.col("medie").cast("string"))
    df = _means(spark, sf).withColumn("published", grades.parse_grade(text))
    return df.select(
        "ord", *as_double("published"),
        grades.reconcile("published", "medie").cast("double").alias("medie"),
        grades.averages_disagree("published", "medie").alias("disagrees"),
    )


@query("old_mean", ov.sql(ov.RESULTS, ov.MARKS, select="""
SELECT ord, rezultat_vechi, CASE WHEN rezultat_vechi IN ('REUSIT', 'RESPINS')
  THEN (lr + dob + da + coalesce(lm_f, 0)) / CASE WHEN lm_f IS NULL THEN 3 ELSE 4 END END AS my_medie
FROM (SELECT *, CASE upper(rezultat) WHEN 'REUSIT' THEN 'REUSIT' WHEN 'RESPINS' THEN 'RESPINS'
  WHEN 'NEPREZENTAT' THEN 'ABSENT' WHEN 'ELIMINAT DIN EXAMEN' THEN 'ELIMINAT' END AS rezultat_vechi FROM finals)"""))
def old_mean(spark: SparkSession, sf: str) -> DataFrame:
    df = _final_marks(spark, sf).withColumn("rezultat_vechi", labels.old_result_label("rezultat"))
    mean = grades.old_mean("rezultat_vechi", "lr_final", "do_final", "da_final", "lm_final")
    return df.select("ord", "rezultat_vechi", mean.alias("my_medie"))


@query("result_label", ov.sql(ov.RESULTS, select=f"""
SELECT ord, {ov.RESULT_LABEL} AS rezultat, {ov.SEX} AS sex, nullif(nullif(limba_materna, ''), '-') AS limba_materna FROM results"""))
def result_label(spark: SparkSession, sf: str) -> DataFrame:
    return views.candidates(spark, sf).select(
        "ord", labels.result_label("rezultat").alias("rezultat"), labels.parse_sex("sex").alias("sex"),
        labels.mother_tongue("limba_materna", ("", "-")).alias("limba_materna"),
    )


@query("cohort_flag", ov.sql(ov.RESULTS, select=f"""
SELECT ord, {ov.EARLIER} AS promotie_anterioara, upper(CASE WHEN ord % 2 = 0 THEN 'da' ELSE 'nu' END) = 'DA' AS din_text FROM results"""))
def cohort_flag(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("ord") % 2 == 0, "da").otherwise("nu")
    return views.candidates(spark, sf).select(
        "ord", labels.earlier_cohort("promotie", "an").alias("promotie_anterioara"), labels.is_yes(text).alias("din_text")
    )


@query("canonical_name", ov.sql(ov.INSTITUTIONS, select=f"""
SELECT 'i' AS tbl, id, {ov.canonical_name('nume')} AS nume FROM institutions
UNION ALL SELECT 'd', doc_id, {ov.canonical_name('text')} FROM documents"""))
def canonical_name(spark: SparkSession, sf: str) -> DataFrame:
    return _both(spark, sf, lambda name, county: names.canonical_name(name, county).alias("nume"))


def _both(spark: SparkSession, sf: str, make) -> DataFrame:
    """A name expression over institutions and over whole document texts."""
    schools, docs = views.institutions(spark, sf), views.table(spark, sf, "documents")
    return schools.select(F.lit("i").alias("tbl"), "id", make(F.col("nume"), F.col("cod_judet"))).unionAll(
        docs.select(F.lit("d"), "doc_id", make(F.col("text"), F.upper("lang")))
    )


@query("repaired_name", ov.sql(ov.INSTITUTIONS, select=f"""
SELECT 'i' AS tbl, id, {ov.repair('nume')} AS nume FROM institutions
UNION ALL SELECT 'd', doc_id, {ov.repair('text')} FROM documents"""))
def repaired_name(spark: SparkSession, sf: str) -> DataFrame:
    return _both(spark, sf, lambda name, county: names.repair_encoding(name).alias("nume"))


@query("canonical_id", ov.sql(ov.INSTITUTIONS, select=f"""
SELECT 'i' AS tbl, id, {ov.canonical_id('nume', 'cod_judet')} AS cid, {ov.canonical_id('nume', 'cod_judet', False)} AS old_cid FROM institutions
UNION ALL SELECT 'd', doc_id, {ov.canonical_id('text', 'upper(lang)')}, {ov.canonical_id('text', 'upper(lang)', False)} FROM documents"""))
def canonical_id(spark: SparkSession, sf: str) -> DataFrame:
    schools, docs = views.institutions(spark, sf), views.table(spark, sf, "documents")

    def ids(df: DataFrame, tbl: str, key: str, name: str, county) -> DataFrame:
        return df.select(
            F.lit(tbl).alias("tbl"), F.col(key).alias("id"), names.canonical_id(name, county).alias("cid"),
            names.canonical_id(name, county, place_rules=False).alias("old_cid"),
        )

    return ids(schools, "i", "id", "nume", "cod_judet").unionAll(ids(docs, "d", "doc_id", "text", F.upper("lang")))


_LATIN, _CYRILLIC, _GREEK = "abegdiklmnoprstuz", "абегдиклмнопрстуз", "αβεγδικλμνοπρστυζ"


@query("script_ids", f"""
SELECT p_partkey AS id, replace(trim(regexp_replace(upper(translate(p_name || ' ' || p_type, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
  || ' AB', '[^A-Z0-9]+', ' ', 'g')), ' ', '_') AS cyrillic, replace(replace(trim(regexp_replace(upper(p_name) || ' AB', '[^A-Z0-9]+', ' ', 'g')), ' ', '_'), 'CH', 'CKH') AS greek
FROM part""")
def script_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Names written with Cyrillic and Greek letters where there is one for one; their ids are those of the Latin names.
    In the Greek ones the h stands for itself but after a c, where it is a chi."""
    part = views.table(spark, sf, "part")
    name = F.lower(F.concat("p_name", F.lit(" "), "p_type"))
    greek = F.replace(F.translate("p_name", _LATIN, _GREEK), F.lit("ch"), F.lit("cχ"))
    return part.select(
        F.col("p_partkey").alias("id"), names.canonical_id(F.translate(name, _LATIN, _CYRILLIC), F.lit("AB"), place_rules=False).alias("cyrillic"),
        names.canonical_id(greek, F.lit("AB"), place_rules=False).alias("greek"),
    )


@query("match_key", ov.sql(ov.INSTITUTIONS, select=f"""
SELECT 'i' AS tbl, id, {ov.match_key('nume', 'cod_judet')} AS match_key FROM institutions
UNION ALL SELECT 'd', doc_id, {ov.match_key('text', 'upper(lang)')} FROM documents"""))
def match_key(spark: SparkSession, sf: str) -> DataFrame:
    return _both(spark, sf, lambda name, county: names.match_key(name, county).alias("match_key"))


@query("fold_key", ov.sql(ov.INSTITUTIONS, select=f"""
SELECT 'i' AS tbl, id, {ov.fold_key('nume', 'cod_judet')} AS fold_key FROM institutions
UNION ALL SELECT 'd', doc_id, {ov.fold_key('text', 'upper(lang)')} FROM documents"""))
def fold_key(spark: SparkSession, sf: str) -> DataFrame:
    return _both(spark, sf, lambda name, county: names.fold_key(name, county).alias("fold_key"))


@query("name_check", ov.sql(ov.INSTITUTIONS, select=f"""
SELECT id, {ov.fold_key('propus', "'X'")} = {ov.fold_key('nume', "'X'")} AS same_name
FROM (SELECT id, nume, CASE WHEN id % 3 = 0 THEN upper(replace(nume, '„', '"')) ELSE replace(nume, 'Școala', 'Liceul') END AS propus FROM institutions)"""))
def name_check(spark: SparkSession, sf: str) -> DataFrame:
    return _with_proposal(spark, sf).select("id", names.same_name("propus", "nume").alias("same_name"))


def _with_proposal(spark: SparkSession, sf: str) -> DataFrame:
    quoted = F.upper(F.replace("nume", F.lit("„"), F.lit('"')))
    other = F.replace("nume", F.lit("Școala"), F.lit("Liceul"))
    return views.institutions(spark, sf).withColumn("propus", F.when(F.col("id") % 3 == 0, quoted).otherwise(other))


@query("display_name", ov.sql(ov.INSTITUTIONS, select=f"""
SELECT 'i' AS tbl, id, {ov.display_name('nume')} AS nume FROM institutions
UNION ALL SELECT 'd', doc_id, {ov.display_name('text')} FROM documents"""))
def display_name(spark: SparkSession, sf: str) -> DataFrame:
    return _both(spark, sf, lambda name, county: names.display_name(name).alias("nume"))


@query("display_name_proposal", ov.sql(ov.INSTITUTIONS, select=f"""
SELECT id, CASE WHEN id % 3 = 0 THEN upper(replace(nume, '„', '"')) ELSE {ov.display_name('nume')} END AS nume
FROM institutions"""))
def display_name_proposal(spark: SparkSession, sf: str) -> DataFrame:
    return _with_proposal(spark, sf).select("id", names.display_name_with_proposal("nume", "propus").alias("nume"))


@query("school_code_fix", ov.sql(ov.INSTITUTIONS, select=f"""
SELECT id, cod_siiir AS cod, {ov.fixed_code('cod_siiir')} AS cod_corect FROM (
  SELECT id, CASE WHEN id % 17 = 0 THEN substr(cod_siiir, 2) WHEN id % 13 = 0 THEN '0162' || substr(cod_siiir, 5) ELSE cod_siiir END AS cod_siiir
  FROM institutions)"""))
def school_code_fix(spark: SparkSession, sf: str) -> DataFrame:
    code = (
        F.when(F.col("id") % 17 == 0, F.expr("substr(cod_siiir, 2)"))
        .when(F.col("id") % 13 == 0, F.concat(F.lit("0162"), F.expr("substr(cod_siiir, 5)")))
        .otherwise(F.col("cod_siiir"))
    )
    df = views.institutions(spark, sf).select("id", code.alias("cod"))
    return df.withColumn("cod_corect", codes.school_code("cod"))


@query("county_lookup", ov.sql(ov.COUNTIES, select=f"""
SELECT k AS id, arg_min(code, pos) AS cod_judet FROM (
  SELECT c_custkey AS k, {ov.county_text('c_custkey')} || ' ' || c_mktsegment AS txt FROM customer)
LEFT JOIN counties ON contains(upper({ov.plain('txt')}), plain) GROUP BY k"""))
def county_lookup(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    text = F.concat(views.county_text(key), F.lit(" "), "c_mktsegment")
    return views.table(spark, sf, "customer").select(key.alias("id"), names.county_from_text(text).alias("cod_judet"))


@query("placement_text", ov.sql(ov.RESULTS, select="""
SELECT ord, CASE WHEN placed THEN split_part(untagged_school, '<br/>', 1) END AS liceu,
  CASE WHEN placed AND lower(repartizat_specializare) <> 'nerepartizat' THEN
    trim(replace(split_part(untagged, '<br/>', 1), regexp_extract(untagged, '(\\([0-9]+\\))', 1), ''))
    || CASE WHEN contains(split_part(untagged, '<br/>', 2), '/') THEN ', ' || trim(split_part(split_part(untagged, '<br/>', 2), '/', -1)) ELSE '' END
  END AS specializare
FROM (SELECT ord, repartizat_specializare,
  replace(replace(repartizat_liceu_nume, '<b>', ''), '</b>', '') AS untagged_school,
  replace(replace(repartizat_specializare, '<b>', ''), '</b>', '') AS untagged,
  repartizat_liceu_nume <> '' AND repartizat_specializare <> '' AS placed FROM results)"""))
def placement_text(spark: SparkSession, sf: str) -> DataFrame:
    school, track = "repartizat_liceu_nume", "repartizat_specializare"
    placed = ~placement.is_unplaced(school, track)
    return views.candidates(spark, sf).select(
        "ord", F.when(placed, placement.placement_school(school)).alias("liceu"),
        F.when(placed, placement.placement_track(track)).alias("specializare"),
    )


@query("old_placement_text", ov.sql(ov.RESULTS, select="""
SELECT ord, regexp_replace(replace(replace(split_part(s, '<br/>', 1), '<b>', ''), '</b>', ''), '^[() 0-9]+', '')
    || CASE WHEN contains(split_part(s, '<br/>', 2), '/') THEN ' (' || split_part(split_part(s, '<br/>', 2), '/', -1) || ')' ELSE '' END AS track,
  trim(split_part(s, '<br/>', 1)) || ' (' || split_part(split_part(s, '<br/>', 2), '(', -1) AS track_b
FROM (SELECT ord, repartizat_specializare AS s FROM results)"""))
def old_placement_text(spark: SparkSession, sf: str) -> DataFrame:
    return views.candidates(spark, sf).select(
        "ord", placement.old_track("repartizat_specializare").alias("track"),
        placement.old_track_from_bracket("repartizat_specializare").alias("track_b"),
    )


@query("registry_cells", """
SELECT o_orderkey AS id, CASE WHEN regexp_matches(c, '^[0-9]{2}/[0-9]{2}/[0-9]{4}')
  THEN regexp_replace(c, '([0-9]{2})/([0-9]{2})/([0-9]{4})', '\\3-\\2-\\1', 'g') ELSE nullif(c, '') END AS cell
FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN o_orderpriority
  WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y') || ' - ' || strftime(o_orderdate, '%d/%m/%Y')
  ELSE 'din ' || strftime(o_orderdate, '%d/%m/%Y') END AS c FROM orders)""")
def registry_cells(spark: SparkSession, sf: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "dd/MM/yyyy")
    cell = (
        F.when(key % 4 == 0, "").when(key % 4 == 1, F.col("o_orderpriority"))
        .when(key % 4 == 2, F.concat(day, F.lit(" - "), day)).otherwise(F.concat(F.lit("din "), day))
    )
    return views.table(spark, sf, "orders").select(key.alias("id"), cells.registry_cell(cell).alias("cell"))


@query("county_of_id", ov.sql(ov.INSTITUTIONS, select=f"""
SELECT id, split_part({ov.canonical_id('nume', 'cod_judet')}, '_', -1) AS cod_judet FROM institutions"""))
def county_of_id(spark: SparkSession, sf: str) -> DataFrame:
    school_id = names.canonical_id("nume", "cod_judet")
    return views.institutions(spark, sf).select("id", names.county_of_id(school_id).alias("cod_judet"))


_REJECT_RAW = """
checked AS (SELECT ord,
  CASE WHEN sex = 'x' THEN ['sex'] ELSE [] END
  || CASE WHEN unitate_siiir IS NOT NULL AND length(unitate_siiir) <> 10 THEN ['school_code'] ELSE [] END
  || CASE WHEN published <> medie THEN ['average'] ELSE [] END
  || CASE WHEN rezultat = 'Amânat' THEN ['label'] ELSE [] END AS why
FROM (SELECT *, CASE WHEN ord % 50 = 7 THEN 5.55 END AS published FROM means))
"""


@query("reject_split", ov.sql(ov.RESULTS, ov.MARKS, _REJECT_RAW, select="""
SELECT reason, count(*) AS "rows" FROM (SELECT unnest(CASE WHEN len(why) = 0 THEN ['none'] ELSE why END) AS reason FROM checked)
GROUP BY reason"""))
def reject_split(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per reject reason, and the rows without one."""
    checked = bac_input_rows(spark, sf)
    fine = F.when(F.size(REASONS) == 0, F.array(F.lit("none"))).otherwise(F.col(REASONS))
    return count_reasons(checked.select(fine.alias(REASONS)))


BAC_MAPPING = {
    f: f for f in [
        "cod_candidat", "sex", "specializare", "promotie", "unitate_siiir", "lr_init", "lr_cont", "limba_materna",
        "lm_init", "lm_cont", "disciplina_obligatorie", "do_init", "do_cont", "disciplina_alegere", "da_init",
        "da_cont", "limba_moderna", "medie", "rezultat",
    ]
}


def bac_records(spark: SparkSession, sf: str) -> DataFrame:
    return views.results(spark, sf).withColumns({
        "specializare": F.col("repartizat_specializare"),
        "medie": F.when(F.col("ord") % 50 == 7, "5.55").otherwise(""),
        "lm_cont": F.lit(""),
        "disciplina_obligatorie": F.lit("Matematică"),
        "disciplina_alegere": F.lit(""),
        "limba_moderna": F.col("limba_materna"),
    }).withColumnRenamed("an", "year")


def bac_input_rows(spark: SparkSession, sf: str) -> DataFrame:
    return rows.bac_rows(bac_records(spark, sf), BAC_MAPPING, F.col("year"), keep=["year", "ord"])


@query("bac_rows", ov.sql(ov.RESULTS, ov.MARKS, _REJECT_RAW, select=f"""
SELECT ord, an, regexp_extract(cod_candidat, '([0-9]+)', 1) AS cod_candidat, {ov.SEX} AS sex,
  {ov.EARLIER} AS promotie_anterioara, {ov.fixed_code('unitate_siiir')} AS unitate_siiir, lang AS limba_materna,
  lr AS lr_final, lm_f AS lm_final, dob AS do_final, da AS da_final, disciplina_obligatorie, disciplina_alegere,
  CASE WHEN ord % 50 = 7 THEN 5.55 ELSE medie END AS medie, {ov.RESULT_LABEL} AS rezultat, array_to_string(why, ',') AS why
FROM means JOIN checked USING (ord), (SELECT 'Matematică' AS disciplina_obligatorie, cast(NULL AS varchar) AS disciplina_alegere)"""))
def bac_rows(spark: SparkSession, sf: str) -> DataFrame:
    return bac_input_rows(spark, sf).select(
        "ord", "an", "cod_candidat", "sex", "promotie_anterioara", "unitate_siiir", "limba_materna",
        *as_double("lr_final", "lm_final", "do_final", "da_final"), "disciplina_obligatorie", "disciplina_alegere",
        *as_double("medie"), "rezultat", F.array_join(REASONS, ",").alias("why"),
    )


EN_MAPPING = {
    "cod_candidat": "cod_candidat", "unitate_nume": "unitate_nume", "unitate_cod_judet": "cod_candidat",
    "unitate_siiir": "unitate_siiir", "lr_init": "lr_init", "lr_cont": "lr_cont", "limba_materna": "limba_materna",
    "lm_init": "lm_init", "ma_init": "do_init", "ma_cont": "do_cont",
    "repartizat_liceu_nume": "repartizat_liceu_nume", "repartizat_specializare": "repartizat_specializare",
    "repartizat_cod_judet": "unitate_cod_judet",
}


@query("en_rows", ov.sql(ov.RESULTS, ov.MARKS, select=f"""
SELECT ord, an, regexp_extract(cod_candidat, '([0-9]+)', 1) AS cod_candidat, {ov.fixed_code('unitate_siiir')} AS unitate_siiir,
  unitate_nume, unitate_cod_judet, nullif(lang, '-') AS limba_materna, lr AS lr_final, lm_f AS lm_final, dob AS ma_final,
  medie_en, medie_en AS medie_adm,
  CASE WHEN placed THEN replace(split_part(replace(repartizat_liceu_nume, '<b>', ''), '<br/>', 1), '</b>', '') END AS repartizat_liceu_nume,
  CASE WHEN placed THEN unitate_cod_judet END AS repartizat_cod_judet,
  CASE WHEN unitate_siiir IS NOT NULL AND length(unitate_siiir) <> 10 THEN 'school_code' ELSE '' END AS why
FROM (SELECT *, repartizat_liceu_nume <> '' AND repartizat_specializare <> '' AS placed FROM means)"""))
def en_rows(spark: SparkSession, sf: str) -> DataFrame:
    raw = views.results(spark, sf).withColumnRenamed("an", "year")
    df = rows.en_rows(raw, EN_MAPPING, F.col("year"), keep=["year", "ord"])
    return df.select(
        "ord", "an", "cod_candidat", "unitate_siiir", "unitate_nume", "unitate_cod_judet", "limba_materna",
        *as_double("lr_final", "lm_final", "ma_final", "medie_en", "medie_adm"),
        "repartizat_liceu_nume", "repartizat_cod_judet", F.array_join(REASONS, ",").alias("why"),
    )

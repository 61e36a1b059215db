"""From source records to canonical rows, one lazy projection per exam.

Each row carries ``reject_reasons``; an empty array means the row can be loaded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.functions import codes, grades, labels, names, placement
from gradeloom.operators.dimension import two_registry_lookup
from gradeloom.operators.rejects import REASONS, reasons
from gradeloom.sources import contracts
from gradeloom.sources.readers import BAD_LINE

BAC_COLUMNS = [
    "an", "cod_candidat", "sex", "specializare", "promotie_anterioara",
    "unitate_siiir", "unitate_nume", "unitate_cod_judet", "clasa",
    "lr_init", "lr_cont", "lr_final",
    "limba_materna", "lm_init", "lm_cont", "lm_final",
    "disciplina_obligatorie", "do_init", "do_cont", "do_final",
    "disciplina_alegere", "da_init", "da_cont", "da_final",
    "limba_moderna", "medie", "rezultat",
]
EN_COLUMNS = [
    "an", "cod_candidat", "sex", "unitate_siiir", "unitate_nume", "unitate_cod_judet",
    "lr_init", "lr_cont", "lr_final",
    "limba_materna", "lm_init", "lm_cont", "lm_final",
    "ma_init", "ma_cont", "ma_final",
    "medie_en", "medie_abs", "medie_adm",
    "repartizat_liceu_nume", "repartizat_specializare", "repartizat_cod_judet",
    "repartizat_liceu_siiir",
]


def _text(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(""))


def _marks(df: DataFrame, subjects: list[str]) -> DataFrame:
    """First mark, mark after appeal and the one that counts, per subject."""
    df = df.withColumns({f"{s}_{k}": grades.parse_grade(f"{s}_{k}") for s in subjects for k in ("init", "cont")})
    return df.withColumns({f"{s}_final": grades.final_grade(f"{s}_cont", f"{s}_init") for s in subjects})


def _kept(raw: DataFrame, keep: list[str]) -> list[str]:
    return keep + ([BAD_LINE] if BAD_LINE in raw.columns else [])


def _bad_line(df: DataFrame) -> Column:
    return F.col(BAD_LINE).isNotNull() if BAD_LINE in df.columns else F.lit(False)


def _year(year: int | Column) -> Column:
    return F.lit(year) if isinstance(year, int) else year


def bac_rows(raw: DataFrame, mapping: dict[str, str], year: int | Column, keep: list[str] = []) -> DataFrame:
    """Leaving-exam rows; ``keep`` names source columns to carry along.

    ``year`` is a number, or a kept column when the source covers several years.
    """
    contracts.check_bac_mapping(mapping)
    fields = contracts.BAC_REQUIRED + contracts.BAC_OPTIONAL
    df = contracts.project(raw, mapping, fields, _kept(raw, keep))
    sex, code, label = F.col("sex"), F.col("unitate_siiir"), F.col("rezultat")
    if "promotie" in mapping:
        earlier = labels.earlier_cohort("promotie", year)
    else:
        earlier = F.coalesce(labels.is_yes("promotie_anterioara"), F.lit(False))
    df = df.withColumns({
        "an": _year(year),
        "_checks": F.struct(
            ((labels.parse_sex(sex).isNull()) if "sex" in mapping else F.lit(False)).alias("sex"),
            codes.bad_school_code(code).alias("code"),
            labels.result_label(label).isNull().alias("label"),
        ),
        "cod_candidat": codes.candidate_number("cod_candidat"),
        "sex": labels.parse_sex(sex),
        "promotie_anterioara": earlier,
        "unitate_siiir": codes.school_code(code),
        "unitate_nume": F.nullif(names.repair_encoding("unitate_nume"), F.lit("")),
        "unitate_cod_judet": _text("unitate_cod_judet"),
        "specializare": _text("specializare"),
        "clasa": _text("clasa"),
        "limba_materna": labels.mother_tongue("limba_materna"),
        "disciplina_obligatorie": _text("disciplina_obligatorie"),
        "disciplina_alegere": _text("disciplina_alegere"),
        "limba_moderna": _text("limba_moderna"),
        "medie": grades.parse_grade("medie"),
        "rezultat": labels.result_label(label),
    })
    df = _marks(df, ["lr", "lm", "do", "da"])
    df = df.withColumn("_mean", grades.truncated_mean(["lr_final", "do_final", "da_final"], "lm_final", "limba_materna"))
    df = df.withColumns({
        REASONS: reasons({
            "line": _bad_line(df),
            "candidate": F.coalesce(F.col("cod_candidat"), F.lit("")) == "",
            "sex": F.col("_checks.sex"),
            "school_code": F.col("_checks.code"),
            "average": grades.averages_disagree("medie", "_mean"),
            "label": F.col("_checks.label"),
        }),
        "medie": grades.reconcile("medie", "_mean"),
    })
    return df.select(*BAC_COLUMNS, *keep, REASONS)


def en_rows(raw: DataFrame, mapping: dict[str, str], year: int | Column, keep: list[str] = []) -> DataFrame:
    """8th-grade exam and placement rows."""
    contracts.check_en_mapping(mapping)
    fields = contracts.EN_REQUIRED + contracts.EN_OPTIONAL
    df = contracts.project(raw, mapping, fields, _kept(raw, keep))
    sex, code = F.col("sex"), F.col("unitate_siiir")
    # An empty cell may be read as null; a field the source does not have stays null.
    school, track = [
        F.coalesce(F.col(f), F.lit("")) if f in mapping else F.col(f)
        for f in ("repartizat_liceu_nume", "repartizat_specializare")
    ]
    placed = ~placement.is_unplaced(school, track)
    df = df.withColumns({
        "an": _year(year),
        "_checks": F.struct(
            ((labels.parse_sex(sex).isNull()) if "sex" in mapping else F.lit(False)).alias("sex"),
            codes.bad_school_code(code).alias("code"),
            (placed & placement.bad_placement_track(track)).alias("track"),
        ),
        "cod_candidat": codes.candidate_number("cod_candidat"),
        "sex": labels.parse_sex(sex),
        "unitate_siiir": codes.school_code(code),
        "unitate_nume": _text("unitate_nume"),
        "unitate_cod_judet": codes.county_prefix("unitate_cod_judet"),
        "limba_materna": labels.mother_tongue("limba_materna", ("", "-")),
        "medie_en": grades.parse_grade("medie_en"),
        "medie_abs": grades.parse_grade("medie_abs"),
        "medie_adm": grades.parse_grade("medie_adm"),
        "repartizat_liceu_nume": F.when(placed, placement.placement_school(school)),
        "repartizat_specializare": F.when(placed, placement.placement_track(track)),
        "repartizat_cod_judet": F.when(placed, _text("repartizat_cod_judet")),
        "repartizat_liceu_siiir": F.lit(None).cast("string"),
    })
    df = _marks(df, ["lr", "lm", "ma"])
    df = df.withColumn("_mean", grades.truncated_mean(["lr_final", "ma_final"], "lm_final", "limba_materna"))
    df = df.withColumns({
        REASONS: reasons({
            "line": _bad_line(df),
            "candidate": F.coalesce(F.col("cod_candidat"), F.lit("")) == "",
            "sex": F.col("_checks.sex"),
            "school_code": F.col("_checks.code"),
            "average": grades.averages_disagree("medie_en", "_mean"),
            "placement": F.col("_checks.track"),
        }),
        "medie_en": grades.reconcile("medie_en", "_mean"),
    })
    if "medie_adm" not in mapping:
        # The source has no admission column at all; a null cell of one is left null.
        df = df.withColumn("medie_adm", F.col("medie_en"))
    return df.select(*EN_COLUMNS, *keep, REASONS)


# -- older layouts ------------------------------------------------------------


def old_bac_rows(
    records: DataFrame, year: int | Column, primary: DataFrame | None = None, secondary: DataFrame | None = None
) -> DataFrame:
    """Older leaving-exam rows. With two registries the records are open data: the school
    comes from its code, the final marks from appeals, the cohort flag from its text."""
    if primary is not None:
        records = two_registry_lookup(records, primary, secondary).withColumn(
            "promotie_anterioara", F.when(labels.earlier_cohort("promotie", year), "DA").otherwise("NU")
        )
        finals = {
            f"{s}_final": F.coalesce(f"{s}_contestatie", f"{s}_initial") for s in ("lr", "lm", "do", "da")
        }
        records = records.withColumns(finals)
    label = labels.old_result_label("rezultat_final")
    df = records.withColumn("rezultat", label)
    return df.select(
        _year(year).alias("an"),
        "cod_candidat",
        F.col("judet").alias("id_judet"),
        names.canonical_id("liceu", "judet", place_rules=False).alias("id_liceu"),
        (F.col("sex") if "sex" in df.columns else F.lit(None).cast("string")).alias("sex"),
        "promotie_anterioara",
        "specializare",
        *[
            c
            for s in ("lr", "lm", "do", "da")
            for c in (
                F.col(f"{s}_initial").alias(f"{s}_init"),
                F.col(f"{s}_contestatie").alias(f"{s}_cont"),
                F.col(f"{s}_final"),
            )
        ],
        "limba_materna",
        F.col("limba_straina").alias("limba_moderna"),
        "disciplina_obligatorie",
        F.col("disciplina_la_alegere").alias("disciplina_alegere"),
        "medie",
        grades.old_mean("rezultat", "lr_final", "do_final", "da_final", "lm_final").alias("my_medie"),
        "rezultat",
        reasons({"line": _bad_line(df), "label": F.col("rezultat").isNull()}).alias(REASONS),
    )


def _school(name: Column, county: Column) -> list[Column]:
    return [
        county.alias("id_judet"),
        names.canonical_id(name, county, place_rules=False).alias("id_scoala"),
        names.canonical_name(name, county, place_rules=False).alias("nume_scoala"),
    ]


def _none(*columns: str, kind: str = "string") -> list[Column]:
    return [F.lit(None).cast(kind).alias(c) for c in columns]


def old_en_rows(records: DataFrame, year: int | Column, keep: list[str] = []) -> DataFrame:
    """Older 8th-grade rows from JSON records with a county and a school code."""
    county, first = F.col("county"), grades.published_final_grade
    medie = grades.parse_grade("mev", upper=None)
    return records.select(
        _year(year).alias("an"), F.col("name").alias("cod_candidat"),
        *_school(F.col("school"), county), F.col("schoolCode").alias("cod_siiir"),
        first("rf", "ri", test_raw=True).alias("lr_final"),
        first("mf", "mi", test_raw=True).alias("ma_final"),
        labels.mother_tongue("lmp", ("-",)).alias("limba_materna"),
        first("lmf", "lmi", test_raw=True).alias("lm_final"),
        medie.alias("medie_en"), *_none("medie_abs", kind="decimal(12,2)"), medie.alias("medie_adm"),
        *_none("repartizat_id_liceu", "repartizat_specializare"), *keep,
    )


def old_en_site_rows(records: DataFrame, year: int | Column, keep: list[str] = []) -> DataFrame:
    """The same from site rows, where the county is the prefix of the candidate code."""
    county, first = codes.county_prefix("cod_candidat"), grades.published_final_grade
    medie = grades.parse_grade("medie", upper=None)
    return records.select(
        _year(year).alias("an"), "cod_candidat",
        *_school(F.col("scoala"), county), *_none("cod_siiir"),
        first("lrf", "lri").alias("lr_final"),
        first("mf", "mi").alias("ma_final"),
        labels.mother_tongue("limba_materna", ("-",)).alias("limba_materna"),
        first("lmf", "lmi").alias("lm_final"),
        medie.alias("medie_en"), *_none("medie_abs", kind="decimal(12,2)"), medie.alias("medie_adm"),
        *_none("repartizat_id_liceu", "repartizat_specializare"), *keep,
    )


def old_placement_rows(records: DataFrame, year: int | Column, keep: list[str] = []) -> DataFrame:
    """Older placement rows from JSON records."""
    county, placed = names.county_from_text("jp"), F.col("h") != ""
    high_school = names.canonical_id(placement.placement_school("h"), F.col("ja"), place_rules=False)
    return records.select(
        _year(year).alias("an"), F.col("n").alias("cod_candidat"),
        *_school(F.col("s"), county), F.col("sc").alias("cod_siiir"),
        grades.parse_grade("nro", upper=None).alias("lr_final"),
        grades.parse_grade("nmate", upper=None).alias("ma_final"),
        labels.mother_tongue("lm", ("-",)).alias("limba_materna"),
        grades.parse_grade("nlm", upper=None).alias("lm_final"),
        grades.parse_grade("mev", upper=None).alias("medie_en"),
        grades.parse_grade("mabs", upper=None).alias("medie_abs"),
        grades.parse_grade("madm", upper=None).alias("medie_adm"),
        F.when(placed, high_school).alias("repartizat_id_liceu"),
        F.when(placed, placement.old_track("sp")).alias("repartizat_specializare"), *keep,
    )


def old_admission_rows(records: DataFrame, keep: list[str] = []) -> DataFrame:
    """Older admission rows; the county of the high school is the candidate's own."""
    county, placed = names.county_from_text("judet"), F.col("repartizat_liceu_nume") != ""
    school = F.split_part(F.col("repartizat_liceu_nume"), F.lit("<br/>"), F.lit(1))
    return records.select(
        "cod_candidat",
        grades.parse_grade("mabs", upper=None).alias("medie_abs"),
        grades.parse_grade("madm", upper=None).alias("medie_adm"),
        F.when(placed, names.canonical_id(school, county, place_rules=False)).alias("repartizat_id_liceu"),
        F.when(placed, placement.old_track_from_bracket("repartizat_specializare")).alias("repartizat_specializare"),
        *keep,
    )

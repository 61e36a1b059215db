"""Source contracts: which source column feeds which canonical field.

A mapping is a plain ``dict`` from canonical field to source column. It is checked on the
driver before any job runs; the projection itself is one ``select``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """A mapping or schema file that does not keep to its contract."""


# ---------------------------------------------------------------- fixed values

BAC_REQUIRED = [
    "cod_candidat", "specializare",
    "lr_init", "lr_cont",
    "limba_materna", "lm_init", "lm_cont",
    "disciplina_obligatorie", "do_init", "do_cont",
    "disciplina_alegere", "da_init", "da_cont",
    "limba_moderna", "medie", "rezultat",
]
BAC_OPTIONAL = [
    "promotie", "promotie_anterioara",
    "unitate_siiir", "unitate_nume", "unitate_cod_judet",
    "sex", "clasa",
]
EN_REQUIRED = ["cod_candidat"]
EN_OPTIONAL = [
    "sex",
    "lr_init", "lr_cont",
    "limba_materna", "lm_init", "lm_cont",
    "ma_init", "ma_cont",
    "medie_en", "medie_abs", "medie_adm",
    "unitate_siiir", "unitate_nume", "unitate_cod_judet",
    "repartizat_liceu_nume", "repartizat_specializare", "repartizat_cod_judet",
]

_BAC_SITE = {
    "cod_candidat": "cod_candidat",
    "specializare": "specializare",
    "promotie_anterioara": "promotie_anterioara",
    "unitate_nume": "nume_unitate",
    "unitate_cod_judet": "cod_judet",
    "lr_init": "lr_init",
    "lr_cont": "lr_cont",
    "limba_materna": "limba_materna",
    "lm_init": "lm_init",
    "lm_cont": "lm_cont",
    "disciplina_obligatorie": "disciplina_obligatorie",
    "do_init": "do_init",
    "do_cont": "do_cont",
    "disciplina_alegere": "disciplina_alegere",
    "da_init": "da_init",
    "da_cont": "da_cont",
    "limba_moderna": "limba_moderna",
    "medie": "medie",
    "rezultat": "rezultat",
}

MAPPINGS: dict[str, dict[str, str]] = {
    "bac_site": _BAC_SITE,
    "bac_static_site": _BAC_SITE,
    "bac_open_data": {
        "cod_candidat": "Cod unic candidat",
        "sex": "Sex",
        "specializare": "Specializare",
        "promotie": "Promoție",
        "unitate_siiir": "Unitate (SIIIR)",
        "clasa": "Clasa",
        "lr_init": "NOTA_EA",
        "lr_cont": "NOTA_CONTESTATIE_EA",
        "limba_materna": "Subiect eb",
        "lm_init": "NOTA_EB",
        "lm_cont": "NOTA_CONTESTATIE_EB",
        "disciplina_obligatorie": "Subiect ec",
        "do_init": "NOTA_EC",
        "do_cont": "NOTA_CONTESTATIE_EC",
        "disciplina_alegere": "Subiect ed",
        "da_init": "NOTA_ED",
        "da_cont": "NOTA_CONTESTATIE_ED",
        "limba_moderna": "Limba modernă",
        "medie": "Medie",
        "rezultat": "STATUS",
    },
    "bac_open_data_2022": {
        "cod_candidat": "Cod",
        "sex": "SEX",
        "specializare": "SPECIALIZARE",
        "promotie": "PROMOTIA",
        "unitate_siiir": "Cod SIIIR",
        "clasa": "CLASA",
        "lr_init": "NOTA_EA",
        "lr_cont": "NOTA_CONTESTATIE_EA",
        "limba_materna": "SUBIECT_MATERNA",
        "lm_init": "NOTA_EB",
        "lm_cont": "NOTA_CONTESTATIE_EB",
        "disciplina_obligatorie": "SUBIEC_EC",
        "do_init": "NOTA_EC",
        "do_cont": "NOTA_CONTESTATIE_EC",
        "disciplina_alegere": "SUBIEC_ED",
        "da_init": "NOTA_ED",
        "da_cont": "NOTA_CONTESTATIE_ED",
        "limba_moderna": "SUBIECT_MODERNA",
        "medie": "MEDIA_FINALA",
        "rezultat": "STATUS_FINAL",
    },
    "en_site": {
        "cod_candidat": "cod_candidat",
        "unitate_nume": "scoala",
        "unitate_cod_judet": "cod_candidat",
        "lr_init": "lri",
        "lr_cont": "lrc",
        "limba_materna": "limba_materna",
        "lm_init": "lmi",
        "lm_cont": "lmc",
        "ma_init": "mi",
        "ma_cont": "mc",
        "medie_en": "medie",
    },
    "en_static_site": {
        "cod_candidat": "name",
        "unitate_siiir": "schoolCode",
        "unitate_nume": "school",
        "unitate_cod_judet": "county",
        "lr_init": "ri",
        "lr_cont": "ra",
        "limba_materna": "lmp",
        "lm_init": "lmi",
        "lm_cont": "lma",
        "ma_init": "mi",
        "ma_cont": "ma",
        "medie_en": "mev",
    },
    "en_open_data": {
        "cod_candidat": "COD UNIC CANDIDAT",
        "unitate_siiir": " COD SIIIR",
        "sex": "SEX",
        "lr_init": "NOTA ROMANA",
        "lr_cont": "NOTA CONTESTATIE ROMANA",
        "lm_init": "NOTA LIMBA MATERNA",
        "lm_cont": "NOTA CONTESTATIE LB MATERNA",
        "ma_init": "NOTA MATEMATICA",
        "ma_cont": "NOTA CONTESTATIE MATEMATICA",
        "medie_en": "MEDIA",
        "medie_abs": "MEDIA V-VIII",
    },
    "admission_site": {
        "cod_candidat": "cod_candidat",
        "unitate_nume": "scoala",
        "unitate_cod_judet": "cod_candidat",
        "medie_en": "mev",
        "medie_abs": "mabs",
        "medie_adm": "madm",
        "repartizat_liceu_nume": "repartizat_liceu_nume",
        "repartizat_specializare": "repartizat_specializare",
        "repartizat_cod_judet": "repartizat_cod_judet",
    },
    "admission_static_site": {
        "cod_candidat": "n",
        "unitate_nume": "s",
        "unitate_cod_judet": "n",
        "medie_en": "mev",
        "medie_abs": "mabs",
        "medie_adm": "madm",
        "repartizat_liceu_nume": "h",
        "repartizat_specializare": "sp",
        "repartizat_cod_judet": "ja",
    },
}

# Headers of the result files written from result pages.
PAGE_HEADERS: dict[str, list[str]] = {
    "bac_site": [
        "id", "cod_candidat", "nume_unitate", "cod_judet", "promotie_anterioara",
        "forma_invatamant", "specializare", "lr_competente", "lr_init", "lr_cont", "lr_final",
        "limba_materna", "limba_moderna", "nota_limba_moderna", "disciplina_obligatorie",
        "disciplina_alegere", "competente_digitale", "medie", "rezultat", "lm_competente",
        "lm_init", "lm_cont", "lm_final", "do_init", "do_cont", "do_final",
        "da_init", "da_cont", "da_final",
    ],
    "bac_static_site": [
        "id", "cod_candidat", "ierarhie_judet", "ierarhie_national", "nume_unitate", "cod_judet",
        "promotie_anterioara", "forma_invatamant", "specializare", "lr_competente", "lr_init",
        "lr_cont", "lr_final", "limba_materna", "limba_moderna", "nota_limba_moderna",
        "disciplina_obligatorie", "disciplina_alegere", "competente_digitale", "medie", "rezultat",
        "lm_competente", "lm_init", "lm_cont", "lm_final", "do_init", "do_cont", "do_final",
        "da_init", "da_cont", "da_final",
    ],
    "en_site": [
        "crt", "cod_candidat", "pozitie_ierarhie", "scoala", "lri", "lrc", "lrf", "mi", "mc", "mf",
        "limba_materna", "lmi", "lmc", "lmf", "medie",
    ],
    "admission_site": [
        "crt", "cod_candidat", "judet", "scoala", "renuntare_lb_mat", "madm", "mev", "mabs", "lr",
        "mate", "lm", "lm_nota", "repartizat_liceu_nume", "repartizat_specializare",
        "repartizat_cod_judet",
    ],
}

# Columns, in order, of the older files that carry no header.
OLD_LAYOUTS: dict[str, list[str]] = {
    "old_bac_open_data": [
        "cod_candidat,str", "sex,str", "specializare,str", "profil,str", "filiera,str",
        "forma_invatamant,str", "mediu,str", "siiir,str", "sirues,str", "clasa,str", "lr,str",
        "limba_materna,str", "limba_straina,str", "disciplina_obligatorie,str",
        "disciplina_la_alegere,str", "promotie,str", "NOTE_RECUN_A,str", "NOTE_RECUN_B,str",
        "NOTE_RECUN_C,str", "NOTE_RECUN_D,str", "NOTE_RECUN_EA,str", "NOTE_RECUN_EB,str",
        "NOTE_RECUN_EC,str", "NOTE_RECUN_ED,str", "STATUS_A,str", "STATUS_B,str", "STATUS_C,str",
        "STATUS_D,str", "STATUS_EA,str", "STATUS_EB,str", "STATUS_EC,str", "STATUS_ED,str",
        "ITA,str", "SCRIS_ITC,str", "SCRIS_PMS,str", "ORAL_PMO,str", "ORAL_IO,str",
        "lr_initial,num", "lm_initial,num", "do_initial,num", "da_initial,num",
        "CONTESTATIE_EA,str", "lr_contestatie,num", "CONTESTATIE_EB,str", "lm_contestatie,num",
        "CONTESTATIE_EC,str", "do_contestatie,num", "CONTESTATIE_ED,str", "da_contestatie,num",
        "PUNCTAJ_DIGITALE,num", "rezultat_final,str", "medie,num",
    ],
    "old_bac_site": [
        "nr_crt,num", "cod_candidat,str", "liceu,str", "judet,str", "promotie_anterioara,str",
        "forma_invatamant,str", "specializare,str", "lr_competente,str", "lr_initial,num",
        "lr_contestatie,num", "lr_final,num", "limba_materna,str", "lm_competente,str",
        "lm_initial,num", "lm_contestatie,num", "lm_final,num", "limba_straina,str", "ls_nota,str",
        "disciplina_obligatorie,str", "do_initial,num", "do_contestatie,num", "do_final,num",
        "disciplina_la_alegere,str", "da_initial,num", "da_contestatie,num", "da_final,num",
        "competente_digitale,str", "medie,num", "rezultat_final,str",
    ],
    "old_bac_report": [
        "nr_crt,num", "cod_candidat,str", "poz_judez,num", "poz_tara,num", "liceu,str",
        "judet,str", "promotie_anterioara,str", "forma_invatamant,str", "specializare,str",
        "lr_competente,str", "lr_initial,num", "lr_contestatie,num", "lr_final,num",
        "limba_materna,str", "limba_straina,str", "ls_nota,str", "disciplina_obligatorie,str",
        "disciplina_la_alegere,str", "competente_digitale,str", "medie,num", "rezultat_final,str",
        "lm_competente,str", "lm_initial,num", "lm_contestatie,num", "lm_final,num",
        "do_initial,num", "do_contestatie,num", "do_final,num", "da_initial,num",
        "da_contestatie,num", "da_final,num",
    ],
    "old_bac_report_2": [
        "nr_crt,num", "cod_candidat,str", "poz_judez,num", "poz_tara,num", "liceu,str",
        "judet,str", "promotie_anterioara,str", "forma_invatamant,str", "specializare,str",
        "lr_competente,str", "lr_initial,num", "lr_contestatie,num", "lr_final,num",
        "limba_materna,str", "lm_competente,str", "lm_initial,num", "lm_contestatie,num",
        "lm_final,num", "limba_straina,str", "ls_nota,str", "disciplina_obligatorie,str",
        "do_initial,num", "do_contestatie,num", "do_final,num", "disciplina_la_alegere,str",
        "da_initial,num", "da_contestatie,num", "da_final,num", "competente_digitale,str",
        "medie,num", "rezultat_final,str",
    ],
    "old_registry": [
        "nr_crt,num", "cod_siiir,str", "nume_unitate,str", "denumire,str", "oras,str",
        "localitate,str", "judet,str", "stare_legala,str", "tip_unitate,str", "administrare,str",
    ],
    "old_registry_2": [
        "nr_crt,num", "judet,str", "nume_unitate,str", "cod_sirues,str", "clasificare_1,str",
        "clasificare_2,str", "clasificare_3,str", "clasificare_4,str", "clasificare_5,str",
    ],
}

# ------------------------------------------------------------- end fixed values


def _check_keys(mapping: dict[str, str], required: list[str], optional: list[str]) -> None:
    missing = [key for key in required if key not in mapping]
    unknown = [key for key in mapping if key not in required + optional]
    if missing:
        raise ContractError(f"missing fields: {', '.join(missing)}")
    if unknown:
        raise ContractError(f"unknown fields: {', '.join(unknown)}")


def check_bac_mapping(mapping: dict[str, str]) -> dict[str, str]:
    """Mapping for the leaving exam: one cohort field, and a school by code or by name."""
    _check_keys(mapping, BAC_REQUIRED, BAC_OPTIONAL)
    if ("promotie" in mapping) == ("promotie_anterioara" in mapping):
        raise ContractError("give exactly one of promotie, promotie_anterioara")
    if ("unitate_siiir" in mapping) == ("unitate_nume" in mapping):
        raise ContractError("give exactly one of unitate_siiir, unitate_nume")
    if ("unitate_nume" in mapping) != ("unitate_cod_judet" in mapping):
        raise ContractError("unitate_cod_judet goes with unitate_nume and only with it")
    return mapping


def check_en_mapping(mapping: dict[str, str]) -> dict[str, str]:
    """Mapping for the 8th-grade exam: a school code, a name with its county, or both."""
    _check_keys(mapping, EN_REQUIRED, EN_OPTIONAL)
    if "unitate_siiir" not in mapping and "unitate_nume" not in mapping:
        raise ContractError("give unitate_siiir or unitate_nume")
    if "unitate_nume" in mapping and "unitate_cod_judet" not in mapping:
        raise ContractError("unitate_nume needs unitate_cod_judet")
    return mapping


def quoted(name: str) -> Column:
    """Column by its exact name, whatever signs the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def project(raw: DataFrame, mapping: dict[str, str], fields: list[str], keep: list[str] = []) -> DataFrame:
    """Canonical string columns from source columns; unmapped fields are null.

    One source column may feed several fields. A mapped column the source lacks is an error.
    """
    absent = sorted({src for src in mapping.values() if src not in raw.columns})
    if absent:
        raise ContractError(f"source has no column: {', '.join(repr(a) for a in absent)}")
    canonical = [
        (quoted(mapping[f]).cast("string") if f in mapping else F.lit(None).cast("string")).alias(f)
        for f in fields
    ]
    return raw.select(*canonical, *[quoted(k) for k in keep])


def normalise_names(df: DataFrame) -> DataFrame:
    """Column names without dots, with underscores for blanks, in lower case."""
    names = [c.replace(".", "").replace(" ", "_").lower() for c in df.columns]
    if len(set(names)) != len(names):
        raise ContractError("column names collide after normalisation")
    return df.toDF(*names)


@dataclass(frozen=True)
class TypedColumn:
    name: str
    kind: str


def parse_layout(lines: list[str]) -> list[TypedColumn]:
    """Check a layout of ``name,kind`` lines, where kind is ``str`` or ``num``."""
    layout = []
    for number, line in enumerate(lines, start=1):
        parts = line.rstrip("\r\n").split(",")
        if len(parts) != 2:
            raise ContractError(f"line {number}: expected name and kind, found {len(parts)} values")
        if not parts[0]:
            raise ContractError(f"line {number}: empty name")
        if parts[1] not in ("str", "num"):
            raise ContractError(f"line {number}: kind {parts[1]!r} is neither 'str' nor 'num'")
        layout.append(TypedColumn(*parts))
    return layout

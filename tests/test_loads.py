from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from gradeloom.operators.rejects import RejectedRowsError, split_valid_rejects
from gradeloom.plans import loads, rows
from gradeloom.sources import contracts, readers

SITE = contracts.MAPPINGS["bac_site"]


def _bac_site(spark, *changes):
    base = dict.fromkeys(contracts.PAGE_HEADERS["bac_site"], "") | {
        "cod_candidat": "AB100", "nume_unitate": "Liceul ,,Ion” X", "cod_judet": "AB", "promotie_anterioara": "Nu", "specializare": "Real",
        "lr_init": "9.55", "lr_cont": "", "do_init": "8", "do_cont": "8.45", "da_init": "7", "medie": "8.33", "rezultat": "Reusit",
    }
    return spark.createDataFrame([base | c for c in changes], ", ".join(f"{c} string" for c in base))


def _schools(spark):
    return loads.Schools(spark.createDataFrame(
        [("Liceul Ion X", "AB", "0161100011"), ("Gimnaziul Y", "AB", "0161100022"), ("Colegiul Z", "CJ", "0161100033")],
        "nume string, cod_judet string, cod_siiir string",
    ))


def test_bac_rows(spark):
    good, bad = split_valid_rejects(rows.bac_rows(_bac_site(
        spark, {}, {"cod_candidat": "AB101", "medie": "8.34"}, {"cod_candidat": "AB", "rezultat": "altul"},
        {"cod_candidat": "AB103", "limba_materna": "Limba M", "medie": "8.33"}, {"cod_candidat": "AB104", "medie": "", "rezultat": "Respins"},
    ), SITE, 2024))
    found = {r.cod_candidat: r for r in good.collect()}
    assert good.columns == rows.BAC_COLUMNS and set(found) == {"100", "103", "104"}
    row = found["100"]
    assert (row.an, row.unitate_nume, row.promotie_anterioara, row.rezultat) == (2024, 'Liceul "Ion" X', False, "promovat")
    assert (row.lr_final, row.do_final, row.da_final, row.medie) == (D("9.55"), D("8.45"), D("7.00"), D("8.33"))
    assert (found["104"].medie, found["104"].rezultat) == (D("8.33"), "nepromovat")
    assert sorted(tuple(r.reject_reasons) for r in bad.collect()) == [("average",), ("candidate", "label")]


def test_bac_year(spark, tmp_path):
    table = str(tmp_path / "bac")
    first = loads.Layer(_bac_site(spark, {}, {"cod_candidat": "AB101", "nume_unitate": "Gimnaziul Yy", "rezultat": "Absent", "medie": ""}), SITE, detect_origin=True)
    later = loads.Layer(_bac_site(spark, {"cod_candidat": "AB101", "lr_init": "9.25", "medie": "8.23"}, {"cod_candidat": "AB999"}), SITE, update=True)
    corrections = spark.createDataFrame([(2024, "100")], "an int, cod_candidat string")
    other_year = loads.Layer(_bac_site(spark, {"cod_candidat": "AB500"}), SITE)
    loads.load_bac_year(spark, [other_year], 2023, table)
    report = loads.load_bac_year(spark, [first, later], 2024, table, _schools(spark), corrections)
    assert report[0] == {"deleted": 0, "inserted": 2}
    assert report[1] == {"updated": 1, "unknown": 1, "deleted": 2, "inserted": 2}
    stored = {(r.an, r.cod_candidat): r for r in spark.read.parquet(table).collect()}
    assert set(stored) == {(2023, "500"), (2024, "100"), (2024, "101")}
    assert stored[2024, "100"].unitate_siiir is None and stored[2024, "100"].unitate_nume is None
    assert stored[2024, "101"].medie == D("8.23") and stored[2024, "101"].unitate_siiir == "0161100022"


def test_bad_rows_stop_a_strict_load(spark, tmp_path):
    table = str(tmp_path / "bac")
    layer = loads.Layer(_bac_site(spark, {}, {"cod_candidat": "AB7", "medie": "1"}), SITE)
    with pytest.raises(RejectedRowsError, match="average: 1 rows"):
        loads.load_bac_year(spark, [layer], 2024, table)
    assert not (tmp_path / "bac").exists()
    assert loads.load_bac_year(spark, [layer], 2024, table, strict=False)[0]["inserted"] == 1


def _en_open_data(spark):
    columns = ["COD UNIC CANDIDAT", " COD SIIIR", "SEX", "NOTA ROMANA", "NOTA CONTESTATIE ROMANA", "NOTA LIMBA MATERNA",
               "NOTA CONTESTATIE LB MATERNA", "NOTA MATEMATICA", "NOTA CONTESTATIE MATEMATICA", "MEDIA", "MEDIA V-VIII"]
    data = [("100", "0162110001", "Masculin", "9", None, None, None, "8.01", None, "8.5", "9.9"),
            ("101", "0161110002", "f", "7", "7.5", "9", None, "8", None, None, "8"),
            ("100", "0161110009", "f", "1", None, None, None, "1", None, None, "1")]
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame(data, schema).withColumn("row", F.monotonically_increasing_id())


def test_layered_en_year(spark, tmp_path):
    table, maps = str(tmp_path / "en"), contracts.MAPPINGS
    static = spark.createDataFrame(
        [("AB100", "0161110001", "Gimnaziul Y", "AB12", "9", None, "-", None, None, "8.01", None, "8.5"),
         ("AB101", "0161110002", "Gimnaziul Y", "AB", "7", "7.5", "Limba M", "9", None, "8", None, "8.16"),
         ("AB999", "0161110002", "Gimnaziul Y", "AB", "7", None, "-", None, None, "8", None, None)],
        "name string, schoolCode string, school string, county string, ri string, ra string, lmp string, lmi string, lma string, mi string, ma string, mev string",
    )
    placed = spark.createDataFrame(
        [("AB100", "Gimnaziul Y", "8.5", "9.9", "8.78", "<b>Colegiul Z</b><br/>Real", "<b>(1) Mate</b><br/>A/B", "CJ"),
         ("AB101", "Gimnaziul Y", "8.16", "8", "8.13", "", "", "CJ")],
        "n string, s string, mev string, mabs string, madm string, h string, sp string, ja string",
    )
    layers = [
        loads.Layer(_en_open_data(spark), maps["en_open_data"], keep_first_by=["row"]),
        loads.Layer(static, maps["en_static_site"], update=True),
        loads.Layer(placed, maps["admission_static_site"], update=True, detect_placement=True),
    ]
    report = loads.load_en_year(spark, layers, 2023, table, _schools(spark))
    assert [r.get("unknown") for r in report] == [None, 1, 0]
    stored = {r.cod_candidat: r for r in spark.read.parquet(table).collect()}
    a, b = stored["100"], stored["101"]
    assert (a.sex, a.unitate_siiir, a.unitate_nume, a.unitate_cod_judet) == ("m", "0161110001", "Gimnaziul Y", "AB")
    assert (a.medie_en, a.medie_abs, a.medie_adm) == (D("8.50"), D("9.90"), D("8.78"))
    assert (a.repartizat_liceu_nume, a.repartizat_specializare, a.repartizat_liceu_siiir) == ("Colegiul Z", "Mate, B", "0161100033")
    assert (b.limba_materna, b.lm_final, b.lr_final, b.medie_adm) == ("Limba M", D("9.00"), D("7.50"), D("8.13"))
    assert (b.repartizat_liceu_nume, b.repartizat_cod_judet, b.repartizat_liceu_siiir) == (None, None, None)
    # Placement before the exam results: the approximation overwrites the real average.
    wrong = str(tmp_path / "wrong")
    loads.load_en_year(spark, [layers[0], layers[2], layers[1]], 2023, wrong, _schools(spark))
    assert {r.cod_candidat: r.medie_adm for r in spark.read.parquet(wrong).collect()}["100"] == D("8.50")


def test_missing_admission_column_differs_from_empty_cell(spark):
    raw = spark.createDataFrame([("AB1", "S", "8", None)], "c string, s string, m string, a string")
    mapping = {"cod_candidat": "c", "unitate_nume": "s", "unitate_cod_judet": "c", "medie_en": "m"}
    assert rows.en_rows(raw, mapping, 2024).first().medie_adm == D("8.00")
    assert rows.en_rows(raw, mapping | {"medie_adm": "a"}, 2024).first().medie_adm is None


def test_repeated_candidates_need_an_order(spark, tmp_path):
    layer = loads.Layer(_en_open_data(spark), contracts.MAPPINGS["en_open_data"])
    assert loads.en_batch(layer, 2024).count() == 3
    layer.keep_first_by = ["row"]
    kept = loads.en_batch(layer, 2024)
    assert {r.cod_candidat: r.medie_en for r in kept.collect()} == {"100": D("8.50"), "101": D("8.16")}


def test_csv_to_rows(spark, tmp_path):
    path = tmp_path / "site.csv"
    _bac_site(spark, {}, {"cod_candidat": "AB101"}).toPandas().to_csv(path, index=False)
    path.write_text(path.read_text() + "too,short\n")
    raw = readers.read_records(spark, str(path))
    good, bad = split_valid_rejects(rows.bac_rows(raw, SITE, 2024))
    assert good.count() == 2 and "line" in bad.first().reject_reasons


def test_old_loads(spark):
    base_cols = "an int, cod_candidat string, id_judet string, id_scoala string, lr_final decimal(12,2), ma_final decimal(12,2), limba_materna string, lm_final decimal(12,2), medie_en decimal(12,2), medie_abs decimal(12,2), medie_adm decimal(12,2), repartizat_id_liceu string, repartizat_specializare string"
    empty = spark.createDataFrame([], base_cols)
    records = spark.createDataFrame(
        [("AB1", "AB", "Scoala A", "c1", "10", None, "9", "bad", "-", None, None, "9.5", 1), ("AB2", "AB", "Scoala A", "c2", "5", "6", "7", None, "M", "8", None, "6", 2)],
        "name string, county string, school string, schoolCode string, ri string, rf string, mi string, mf string, lmp string, lmi string, lmf string, mev string, o int",
    )
    schools = spark.createDataFrame([("SCOALA_A_AB", "old", "c0")], "id string, nume string, cod_siiir string")
    facts, grown = loads.old_en_year(empty, rows.old_en_rows(records, 2022, ["o"]), schools, ["o"], update=False)
    found = {r.cod_candidat: r for r in facts.collect()}
    assert (found["AB1"].lr_final, found["AB1"].ma_final, found["AB1"].limba_materna) == (D("10"), None, None)
    assert (found["AB2"].lr_final, found["AB2"].medie_adm, found["AB2"].id_scoala) == (D("6"), D("6"), "SCOALA_A_AB")
    assert [tuple(r) for r in grown.collect()] == [("SCOALA_A_AB", "SCOALA A", "c1")]
    placed = spark.createDataFrame(
        [("AB2", "ALBA", "Scoala A", "c9", "1", "2", "-", "-", "7", "8", "7.5", "<b>Lic B</b><br/>x", "<b>(2) Bio</b><br/>R/M", "CJ", 1),
         ("AB3", "ALBA", "Scoala N", "c3", "1", "2", "-", "-", "7", "8", "7.5", "", "", "CJ", 2)],
        "n string, jp string, s string, sc string, nro string, nmate string, lm string, nlm string, mev string, mabs string, madm string, h string, sp string, ja string, o int",
    )
    merged, grown = loads.old_en_year(facts, rows.old_placement_rows(placed, 2022, ["o"]), grown, ["o"], update=True)
    after = {r.cod_candidat: r for r in merged.collect()}
    assert (after["AB2"].lr_final, after["AB2"].medie_adm, after["AB2"].repartizat_id_liceu, after["AB2"].repartizat_specializare) == (D("6"), D("7.5"), "LIC_B_CJ", "Bio (M)")
    assert after["AB3"].is_new and after["AB3"].lr_final == D("1") and not after["AB1"].is_new
    assert {r.id: r.cod_siiir for r in grown.collect()} == {"SCOALA_A_AB": "c9", "SCOALA_N_AB": "c3"}
    admission = spark.createDataFrame(
        [("AB1", "ALBA", "9", "8", "Lic C<br/>x", "Mate<br/>Limba (B)", 1), ("AB1", "ALBA", "1", "1", "", "", 2)],
        "cod_candidat string, judet string, madm string, mabs string, repartizat_liceu_nume string, repartizat_specializare string, o int",
    )
    updated = {r.cod_candidat: r for r in loads.old_admission_update(facts, rows.old_admission_rows(admission, ["o"]), 2022, ["o"]).collect()}
    assert (updated["AB1"].medie_adm, updated["AB1"].repartizat_id_liceu, updated["AB1"].repartizat_specializare) == (D("9"), "LIC_C_AB", "Mate (B)")
    assert updated["AB2"].medie_adm == D("6")

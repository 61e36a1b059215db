from decimal import Decimal as D

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalog import views
from gradeloom.functions import codes, distance, grades, labels, names, placement, registry, rules
from gradeloom.functions.distance import edit_distances, near_pairs


def test_grades(values):
    cells = ["9.5", " 9.5 ", "9.5d", "NaN", "Infinity", "1e1", "-", "", None, "0.99", "1", "10", "10.01", "+7", "10.004"]
    expected = ["9.5", "9.5", None, None, None, "10", None, None, None, None, "1", "10", None, "7", None]
    assert values(grades.parse_grade, cells) == [None if e is None else D(e) for e in expected]
    assert values(lambda c: grades.parse_grade(c, upper=None), ["57.5", "0.5"]) == [D("57.5"), None]


def test_truncated_mean(values):
    def mean(lr, do, da, lm, lang):
        parsed = [grades.parse_grade(c) for c in (lr, do, da, lm)]
        return grades.truncated_mean(parsed[:3], parsed[3], F.col(lang))

    rows = [
        ("9.55", "8.45", "7.00", None, None),
        ("9.55", "8.45", "7.01", "10", "X"),
        ("9.99", "9.99", "9.98", None, None),
        ("9", "9", "9", None, "X"),
        (None, "9", "9", "9", "X"),
    ]
    assert values(mean, rows) == [D("8.33"), D("8.75"), D("9.98"), None, None]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(100, 1000), min_size=2, max_size=4))
def test_truncation_equals_guarded_float_floor(hundredths):
    exact = sum(hundredths) // len(hundredths)
    as_float = sum(h / 100 for h in hundredths) / len(hundredths)
    assert round((as_float + 1e-5) // 0.01) == exact


def test_averages_disagree(values):
    found = values(lambda a, b: grades.averages_disagree(F.col(a), F.col(b)), [("9", "9"), ("9", "8"), (None, "8"), ("9", None)])
    assert found == [False, True, False, False]


def test_candidate_codes(values):
    cells = ["AB123", "123", "AB", "ab7", ""]
    assert values(codes.candidate_number, cells) == ["123", "123", "", "7", ""]
    assert values(codes.county_prefix, cells) == ["AB", None, "AB", "ab", None]


def test_school_codes(values):
    cells = [None, "016111", "01611100021", "0162110002", "0161310002", "0161300000", "01613a0000"]
    fixed = values(codes.school_code, cells)
    assert fixed[:4] == [None, None, None, "0161110002"]
    for code in fixed[4:6]:
        total = sum(int(c) * w for c, w in zip(code, rules.SCHOOL_CODE_WEIGHTS)) % 9
        assert code[3:5] == "12" and code[9] == str(total or 9)
    assert values(codes.bad_school_code, cells) == [False, True, True, False, False, False, True]


def test_check_digit_nine_stands_for_zero(values):
    assert values(codes.check_digit, ["000000000", "000000001"]) == ["9", "8"]


def test_labels(values):
    assert values(labels.parse_sex, ["Masculin", "FEMININ", "m", "x", None]) == ["m", "f", "m", None, None]
    cells = ["REUSIT", "Respins", "neprezentat", "Eliminat din examen", "promovat", "neevaluat", "altul", None]
    expected = ["promovat", "nepromovat", "absent", "eliminat", "promovat", "neevaluat", None, None]
    assert values(labels.result_label, cells) == expected
    assert values(labels.old_result_label, ["Reușit", "admis", "Absent", "x"]) == ["REUSIT", "REUSIT", "ABSENT", None]
    assert values(lambda c: labels.earlier_cohort(c, 2024), ["2023-2024", "2022-2023", None]) == [False, True, True]
    assert values(labels.is_yes, ["da", "NU", None]) == [True, False, None]
    assert values(lambda c: labels.mother_tongue(c, ("", "-")), ["", "-", "X", None]) == [None, None, "X", None]


def test_repaired_names(values):
    for wrong, right in rules.MOJIBAKE:
        if right != "'":
            assert values(names.repair_encoding, [f"x{wrong}y"]) == [f"x{right}y"]
    cells = ["a'b", "''a''", ",,a”", "„a“ ’b", "Şcoală ţ", 'a""b', "Scoalaâ€™s"]
    assert values(names.repair_encoding, cells) == ["ab", '"a"', '"a"', 'a b', "Școală ț", "ab", "Scoalas"]


def test_canonical_forms(values):
    pairs = [("Şcoala_nr.  7 „Ion”", "AB"), ("municipiul Râmnicu", "VL"), (None, "AB"), ("x", None), ("Straße æ №5", "CJ")]
    assert values(names.canonical_name, pairs) == ['ȘCOALA NR. 7 "ION"', "MUN RÂMNICU", None, None, "STRASSE Æ №5"]
    assert values(names.canonical_id, pairs) == ["SCOALA_NR_7_ION_AB", "MUN_RM_VL", None, None, "STRASSE_AE_NO5_CJ"]
    without = values(lambda a, b: names.canonical_id(a, b, place_rules=False), [("comuna Râmnicu", "VL")])
    assert without == ["COMUNA_RAMNICU_VL"]
    assert values(names.match_key, [("Nr. 12 A", "AB"), ("", "AB")]) == ["AB_NR_" + "1" * 10 + "2" * 10 + "_A", "AB_"]
    assert values(names.fold_key, [("Râmna", "AB")]) == values(names.fold_key, [("RÎMNA", "AB")])


def test_canonical_forms_are_stable(values):
    first = values(names.canonical_name, [("„Școala” comuna X_Y", "AB")])[0]
    assert values(names.canonical_name, [(first, "AB")]) == [first]


def test_display_names(values):
    cells = ['LICEUL "ION CREANGA" TIRGU MURES', "SCOALA DE ARTE SI MESERII NR. II", "COLEGIUL „A-B”", "UCECOM CLUJ-NAPOCA", "MUNICIPIUL X"]
    assert values(names.display_name, cells) == [
        "Liceul „Ion Creanga”, Târgu Mures", "Scoala de Arte și Meserii Nr. II", "Colegiul „A-B”", "UCECOM Cluj-Napoca", "Mun. X",
    ]
    assert values(names.display_name_old, ["SCOALA DE ARTE II"]) == ["Scoala de Arte Ii"]
    found = values(names.display_name_with_proposal, [("SCOALA RAMNA", 'Școala "Râmna"'), ("SCOALA RAMNA", "Liceul")])
    assert found == ["Școala „Râmna”", "Scoala Ramna"]


def test_name_checks(values):
    assert values(names.same_name, [("Școala Râmna", "SCOALA RIMNA"), ("A", "B"), (None, "B")]) == [True, False, None]
    assert values(names.same_name_as_id, [("Școala Râmna", "SCOALA_RIMNA_AB")]) == [True]


def test_counties(values):
    cells = ["JUD. MUREȘ", "Maramureș", "Municipiul București", "CARAŞ-SEVERIN", "Necunoscut", None]
    assert values(names.county_from_text, cells) == ["MS", "MM", "B", "CS", None, None]
    assert len(rules.COUNTIES) == 42
    assert values(names.county_of_id, ["SCOALA_NR_7_AB"]) == ["AB"]


def test_placement(values):
    rows = [
        ("<b>LIC A</b><br/>Real", "<b>(119) Mate (119)</b><br/>Limba A / Limba B"),
        ("L", "<b>(7) Bio</b><br/>Limba A"), ("L", "Nerepartizat"), ("L", "<b>Bio</b><br/>x"), ("L", "(7) a<br/>b<br/>c"), ("", "x"), (None, None),
    ]
    assert values(lambda s, t: placement.placement_school(s), rows)[:1] == ["LIC A"]
    assert values(lambda s, t: placement.placement_track(t), rows) == ["Mate, Limba B", "Bio", None, None, None, None, None]
    assert values(lambda s, t: placement.bad_placement_track(t), rows) == [False, False, False, True, True, True, False]
    assert values(placement.is_unplaced, rows) == [False] * 5 + [True, False]
    assert values(placement.old_track, ["<b>(119) Mate</b><br/>A/B", "(1) X<br/>A"]) == ["Mate (B)", "X"]
    assert values(placement.old_track_from_bracket, ["Mate <br/>Limba (B)"]) == ["Mate (B)"]


def test_registry_cells(values):
    cells = ["", "01/02/2024", "01/02/2024 - 03/04/2025", "din 01/02/2024", None]
    assert values(registry.registry_cell, cells) == [None, "2024-02-01", "2024-02-01 - 2025-04-03", "din 01/02/2024", None]
    assert values(registry.registry_code_cell, ["12", "0162110002", "12345"]) == ["12", "0161110002", None]
    assert values(registry.bad_registry_code, ["12", "0162110002", "12345", ""]) == [False, False, True, False]


def test_addresses(values):
    rows = [(" Str. A,", "12.", "CLUJ-NAPOCA", "400"), ("Str. A", " x ", None, None), ("Str. A", None, "X", None), (None, "1", "X", "2")]
    assert values(registry.postal_address, rows) == ["Str. A 12, Cluj-Napoca, 400", "Str. A", "Str. A, X", None]


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abcș", max_size=140), min_size=1, max_size=4), st.lists(st.text("abdș", max_size=140), min_size=1, max_size=4))
def test_edit_distances(keys, texts):
    found = edit_distances(keys, texts)
    assert found.tolist() == [[_distance(k, t) for t in texts] for k in keys]


@settings(max_examples=80, deadline=None)
@given(
    st.lists(st.text("abcș", max_size=140), min_size=1, max_size=5), st.lists(st.text("abdș", max_size=140), min_size=1, max_size=5),
    st.integers(0, 10),
)
def test_near_pairs(keys, texts, tenths):
    most = np.array([len(k) * tenths // 10 for k in keys])
    whole = edit_distances(keys, texts)
    row, column = np.nonzero(whole <= most[:, None])
    found = near_pairs(keys, texts, most)
    assert [x.tolist() for x in found] == [row.tolist(), column.tolist(), whole[row, column].tolist()]


def test_few_pairs_are_compared(monkeypatch):
    """Names of different letters are told apart before any distance is worked out."""
    words = ["GEAR", "BOLT", "WIRE", "LAMP", "DOOR", "RUST", "MILK", "SAND"]
    names = [f"SCOALA_{a}_{b}_NR_{str(n) * 10}" for n in range(6) for a in words for b in words]
    compared = []
    step = distance._pair_step
    monkeypatch.setattr(distance, "_pair_step", lambda places, last, *more: compared.append(len(last)) or step(places, last, *more))
    near_pairs(names, names, np.array([len(k) * 4 // 10 for k in names]))
    assert sum(compared) < len(names) ** 2 / 2


def test_pairs_farther_than_the_nearest_are_not_compared(monkeypatch):
    """With few names asked for, a key is done when no pair left can be as near; what is found is what all pairs give."""
    words = ["GEAR", "BOLT", "WIRE", "LAMP", "DOOR", "RUST", "MILK", "SAND"]
    texts = [f"SCOALA_{a}_{b}_NR_{str(n) * 10}" for n in range(6) for a in words for b in words]
    keys = texts[::7] + [t.replace("L", "") for t in texts[::5]] + ["SCOALA_" + t[12:16] + t for t in texts[::9]] + ["", "ZZZZ", "N_" * 40]
    most = np.array([len(k) * 4 // 10 for k in keys])
    for enough in (1, 2, 20):
        compared = []
        step = distance._pair_step
        with monkeypatch.context() as patch:
            patch.setattr(distance, "_pair_step", lambda places, last, *more: compared.append(len(last)) or step(places, last, *more))
            row, column, dist = near_pairs(keys, texts, most, enough)
        assert enough > 2 or sum(compared) < len(keys) * len(texts) / 8
        matrix = edit_distances(keys, texts)
        got = {(r, c): d for r, c, d in zip(row.tolist(), column.tolist(), dist.tolist(), strict=True)}
        assert len(got) == len(row) and all(matrix[r, c] == d <= most[r] for (r, c), d in got.items())
        for r in range(len(keys)):
            near = np.sort(matrix[r][matrix[r] <= most[r]])
            last = near[min(enough, len(near)) - 1] if len(near) else -1
            assert {(r, c) for c in np.flatnonzero(matrix[r] <= last).tolist()} <= set(got)


def test_texts_count_as_many_as_they_are_worth(monkeypatch):
    """A name that stands for many codes is enough for a key; names as near as the last one are found all the same, in any number of goes."""
    texts = [f"SCOALA_{a}{b}_{n}" for n in "123" for a in "BCDFGHJK" for b in ["ARA", "ORA", "IRIS", "UNU"]]
    keys = texts[::3] + [t + "X" for t in texts[::4]] + ["", "Z"]
    most, worth = np.array([len(k) * 4 // 10 for k in keys]), np.array([1 + 30 * (n % 2) for n in range(len(texts))])
    matrix = edit_distances(keys, texts)
    for at_once in (1, 4_194_304):
        monkeypatch.setattr(distance, "BOUNDS_AT_ONCE", at_once)
        row, column, dist = near_pairs(keys * 5, texts, np.tile(most, 5), 20, worth)
        got = {(r, c): d for r, c, d in zip(row.tolist(), column.tolist(), dist.tolist(), strict=True)}
        assert len(got) == len(row) and all(matrix[r % len(keys), c] == d <= most[r % len(keys)] for (r, c), d in got.items())
        for r in range(len(keys) * 5):
            near = sorted((d, c) for c, d in enumerate(matrix[r % len(keys)].tolist()) if d <= most[r % len(keys)])
            reach = np.cumsum([worth[c] for _, c in near])
            last = near[min(int(np.searchsorted(reach, 20)), len(near) - 1)][0] if near else -1
            assert {(r, c) for d, c in near if d <= last} <= set(got)


def test_letters_of_other_scripts(values):
    cases = {
        "Школа № 5 Щукин": "SHKOLA_NO_5_SHCHUKIN_AB", "Лицей имени Ёлкина": "LITSEI_IMENI_IOLKINA_AB", "Гимназия": "GIMNAZIIA_AB",
        "Θεσσαλονίκη Άγιος Ψ": "THESSALONIKE_AGIOS_PS_AB", "ΧΙΟΣ": "KHIOS_AB", "თბილისი": "TBILISI_AB", "שלום": "SHLVM_AB",
        "Școala Élève": "SCOALA_ELEVE_AB", "学校 7": "7_AB",
    }
    found = values(lambda c: names.canonical_id(c, F.lit("AB")), list(cases))
    for (text, wanted), got in zip(cases.items(), found, strict=True):
        assert got == wanted, (text, got)


def test_cells_are_worked_out_once(spark):
    """The text of an expression names its cell a few times, not once for each use of what is made of it."""
    made = {
        "proposal": names.display_name_with_proposal("cell_a", "cell_b"), "display": names.display_name("cell_a"),
    }
    assert all(str(column).count("cell_a") <= 3 for column in made.values()), made.keys()


def test_registry_codes_are_worked_out_once(spark):
    assert str(registry.registry_code_cell("cell_a")).count("cell_a") <= 3
    assert str(registry.bad_registry_code("cell_a")).count("cell_a") <= 3


def test_ascii_words_of_display_names_skip_the_accent_table(values):
    cells = ["SCOALA DE ARTE SI MESERII II", "Școala ŞI ȘI sau", "ﬁ dé DÉ æ ß", None, "x  de   y"]
    assert values(names.display_name, cells) == [
        "Scoala de Arte și Meserii II", "Școala și și sau", "Fi de de Æ Ss", None, "X de Y",
    ]


def test_small_files_are_dealt_to_all_cores(spark, tmp_path):
    spark.range(50).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    rows = views.table(spark, str(tmp_path), "part")
    assert rows.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert sorted(r.id for r in rows.collect()) == list(range(50))

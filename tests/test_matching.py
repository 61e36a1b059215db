import random
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from gradeloom.operators import matching


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_force(keys, targets, tiers):
    """The rounds as stated, over all pairs."""
    dist = {}
    for county, key in keys:
        for c, code, alias in targets:
            if c == county:
                d = _distance(key, alias)
                pair = (county, key, code)
                dist[pair] = min(d, dist.get(pair, d))
    matched, taken = {}, set()
    for tier in tiers:
        while True:
            asked = {}
            for county, key in keys:
                if (county, key) in matched:
                    continue
                free = [(d, code) for (c, k, code), d in dist.items() if (c, k) == (county, key) and (c, code) not in taken]
                if free and min(free)[0] * 10 <= tier * len(key):
                    d, code = min(free)
                    asked.setdefault((county, code), []).append((d, key))
            if not asked:
                break
            for (county, code), wishes in asked.items():
                matched[county, min(wishes)[1]] = (code, min(wishes)[0], tier)
                taken.add((county, code))
    return matched


def random_names(seed, n):
    rng = random.Random(seed)
    words = ["ION", "IOANA", "IONA", "MARE", "MARA", "NR_1111111111", "NR_2222222222", "A", "B"]
    return ["A_" + "_".join(rng.choices(words, k=rng.choice([1, 2, 3]))) for _ in range(n)]


@pytest.mark.parametrize("seed,limit,in_task", [(1, 1, 9999), (2, 2, 9999), (3, 32, 9999), (4, 32, 0), (5, 32, 60)])
def test_fuzzy_equals_brute_force(spark, monkeypatch, seed, limit, in_task):
    """In one task or in rounds, and with cut lists."""
    monkeypatch.setattr(matching, "SETTLED_PAIRS", in_task)
    counties = ["A", "B"]
    keys = sorted({(c, k) for c in counties for k in random_names(seed, 20)})
    aliases = random_names(seed + 100, 36)
    targets = sorted({(c, f"{i % 24:03d}", a) for i, a in enumerate(aliases) for c in counties})
    tiers = [1, 2, 3, 4]
    found = matching.fuzzy_matches(
        spark.createDataFrame(keys, "county string, key string"),
        spark.createDataFrame(targets, "county string, code string, alias string"),
        tiers, limit,
    ).collect()
    got = {(r.county, r.key): (r.code, r.dist, r.tier) for r in found}
    assert got == brute_force(keys, targets, tiers)
    assert len(found) == len(got) == len({(r.county, r.code) for r in found})


@pytest.mark.parametrize("seed,limit,in_task", [(1, 1, 9999), (2, 2, 9999), (3, 4, 9999), (4, 1, 25), (5, 2, 60), (6, 1, 0), (7, 32, 9999)])
def test_tier_by_tier_equals_brute_force(spark, monkeypatch, seed, limit, in_task):
    """Large counties are looked up for each tier; lists run dry, and a county may leave its task for rounds when they are filled again."""
    monkeypatch.setattr(matching, "PAIRS_FOR_ALL_TIERS", 300)
    monkeypatch.setattr(matching, "SETTLED_PAIRS", in_task)
    keys = sorted({("A", k) for k in random_names(seed, 30)} | {("B", k) for k in random_names(seed + 50, 5)})
    aliases = random_names(seed + 100, 40)
    targets = sorted({(c, f"{i % 28:03d}", a) for i, a in enumerate(aliases) for c in ("A", "B")} | {("A", f"{i:03d}", aliases[0]) for i in range(6, 30)})
    found = matching.fuzzy_matches(
        spark.createDataFrame(keys, "county string, key string"),
        spark.createDataFrame(targets, "county string, code string, alias string"),
        [1, 2, 3, 4], limit,
    ).collect()
    assert {(r.county, r.key): (r.code, r.dist, r.tier) for r in found} == brute_force(keys, targets, [1, 2, 3, 4])
    assert len(found) == len({(r.county, r.key) for r in found}) == len({(r.county, r.code) for r in found})


def test_pairs_of_keys_and_codes_are_not_stored(spark, monkeypatch):
    """Keys with many near codes list a few at a time, in one row: what is written grows with the keys and codes, not with their pairs."""
    keys = [("A", f"A_SCOALA_{a}{b}_MARE") for a in "BCDFG" for b in "AEIOUY"]
    targets = [("A", f"{n:04d}", f"A_SCOALA_{'BCDFG'[n % 5]}{'AEIOUY'[n // 5 % 6]}T_MARE") for n in range(900)]
    written, cut = [], matching.cut_lineage
    monkeypatch.setattr(matching, "cut_lineage", lambda df: written.append(cut(df)) or written[-1])
    found = matching.fuzzy_matches(
        spark.createDataFrame(keys, "county string, key string"), spark.createDataFrame(targets, "county string, code string, alias string")
    )
    assert found.count() == len(keys)
    assert max(df.count() for df in written) <= len(targets)
    assert max(df.select(F.sum(F.size("codes"))).first()[0] for df in written if "codes" in df.columns) <= matching.LISTED_CODES * len(keys)


def test_wide_tiers_see_only_what_is_left(spark, monkeypatch):
    monkeypatch.setattr(matching, "PAIRS_FOR_ALL_TIERS", 0)
    seen, look_up = [], matching._nearest_lists
    monkeypatch.setattr(matching, "_nearest_lists", lambda keys, free, tenths, limit: seen.append((tenths, keys.count(), free.count())) or look_up(keys, free, tenths, limit))
    keys = [("A", "A_SCOALA_MARE_UNU"), ("A", "A_SCOALA_MICA_DOI"), ("A", "A_LICEUL_XXXX_TREI")]
    targets = [("A", "1", "A_SCOALA_MARE_UNUU"), ("A", "2", "A_SCOALA_MICA_DOIS"), ("A", "3", "A_LICEUL_YYYYY_TREI")]
    found = matching.fuzzy_matches(
        spark.createDataFrame(keys, "county string, key string"), spark.createDataFrame(targets, "county string, code string, alias string")
    )
    assert sorted((r.key, r.code, r.dist, r.tier) for r in found.collect()) == [
        ("A_LICEUL_XXXX_TREI", "3", 5, 3), ("A_SCOALA_MARE_UNU", "1", 1, 1), ("A_SCOALA_MICA_DOI", "2", 1, 1)
    ]
    assert seen == [(1, 3, 3), (2, 1, 1), (3, 1, 1), (4, 0, 0)]


def test_blocks_and_tiles_do_not_change_the_result(spark, monkeypatch):
    keys = spark.createDataFrame(sorted({("A", k) for k in random_names(5, 60)}), "county string, key string")
    rows = sorted({("A", f"{i:03d}", a) for i, a in enumerate(random_names(6, 80))})
    targets = spark.createDataFrame(rows, "county string, code string, alias string")
    whole = sorted(map(tuple, matching.nearest_codes(keys, targets, 4, 5).collect()))
    monkeypatch.setattr(matching, "BLOCK_ALIASES", 7)
    monkeypatch.setattr(matching, "TILE_KEYS", 5)
    assert sorted(map(tuple, matching.nearest_codes(keys, targets, 4, 5).collect())) == whole
    assert sorted(map(tuple, matching.nearest_codes(keys.repartition(3), targets.repartition(5), 4, 5).collect())) == whole


def _institutions(spark):
    return spark.createDataFrame(
        [("Școala „Ion” Nr. 1", "AB", "1"), ("Școala „Ion” Nr. 2", "AB", "2"), ("Liceul Mare", "AB", "3"),
         ("Liceul Mare", "CJ", "4"), ("Fara cod", "AB", None), (None, "AB", "5")],
        "nume string, cod_judet string, cod_siiir string",
    )


def test_match_schools_and_attach(spark):
    facts = spark.createDataFrame(
        [(1, "SCOALA ION NR 1", "AB", None), (2, "Școala ,,Ion” Nr. 1", "AB", None), (3, "Liceul Marre", "AB", None),
         (4, "Liceul Mare", "XX", None), (5, None, "AB", None), (6, "Scoala Ion Nr 3", "AB", "own"), (7, "Liceul Mare", "CJ", "kept")],
        "id int, n string, c string, code string",
    )
    registry = spark.createDataFrame(
        [("3", "Liceul Teoretic Mare", "AB", "da"), ("9", "Altul", "AB", "da"), ("2", "Gimnaziul", "AB", None)],
        "cod_siiir_unitate string, denumire_lunga_unitate string, judet_pj string, stare_liceal string",
    )
    targets = {(r.code, r.is_primary) for r in matching.match_targets(_institutions(spark), registry).collect()}
    assert targets == {("1", True), ("2", True), ("3", True), ("4", True), ("3", False)}
    matches = matching.match_schools(facts, "n", "c", _institutions(spark), registry)
    attached = matching.attach_codes(facts, matches, "n", "c", "code").orderBy("id")
    # The digit difference of row 6 weighs ten edits of twenty-five, just within the last tier.
    assert [r.code for r in attached.collect()] == ["1", "1", "3", None, None, "own", "kept"]
    replaced = matching.attach_codes(facts, matches, "n", "c", "code", only_missing=False).orderBy("id")
    assert [r.code for r in replaced.collect()][:5] == ["1", "1", "3", None, None]
    assert replaced.collect()[6].code == "4"


def test_middle_school_mode_needs_equal_names(spark):
    facts = spark.createDataFrame([("Liceul Marre", "AB"), ("Liceul mare", "AB")], "n string, c string")
    found = matching.match_schools(facts, "n", "c", _institutions(spark), None, high_school=False).collect()
    assert [(r.key, r.code) for r in found] == [("AB_LICEUL_MARE", "3")]


def test_every_own_name_counts_in_the_exact_pass(spark):
    schools = spark.createDataFrame(
        [("Liceul Mare", "AB", "1"), ("Colegiul Nou", "AB", "1"), ("Liceul Mic", "AB", "2")], "nume string, cod_judet string, cod_siiir string"
    )
    for high_school in (True, False):
        for name, code in (("Liceul Mare", "1"), ("Colegiul Nou", "1"), ("Liceul Mic", "2")):
            facts = spark.createDataFrame([(name, "AB")], "n string, c string")
            found = matching.match_schools(facts, "n", "c", schools, None, high_school).collect()
            assert [r.code for r in found] == [code]
    both = spark.createDataFrame([("Liceul Mare", "AB"), ("Colegiul Nou", "AB")], "n string, c string")
    assert [(r.key, r.code) for r in matching.match_schools(both, "n", "c", schools.filter("cod_siiir = '1'")).collect()] == [("AB_COLEGIUL_NOU", "1")]


def test_a_school_without_a_code_gets_none_from_its_neighbour(spark):
    schools = spark.createDataFrame([("Liceul Mare Unu", "AB", None), ("Liceul Mare Doi", "AB", "7")], "nume string, cod_judet string, cod_siiir string")
    facts = spark.createDataFrame([("Liceul Mare Unu", "AB")], "n string, c string")
    assert matching.match_schools(facts, "n", "c", schools).collect() == []
    assert matching.codeless_keys(schools).count() == 1


def test_backfill(spark):
    schools = spark.createDataFrame(
        [("A_AB", "A", None), ("B_AB", "B", None), ("C_AB", "C", "7")], "id string, nume string, cod_siiir string"
    )
    matches = spark.createDataFrame([("AB", "AB_A", "1"), ("AB", "AB_B", "7")], "county string, key string, code string")
    found = matching.backfill_codes(schools, matches)
    assert {(r.id, r.code, r.owner, r.accepted) for r in found.collect()} == {("A_AB", "1", None, True), ("B_AB", "7", "C_AB", False)}
    filled = {r.id: r.cod_siiir for r in matching.apply_backfill(schools, found).collect()}
    assert filled == {"A_AB": "1", "B_AB": None, "C_AB": "7"}


def test_keys_ignore_nulls_and_repeat(spark):
    schools = spark.createDataFrame([("a", "X"), ("A", "X"), (None, "X"), ("a", None)], "n string, c string")
    assert [r.key for r in matching.source_keys(schools, "n", "c").collect()] == ["X_A"]
    assert matching.unmatched_schools(
        schools, "n", "c", spark.createDataFrame([], "county string, key string")
    ).select(F.count("*")).first()[0] == 1


def test_tile_function_needs_no_package_on_executors(tmp_path):
    (tmp_path / "f").write_bytes(cloudpickle.dumps(matching._compare_tile(3)))
    code = (
        "import pickle, pandas as pd; from pyspark import cloudpickle; f = pickle.load(open('f', 'rb'));"
        "k = pd.DataFrame({'county': ['A'], 'key': ['ABC'], 'k': [1]}); n = pd.DataFrame({'alias': ['ABD', 'X'], 'codes': [['1'], ['2']]});"
        "print(f(k, n)['dist'].tolist())"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": ""})
    assert done.stdout.strip() == "[1]", done.stderr

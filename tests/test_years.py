from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from catalog import year_queries
from gradeloom.operators import updates
from gradeloom.plans import loads, years
from gradeloom.sources import contracts
from gradeloom.sources.tables import EmptyBatchError
from gradeloom.sources.years import ConflictError, YearTable
from tests.test_loads import SITE, _bac_site, _en_open_data, _schools

SCHEMA = "an int, cod string, status string, price double"


@pytest.fixture
def rows(spark):
    return lambda *data: spark.createDataFrame(list(data), SCHEMA)


def stored(table, version=None):
    return sorted(tuple(r) for r in table.read(version).select("an", "cod", "status", "price").collect())


def test_versions_are_whole_and_stay(spark, tmp_path, rows):
    table = YearTable(spark, str(tmp_path / "t"))
    assert table.version() == 0 and table.runs().collect() == [] and table.files().collect() == []
    with pytest.raises(EmptyBatchError):
        table.read()
    first = [(1, "a", "x", 1.0), (1, "b", None, 2.0), (2, "a", "y", 3.0)]
    assert table.replace(rows(*first), [1, 2]) == 1
    reader = table.read()
    changed = reader.filter("an = 1 and cod = 'a'").withColumn("status", F.lit("new"))  # reads what it replaces
    assert table.replace(changed, [1]) == 2
    assert stored(table, 1) == sorted(first, key=str) and stored(table) == [(1, "a", "new", 1.0), (2, "a", "y", 3.0)]
    assert reader.count() == 3  # a reader keeps the version it began with
    assert [tuple(r) for r in table.read(years=[2]).select("an", "cod").collect()] == [(2, "a")]
    counts = {(r.version, r.an, r.measure): r.n for r in table.runs().collect()}
    assert counts == {(1, 1, "replaced"): 0, (1, 1, "inserted"): 2, (1, 2, "replaced"): 0, (1, 2, "inserted"): 1, (2, 1, "replaced"): 2, (2, 1, "inserted"): 1}


@pytest.mark.parametrize("bad", [[(3, "a", "x", 1.0)], [(1, "a", "x", 1.0), (2, "b", "x", 1.0)], [(1, "a", "x", 1.0), (None, "b", "x", 1.0)], []])
def test_bad_years_change_nothing(spark, tmp_path, rows, bad):
    table = YearTable(spark, str(tmp_path / "t"))
    table.replace(rows((1, "a", "x", 1.0), (2, "a", "x", 1.0)), [1, 2])
    with pytest.raises(Exception, match="rows of another year|no rows for"):
        table.replace(rows(*bad), [1])
    assert table.version() == 1 and len(stored(table)) == 2


@pytest.mark.parametrize("dies_in", ["_write", "_publish", "files"])
def test_a_job_that_dies_leaves_the_old_version(spark, tmp_path, rows, monkeypatch, dies_in):
    table = YearTable(spark, str(tmp_path / "t"))
    table.replace(rows((1, "a", "x", 1.0)), [1])
    whole = getattr(YearTable, dies_in)

    def dying(self, *args, **more):
        if dies_in == "_write":
            whole(self, *args, **more)  # the files are there, nothing names them
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(YearTable, dies_in, dying)
        with pytest.raises(RuntimeError, match="lost"):
            table.replace(rows((1, "b", "y", 2.0)), [1])
    again = YearTable(spark, str(tmp_path / "t"))
    assert stored(again) == [(1, "a", "x", 1.0)]
    again.replace(rows((1, "c", "z", 3.0)), [1])
    assert stored(again) == [(1, "c", "z", 3.0)] and again.version() == 2


def test_two_writers(spark, tmp_path, rows):
    one, two = (YearTable(spark, str(tmp_path / "t")) for _ in range(2))
    one.replace(rows((1, "a", "x", 1.0), (2, "a", "x", 1.0), (3, "a", "x", 1.0)), [1, 2, 3])
    start = one.version()
    one.replace(rows((1, "a", "one", 1.0)), [1], start)
    assert two.replace(rows((2, "a", "two", 1.0)), [2], start) == 3  # another year: committed on top
    with pytest.raises(ConflictError, match="years \\[1\\] were changed after version 1"):
        two.replace(rows((1, "a", "two", 1.0)), [1], start)
    with pytest.raises(ConflictError):
        years.update_stored(_at(two, start), rows((2, "a", "late", 9.0)), ["an", "cod"])
    assert stored(one) == [(1, "a", "one", 1.0), (2, "a", "two", 1.0), (3, "a", "x", 1.0)]


def _at(table, version):
    """A writer that has not seen later versions yet, until it commits."""
    class Late(YearTable):
        asked = 0

        def version(self):
            self.asked += 1
            return version if self.asked == 1 else super().version()

    return Late(table.spark, table.path)


def test_only_files_with_a_key_are_written_anew(spark, tmp_path):
    table = YearTable(spark, str(tmp_path / "t"))
    base = spark.range(4000).select((F.col("id") % 4).cast("int").alias("an"), F.col("id").cast("string").alias("cod"), F.lit("old").alias("status"), F.col("id").cast("double").alias("price"))
    table.replace(base.repartitionByRange(10, F.col("price")), [0, 1, 2, 3])
    before = {r.file for r in table.files().collect()}
    assert len(before) == 40
    keys = spark.createDataFrame([(0, "4"), (0, "8"), (1, "5"), (2, "77777")], "an int, cod string").withColumn("status", F.lit("new"))
    version, touched = years.update_stored(table, keys, ["an", "cod"])
    assert (version, touched) == (2, 2)
    after = {r.file for r in table.files().collect()}
    assert len(before - after) == 2 and len(before & after) == 38
    expected = updates.update_by_key(base, keys, ["an", "cod"])
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, expected.select(*table.read().columns).collect()))
    assert {(r.an, r.measure): r.n for r in table.runs().filter("version = 2").collect()} == {
        (0, "updated"): 2, (0, "unknown"): 0, (1, "updated"): 1, (1, "unknown"): 0, (2, "updated"): 0, (2, "unknown"): 1}
    batch = spark.createDataFrame([(3, "3", "up", -1.0), (3, "x", "added", -2.0)], SCHEMA)
    assert years.upsert_stored(table, batch, ["an", "cod"], ["price"])[1] == 1
    assert [tuple(r) for r in table.read().filter("price < 0").orderBy("price").collect()] == [(3, "x", "added", -2.0), (3, "3", "old", -1.0)]
    assert table.read().count() == 4001
    none = years.update_stored(table, keys.filter("cod = '77777'"), ["an", "cod"])
    assert none == (4, 0) and table.read().count() == 4001


def test_folded_layers_equal_updates_in_turn(spark):
    base = spark.createDataFrame([(1, "a", "x", 1.0), (1, "b", "x", 2.0), (1, "b", "again", 2.5), (2, "a", "x", 3.0), (2, "c", None, None)], SCHEMA)
    one = spark.createDataFrame([(1, "a", None, 10.0), (1, "zz", "s", 11.0), (2, "a", "s2", None)], SCHEMA)
    two = spark.createDataFrame([(1, "b", None, None), (1, "a", "t", None), (2, "c", None, 7.0)], SCHEMA)
    three = spark.createDataFrame([(1, "a", 99.0)], "an int, cod string, price double")
    layers = [one, two, three]
    found = updates.fold_layers(base, layers, ["an", "cod"], "an")
    expected = base
    for year in (1, 2):  # a load is of one year
        for layer in layers:
            part = layer.filter(F.col("an") == year)
            expected = updates.update_by_key(expected.filter(F.col("an") == year), part, ["an", "cod"]).unionByName(expected.filter(F.col("an") != year))
    assert sorted(map(tuple, found.filter("is_known").select(*base.columns).collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    assert [r.cod for r in found.filter("not is_known").collect()] == ["zz"]
    assert found.filter("is_updated").count() == 5
    with pytest.raises(Exception, match="repeats a key"):
        updates.fold_layers(base, [one.unionByName(one)], ["an", "cod"], "an").collect()


def test_bac_years_are_accepted_or_left_out_whole(spark, tmp_path):
    table = YearTable(spark, str(tmp_path / "bac"))
    raw = _bac_site(spark, {}, {"cod_candidat": "AB101", "nume_unitate": "Gimnaziul Yy", "rezultat": "Absent", "medie": ""})
    both = raw.withColumn("y", F.lit("2023")).unionByName(raw.withColumn("y", F.lit("2024")))
    bad = _bac_site(spark, {"cod_candidat": "AB7", "medie": "1"}).withColumn("y", F.lit("2022"))
    later = _bac_site(spark, {"cod_candidat": "AB101", "lr_init": "9.25", "medie": "8.23"}, {"cod_candidat": "AB999"}).withColumn("y", F.lit("2024"))
    corrections = spark.createDataFrame([(2024, "100")], "an int, cod_candidat string")
    layers = [loads.Layer(both.unionByName(bad), SITE, detect_origin=True), loads.Layer(later, SITE, update=True)]
    report = years.load_bac_years(table, layers, "y", _schools(spark), corrections)
    assert (report.version, report.years, report.left_out) == (1, [2023, 2024], {2022: {"average": 1}})
    found = {(r.an, r.cod_candidat): r for r in table.read().collect()}
    assert set(found) == {(2023, "100"), (2023, "101"), (2024, "100"), (2024, "101")}
    assert found[2024, "100"].unitate_nume is None and found[2023, "100"].unitate_siiir == "0161100011"
    assert (found[2024, "101"].medie, found[2023, "101"].medie) == (D("8.23"), D("8.33"))
    counts = {(r.an, r.measure): r.n for r in table.runs().collect()}
    assert (counts[2024, "updated"], counts[2024, "unknown"], counts[2023, "updated"], counts[2023, "inserted"]) == (1, 1, 0, 2)
    nothing = years.load_bac_years(table, [loads.Layer(bad, SITE)], "y")
    assert nothing.version is None and table.version() == 1
    assert years.load_bac_years(table, [loads.Layer(bad, SITE)], "y", strict=False).left_out == {2022: {"average": 1}}


def test_years_equal_the_loads_of_single_years(spark, tmp_path):
    maps = contracts.MAPPINGS
    open_data = _en_open_data(spark)
    static = spark.createDataFrame(
        [("AB100", "0161110001", "Gimnaziul Y", "AB12", "9", None, "-", None, None, "8.01", None, "8.5"),
         ("AB101", "0161110002", "Gimnaziul Q", "AB", "7", "7.5", "Limba M", "9", None, "8", None, "8.16"),
         ("AB999", "0161110002", "Gimnaziul Y", "AB", "7", None, "-", None, None, "8", None, None)],
        "name string, schoolCode string, school string, county string, ri string, ra string, lmp string, lmi string, lma string, mi string, ma string, mev string",
    )
    placed = spark.createDataFrame(
        [("AB100", "Gimnaziul Y", "8.5", "9.9", "8.78", "<b>Colegiul Z</b><br/>Real", "<b>(1) Mate</b><br/>A/B", "CJ"),
         ("AB101", "Gimnaziul Y", "8.16", "8", "8.13", "<b>Nowhere</b>", "<b>(1) Mate</b><br/>A/B", "CJ")],
        "n string, s string, mev string, mabs string, madm string, h string, sp string, ja string",
    )

    def layers(cut=lambda df: df):
        return [
            loads.Layer(cut(open_data), maps["en_open_data"], keep_first_by=["row"]),
            loads.Layer(cut(static), maps["en_static_site"], update=True, detect_origin=True),
            loads.Layer(cut(placed), maps["admission_static_site"], update=True, detect_placement=True),
        ]

    table, plain = YearTable(spark, str(tmp_path / "en")), str(tmp_path / "plain")
    both = lambda df: df.withColumn("y", F.lit(2022)).unionByName(df.withColumn("y", F.lit(2023)))
    report = years.load_en_years(table, layers(both), "y", _schools(spark))
    assert report.years == [2022, 2023]
    for y in (2022, 2023):
        loads.load_en_year(spark, layers(), y, plain, _schools(spark))
    columns = table.read().columns
    assert sorted(map(str, table.read().collect())) == sorted(map(str, spark.read.parquet(plain).select(*columns).collect()))
    assert sorted(tuple(r) for r in table.notes(1).select("an", "layer", "county", "name", "rows").collect()) == [
        (2022, 2, "CJ", "Nowhere", 1), (2023, 2, "CJ", "Nowhere", 1)]
    # a later load that only updates
    late = years.load_en_years(table, [loads.Layer(both(placed).withColumn("madm", F.lit("7")), maps["admission_static_site"], update=True)], "y")
    assert late.version == 2 and {r.medie_adm for r in table.read().collect()} == {D("7.00")}


def test_layers_are_folded_by_one_value_each(spark):
    """A layer's row of a key is one value of the aggregate, however many columns it has."""
    base = spark.createDataFrame([(1, "a", "x", 1.0), (2, None, "y", 2.0)], SCHEMA)
    layers = [spark.createDataFrame([(1, "a", None, 5.0), (None, "a", "n", 1.0), (2, None, "z", 3.0)], SCHEMA)] * 2
    found = updates.fold_layers(base, layers, ["an", "cod"], "an")
    assert "max_by" not in found._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, found.select(*base.columns, "is_known", "is_updated").collect()), key=str) == [
        (1, "a", "x", 5.0, True, True), (2, None, "y", 2.0, True, False), (2, None, "z", 3.0, False, False)]


def test_records_of_en_years_are_made_once(spark, monkeypatch):
    """Three layers read the joined records, so they are stored."""
    layers = []

    def load(table, found, *args, **kwargs):
        layers.extend(found)
        raise StopIteration

    left, right = spark.createDataFrame([(2020, 1)], "an int, ord long"), spark.createDataFrame([(1, "x")], "ord long, mark string")
    monkeypatch.setattr(year_queries.views, "results", lambda *_: left.join(right, "ord"))
    monkeypatch.setattr(year_queries, "high_schools", lambda *_: None)
    monkeypatch.setattr(year_queries.years, "load_en_years", load)
    with pytest.raises(StopIteration):
        year_queries.en_layered_years(spark, "")
    assert len(layers) == 3
    assert all("Join" not in layer.raw._jdf.queryExecution().optimizedPlan().toString() for layer in layers)

import json

import pytest
from pyspark.sql import functions as F

from gradeloom.operators.rejects import RejectedRowsError, require_valid
from gradeloom.plans.loads import registry_rows
from gradeloom.sources import contracts, readers, tables
from gradeloom.sources.contracts import ContractError


def _write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_quotes_line_breaks_and_bad_lines(spark, tmp_path):
    path = _write(tmp_path / "a.csv", 'id,name\n1,"a, ""b""\nc"\n2,x,y\n3\n4,\n')
    rows = {r["id"]: r for r in readers.read_records(spark, path).collect()}
    assert rows["1"]["name"] == 'a, "b"\nc' and rows["1"][readers.BAD_LINE] is None
    assert rows["2"][readers.BAD_LINE] == "2,x,y" and rows["3"][readers.BAD_LINE] == "3"
    assert rows["4"]["name"] is None and rows["4"][readers.BAD_LINE] is None


def test_repeated_header_is_an_error(spark, tmp_path):
    with pytest.raises(ContractError, match="repeated"):
        readers.read_records(spark, _write(tmp_path / "a.csv", "a,b,a\n1,2,3\n"))


def test_json_keeps_numbers_as_text(spark, tmp_path):
    path = _write(tmp_path / "a.json", '[{"a": 10, "b": null}, {"a": 9.5, "b": "x"}]')
    assert [(r.a, r.b) for r in readers.read_records(spark, path, "json").collect()] == [("10", None), ("9.5", "x")]
    with pytest.raises(ContractError):
        readers.read_records(spark, path, "xml")


def test_many_files(spark, tmp_path):
    one, two = _write(tmp_path / "a.csv", "a,b\n1,2\n"), _write(tmp_path / "b.csv", "b,c\n3,4\n")
    rows = readers.read_many(spark, [one, two]).orderBy("b").collect()
    assert [(r.a, r.b, r.c) for r in rows] == [("1", "2", None), (None, "3", "4")]
    assert rows[0].source_file.endswith("a.csv")
    paths = [_write(tmp_path / f"{i}.json", json.dumps([{"a": i}])) for i in range(2)]
    assert sorted(r.a for r in readers.read_many(spark, paths, "json").collect()) == ["0", "1"]


def _grid(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, c0 string, c1 string, c2 string")


def test_header_promotion(spark):
    grid = _grid(spark, [("Title", None, None), (None, None, None), ("a", "b", "c"), ("1", None, "3"), ("4", "5", "6")])
    assert [tuple(r) for r in readers.promote_header(grid, "n", 2).orderBy("n").collect()] == [(3, "1", None, "3"), (4, "4", "5", "6")]
    with pytest.raises(ContractError, match="no row"):
        readers.promote_header(_grid(spark, [("a", None, None)]), "n", 2)


def test_registry_rows(spark):
    grid = _grid(spark, [("Title", None, None), ("Nr. Crt", "Cod SIIIR unitate", "Data"), ("1", "0162110002", "01/02/2024"), ("2", "12345", "")])
    rows = registry_rows(grid, "n").orderBy("nr_crt")
    assert rows.columns == ["nr_crt", "cod_siiir_unitate", "data", "reject_reasons"]
    assert [tuple(r) for r in rows.collect()] == [("1", "0161110002", "2024-02-01", []), ("2", None, None, ["Cod SIIIR unitate"])]
    with pytest.raises(RejectedRowsError, match="1 rows"):
        require_valid(rows)


def test_typed_csv(spark, tmp_path):
    path = _write(tmp_path / "t.csv", "1.5, x \nabc,  \n")
    rows = readers.read_typed_csv(spark, path, ["n,num", "s,str"]).collect()
    assert [(r.n, r.s) for r in rows] == [(1.5, "x"), (None, None)]
    for name, layout in contracts.OLD_LAYOUTS.items():
        assert len(contracts.parse_layout(layout)) == {
            "old_bac_open_data": 52, "old_bac_site": 29, "old_bac_report": 31, "old_bac_report_2": 31, "old_registry": 10, "old_registry_2": 9,
        }[name]


@pytest.mark.parametrize("lines,problem", [(["a,str", "b"], "line 2"), ([",str"], "empty"), (["a,int"], "kind")])
def test_bad_layouts(lines, problem):
    with pytest.raises(ContractError, match=problem):
        contracts.parse_layout(lines)


def test_registry_json(spark, tmp_path):
    body = {"data": {"content": [{"CODE": "1", "ID_SCHOOL": 5, "NAME": "A"}, {"CODE": "2", "COUNTY": "X"}]}}
    raw = spark.read.json(_write(tmp_path / "r.json", json.dumps(body)), multiLine=True)
    rows = readers.registry_from_json(raw).orderBy("cod").collect()
    assert [(r.cod, r.aux_id, r.denumire, r.judet, r.statut) for r in rows] == [("1", "5", "A", None, None), ("2", None, None, "X", None)]


def test_contracts():
    for name, mapping in contracts.MAPPINGS.items():
        check = contracts.check_bac_mapping if name.startswith("bac") else contracts.check_en_mapping
        assert check(mapping) is mapping
    site, open_data = contracts.MAPPINGS["bac_site"], contracts.MAPPINGS["bac_open_data"]
    for bad in (
        {k: v for k, v in site.items() if k != "medie"}, site | {"x": "y"}, site | {"promotie": "p"},
        {k: v for k, v in site.items() if k != "promotie_anterioara"}, site | {"unitate_siiir": "s"},
        {k: v for k, v in site.items() if k != "unitate_cod_judet"}, open_data | {"unitate_cod_judet": "c"},
    ):
        with pytest.raises(ContractError):
            contracts.check_bac_mapping(bad)
    for bad in ({"unitate_siiir": "s"}, {"cod_candidat": "c"}, {"cod_candidat": "c", "unitate_nume": "n"}):
        with pytest.raises(ContractError):
            contracts.check_en_mapping(bad)
    assert [len(h) for h in contracts.PAGE_HEADERS.values()] == [29, 31, 15, 15]


def test_projection(spark):
    raw = spark.createDataFrame([("1", "2")], "` a.b (x)` string, c string")
    df = contracts.project(raw, {"f": " a.b (x)", "g": " a.b (x)"}, ["f", "g", "h"], ["c"])
    assert [tuple(r) for r in df.collect()] == [("1", "1", None, "2")]
    with pytest.raises(ContractError, match="no column"):
        contracts.project(raw, {"f": "z"}, ["f"])
    assert contracts.normalise_names(raw.toDF("A. b", "C")).columns == ["a_b", "c"]


def test_replace_year(spark, tmp_path):
    path = str(tmp_path / "facts")
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "an int, v string")
    one, two = rows.filter("an = 1"), rows.filter("an = 2")
    assert tables.replace_year(one, path, 1) == {"deleted": 0, "inserted": 2}
    assert tables.replace_year(two, path, 2) == {"deleted": 0, "inserted": 1}
    stored = spark.read.parquet(path).filter("an = 1 and v = 'a'").withColumn("v", F.lit("z"))
    assert tables.replace_year(stored, path, 1) == {"deleted": 2, "inserted": 1}
    assert sorted((r.an, r.v) for r in spark.read.parquet(path).collect()) == [(1, "z"), (2, "c")]
    with pytest.raises(tables.EmptyBatchError):
        tables.replace_year(rows.filter("an = 3"), path, 3)
    for other in (rows, spark.createDataFrame([(1, "q"), (None, "r")], "an int, v string")):
        with pytest.raises(Exception, match=tables.FOREIGN_YEAR):
            tables.replace_year(other, path, 1)
    assert sorted((r.an, r.v) for r in spark.read.parquet(path).collect()) == [(1, "z"), (2, "c")]
    pruned = readers.read_table(spark, path, ["v"], F.col("an") == 2)
    assert [r.v for r in pruned.collect()] == ["c"]


def test_replace_table_from_itself(spark, tmp_path):
    path = str(tmp_path / "dim")
    assert tables.replace_table(spark.range(5).select("id"), path) == 5
    assert tables.replace_table(tables.current_table(spark, path).filter("id > 2"), path) == 2
    assert sorted(r.id for r in tables.current_table(spark, path).collect()) == [3, 4]
    with pytest.raises(tables.EmptyBatchError):
        tables.replace_table(tables.current_table(spark, path).filter("id > 9"), path)
    spark.range(9).select("id").write.parquet(f"{path}/rows-broken-off")  # a version that was never listed
    assert tables.current_table(spark, path).count() == 2


def test_headers_that_differ(spark, tmp_path):
    for name, text in (("x/1.csv", "a,b\n1,2\n"), ("x/2.csv", "b,a\n4,3\n"), ("y/3.csv", "b,a,\"c d\"\n6,5,7\n9,8\n")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    merged = readers.read_many(spark, [str(tmp_path / "x"), str(tmp_path / "y")])
    assert sorted((r.a, r.b, r["c d"], r[readers.BAD_LINE]) for r in merged.collect()) == [("1", "2", None, None), ("3", "4", None, None), ("5", "6", "7", None), ("8", "9", None, "9,8")]
    with pytest.raises(Exception, match="header"):
        readers.read_records(spark, str(tmp_path / "x")).collect()
    (tmp_path / "x" / "4.csv").write_text('a,"b\nc"\n1,2\n')
    with pytest.raises(ContractError, match="line break"):
        readers.read_many(spark, [str(tmp_path / "x")])


def test_json_array(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1, "b": null},\n {"a": "x", "b": 2.50}]')
    read = readers.read_many(spark, [str(tmp_path / "a.json")], "json")
    assert sorted((r.a, r.b, r.source_file.rsplit("/", 1)[1]) for r in read.collect()) == [("1", None, "a.json"), ("x", "2.50", "a.json")]


def test_numbers_of_typed_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text("9.5d,x\nNaN,y\n 1e1 ,z\n-3,\n")
    read = readers.read_typed_csv(spark, str(tmp_path / "t.csv"), ["n,num", "s,str"])
    assert [(r.n, r.s) for r in read.collect()] == [(None, "x"), (None, "y"), (10.0, "z"), (-3.0, None)]


def test_csv_and_json_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(2, 1, 'q"\n', "x"), (1, 2, " b ", "y"), (1, 1, None, "z")], "page_no int, row_no int, v string, w string")
    tables.write_csv(rows, str(tmp_path / "csv"), ["page_no", "row_no"])
    assert [r.v for r in readers.read_records(spark, str(tmp_path / "csv")).collect()] == [None, " b ", 'q"\n']
    tables.write_json(rows, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 3

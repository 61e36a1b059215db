import json
import random

import pytest
from pyspark.sql import functions as F

from gradeloom.sources import readers
from gradeloom.sources.contracts import ContractError
from gradeloom.sources.pieces import CsvLines, JsonObjects, split_records


@pytest.fixture
def small_pieces(spark):
    """Files are cut every few hundred bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def cell(rand):
    kind = rand.randrange(6)
    if kind == 0:
        return ""
    if kind == 1:
        return "plain" + str(rand.randrange(1000))
    if kind == 2:
        return 'mid"dle'  # a quote inside a plain cell opens nothing
    text = "".join(rand.choice(['a', 'b ', '"', ',', '\n', '\r\n', 'é', '{', '}']) for _ in range(rand.choice([3, 20, 20, 900 if kind == 5 else 5])))
    return '"' + text.replace('"', '""') + '"'


def csv_file(path, seed, rows, end="\n"):
    rand = random.Random(seed)
    lines = ["id,one,two"] + [",".join([str(n), cell(rand), cell(rand)]) for n in range(rows)]
    lines[rows // 2:rows // 2] = ["too,short", "", '"a","b","c","d"']
    path.write_bytes((end.join(lines) + end).encode())


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize(("seed", "end"), [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_split_csv_equals_whole_files(spark, tmp_path, small_pieces, seed, end):
    for n in range(3):
        csv_file(tmp_path / f"{n}.csv", 10 * seed + n, 120, end)
    whole = readers.read_records(spark, str(tmp_path))
    parts = readers.read_records(spark, str(tmp_path), split=True)
    assert parts.columns == whole.columns == ["id", "one", "two", readers.BAD_LINE]
    assert parts.rdd.getNumPartitions() > 20  # many tasks a file
    assert rows_of(parts) == rows_of(whole)


def test_records_are_numbered_in_order(spark, tmp_path, small_pieces):
    csv_file(tmp_path / "a.csv", 7, 200)
    found = split_records(spark, str(tmp_path), CsvLines()).orderBy("file", "start", "place").collect()
    assert "\n".join(r.value for r in found) + "\n" == (tmp_path / "a.csv").read_bytes().decode()


def test_headers_are_checked(spark, tmp_path, small_pieces):
    (tmp_path / "a.csv").write_text('﻿x,"y,z"\n1,2\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text('x,"y,z"\n3,"4\n5"\n')
    (tmp_path / "empty.csv").write_text("")
    assert sorted(tuple(r) for r in readers.split_csv(spark, str(tmp_path)).collect()) == [("1", "2", None), ("3", "4\n5", None)]
    (tmp_path / "c.csv").write_text("x,w\n6,7\n")
    with pytest.raises(ContractError, match="2 different headers"):
        readers.split_csv(spark, str(tmp_path))
    with pytest.raises(Exception, match="another header"):
        readers.split_csv(spark, str(tmp_path), ["x", "y,z"]).collect()


def test_headers_of_large_files_take_a_few_bytes(spark, tmp_path, monkeypatch):
    asked = []
    first = readers._first_lines
    monkeypatch.setattr(readers, "_first_lines", lambda spark, paths, most=readers.HEADER_BYTES: asked.append((len(paths), most)) or first(spark, paths, most))
    (tmp_path / "a.csv").write_text("x,y\n" + "1,2\n" * 200_000)
    (tmp_path / "b.csv").write_text("y,z\n3,4\n")
    merged = readers.read_many(spark, [str(tmp_path)])
    assert asked == [(2, readers.HEADER_BYTES)] and merged.count() == 200_001
    with pytest.raises(ContractError, match="longer than 3 bytes"):
        first(spark, [f"file://{tmp_path}/a.csv"], 3)


def json_value(rand, depth):
    kind = rand.randrange(7 if depth else 4)
    if kind < 2:
        return "".join(rand.choice(['a', '"', '\\', '{', '}', '[', ']', ' ', 'é', '\n', ',']) for _ in range(rand.choice([2, 10, 400 if depth == 2 else 4])))
    if kind == 2:
        return rand.randrange(1000)
    if kind == 3:
        return None
    if kind == 4:
        return [json_value(rand, depth - 1) for _ in range(rand.randrange(4))]
    return {f"k{n}": json_value(rand, depth - 1) for n in range(rand.randrange(4))}


@pytest.mark.parametrize(("seed", "indent"), [(1, None), (2, None), (3, 2), (4, 2)])
def test_json_objects_of_cut_arrays(spark, tmp_path, small_pieces, seed, indent):
    rand, expected = random.Random(seed), []
    for n in range(3):
        objects = [{"id": f"{n}-{i}", "v": json_value(rand, 3), "w": json_value(rand, 2)} for i in range(60)]
        expected += objects
        (tmp_path / f"{n}.json").write_text(json.dumps(objects, indent=indent, ensure_ascii=False), encoding="utf-8")
    found = split_records(spark, str(tmp_path), JsonObjects())
    assert found.rdd.getNumPartitions() > 20
    key = lambda o: o["id"]
    assert sorted((json.loads(r.value) for r in found.collect()), key=key) == sorted(expected, key=key)


def test_json_array_records(spark, tmp_path, small_pieces):
    objects = [{"name": f"AB{n}", "note": 'a } "quoted" ] {', "inner": {"x": [1, {"y": n}]}, "line": "one\ntwo"} for n in range(200)]
    (tmp_path / "a.json").write_text(json.dumps(objects))
    (tmp_path / "none.json").write_text("[]")
    whole = readers.read_records(spark, str(tmp_path), "json")
    parts = readers.read_records(spark, str(tmp_path), "json", split=True)
    assert parts.dtypes == whole.dtypes and rows_of(parts) == rows_of(whole)
    assert dict(parts.dtypes)["inner"].startswith("struct")


def test_registry_responses(spark, tmp_path, small_pieces):
    schools = [{"CODE": n, "ID_SCHOOL": n + 1, "NAME": f"S{n} }}", "COUNTY": {"not": "text"} if n == 900 else "AB"} for n in range(100)]
    (tmp_path / "r.json").write_text(json.dumps({"status": {"ok": True}, "data": {"page": {"n": [1]}, "content": schools, "more": {"a": 1}}}))
    found = readers.read_registry(spark, str(tmp_path))
    response = spark.read.json(str(tmp_path), multiLine=True, primitivesAsString=True)
    assert rows_of(found) == rows_of(readers.registry_from_json(response)) and found.count() == 100


def test_quotes_and_strings_over_many_pieces(spark, tmp_path, small_pieces):
    long = 'start ""' + "x,\n" * 2_000 + '"" end'
    (tmp_path / "a.csv").write_text(f'a,b\n1,"{long}"\n2,"{long}"\n3,z\n')
    assert rows_of(readers.split_csv(spark, str(tmp_path))) == rows_of(readers.read_records(spark, str(tmp_path)))
    folder = tmp_path / "json"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps([{"a": "}{" * 3_000}, {"b": {"c": ["}"] * 1_000}}, {"d": 1}]))
    found = split_records(spark, str(folder), JsonObjects()).select(F.length("value").alias("n")).collect()
    assert sorted(r.n for r in found)[0] == len('{"d": 1}') and len(found) == 3
